"""Web-corpus analytics as Spark DataFrame jobs."""
