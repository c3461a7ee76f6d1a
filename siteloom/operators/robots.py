"""Robots texts as tables of groups, rules, delays and sitemap locations.

Input is ``robots(host, content)``, one row per host. Windows here run over the
lines of one robots text, never over the pages of a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.session import materialise

DEFAULT_DELAY = 3
FEW_RULES = 100

# Line ends, and the keys that change the parser's state.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
KEY_VALUE = r"(?s)^([^:]*):(.*)$"
AGENT = "user-agent"
RULES = ("disallow", "allow", "crawl-delay", "request-rate")


def unquote(text: Column) -> Column:
    """Percent-decode; a text with a broken escape stays as it is."""
    # url_decode reads '+' as a blank, so it is protected first.
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), F.coalesce(decoded, text)).otherwise(text)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _lines(robots: DataFrame) -> DataFrame:
    """``(host, line_no, is_break, key, value)`` of every empty line and every key line."""
    split = robots.select("host", F.posexplode(F.split("content", LINE_END)).alias("line_no", "line"))
    text = F.regexp_replace("line", "(?s)#.*$", "")
    cut = split.select(
        "host",
        "line_no",
        (F.col("line") == "").alias("is_break"),
        F.lower(_strip(F.regexp_extract(text, KEY_VALUE, 1))).alias("key"),
        unquote(_strip(F.regexp_extract(text, KEY_VALUE, 2))).alias("value"),
    )
    return cut.where(F.col("is_break") | F.col("key").isin("sitemap", AGENT, *RULES))


def grouped_lines(robots: DataFrame) -> DataFrame:
    """Agent and rule lines with the number of their group.

    A group starts behind an empty line, and at an agent line that does not
    follow another agent line. Groups without an agent or without a rule line are dropped.
    """
    by_line = Window.partitionBy("host").orderBy("line_no")
    state = _lines(robots).where(F.col("is_break") | (F.col("key") != "sitemap"))
    starts = F.col("is_break") | (
        (F.col("key") == AGENT) & (F.coalesce(F.lag("key").over(by_line), F.lit("")) != AGENT)
    )
    flagged = state.withColumn("_start", F.when(starts, 1).otherwise(0))
    numbered = flagged.withColumn("group_no", F.sum("_start").over(by_line)).where(~F.col("is_break"))
    group = Window.partitionBy("host", "group_no")
    is_agent = F.col("key") == AGENT
    return (
        numbered.withColumns(
            {
                "_agents": F.sum(F.when(is_agent, 1).otherwise(0)).over(group),
                "_rules": F.sum(F.when(is_agent, 0).otherwise(1)).over(group),
            }
        )
        .where((F.col("_agents") > 0) & (F.col("_rules") > 0))
        .select("host", "group_no", "line_no", "key", "value")
    )


def rules(robots: DataFrame) -> DataFrame:
    """``(host, group_no, agent, rule_no, allow, path)``: one row per agent and path rule."""
    lines = grouped_lines(robots)
    agents = lines.where(F.col("key") == AGENT).select("host", "group_no", F.col("value").alias("agent"))
    # An empty Disallow allows all; an empty '?' or '#' is no part of a rule.
    paths = lines.where(F.col("key").isin("allow", "disallow")).select(
        "host",
        "group_no",
        F.col("line_no").alias("rule_no"),
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
        urls.join(urls.split("value")).alias("path"),
    )
    return agents.join(paths, ["host", "group_no"]).select(
        "host", "group_no", "agent", "rule_no", "allow", "path"
    )


def any_agent_lines(robots: DataFrame) -> DataFrame:
    """Lines of the one group per host that governs the agent ``*``: the first that names it.

    A group that names an empty agent governs every agent, ahead of the ``*`` group.
    """
    lines = grouped_lines(robots)
    group = Window.partitionBy("host", "group_no")
    is_agent = F.col("key") == AGENT
    star = F.max(is_agent & (F.col("value") == "*")).over(group)
    blank = F.max(is_agent & (F.col("value") == "")).over(group)
    order = F.when(star, F.struct(F.lit(1).alias("after"), "group_no")).when(
        blank, F.struct(F.lit(0).alias("after"), "group_no")
    )
    ranked = lines.withColumn("_order", order)
    first = F.min("_order").over(Window.partitionBy("host"))
    return ranked.withColumn("_first", first).where(F.col("_order") == F.col("_first")).drop("_order", "_first")


def policies(robots: DataFrame) -> DataFrame:
    """One row per host: ordered path rules for ``*``, crawl delay, request rate, sitemap.

    ``rules`` holds the rules of one robots text, so its size is bounded by that text.
    """
    lines = any_agent_lines(robots)
    digits = r"^\s*(\d+)\s*$"
    rate = r"^\s*(\d+)\s*/\s*(\d+)\s*$"

    def last_number(key: str, pattern: str, part: int) -> Column:
        # A number that no int holds is passed over, as any other odd value.
        number = F.regexp_extract("value", pattern, part).try_cast("int")
        valid = (F.col("key") == key) & F.col("value").rlike(pattern) & number.isNotNull()
        return F.max_by(F.when(valid, number), F.when(valid, F.col("line_no")))

    is_path = F.col("key").isin("allow", "disallow")
    rule = F.struct(
        F.col("line_no").alias("rule_no"),
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
        urls.join(urls.split("value")).alias("path"),
    )
    grouped = lines.groupBy("host").agg(
        F.array_sort(F.collect_list(F.when(is_path, rule))).alias("rules"),
        last_number("crawl-delay", digits, 1).alias("crawl_delay"),
        last_number("request-rate", rate, 1).alias("req_num"),
        last_number("request-rate", rate, 2).alias("req_secs"),
    )
    return (
        robots.select("host")
        .distinct()
        .join(grouped, "host", "left")
        .join(sitemap_locations(robots), "host", "left")
        .withColumn("crawl_delay", F.coalesce("crawl_delay", F.lit(DEFAULT_DELAY)))
    )


def sitemap_locations(robots: DataFrame) -> DataFrame:
    """``(host, sitemap_url)``: the last ``Sitemap`` line, whatever stands around it."""
    named = _lines(robots).where(F.col("key") == "sitemap")
    return named.groupBy("host").agg(F.max_by("value", "line_no").alias("sitemap_url"))


def with_permission(pages: DataFrame, robots: DataFrame, *, url: str = "url", few: int = FEW_RULES) -> DataFrame:
    """Add ``host`` and ``allow``: may the agent ``*`` fetch this URL?

    The first rule in file order whose path is a prefix of the URL's path
    decides; without one the page is allowed. A host's rules travel as one array of at most ``few``, so a page
    meets them in one row and no second shuffle by URL is needed. The paths of hosts with more rules are cut at the
    lengths that their host's rules have, and the cuts are joined to the rules by (host, prefix): a path
    costs one row for each length, whatever the number of rules.
    """
    host = pages.withColumn("host", urls.authority(url))
    keyed = host.withColumn("_path", unquote(urls.bare_path(url)))
    whole_path = F.when(F.col("_path") == "", "/").otherwise(F.col("_path"))
    keyed = keyed.withColumn("_path", whole_path)
    rules_ = materialise(policies(robots).select("host", "rules"))  # a row for each host
    long = rules_.where(F.size("rules") > few)
    short = rules_.where(F.size("rules") <= few)

    def tested(rows: DataFrame) -> DataFrame:
        matching = F.filter("rules", lambda rule: F.startswith(F.col("_path"), rule["path"]))
        first = F.try_element_at(matching, F.lit(1))["allow"]
        joined = rows.join(short, "host", "left")
        return joined.withColumn("allow", F.coalesce(first, F.lit(True))).drop("rules", "_path")

    if long.isEmpty():
        return tested(keyed)
    keyed = materialise(keyed)
    verdicts = _by_prefix(keyed.select("host", "_path").distinct(), long)
    many = long.select("host")
    decided = keyed.join(many, "host", "left_semi").join(verdicts, ["host", "_path"], "left")
    decided = decided.withColumn("allow", F.coalesce("allow", F.lit(True))).drop("_path")
    others = tested(keyed.join(many, "host", "left_anti"))
    return others.unionByName(decided)


def _by_prefix(paths: DataFrame, rules_: DataFrame) -> DataFrame:
    """``(host, _path, allow)`` of the paths that some rule of ``(host, rules)`` is a prefix of."""
    each = rules_.select("host", F.inline("rules"))
    first = materialise(each.groupBy("host", F.col("path").alias("prefix")).agg(F.min(F.struct("rule_no", "allow")).alias("rule")))
    lengths = rules_.select("host", F.array_distinct(F.transform("rules", lambda rule: F.length(rule["path"]))).alias("lengths"))
    fitting = F.filter("lengths", lambda n: n <= F.length("_path"))
    cut = paths.join(lengths, "host").select("host", "_path", F.explode(fitting).alias("n"))
    cuts = cut.select("host", "_path", F.substr(F.col("_path"), F.lit(1), F.col("n")).alias("prefix"))
    met = cuts.join(first, ["host", "prefix"]).groupBy("host", "_path").agg(F.min("rule").alias("rule"))
    return met.select("host", "_path", "rule.allow")


def permitted(pages: DataFrame, robots: DataFrame, *, url: str = "url") -> DataFrame:
    """The pages that the agent ``*`` may fetch, with their columns unchanged."""
    tested = with_permission(pages, robots, url=url)
    return tested.where("allow").select(*pages.columns)


def sitemap_choice(hosts: DataFrame, robots: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """``(host, url, content)``: the sitemap that robots name, else ``/sitemap.xml``, else NULL.

    ``hosts`` needs ``(host, scheme)``.
    """
    wanted = hosts.join(sitemap_locations(robots), "host", "left").withColumn(
        "_default", F.concat("scheme", F.lit("://"), "host", F.lit("/sitemap.xml"))
    )
    named = sitemaps.select(F.col("url").alias("sitemap_url"), F.col("content").alias("_named"))
    default = sitemaps.select(F.col("url").alias("_default"), F.col("content").alias("_fallback"))
    found = wanted.join(named, "sitemap_url", "left").join(default, "_default", "left")
    from_robots = F.col("_named").isNotNull()
    return found.select(
        "host",
        F.when(from_robots, F.col("sitemap_url"))
        .when(F.col("_fallback").isNotNull(), F.col("_default"))
        .alias("url"),
        F.coalesce("_named", "_fallback").alias("content"),
    )


def site_rows(urls_seen: DataFrame, robots: DataFrame, sitemaps: DataFrame, site: DataFrame) -> DataFrame:
    """New ``site`` rows ``(domain, robots_content, sitemap_content)`` for hosts not stored yet."""
    seen = urls_seen.select(urls.authority("url").alias("host"), urls.scheme("url").alias("scheme"))
    hosts = seen.groupBy("host").agg(F.min("scheme").alias("scheme"))
    new = hosts.join(site.select(F.col("domain").alias("host")), "host", "left_anti")
    chosen = sitemap_choice(new, robots, sitemaps).select("host", F.col("content").alias("sitemap_content"))
    texts = robots.select("host", F.col("content").alias("robots_content"))
    return chosen.join(texts, "host", "left").select(
        F.col("host").alias("domain"), "robots_content", "sitemap_content"
    )
