from siteloom.operators import dedup, minhash
from siteloom.streaming import arrivals


def test_arrivals(spark, tmp_path):
    text = "the quick brown fox jumps over the lazy dog and runs away from it "
    batches = [
        [(1, "u1", text), (2, "u2", "something else that is not like the others at all")],
        [(3, "u3", text.upper()), (4, "u4", text), (5, "u5", "a third kind of text, quite new in this store of pages")],
    ]
    source, store, progress = (str(tmp_path / name) for name in ("in", "store", "progress"))
    vocab = spark.createDataFrame([(g, n) for n, g in enumerate(["the", "THE", "oth", "qui"])], "gram string, idx long")
    scheme = minhash.Scheme(num_bands=1, num_hash=1)
    for rows in batches:
        spark.createDataFrame(rows, arrivals.ARRIVALS).coalesce(1).write.mode("append").parquet(source)
        arrivals.start(spark, source, store, progress, vocab, scheme, similarity=dedup.matching_blocks(autojunk=True)).awaitTermination()
    pages = {row.page_id: row for row in arrivals.stored_pages(spark, store).collect()}
    assert {page: row.page_type_code for page, row in pages.items()} == {1: "HTML", 2: "HTML", 3: "HTML", 4: "DUPLICATE", 5: "HTML"}
    assert pages[4].html is None and pages[1].batch_id != pages[4].batch_id
    assert [(row.from_page, row.to_page) for row in arrivals.stored_links(spark, store).collect()] == [(1, 4)]
