"""One row of each group of near duplicates stays, with ids that are missing or repeated too."""

from collections import Counter


def test_rows_without_id_and_repeated_ids(spark):
    import corpus_pipeline as pipeline

    def text(name, changed=0):
        return " ".join([f"{name}{i}" for i in range(60 - changed)] + [f"new{i}" for i in range(changed)])

    rows = [(None, text("a")), (None, text("a")), (None, text("a", 2))]
    rows += [(4, text("b")), (4, text("b")), (None, text("b", 1)), (9, text("b"))]
    # Id 4 again, with a text of its own, and a copy of that under another id.
    rows += [(4, text("c")), (3, text("c")), (3, text("c", 2))]
    rows += [(None, ""), (None, None), (7, " "), (7, " ")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).repartition(3)
    kept = pipeline.near_duplicates(spark, docs, "").collect()
    name = {None: None, "": "", " ": " "}
    got = Counter((r.doc_id, name.get(r.text, r.text and r.text[:1])) for r in kept)
    assert got == Counter([(None, "a"), (4, "b"), (3, "c"), (None, ""), (None, None), (7, " "), (7, " ")])
