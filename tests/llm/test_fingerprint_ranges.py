"""Fingerprints of rows that share an id or have none: dealt to several ranges, each row with the next."""

import hashlib

import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_of_one_id_are_split(spark, shared):
    from skyfare.llm import fingerprints

    rows = [(shared, f"text number {i} " + f"w{i} " * (i % 5)) for i in range(120)] + [(i, f"own {i} words") for i in range(10, 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fingerprints.edited_by_next(df).collect()
    placed = df.select("doc_id", "text", F.xxhash64("text").alias("hash")).collect()
    order = sorted(placed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.hash), reverse=True)
    expected = []
    for here, after in zip(order, order[1:] + order[:1]):
        cut = len(here.text) // 3
        edited = here.text[: len(here.text) - cut] + after.text[:cut]
        expected.append((here.doc_id, len(here.text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((tuple(r[:3]) for r in got), key=str) == sorted(expected, key=str)

    places = df.select(F.coalesce("doc_id", F.lit(fingerprints.NO_ID)).alias("place"), F.xxhash64("text").alias("hash"), "doc_id")
    splitters, also = fingerprints._routes(places)
    dealt = fingerprints._bucketed(places, splitters, also).where("copy = 0")
    sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 120


def test_equal_rows(spark):
    from skyfare.llm.fingerprints import edited_by_next

    df = spark.createDataFrame([(None, "a b c d e f g")] * 9 + [(3, None)], "doc_id long, text string").repartition(4)
    got = edited_by_next(df).collect()
    assert len(got) == 10 and len({r.fingerprint for r in got if r.doc_id is None}) == 1
