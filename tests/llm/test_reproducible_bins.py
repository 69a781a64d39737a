"""Packing as a whole against a plain version, whatever the partitions of the input."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402


def documents(n=260):
    r = random.Random(n)
    rows = []
    for i in range(n):
        words = " ".join(f"w{r.randrange(3000)}" for _ in range(r.choice([0, 3, 20, 50, 120])))
        rows.append((r.choice([i, i, i, None, 7]), words or r.choice([None, "", " \n"]), r.choice(["a", "b", "c", None]), r.choice([None, "x", f"c{i}", f"d{i % 20}"])))
    return rows + [(None, "same words here " * 12, "a", "x")] * 30 + [(3, "long " * 333, "b", None)]


SCHEMA = "doc_id long, text string, source string, kin string, tie int, copy int, shard int"


def expected(spark, rows, capacity, shard_bins):
    """(doc_id, piece, first_token, n_tokens, bin, offset) of all rows, packed shard by shard."""
    from skyfare.llm.packing import shard_of

    sizes = [len(brute.WORD.findall(t or "")) for _, t, _, _ in rows]
    shards = max(1, -(-sum(sizes) // (capacity * shard_bins)))
    seen, pieces, out = {}, [], []
    for (i, t, s, k), n in zip(rows, sizes):
        seen[i, t, s, k] = copy = seen.get((i, t, s, k), 0) + 1
        if not n:
            out.append((i, 0, 0, 0, None, None))
        pieces += [(i, t or "", copy, p, min(capacity, n - p * capacity), s, k) for p in range(-(-n // capacity))]
    df = spark.createDataFrame(pieces, "doc_id long, text string, copy long, piece int, size long, source string, cluster string")
    df = df.withColumn("tie", F.xxhash64("text")).withColumn("shard", shard_of(shards))
    by = {}
    for x in df.collect():
        by.setdefault(x.shard, []).append(x)
    for shard, held in by.items():
        held.sort(key=lambda x: (-x.size, x.doc_id is None, x.doc_id or 0, x.piece, x.source or "", x.cluster or "", x.tie, x.copy))
        for x, (b, offset) in zip(held, brute.best_fit([(x.size, x.source, x.cluster) for x in held], capacity)):
            out.append((x.doc_id, x.piece, x.piece * capacity, x.size, f"{shard}-{b}", offset))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_bins", [4, 1024])
def test_bins_against_a_plain_version(spark, shard_bins):
    from skyfare.llm.packing import packed

    rows = documents()
    want = expected(spark, rows, 128, shard_bins)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for dealt, width in ((df, "4"), (df.repartition(3), "4"), (df.orderBy(F.xxhash64("text")), "7")):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            got = packed(dealt, 128, shard_bins, cluster=F.col("kin")).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert sorted(map(tuple, got), key=repr) == want


def test_bins_with_near_copies_are_reproducible(spark):
    from skyfare.llm.packing import packed

    df = spark.createDataFrame([(*r, 1, 2, 3) for r in documents(80)], SCHEMA)
    got = [sorted(map(tuple, packed(d, 256, 4).collect()), key=repr) for d in (df, df.repartition(5).orderBy("text"))]
    assert got[0] == got[1]
