"""Near copies and repeated rows in packing."""

from collections import Counter


def test_near_copies_do_not_share_a_bin(spark):
    from skyfare.llm import packing

    def text(name, changed):
        return " ".join([f"{name}{i}" for i in range(60 - changed)] + [f"{name}new{changed}x{i}" for i in range(changed)])

    # Four near copies of each text, some without id, all from different sources; three rows fit in a bin.
    rows = [(None if c == 3 else 10 * t + c, text(f"t{t}x", c), f"s{t}x{c}") for t in range(6) for c in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    placed = packing.packed(df, capacity=200).collect()
    assert sum(p.n_tokens for p in placed) == 60 * len(rows)
    held = Counter((p.bin_id, p.doc_id // 10) for p in placed if p.doc_id is not None)
    assert max(held.values()) == 1
    assert max(Counter(p.bin_id for p in placed).values()) == 3


def test_copies_spread_over_shards(spark, monkeypatch):
    from skyfare.llm import packing

    monkeypatch.setattr(packing, "SHARD_PIECES", 100)
    rows = [(None, "a b c", "s")] * 1000 + [(7, "d e f", "s")] * 1000
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    placed = packing.packed(df).collect()
    shards = Counter(p.bin_id.split("-")[0] for p in placed)
    assert len(placed) == 2000 and len(shards) == 20 and max(shards.values()) <= 200
