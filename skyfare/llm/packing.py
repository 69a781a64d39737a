"""Best-fit packing of documents into bins, with conflicts of sources and of duplicate clusters.

Documents are dealt into shards of bounded size by a hash of their id, their text and, of equal rows, a number, so
bins do not depend on how the table is partitioned. A shard keeps its open bins
by the room left in them, with a bitmap of the sources and one of the duplicate clusters that each bin
holds. The largest piece goes first; the search goes on from the tightest bin that has room to the
next, until one holds neither the piece's source nor its cluster.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.llm.mixing import n_words
from skyfare.llm.ngram_join import grouped
from skyfare.llm.store import stored

#: Pieces of a shard on average, however short they are.
SHARD_PIECES = 20_000
PLACED = "doc_id long, piece int, first_token long, n_tokens long, bin_id string, offset long"


def best_fit(items: Iterable[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item (size, source, cluster), whose sizes descend.

    A None source or cluster is in conflict with nothing.
    """
    source_bit: dict[object, int] = {None: 0}
    cluster_bit: dict[object, int] = {None: 0}
    open_bins: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    held: list[list[tuple[int, int]]] = []
    # Open bins with a source or cluster; where all have it, there is nothing to search.
    with_source: dict[int, int] = {}
    with_cluster: dict[int, int] = {}
    placed = []
    for size, source, cluster in items:
        s = source_bit.setdefault(source, 1 << len(source_bit))
        c = cluster_bit.setdefault(cluster, 1 << len(cluster_bit))
        at = bisect_left(open_bins, (size, -1))
        if max(with_source.get(s, 0), with_cluster.get(c, 0)) == len(open_bins):
            at = len(open_bins)
        while at < len(open_bins) and (sources[open_bins[at][1]] & s or clusters[open_bins[at][1]] & c):
            at += 1
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            room, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
            held.append([])
        placed.append((b, capacity - room))
        sources[b] |= s
        clusters[b] |= c
        held[b].append((s, c))
        if room > size:
            insort(open_bins, (room - size, b))
            changed, by = [(s, c)], 1
        else:
            changed, by = held[b][:-1], -1
        for x, y in changed:
            if x:
                with_source[x] = with_source.get(x, 0) + by
            if y:
                with_cluster[y] = with_cluster.get(y, 0) + by
    return placed


def _shard_packed(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (-r["n_tokens"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["source"] or "", r["cluster"] or "", r["tie"], r["copy"]))
        found = best_fit(((r["n_tokens"], r["source"], r["cluster"]) for r in rows), capacity)
        return pa.table(
            {
                "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                "piece": pa.array([r["piece"] for r in rows], pa.int32()),
                "first_token": pa.array([r["first_token"] for r in rows], pa.int64()),
                "n_tokens": pa.array([r["n_tokens"] for r in rows], pa.int64()),
                "bin_id": pa.array([f"{r['shard']}-{b}" for r, (b, _) in zip(rows, found)], pa.string()),
                "offset": pa.array([o for _, o in found], pa.int64()),
            }
        )

    return run


def shard_of(shards: int) -> Column:
    """The shard of a piece of a row."""
    return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "tie", "copy", "piece"), F.lit(shards))


def packed(
    docs: DataFrame,
    capacity: int = 2048,
    shard_bins: int = 1024,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cluster: Column | None = None,
) -> DataFrame:
    """Where the tokens (words) of each document go: one row per piece, see PLACED.

    A document of more than ``capacity`` tokens gives pieces of that size, which fill bins alone, and a
    rest. No bin holds two pieces of one source or one duplicate cluster (``cluster``, by default
    documents that ``ngram_join.grouped`` links as near copies). Shards hold about ``shard_bins`` bins of tokens each, and
    SHARD_PIECES pieces at most on average, whatever the size of a source or cluster; no bin spans shards.

    A document without tokens (NULL, empty or blank text) gives one row without bin. A NULL source is
    in conflict with nothing, and an id may be NULL. Repeated rows are packed apart, being copies. The bins of a
    table are the same however its rows are dealt out and ordered. An empty table gives an empty result. Other columns are left out.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    columns = {
        "doc_id": F.col(key).cast("long"),
        "source": F.col(source).cast("string"),
        "tokens": n_words(body),
        "tie": F.xxhash64(body),
    }
    if cluster is None:
        rows = grouped(docs, columns, text).withColumn("cluster", F.col("component").cast("string"))
    else:
        rows = docs.select(*[c.alias(n) for n, c in columns.items()], cluster.cast("string").alias("cluster"))
    # Rows that are equal in all that matters are counted before they are numbered; any of them may have any number.
    narrow = rows.groupBy(*columns, "cluster").count()
    narrow = narrow.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count")))).drop("count")
    narrow = stored(narrow, "packing-sizes")
    sums = narrow.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum(F.ceil(F.col("tokens") / capacity)), F.lit(0))
    ).first()
    shards = max(1, -(-sums[0] // (capacity * shard_bins)), -(-sums[1] // SHARD_PIECES))
    pieces = narrow.where("tokens > 0").withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / capacity).cast("int")))
    )
    first = F.col("piece").cast("long") * capacity
    pieces = pieces.select(
        shard_of(shards).alias("shard"),
        "tie",
        "copy",
        "doc_id",
        "piece",
        first.alias("first_token"),
        F.least(F.lit(capacity), F.col("tokens") - first).cast("long").alias("n_tokens"),
        "source",
        "cluster",
    )
    placed = pieces.groupBy("shard").applyInArrow(_shard_packed(capacity), PLACED)
    none = narrow.where("tokens = 0").select(
        "doc_id",
        F.lit(0).alias("piece"),
        F.lit(0).cast("long").alias("first_token"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.lit(None).cast("string").alias("bin_id"),
        F.lit(None).cast("long").alias("offset"),
    )
    return placed.unionByName(none)
