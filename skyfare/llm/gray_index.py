"""SimHash near-duplicates by a Gray-order hierarchical index.

The fingerprint of a text has 64 bits, each the majority of that bit over the hashes of its four-word
shingles. Two fingerprints are linked if ``most`` bits or fewer differ. With the bits in ``most + 1`` blocks they
agree in one block at least, so fingerprints are dealt out once by each block, and those that agree
there are indexed together:

- They are sorted by Gray rank, so that neighbours differ in few bits.
- Runs of them are nodes, runs of nodes are nodes above. A node has the bits all its fingerprints
  share, as a mask and a pattern; an upper node so factors out what the nodes below have in common.
- The index is joined with itself from the top. A pair of nodes adds the differences of the bits that
  both have come to share on the way down; once they exceed ``most``, both groups are left out whole.
- Groups that are known to be linked with each other are not compared again, so that a group of copies
  gives a tree of links and not all its pairs.

Fingerprints that agree in a block but are too many for one task are dealt out again, by blocks of their
other bits. Links come out as a spanning forest of each task; components join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.llm.components import components
from skyfare.llm.store import partitions, stored
from skyfare.llm.words import LOWER

SHINGLE, SEED, BITS = 4, 42, 64
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 15
#: Bits that may differ within a group that is not dealt out again.
LAST_BITS = 20
#: Fingerprints or nodes below a node, and pairs of nodes taken down at a time.
FAN, PAIRS = 8, 4096
_LOWER = LOWER.tobytes()
_BIT = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's shingles, repeated ones counted; 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes + 1) - 1
    last = ends[SHINGLE - 1 :].tolist() or [len(joined)]
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip((ends - sizes).tolist(), last)]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = np.array(hashes[at : at + COUNTED], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(_BIT[2 * counts > len(hashes)].sum())


def with_fingerprints(docs: DataFrame, columns: list[Column], text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and ``fingerprint``, as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(batch.num_columns - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], [*batch.schema.names[:-1], "fingerprint"])

    rows = docs.select(*columns, F.col(text).alias("fingerprinted text"))
    kinds = [f"`{c}` {t}" for c, t in rows.dtypes[:-1]]
    return rows.mapInArrow(run, ", ".join([*kinds, "fingerprint long"]))


class Index:
    """The nodes over fingerprints ``x``, which are in Gray order: a pattern and a mask by level.

    ``level[0]`` are the fingerprints themselves, of which all bits are shared.
    """

    def __init__(self, x: np.ndarray):
        patterns, apart = x, np.zeros(len(x), np.uint64)
        self.levels = [(patterns, ~apart)]
        while len(patterns) > FAN:
            first = np.arange(0, len(patterns), FAN)
            head = np.repeat(patterns[first], np.diff(np.append(first, len(patterns))))
            apart = np.bitwise_or.reduceat(apart | (patterns ^ head), first)
            patterns = patterns[first]
            self.levels.append((patterns, ~apart))

    def uniform(self, label: np.ndarray) -> list[np.ndarray]:
        """Per level, the label that all fingerprints of a node have, or -1."""
        low = high = label
        out = [label]
        for patterns, _ in self.levels[1:]:
            first = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            out.append(np.where(low == high, low, -1))
        return out

    def below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of children of pairs of nodes, and which pair each is of."""
        n = len(self.levels[level - 1][0])
        step = np.arange(FAN * FAN)
        of = np.repeat(np.arange(len(a)), FAN * FAN)
        c = a[of] * FAN + np.tile(step // FAN, len(a))
        d = b[of] * FAN + np.tile(step % FAN, len(a))
        real = (c < n) & (d < n) & (c <= d)
        if level == 1:
            real &= c < d
        return c[real], d[real], of[real]


class Labels:
    """Components of fingerprints, numbered, as links come in.

    ``label`` is brought up to date once enough components have been joined; ``find`` is always so.
    """

    def __init__(self, label: np.ndarray):
        self.label = label
        self.parent = list(range(int(label[-1]) + 1 if len(label) else 0))
        self.joins = 0

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Which links (u, v) join two components; those are one from now on."""
        a, b = self.label[u], self.label[v]
        _, first = np.unique(np.minimum(a, b) * len(self.parent) + np.maximum(a, b), return_index=True)
        kept = []
        for i in first.tolist():
            p, q = self.find(int(a[i])), self.find(int(b[i]))
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                kept.append(i)
        self.joins += len(kept)
        return np.array(kept, np.int64)

    def renewed(self) -> bool:
        """Brings ``label`` up to date, unless little has changed."""
        if not self.joins or self.joins * 50 < len(self.parent):
            return False
        now = np.array(self.parent)
        while (now[now] != now).any():
            now = now[now]
        self.parent, self.joins = now.tolist(), 0
        self.label = now[self.label]
        return True


def forest(x: np.ndarray, mask: np.uint64, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions u, v) that connect all of ``x`` that agree under ``mask`` and differ in ``most`` bits at most.

    ``x`` is in order of the bits under ``mask``, then of Gray rank. Other links may be among them.
    """
    near = np.flatnonzero(np.bitwise_count(x[1:] ^ x[:-1]) <= most)
    us, vs = [near], [near + 1]
    fresh = np.ones(len(x), bool)
    fresh[near + 1] = False
    labels = Labels(np.cumsum(fresh) - 1)
    index = Index(x)
    same = index.uniform(labels.label)
    top = len(index.levels) - 1
    a, b = np.triu_indices(len(index.levels[top][0]), 0 if top else 1)
    zeros = np.zeros(len(a), np.uint64)
    stack = [(top, a, b, zeros, zeros)]
    while stack:
        level, a, b, known, apart = stack.pop()
        step = PAIRS if level else PAIRS * FAN * FAN
        if len(a) > step:
            stack += [(level, *(z[at : at + step] for z in (a, b, known, apart))) for at in range(0, len(a), step)]
            continue
        patterns, masks = index.levels[level]
        shared = masks[a] & masks[b]
        differ = patterns[a] ^ patterns[b]
        apart = apart + np.bitwise_count(differ & shared & ~known)
        joined = (same[level][a] == same[level][b]) & (same[level][a] >= 0)
        open_ = (apart <= most) & (differ & shared & mask == 0) & ~joined
        a, b, shared, apart = a[open_], b[open_], shared[open_], apart[open_]
        if not len(a):
            continue
        if level:
            c, d, of = index.below(level, a, b)
            stack.append((level - 1, c, d, shared[of], apart[of]))
            continue
        links = labels.join(a, b)
        us.append(a[links])
        vs.append(b[links])
        if labels.renewed():
            same = index.uniform(labels.label)
    return np.concatenate(us), np.concatenate(vs)


def _joined(most: int, batch_rows: int):
    """Links of rows (mask, bits, fingerprint), sorted, of groups that agree in mask and bits."""

    def links(mask: int, x: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(x)
        u, v = forest(values.view(np.uint64), np.uint64(mask & (1 << BITS) - 1), most)
        return pa.RecordBatch.from_arrays([pa.array(values[u]), pa.array(values[v])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for batch in batches:
            masks, bits, x = (batch.column(c).to_numpy() for c in range(3))
            cuts = np.flatnonzero(np.concatenate(([True], (masks[1:] != masks[:-1]) | (bits[1:] != bits[:-1]))))
            for s, e in zip(cuts.tolist(), np.append(cuts[1:], len(x)).tolist()):
                group = int(masks[s]), int(bits[s])
                if held and group != now and (group[0] != now[0] or size >= batch_rows):
                    yield links(now[0], held)
                    held, size = [], 0
                now = group
                held.append(x[s:e].copy())
                size += e - s
        if held:
            yield links(now[0], held)

    return run


def _blocks(mask: int, most: int) -> list[int]:
    """``mask`` with each of ``most + 1`` blocks of the bits it does not have, as signed numbers."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    out = []
    for k in range(most + 1):
        more = mask
        for i in free[k * len(free) // (most + 1) : (k + 1) * len(free) // (most + 1)]:
            more |= 1 << i
        out.append(more)
    return out


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def gray_rank(bits: Column) -> Column:
    """The number whose Gray code ``bits`` is: each bit is the parity of those from the top to it."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def near_links(fingerprints: DataFrame, most: int = 4, group_rows: int = 2_000_000, batch_rows: int = 50_000) -> DataFrame:
    """Links (u, v) that connect all distinct numbers ``fingerprint`` that differ in ``most`` bits at most.

    Groups of more than ``group_rows`` that agree in a block are dealt out again by blocks of their other bits, until none
    is left or all but LAST_BITS bits agree, when a group has 2 ** LAST_BITS members at most. That takes five turns.
    """
    spark = fingerprints.sparkSession
    fingerprints = fingerprints.select("fingerprint")
    rows, masks, found = fingerprints, [0], []
    while True:
        # ``most + 1`` masks below each, of which there are a few thousand at most, whatever the data.
        below = {m: _blocks(m, most) for m in masks}
        if rows is fingerprints:
            rows = rows.select("fingerprint", F.explode(F.array(*[F.lit(_signed(x)) for x in below[0]])).alias("mask"))
        else:
            finer = spark.createDataFrame([(_signed(m), [_signed(x) for x in more]) for m, more in below.items()], "mask long, finer array<long>")
            rows = rows.join(F.broadcast(finer), "mask").select("fingerprint", F.explode("finer").alias("mask"))
        masks = [x for more in below.values() for x in more]
        rows = rows.withColumn("bits", F.col("fingerprint").bitwiseAND(F.col("mask")))
        large = stored(rows.groupBy("mask", "bits").count().where(F.col("count") > group_rows).select("mask", "bits"), "large-groups")
        none = large.isEmpty() or BITS - max(m.bit_count() for m in masks) <= LAST_BITS
        small = rows if none else rows.join(large, ["mask", "bits"], "left_anti")
        rest = gray_rank(F.col("fingerprint").bitwiseAND(F.bitwise_not("mask")))
        dealt = small.repartition(partitions(spark), "mask", "bits").sortWithinPartitions("mask", "bits", rest)
        dealt = dealt.select("mask", "bits", "fingerprint").mapInArrow(_joined(most, batch_rows), "u long, v long")
        found.append(stored(dealt, "near-links"))
        if none:
            break
        rows = stored(rows.join(large, ["mask", "bits"], "left_semi").select("fingerprint", "mask"), "large-groups")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = 4, group_rows: int = 2_000_000
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits) and component_id, the least id that links reach.

    Two rows are linked if their fingerprints differ in ``most`` bits or fewer. NULL, empty and blank texts
    have fingerprint 0 and are linked like any other; a text of fewer than four words has all its words as
    its only shingle. Repeated rows all stay. A row without id takes part; its component_id is NULL if no
    row of its component has an id. An empty table gives an empty result. Other columns are left
    out, and the id keeps its name.
    """
    members = stored(with_fingerprints(docs, [F.col(key).cast("long").alias("id")], text), "fingerprints")
    distinct = stored(members.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-fingerprints")
    found = components(near_links(distinct.select("fingerprint"), most, group_rows))
    placed = distinct.join(found, distinct.fingerprint == found.node, "left")
    placed = placed.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    # Stored, so that the join can be split where a fingerprint has a large part of all rows.
    ids = stored(placed.join(least, "component").select(F.col("fingerprint").alias("of"), "component_id"), "fingerprint-ids")
    shown = F.lpad(F.lower(F.hex("fingerprint")), BITS // 4, "0")
    return members.join(ids, members.fingerprint == ids.of).select(F.col("id").alias(key), shown.alias("fingerprint"), "component_id")
