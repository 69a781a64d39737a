"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.store import partitions
from skyfare.llm.words import chunks, mix, shingle_hashes

BINS = 512
BITS = 4
#: Place of rows without id, after all others.
NO_ID = -(1 << 63)
_RANDOM = np.random.default_rng(7)
#: The bins an empty bin asks, in its own random order, until one that was filled by a shingle answers.
_PROBES = np.stack([_RANDOM.permutation(BINS) for _ in range(BINS)]).astype(np.int64)

_SALTS = _RANDOM.integers(0, 1 << 63, BINS, dtype=np.uint64)


def sketches(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed fingerprints, one row of bytes for each text, and which texts have any shingle.

    All shingle hashes of a text are binned once by their high bits and each bin keeps its least.
    An empty bin copies from the first filled bin in its own random order of bins.
    """
    packed, full = [], []
    for _, _, data, offsets in chunks(texts):
        hashes, bounds = shingle_hashes(data, offsets)
        n = len(offsets) - 1
        doc = np.repeat(np.arange(n), np.diff(bounds))
        cell = doc * BINS + (hashes >> np.uint64(64 - 9)).astype(np.int64)
        # Hashes ascend within a text, so the first of a run of equal cells is the least.
        least = np.ones(len(cell), bool)
        least[1:] = cell[1:] != cell[:-1]
        values = np.zeros(n * BINS, np.uint64)
        filled = np.zeros(n * BINS, bool)
        values[cell[least]] = hashes[least]
        filled[cell[least]] = True
        some = np.diff(bounds) > 0
        empty = np.flatnonzero(~filled.reshape(n, BINS) & some[:, None])
        for attempt in range(BINS):
            if not len(empty):
                break
            asked = empty - empty % BINS + _PROBES[empty % BINS, attempt]
            found = filled[asked]
            values[empty[found]] = values[asked[found]]
            empty = empty[~found]
        # Bits depend on the bin as well, else copies of one value would agree by chance together.
        values = mix(values.reshape(n, BINS) + _SALTS) & np.uint64((1 << BITS) - 1)
        values = values.astype(np.uint8) * some[:, None]
        packed.append(values[:, 0::2] << BITS | values[:, 1::2])
        full.append(some)
    if not packed:
        return np.zeros((0, BINS // 2), np.uint8), np.zeros(0, bool)
    return np.concatenate(packed), np.concatenate(full)


def likeness(a: np.ndarray, b: np.ndarray, a_full: np.ndarray, b_full: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of paired fingerprints, from 0 to 1.

    Low bits of different shingles agree by chance once in 2 ** BITS, which is taken out. Two texts
    without shingles are alike; one without and one with are not.
    """
    same = ((a >> BITS) == (b >> BITS)).sum(1) + ((a & 15) == (b & 15)).sum(1)
    chance = 1 / (1 << BITS)
    out = np.clip((same / BINS - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_full & b_full, out, (a_full == b_full).astype(float))


def _hex(row: np.ndarray, full: bool) -> str:
    return row.tobytes().hex() if full else ""


def fingerprinted(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with a column ``name``: hex of BINS values of BITS bits, '' for a text without words.

    NULL counts as empty. Equal texts get equal fingerprints. A column called ``name`` is replaced.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        rows, full = sketches(pa.Array.from_pandas(texts, type=pa.string()))
        return pd.Series([_hex(r, f) for r, f in zip(rows, full)], dtype=object)

    return docs.withColumn(name, run(F.col(text)))


def _routes(rows: DataFrame) -> tuple[np.ndarray, dict[tuple[int, int], int]]:
    """Splitters of the places, and to which bucket the first row of another bucket goes as well.

    Both are at most as long as the session's shuffle width. A place with many rows is found several times.
    """
    buckets = partitions(rows.sparkSession)
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.approxQuantile("place", shares, 1 / (4 * buckets)) if shares else []
    splitters = np.sort(np.array(found, dtype=np.float64).astype(np.int64))
    heads = _bucketed(rows.select("place", "hash"), splitters, {}).groupBy("bucket")
    heads = sorted((r.bucket, (r.head.place, r.head.hash)) for r in heads.agg(F.max(F.struct("place", "hash")).alias("head")).collect())
    used = [b for b, _ in heads]
    return splitters, {head: used[(i + 1) % len(used)] for i, (_, head) in enumerate(heads)}


def _bucketed(rows: DataFrame, splitters: np.ndarray, also: dict[tuple[int, int], int]) -> DataFrame:
    """``rows`` with ``bucket``, ascending by place; a place that is a splitter r times has r buckets, by hash."""

    @F.pandas_udf("array<int>")
    def buckets(places: pd.Series, hashes: pd.Series) -> pd.Series:
        low = np.searchsorted(splitters, places.to_numpy(), "left")
        times = np.searchsorted(splitters, places.to_numpy(), "right") - low
        share = (hashes.to_numpy().astype(np.float64) / 2.0**64 + 0.5) * times
        own = (low + np.minimum(times, 1 + share.astype(np.int64))).tolist()
        keys = zip(places.tolist(), hashes.tolist())
        return pd.Series([[b, also[k]] if k in also else [b] for b, k in zip(own, keys)])

    return rows.select("*", F.posexplode(buckets("place", "hash")).alias("copy", "bucket"))


def edited_by_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to each other and the next.

    Documents are ordered by descending id; after the last comes the first. The last third of the
    code points (rounded down) of a text gives way to as many from the start of the next text.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    NULL texts are empty; NULL ids come last, rows of one id in the order of a hash of their texts. A table with
    one row has itself as next; an empty one gives an empty result. Other columns are left out.

    Rows are dealt once, into ranges of ids between sampled splitters, and each range reads on into
    the next by one row: the first of every range is sent to the range before it as well. Rows of one id,
    or without, are dealt to several ranges if there are many; only rows of one id and text stay together.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("place"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    splitters, also = _routes(rows)
    ranged = _bucketed(rows, splitters, also).repartitionById(partitions(docs.sparkSession), F.col("bucket"))
    ordered = ranged.sortWithinPartitions("bucket", "copy", F.col("place").desc(), F.col("hash").desc(), "text")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def compared(run: list[tuple]) -> pa.RecordBatch | None:
        """All rows of ``run`` but the last, each with the one after it; a copy only follows."""
        here = [i for i in range(len(run) - 1) if not run[i][1] and run[i][0] == run[i + 1][0]]
        if not here:
            return None
        texts = [r[3] for r in run]
        edited = [texts[i][: len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][: len(texts[i]) // 3] for i in here]
        own, own_full = sketches(pa.array(texts, pa.string()))
        new, new_full = sketches(pa.array(edited, pa.string()))
        at = np.array(here)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([run[i][2] for i in here], pa.int64()),
                pa.array([len(texts[i]) for i in here], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                pa.array([_hex(own[i], own_full[i]) for i in here]),
                pa.array([_hex(r, f) for r, f in zip(new, new_full)]),
                pa.array(likeness(own[at], new, own_full[at], new_full)),
                pa.array(likeness(own[at], own[at + 1], own_full[at], own_full[at + 1])),
            ],
            [c.split(" ")[0] for c in schema.split(", ")],
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")]):
                run.append(row)
                size += len(row[3])
                if len(run) > 1 and (size > 1 << 20 or len(run) > 2000):
                    if (out := compared(run)) is not None:
                        yield out
                    run, size = run[-1:], len(row[3])
        if (out := compared(run)) is not None:
            yield out

    return ordered.select("bucket", "copy", "doc_id", "text").mapInArrow(walk, schema)
