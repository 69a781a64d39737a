"""Token counts by byte-pair merging, without emitting identifiers.

Each pre-token begins as a linked list of byte symbols. A heap yields the adjacent pair of lowest
rank (the leftmost of equals); popping it joins two symbols. The count is the initial number of
symbols less the number of merges. Equal pre-tokens are counted once per Python worker.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how the byte-level vocabulary splits a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens kept with their counts by a worker; beyond that the store starts anew.
REMEMBERED = 300_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in plain)
    shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [shown[b] for b in range(256)]


class Vocabulary:
    """Merge ranks and special strings of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in content["model"]["merges"]]
        self.specials = [t["content"] for t in content["added_tokens"]]
        symbol = byte_symbols()
        self.of_byte = list(range(256))
        known = {s: b for b, s in enumerate(symbol)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            made = known.setdefault(a + b, len(known))
            self.merges[known[a], known[b]] = (rank, made)


def count_merged(symbols: bytes, merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Symbols left of a byte string after all merges, lowest rank first and from the left."""
    n = len(symbols)
    if n < 2:
        return n
    value = list(symbols)
    after = [*range(1, n), -1]
    before = list(range(-1, n - 1))
    heap = [
        (found[0], i, value[i], value[i + 1], found[1])
        for i in range(n - 1)
        if (found := merges.get((value[i], value[i + 1])))
    ]
    heapq.heapify(heap)
    count = n
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i]
        if value[i] != a or j < 0 or value[j] != b:
            continue
        value[i], value[j] = made, -1
        after[i] = k = after[j]
        count -= 1
        if k >= 0:
            before[k] = i
            if found := merges.get((made, value[k])):
                heapq.heappush(heap, (found[0], i, made, value[k], found[1]))
        h = before[i]
        if h >= 0 and (found := merges.get((value[h], made))):
            heapq.heappush(heap, (found[0], h, value[h], made, found[1]))
    return count


class Counter:
    """Counts tokens of texts, keeping the counts of pre-tokens seen before."""

    def __init__(self, vocabulary: Vocabulary):
        self.merges = vocabulary.merges
        self.split = regex.compile(PRE_TOKEN).findall
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.seen: dict[str, int] = {}

    def count(self, text: str) -> int:
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        total, seen = 0, self.seen
        for piece in self.split(text):
            n = seen.get(piece)
            if n is None:
                n = count_merged(piece.encode(), self.merges)
                if len(piece) <= 64:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[piece] = n
            total += n
        return total


def count_tokens(
    docs: DataFrame, vocabulary_path: str, limit: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    A NULL or empty text has no bytes and no tokens. Whole texts are counted; special strings of
    the vocabulary inside a text count as one token each. A NULL key and repeated rows stay as
    they are; other columns are left out. The vocabulary is read on the driver and goes to the
    tasks; its size is that of the file, whatever the data.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            texts = batch.column(1)
            counts = [counter.count(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), batch.column(2)],
                ["key", "n_tokens", "n_bytes"],
            )

    # A key whose name clashes with an added column is renamed on the way.
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"key {kind}, n_tokens long, n_bytes long")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
