"""Suffix-array deduplication of byte strings of 100 and more that repeat in the corpus.

A byte goes if it lies in a 100-byte string that also starts earlier: in a document of smaller id, or
earlier in the same. Rows are told apart by their place, which is the id, and their tie, a hash of the text,
which also is their order. Sorting every suffix would move a hundred times the corpus, so a sparse
suffix array is sorted that still decides every string. In each 100-byte string the 50-byte substring
of least hash, the leftmost of equals, is its anchor. Equal strings have their anchors at the same
place, and the strings of one anchor start next to each other. So a suffix is kept for each anchor, with
the bytes before it that its strings need, and decides some 25 strings at once.

1. Hashes of anchors are counted over all documents; suffixes whose anchor occurs once end here.
2. Each task drops suffixes that repeat one it holds, so that no string is moved often.
3. Splitters sampled from the suffixes deal them into ranges of their leading bytes and, where many
   lead alike, of their place; a bucket is sorted by multikey quicksort, eight bytes at a time, in
   which suffixes that are told apart leave the sort.
4. A run of equal strings may go on in the next bucket. The buckets hand on the strings of their
   first and last anchor, which are compared across boundaries.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.llm.packing_bytes import TOKEN_BITS, pack, unpack
from skyfare.llm.store import partitions, stored
from skyfare.llm.words import _BASE, _BYTE, _INVERSE, chunks, mix, powers

LENGTH, LEAD = 100, 50
SPAN = LENGTH - LEAD + 1
#: Anchors of a block in the count, and suffixes that a task holds before it sends them on.
BLOCK_ANCHORS, HELD = 500_000, 30_000
#: Bytes of texts searched for anchors at a time, of one text at most, and rows of a batch of texts.
SEARCHED, PIECE_BYTES, BATCH_ROWS = 1 << 18, 1 << 20, 1000
#: Documents from which splitters are sampled, and suffixes of each.
SAMPLE_DOCS, SAMPLE_EACH = 2000, 8
#: Documents without id come after ids below this, in order of a hash of their text.
NO_ID = 1 << 62
_SALT = np.uint64(0xA24BAED4963EE407)
_INDEX = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of all 100-byte strings of texts: (place, first and last start of its strings, hash, bounds).

    In order; ``bounds`` has where the anchors of each text begin. All texts together have less than 16 MB.
    """
    n = len(data) - LEAD + 1
    starts_of = np.diff(offsets) - LENGTH + 1
    if n < SPAN or not (starts_of > 0).any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    h = mix((sums[LEAD:] - sums[:-LEAD]) * powers(_INVERSE, n))
    del sums
    # The high bits and the place in one number, whose least is the leftmost least hash.
    least = (h & ~_INDEX) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    counts = np.maximum(starts_of, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    begun = np.cumsum(counts) - counts
    start = np.arange(len(doc)) - begun[doc] + offsets[:-1][doc]
    at = (least[start] & _INDEX).astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    bounds = np.searchsorted(doc[first], np.arange(len(offsets)))
    return at[first], start[first], start[last], h[at[first]], bounds


def text_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``anchors`` for texts of any length, of long ones in overlapping pieces.

    The strings of an anchor at the border of two pieces come in two runs, each compared by itself.
    """
    if len(data) <= PIECE_BYTES:
        return anchors(data, offsets)
    parts, bounds, step = [], [0], PIECE_BYTES
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        count = 0
        for x in range(a, max(b - LENGTH + 1, a), step):
            piece = data[x : min(b, x + step + LENGTH - 1)]
            at, lo, hi, h, _ = anchors(piece, np.array([0, len(piece)]))
            parts.append((at + x, lo + x, hi + x, h))
            count += len(at)
        bounds.append(bounds[-1] + count)
    if not parts:
        return anchors(data[:0], np.zeros(len(offsets), np.int64))
    return *(np.concatenate(c) for c in zip(*parts)), np.array(bounds)


ROW = "bucket int, kind int, block long, a binary, b binary"
TOKENS, OWN, KNOWN, DOCS = range(4)
ANSWER = "block long, kind int, a binary, b binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = zip(*rows) if rows else ((),) * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _counted(buckets: int):
    """Blocks of anchors: hashes for the buckets that count them, and what the block knows itself."""

    def rows(number: int, tokens: np.ndarray, places: list[int], ties: list[int], counts: list[int]) -> Iterator[tuple]:
        block = TaskContext.get().partitionId() << 32 | number
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sizes = np.diff(np.append(starts, len(ranked)))
        twice = np.repeat(sizes > 1, sizes)
        if twice.any():
            yield block % buckets, OWN, block, b"", order[twice].astype(np.uint32).tobytes()
        for kind, some, index in ((KNOWN, ranked[starts[sizes > 1]], None), (TOKENS, ranked[~twice], order[~twice])):
            edges = [((i << TOKEN_BITS) + buckets - 1) // buckets for i in range(buckets + 1)]
            at = np.searchsorted(some, np.array(edges, np.uint64)).tolist()
            for bucket in range(buckets):
                a, b = at[bucket], at[bucket + 1]
                if a < b:
                    own = b"" if index is None else index[a:b].astype(np.uint32).tobytes()
                    yield bucket, kind, block, pack(some[a:b]), own
        yield block % buckets, DOCS, block, np.array([places, ties], np.int64).tobytes(), np.array(counts, np.int64).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, tokens, places, ties, counts = 0, 0, [], [], [], []
        for batch in batches:
            place, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, end, data, offsets in chunks(batch.column(2), SEARCHED):
                _, _, _, h, bounds = text_anchors(data, offsets)
                if not len(h):
                    continue
                tokens.append(mix(h ^ _SALT) >> np.uint64(64 - TOKEN_BITS))
                places += place[first:end].tolist()
                ties += tie[first:end].tolist()
                counts += np.diff(bounds).tolist()
                size += len(h)
                if size >= BLOCK_ANCHORS:
                    yield _batch(list(rows(number, np.concatenate(tokens), places, ties, counts)), ROW)
                    number, size, tokens, places, ties, counts = number + 1, 0, [], [], [], []
        if tokens:
            yield _batch(list(rows(number, np.concatenate(tokens), places, ties, counts)), ROW)

    return run


def _answered(table: pa.Table) -> pa.Table:
    """Which anchors of each block occur twice or more."""
    kinds = table.column("kind").to_numpy()
    blocks = table.column("block").to_numpy()
    a, b = table.column("a"), table.column("b")
    out = [(blocks[i], kinds[i], a[i].as_py(), b[i].as_py()) for i in np.flatnonzero((kinds == OWN) | (kinds == DOCS)).tolist()]
    at = np.flatnonzero(kinds == TOKENS).tolist()
    known = [unpack(a[i].as_py()) for i in np.flatnonzero(kinds == KNOWN).tolist()]
    if at:
        parts = [unpack(a[i].as_py()) for i in at]
        tokens = np.concatenate(parts)
        ranked = np.sort(tokens)
        repeated = np.unique(np.concatenate([ranked[1:][ranked[1:] == ranked[:-1]], *known]))
        place = np.searchsorted(repeated, tokens)
        place[place == len(repeated)] = 0
        wanted = repeated[place] == tokens if len(repeated) else np.zeros(len(tokens), bool)
        first = 0
        for i, part in zip(at, parts):
            own = wanted[first : first + len(part)]
            first += len(part)
            if own.any():
                out.append((blocks[i], OWN, b"", np.sort(np.frombuffer(b[i].as_py(), np.uint32)[own]).tobytes()))
    return pa.Table.from_batches([_batch(out, ANSWER)])


NUMBERS = "place long, tie long, numbers binary"


def _by_document(table: pa.Table) -> pa.Table:
    """The repeated anchors of each document of a block, by their number in it."""
    kinds = table.column("kind").to_numpy()
    a, b = table.column("a"), table.column("b")
    found = [np.frombuffer(b[i].as_py(), np.uint32) for i in np.flatnonzero(kinds == OWN).tolist()]
    out = []
    if found:
        found = np.unique(np.concatenate(found)).astype(np.int64)
        docs = int(np.flatnonzero(kinds == DOCS)[0])
        places, ties = np.frombuffer(a[docs].as_py(), np.int64).reshape(2, -1)
        bounds = np.concatenate(([0], np.cumsum(np.frombuffer(b[docs].as_py(), np.int64))))
        cut = np.searchsorted(found, bounds)
        for d in np.flatnonzero(np.diff(cut)).tolist():
            out.append((places[d], ties[d], (found[cut[d] : cut[d + 1]] - bounds[d]).astype(np.uint32).tobytes()))
    return pa.Table.from_batches([_batch(out, NUMBERS)])


#: A row: its place and its tie.
Row = tuple[int, int]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Row, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bytes, anchors, first starts, last starts) of documents (place, tie, packed, numbers)."""
    opened = zstandard.ZstdDecompressor()
    for batch in batches:
        for place, tie, packed, numbers in zip(*batch.columns):
            text = opened.decompress(packed.as_py())
            data = np.frombuffer(text, np.uint8)
            at, lo, hi, _, _ = text_anchors(data, np.array([0, len(data)]))
            own = np.frombuffer(numbers.as_py(), np.uint32)
            yield (place.as_py(), tie.as_py()), text, at[own], lo[own], hi[own]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, text, at, _, _ in _suffixes(batches):
        some = at[np.unique(np.linspace(0, len(at) - 1, SAMPLE_EACH).astype(int))] if len(at) else at
        yield _batch([(*row, text[i : i + LEAD]) for i in some.tolist()], "place long, tie long, lead binary")


PIECE = "bucket int, place long, tie long, start long, size long, anchor int, piece binary"


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as disjoint ones that do not touch, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate(([True], starts[1:] > ends[:-1]))
    last = np.append(np.flatnonzero(fresh)[1:], len(starts)) - 1
    return starts[fresh], ends[last]


def _dealt(splitters: list[tuple[bytes, int, int]], buckets: int):
    """Suffixes with their bucket, and the intervals of those that repeat one the task holds."""

    def flush(held: dict, gone: dict[Row, list[tuple[int, int]]]) -> pa.RecordBatch:
        rows = []
        for (piece, anchor), (place, tie, start) in held.items():
            bucket = bisect_right(splitters, (piece[anchor : anchor + LEAD], place, tie))
            rows.append((bucket, place, tie, start, len(piece), anchor, piece))
        for (place, tie), spans in gone.items():
            lo, hi = _merged(*np.array(spans, np.int64).T)
            rows += [((place ^ tie) % buckets, place, tie, s, e - s, 0, None) for s, e in zip(lo.tolist(), hi.tolist())]
        held.clear()
        gone.clear()
        return _batch(rows, PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, int], tuple[int, int, int]] = {}
        gone: dict[Row, list[tuple[int, int]]] = {}
        lost = 0
        for row, text, at, lo, hi in _suffixes(batches):
            for a, s, e in zip(at.tolist(), lo.tolist(), (hi + LENGTH).tolist()):
                piece = (text[s:e], a - s)
                mine = (*row, s)
                first = held.setdefault(piece, mine)
                if first != mine:
                    if mine < first:
                        held[piece], first, mine = mine, mine, first
                    gone.setdefault(mine[:2], []).append((mine[2], mine[2] + e - s))
                    lost += 1
                if len(held) + lost >= HELD:
                    yield flush(held, gone)
                    lost = 0
        yield flush(held, gone)

    return run


def multikey(n: int, word: Callable[[int, np.ndarray], np.ndarray], words: int, state=None):
    """Multikey quicksort of ``n`` keys by eight bytes at a time: (order, label, unresolved positions).

    ``word(k, rows)`` gives word k of keys. Every round sorts, within their runs, the keys that are
    equal so far by their next word; a key alone in its run leaves the sort. ``label`` is where
    the run of each position begins.
    """
    order, label, active = state or (np.arange(n), np.zeros(n, np.int64), np.arange(n))
    for k in range(words):
        if len(active) < 2:
            break
        rows, run = order[active], label[active]
        w = word(k, rows)
        by = np.lexsort((w, run))
        order[active] = rows[by]
        w = w[by]
        fresh = np.concatenate(([True], (w[1:] != w[:-1]) | (run[1:] != run[:-1])))
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(active)))
        label[active] = np.repeat(active[starts], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
    return order, label, active


FOUND = "place long, tie long, start long, size long, string binary"


def _ordered(x: np.ndarray) -> np.ndarray:
    """Signed numbers as unsigned ones of the same order."""
    return x.view(np.uint64) ^ np.uint64(1 << 63)


def _sorted_bucket(table: pa.Table) -> pa.Table:
    """Intervals of a bucket that repeat an earlier string, and the strings of its first and last anchor."""
    table = table.combine_chunks()
    out_place, out_tie, out_start, out_size = ([] for _ in range(4))
    own = np.array(table.column("piece").is_null())
    for column, to in (("place", out_place), ("tie", out_tie), ("start", out_start), ("size", out_size)):
        to.append(table.column(column).to_numpy()[own])
    rows = table.filter(pa.array(~own))
    edge_rows: list[tuple] = []
    n = len(rows)
    if n:
        pieces = rows.column("piece").combine_chunks()
        if isinstance(pieces, pa.ChunkedArray):
            pieces = pieces.chunk(0)
        begin = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + n + 1].astype(np.int64)
        data = pieces.buffers()[2]
        view = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
        size = np.diff(begin)
        begin = begin[:-1]
        place, tie, start, anchor = (rows.column(c).to_numpy().astype(np.int64) for c in ("place", "tie", "start", "anchor"))

        def lead(k: int, r: np.ndarray) -> np.ndarray:
            return view[begin[r] + anchor[r] + min(8 * k, LEAD - 8)].astype(np.uint64)

        def rest(k: int, r: np.ndarray) -> np.ndarray:
            if k == 0:
                return (size[r] << 8 | anchor[r]).astype(np.uint64)
            return view[begin[r] + np.minimum(8 * (k - 1), size[r] - 8)].astype(np.uint64)

        def where(k: int, r: np.ndarray) -> np.ndarray:
            return _ordered((place, tie, start)[k][r])

        order, label, active = multikey(n, lead, (LEAD + 7) // 8)
        leads = label.copy()
        order, label, active = multikey(n, rest, 1 + (2 * LENGTH + 7) // 8, (order, label, active))
        pieces_of = label.copy()
        order, _, _ = multikey(n, where, 3, (order, label, active))
        # A piece equal to an earlier one goes as a whole.
        first = order[pieces_of]
        later = (place[order] != place[first]) | (tie[order] != tie[first]) | (start[order] != start[first])
        gone = order[later]
        out_place.append(place[gone])
        out_tie.append(tie[gone])
        out_start.append(start[gone])
        out_size.append(size[gone])
        # Different pieces of one anchor are compared string by string.
        heads = np.unique(pieces_of)
        run = leads[heads]
        _, at, counts = np.unique(run, return_inverse=True, return_counts=True)
        edge = (run == run[0]) | (run == run[-1])
        chosen = (counts[at] > 1) | edge
        chosen_rows, chosen_runs, chosen_edge = order[heads[chosen]], run[chosen], edge[chosen]
        strings = size[chosen_rows] - LENGTH + 1
        r = np.repeat(chosen_rows, strings)
        j = np.arange(len(r)) - np.repeat(np.cumsum(strings) - strings, strings)
        group = np.repeat(chosen_runs, strings)
        on_edge = np.repeat(chosen_edge, strings)
        base, s_place, s_tie, s_start = begin[r] + j, place[r], tie[r], start[r] + j
        tag = (group << 8 | (anchor[r] - j)).astype(np.uint64)

        def string(k: int, x: np.ndarray) -> np.ndarray:
            return tag[x] if k == 0 else view[base[x] + min(8 * (k - 1), LENGTH - 8)].astype(np.uint64)

        def string_where(k: int, x: np.ndarray) -> np.ndarray:
            return _ordered((s_place, s_tie, s_start)[k][x])

        m = len(r)
        order, label, active = multikey(m, string, 1 + (LENGTH + 7) // 8)
        equal = label.copy()
        order, _, _ = multikey(m, string_where, 3, (order, label, active))
        first = order[equal] if m else order
        later = (s_place[order] != s_place[first]) | (s_tie[order] != s_tie[first]) | (s_start[order] != s_start[first])
        gone = order[later]
        out_place.append(s_place[gone])
        out_tie.append(s_tie[gone])
        out_start.append(s_start[gone])
        out_size.append(np.full(len(gone), LENGTH))
        keep = order[(equal == np.arange(m)) & on_edge[order]] if m else order
        raw = memoryview(data)
        found = zip(s_place[keep].tolist(), s_tie[keep].tolist(), s_start[keep].tolist(), base[keep].tolist())
        edge_rows = [(p, t, s, LENGTH, bytes(raw[b : b + LENGTH])) for p, t, s, b in found]
    places, ties, starts, sizes = (np.concatenate(x).astype(np.int64) for x in (out_place, out_tie, out_start, out_size))
    # Intervals of one document that touch are one.
    by = np.lexsort((starts, ties, places))
    done = []
    places, ties, starts, sizes = places[by], ties[by], starts[by], sizes[by]
    fresh = np.concatenate(([True], (places[1:] != places[:-1]) | (ties[1:] != ties[:-1])))
    cuts = np.flatnonzero(fresh).tolist() if len(places) else []
    for a, b in zip(cuts, [*cuts[1:], len(places)]):
        lo, hi = _merged(starts[a:b], starts[a:b] + sizes[a:b])
        done += [(places[a], ties[a], s, e - s, None) for s, e in zip(lo.tolist(), hi.tolist())]
    return pa.Table.from_batches([_batch(done + edge_rows, FOUND)])


def _packed(columns: list[Column], schema: str, rows: DataFrame) -> DataFrame:
    """Columns and, as ``packed``, the column ``text`` as compressed bytes, to be dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                packed = [packer.compress((t.as_py() or "").encode()) for t in part.column(part.num_columns - 1)]
                names = [*part.schema.names[:-1], "packed"]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary())], names)

    return rows.select(*columns, "text").mapInArrow(run, f"{schema}, packed binary")


def _row(key: str, text: str) -> list[Column]:
    """Place and tie of rows. Rows of one id and one text are one and the same."""
    tie = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit((1 << 63) - 1))
    unnamed = F.lit(NO_ID) + tie.bitwiseAND(F.lit(NO_ID - 1))
    return [F.coalesce(F.col(key).cast("long"), unnamed).alias("place"), tie.alias("tie")]


def _packed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(*_row(key, text), F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return _packed([F.col("place"), F.col("tie"), F.col("id")], "place long, tie long, id long", rows)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(place, tie, start, size): intervals of bytes that repeat an earlier string, possibly overlapping."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    asked = docs.select(*_row(key, text), text).mapInArrow(_counted(buckets), ROW)
    answers = asked.groupBy("bucket").applyInArrow(_answered, ANSWER)
    numbers = answers.groupBy("block").applyInArrow(_by_document, NUMBERS)
    # Rows of one id and text have equal numbers, of which one is enough.
    numbers = stored(numbers.distinct(), "repeated-anchors")
    few = max(1, numbers.count() // SAMPLE_DOCS)
    sample = numbers.where(F.pmod(F.xxhash64("place", "tie"), F.lit(few)) == 0)
    # Some SAMPLE_DOCS rows, of which each is read once, however often it comes.
    found = docs.select(*_row(key, text), F.col(text).alias("text")).join(F.broadcast(sample), ["place", "tie"])
    found = found.groupBy("place", "tie").agg(F.any_value("numbers").alias("numbers"), F.any_value("text").alias("text"))
    found = _packed([F.col("place"), F.col("tie"), F.col("numbers")], NUMBERS, found)
    found = found.select("place", "tie", "packed", "numbers").mapInArrow(_sampled, "place long, tie long, lead binary")
    ranked = sorted((bytes(r.lead), r.place, r.tie) for r in found.collect())
    ranges = 8 * buckets
    splitters = sorted({ranked[i * len(ranked) // ranges] for i in range(1, ranges)}) if ranked else []
    texts = _packed_texts(docs, key, text).drop("id")
    texts = texts.join(numbers, ["place", "tie"]).select("place", "tie", "packed", "numbers")
    dealt = texts.mapInArrow(_dealt(splitters, ranges), PIECE)
    found = stored(dealt.groupBy("bucket").applyInArrow(_sorted_bucket, FOUND), "repeated-spans")
    # Strings of the first and last anchors of buckets, compared across boundaries.
    edges = found.where("string is not null").select("place", "tie", "start", "string")
    at = F.struct("place", "tie", "start")
    firsts = edges.groupBy("string").agg(F.min(at).alias("first"), F.count("*").alias("n"))
    later = edges.join(firsts.where("n > 1"), "string").where(at > F.col("first"))
    spans = found.where("string is null").select("place", "tie", "start", "size")
    return spans.unionByName(later.select("place", "tie", "start", F.lit(LENGTH).cast("long").alias("size")))


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(at, BATCH_ROWS) for at in range(0, batch.num_rows, BATCH_ROWS))


def _cut(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor()
        for batch in _parts(batches):
            spans = batch.column(2)
            bounds = np.concatenate(([0], np.cumsum([0 if s is None else s for s in _lengths(spans)])))
            flat = spans.flatten()
            lows, sizes = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            removed, counts, sums, bytes_of, kept = [], [], [], [], []
            for d, packed in enumerate(batch.column(1)):
                body = opened.decompress(packed.as_py())
                a, b = bounds[d], bounds[d + 1]
                lo, hi = _merged(lows[a:b], lows[a:b] + sizes[a:b])
                parts, at = [], 0
                for s, e in zip(lo.tolist(), hi.tolist()):
                    parts.append(body[at:s])
                    at = e
                parts.append(body[at:])
                rest = b"".join(parts)
                bytes_of.append(len(body))
                removed.append(len(body) - len(rest))
                counts.append(len(lo))
                sums.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_kept else None)
            numbers = [pa.array(x, pa.int64()) for x in (bytes_of, removed, counts)]
            columns = [batch.column(0), *numbers, pa.array(sums, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in RESULT.split(", ")])

    return run


def _lengths(spans: pa.ListArray) -> list[int | None]:
    return spans.value_lengths().to_pylist()


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 and kept.

    Removed is every byte in a 100-byte string that also starts earlier, judged on the input; kept has
    the remaining bytes (NULL unless ``with_kept``), n_spans the number of maximal removed runs.

    NULL and empty texts have no bytes. Rows without id come after all others, in order of a hash
    of their text. Rows of equal id with different texts are documents of their own, in order of a hash of their text; of equal
    texts under one id none is earlier, and none is removed for the other. An empty table gives an empty result. Other columns are left out; the id keeps its name.
    """
    spans = repeated_spans(docs, key, text).groupBy("place", "tie").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    rows = _packed_texts(docs, key, text).join(spans, ["place", "tie"], "left").select("id", "packed", "spans")
    return rows.mapInArrow(_cut(with_kept), RESULT).withColumnRenamed("id", key)
