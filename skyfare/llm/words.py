"""Words and word shingles of whole texts, hashed for a batch of texts at a time.

Texts are UTF-8 bytes. A word is a run of bytes other than blank and 0x09 to 0x0D, so every
other character, Unicode blanks included, belongs to a word. All functions work on one
concatenated byte array with the offsets of the texts, as Arrow holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Bytes of text hashed at a time; one longer text is hashed alone.
CHUNK_BYTES = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n, kept for the next call."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= CHUNK_BYTES + 1:
            _powers[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins and the last ends. NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    wide = texts.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, bytes, offsets) for runs of whole texts of about ``size`` bytes."""
    data, offsets = joined(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where the words of each text begin among them."""
    blank = BLANK[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    before[:1], before[1:] = True, blank[:-1]
    after[-1:], after[:-1] = True, blank[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z as a-z if ``lower``."""
    table = _BYTE[LOWER] if lower else _BYTE
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[data] * powers(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed shingles of each text in ascending order, and each text's bounds.

    A shingle is five successive words in lower case (A-Z). A text with one to four words has
    all its words as its only shingle; one without words has none.
    """
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    counts = np.diff(first)
    n = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.empty(bounds[-1], np.uint64)
    if len(words) >= SHINGLE:
        every = len(words) - SHINGLE + 1
        slid = np.zeros(every, np.uint64)
        for j in range(SHINGLE):
            slid += words[j : j + every] * _PLACE[j]
        whole = counts >= SHINGLE
        place = np.repeat(first[:-1][whole] - bounds[:-1][whole], n[whole])
        at = np.flatnonzero(np.repeat(whole, n))
        out[at] = slid[at + place]
    for d in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        part = words[first[d] : first[d + 1]]
        out[bounds[d]] = (part * _PLACE[: len(part)]).sum(dtype=np.uint64) + np.uint64(len(part))
    out = mix(out)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][n > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))[bounds]
    return out[fresh], kept
