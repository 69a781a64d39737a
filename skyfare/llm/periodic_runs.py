"""Periodic run detection: a suffix automaton whose suffix links are a link-cut forest.

The states of the automaton of the words so far form a tree by their suffix links. Every state has a
colour, the last place where its strings end; states of one colour in a row towards the root are one
path of a link-cut tree. Appending word i accesses the state of the whole prefix, which takes all paths
to the root and recolours them with i. A path that was last coloured r and whose deepest state
has strings of length L says that the last L words before i also end at r, and not a longer string. If
i - r is at most L, they overlap or touch: a square of period i - r, which cannot begin earlier. Extended
to the right it is a run. Every run of two periods and more is met so, since its period is how far
back its last period ends.

Only stretches of a text that can hold a run are fed to the automaton: in a run of ``least`` words
and three periods all eight-word windows after the first period occur earlier in the text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.words import chunks, mix, word_bounds, word_hashes

#: Words of a window, and the least length of a run in words and in periods.
WINDOW, LEAST_WORDS, LEAST_PERIODS = 8, 24, 3
_PLACES = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
NONE = -1


class Automaton:
    """The suffix automaton of the words appended so far, with its links as a link-cut forest.

    Arrays by state: ``size`` of its longest string, ``link``; ``up``, ``left`` and ``right`` of the splay tree of its
    path, in order of size, where the ``up`` of a tree's root is the state above the path; ``colour`` counts
    at roots of splay trees. A state's first transition is in arrays, others in ``more``.
    """

    def __init__(self) -> None:
        self.size, self.link, self.up, self.left, self.right, self.colour = (array("i", [x]) for x in (0, NONE, NONE, NONE, NONE, NONE))
        self.word, self.to = array("i", [NONE]), array("i", [NONE])
        self.more: dict[int, dict[int, int]] = {}
        self.last = 0
        self.length = 0

    def _state(self, size: int) -> int:
        for values, x in (
            (self.size, size), (self.link, NONE), (self.up, NONE), (self.left, NONE), (self.right, NONE),
            (self.colour, NONE), (self.word, NONE), (self.to, NONE),
        ):
            values.append(x)
        return len(self.size) - 1

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        further = self.more.get(state)
        return NONE if further is None else further.get(word, NONE)

    def _set(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (NONE, word):
            self.word[state], self.to[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def splay(self, x: int) -> None:
        """Makes ``x`` the root of the tree of its path."""
        up, left, right, colour = self.up, self.left, self.right, self.colour

        def rotate(x: int) -> None:
            p = up[x]
            g = up[p]
            if left[p] == x:
                b = right[x]
                left[p], right[x] = b, p
            else:
                b = left[x]
                right[p], left[x] = b, p
            if b >= 0:
                up[b] = p
            up[p], up[x] = x, g
            if g >= 0:
                if left[g] == p:
                    left[g] = x
                elif right[g] == p:
                    right[g] = x
            # Of use if p was the root, as it is in the last turn.
            colour[x] = colour[p]

        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    def append(self, word: int) -> list[tuple[int, int]]:
        """(last end, length) of the paths that the new prefix takes over, longest strings first."""
        at = self.length
        self.length += 1
        new = self._state(at + 1)
        p, target = self.last, NONE
        while p >= 0:
            target = self._next(p, word)
            if target >= 0:
                break
            self._set(p, word, new)
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        elif self.size[target] == self.size[p] + 1:
            self.link[new] = target
        else:
            self.link[new] = self._split(target, p, word)
        self.last = new
        # Access: every path on the way to the root loses what is deeper and joins that of the new state.
        left, right, up, colour = self.left, self.right, self.up, self.colour
        up[new] = self.link[new]
        taken, below, x = [], new, up[new]
        while x >= 0:
            self.splay(x)
            taken.append((colour[x], self.size[x]))
            deeper = right[x]
            if deeper >= 0:
                colour[deeper] = colour[x]
            right[x] = below
            up[below] = x
            below, x = x, up[x]
        colour[below] = at
        return taken

    def _split(self, state: int, p: int, word: int) -> int:
        """A state for the shorter strings of ``state``, put right above it on its path."""
        copy = self._state(self.size[p] + 1)
        self.word[copy], self.to[copy] = self.word[state], self.to[state]
        if state in self.more:
            self.more[copy] = dict(self.more[state])
        self.link[copy] = self.link[state]
        while p >= 0 and self._next(p, word) == state:
            self._set(p, word, copy)
            p = self.link[p]
        self.link[state] = copy
        # Up to now both have ended at the same places, so they have one colour.
        self.splay(state)
        above = self.left[state]
        self.left[copy] = above
        if above >= 0:
            self.up[above] = copy
        self.left[state], self.up[copy] = copy, state
        return copy


def runs_of(words: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of numbered words that are ``least`` and ``periods`` periods long."""
    automaton, n = Automaton(), len(words)
    reached: dict[int, int] = {}
    found = []
    for i, word in enumerate(words):
        for last, length in automaton.append(word):
            period = i - last
            if last < 0 or period > length or reached.get(period, NONE) >= i:
                continue
            end = i + 1
            while end < n and words[end] == words[end - period]:
                end += 1
            reached[period] = end - 1
            start = last - length + 1
            if end - start >= max(least, periods * period):
                found.append((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first word, end) of disjoint stretches that hold every run of LEAST_WORDS and three periods.

    In a run of L words and period q the L - q - 7 windows after the first period occur q words
    earlier. So many windows in a row that have occurred tell an end, and a start half as far back.
    """
    counts = np.diff(bounds)
    if len(starts) < LEAST_WORDS:
        return []
    h = word_hashes(data, starts, ends, lower=False)
    n = len(h) - WINDOW + 1
    doc = np.repeat(np.arange(len(counts)), counts)
    rolled = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        rolled += h[j : j + n] * _PLACES[j]
    whole = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    key = mix(rolled[whole] ^ mix(doc[whole].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    at, ranked = whole[order], key[order]
    again = np.flatnonzero(ranked[1:] == ranked[:-1])
    later, before = at[again + 1], at[again]
    near = (later - before) * LEAST_PERIODS <= counts[doc[later]]
    seen = np.zeros(n + 1, bool)
    seen[later[near]] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([False], seen)).astype(np.int8)))
    out: list[tuple[int, int, int]] = []
    for j, stop in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        if stop - j < LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS - WINDOW + 1:
            continue
        d = int(doc[j])
        first = max(int(bounds[d]), j - (stop - j + WINDOW - 1) // (LEAST_PERIODS - 1))
        end = stop + WINDOW - 1
        # A long stretch may reach back over several.
        while out and out[-1][0] == d and out[-1][2] >= first:
            first, end = min(first, out[-1][1]), max(end, out[-1][2])
            out.pop()
        out.append((d, first, end))
    return out


def text_runs(texts: pa.Array) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """The runs and the words of each text."""
    for _, _, data, offsets in chunks(texts):
        starts, ends, bounds = word_bounds(data, offsets)
        found: dict[int, list[tuple[int, int, int]]] = {}
        raw = data.tobytes()
        for d, first, end in stretches(data, starts, ends, bounds):
            number: dict[bytes, int] = {}
            words = [number.setdefault(raw[a:b], len(number)) for a, b in zip(starts[first:end].tolist(), ends[first:end].tolist())]
            base = first - int(bounds[d])
            found.setdefault(d, []).extend((base + s, length, period) for s, length, period in runs_of(words))
        for d in range(len(offsets) - 1):
            runs = sorted(found.get(d, ()), key=lambda r: (r[0], r[2]))
            yield runs, raw[offsets[d] : offsets[d + 1]].split()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run has after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join(w for w, g in zip(words, np.cumsum(gone).tolist()) if not g)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def with_runs(docs: DataFrame, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` (all by default) with a struct ``periodic``: runs and collapsed.

    runs: (start, length, period) in words, by start and period: maximal stretches of words whose smallest
    period goes three times into them, of 24 words and more. collapsed: the words joined by one
    blank, without those that lie in any run after its first period.

    Words are runs of anything but blank and 0x09 to 0x0D. NULL, empty and blank texts have no
    words, no runs, and an empty collapsed text. Rows of equal content all stay. A text is read as a whole, and the
    automaton takes some 100 bytes for each word of its periodic stretches. An empty table gives an empty result.
    A column called ``periodic`` is replaced.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c != "periodic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, rest = [], []
            for found, words in text_runs(batch.column(batch.num_columns - 1)):
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                rest.append(collapsed(words, found).decode())
            column = pa.StructArray.from_arrays(
                [pa.array(runs, pa.list_(RUN)), pa.array(rest, pa.string())], ["runs", "collapsed"]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], "periodic"])

    rows = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(text).alias("periodic"))
    kinds = [f"`{c.replace('`', '``')}` {t}" for c, t in rows.dtypes[:-1]]
    fields = "runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string"
    return rows.mapInArrow(run, ", ".join([*kinds, f"`periodic` struct<{fields}>"]))
