"""Quality rules: fixed rules on word statistics, then robust multivariate outliers.

For each language and source a minimum-covariance-determinant estimate is made from all rows. From
several starts concentration steps are taken: distances under the present centre and scatter, the half of the rows that
are nearest, their centre and scatter, as long as the determinant falls; the least of all is the group's. Its
scatter is made consistent with a normal sample, and blended with that of the group's language by the number of rows.

Every step is two aggregates of partial sums: counts of distances by narrow classes, which tell where half of
the rows are reached, and moments of the rows up to there. So a group with a third of all rows is reduced where its
rows are, and results do not depend on how rows are dealt out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.store import stored
from skyfare.llm.words import BLANK, chunks, mix, word_bounds, word_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper", "n_bangs")
#: Spread below which a statistic is not told apart from its centre, one for each entry of ``vector``.
LEAST_SPREAD = (0.05, 0.04, 0.2, 0.12, 0.05, 0.05)
DIMENSIONS = len(LEAST_SPREAD)
#: Classes of distances in a doubling; classes of a statistic in its least spread.
CLASSES, FINE = 32, 8
#: Share of a normal sample that is rejected. Statistics of clean texts have longer tails.
TAIL = 1e-7
PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_BLANKS = bytes(np.flatnonzero(BLANK).tolist())


def counted(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of whole texts, by the names in COUNTS."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS}
    for first, end, data, offsets in chunks(texts):
        starts, ends, bounds = word_bounds(data, offsets)

        def within(mask: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])

        lead = (data & 0xC0) != 0x80
        parts["n_words"].append(np.diff(bounds))
        parts["word_chars"].append(within(lead & ~BLANK[data]))
        parts["n_symbols"].append(within(_SYMBOL[data]))
        parts["n_upper"].append(within(_UPPER[data]))
        parts["n_bangs"].append(within(data == 33))
        lines, repeated = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            full = [x for x in data[a:b].tobytes().split(b"\n") if x.strip(_BLANKS)]
            lines.append(len(full))
            repeated.append(len(full) - len(set(full)))
        parts["n_lines"].append(np.array(lines))
        parts["n_dup_lines"].append(np.array(repeated))
        parts["n_repeat_words"].append(_repeat_words(data, starts, ends, bounds))
    return {n: np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64) for n, p in parts.items()}


def _repeat_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of three words found twice or more in that text."""
    counts = np.diff(bounds)
    covered = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= 3:
        h = word_hashes(data, starts, ends, lower=False)
        doc = np.repeat(np.arange(len(counts)), counts)
        whole = np.flatnonzero(doc[:-2] == doc[2:])
        three = h[whole] * np.uint64(3) + mix(h[whole + 1]) * np.uint64(5) + mix(mix(h[whole + 2]))
        three = mix(three + mix(doc[whole].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(three)
        same = three[order][1:] == three[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = whole[twice]
        for j in range(3):
            covered[at + j] = 1
    return np.diff(np.concatenate(([0], np.cumsum(covered)))[bounds])


def with_counts(docs: DataFrame, columns: list[str], text: str, name: str) -> DataFrame:
    """``columns`` of ``docs``, with a struct column ``name`` that holds the counts of its text."""
    fields = ", ".join(f"{c}: bigint" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = counted(batch.column(batch.num_columns - 1))
            column = pa.StructArray.from_arrays([pa.array(found[c]) for c in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], name])

    rows = docs.select(*columns, F.col(text).alias("counted text"))
    kinds = [f"`{c.replace('`', '``')}` {t}" for c, t in rows.dtypes[:-1]]
    return rows.mapInArrow(run, ", ".join([*kinds, f"`{name}` struct<{fields}>"]))


def base_failed(s: Column, least_words: int = 50, most_repeated: int = 50) -> Column:
    return (s["n_words"] < least_words) | (100 * s["n_repeat_words"] > most_repeated * s["n_words"])


def vector(s: Column) -> list[Column]:
    """The statistics, transformed so that their spread depends little on their size."""
    words, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    return [
        F.log(chars / words),
        F.sqrt(s["n_symbols"] / chars),
        F.sqrt(s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1))),
        F.sqrt(s["n_repeat_words"] / words),
        F.sqrt(s["n_upper"] / chars),
        F.sqrt(s["n_bangs"] / chars),
    ]


def _distance(at: Column, centre: Column, precision: Column) -> Column:
    d = [at[i] - centre[i] for i in range(DIMENSIONS)]
    terms = [(1 if i == j else 2) * precision[k] * d[i] * d[j] for k, (i, j) in enumerate(PAIRS)]
    return sum(terms[1:], terms[0])


def chi2_share(x: float, degrees: int) -> float:
    """Share of a chi-square variable up to ``x``; ``degrees`` is even."""
    terms = [1.0]
    for i in range(1, degrees // 2):
        terms.append(terms[-1] * x / 2 / i)
    return 1.0 - math.exp(-x / 2) * sum(terms)


def chi2_quantile(tail: float, degrees: int) -> float:
    """Where all but ``tail`` of a chi-square variable is below."""
    low, high = 0.0, 1e4
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if 1.0 - chi2_share(middle, degrees) > tail else (low, middle)
    return low


def consistency(share: float) -> float:
    """By how much the scatter of the nearest ``share`` of a normal sample is too small."""
    if share >= 1.0:
        return 1.0
    return share / chi2_share(chi2_quantile(1.0 - share, DIMENSIONS), DIMENSIONS + 2)


_FLOOR = np.diag(np.square(LEAST_SPREAD))


def _square(values) -> np.ndarray:
    out = np.zeros((DIMENSIONS, DIMENSIONS))
    for (i, j), v in zip(PAIRS, values):
        out[i, j] = out[j, i] = v
    return out


STATE = "g string, start int, n long, m long, centre array<double>, scatter array<double>, precision array<double>, determinant double"


def _estimated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Estimates from scatters (g, start, n, m, centre, scatter); LEAST_SPREAD is added before they are inverted."""
    for groups in batches:
        rows = []
        for r in groups.itertuples(index=False):
            scatter = _square(r.scatter) + _FLOOR
            inverse = np.linalg.inv(scatter)
            rows.append((r.g, r.start, r.n, r.m, r.centre, r.scatter, [inverse[p] for p in PAIRS], np.linalg.det(scatter)))
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in STATE.split(", ")])


def _blended(parent_rows: int):
    """Models of groups (g1, g2), each blended with those around it, once.

    ``chain`` has the estimates of the group and of all around it, by depth. An estimate counts as often as its group
    has rows, the blend around it as ``parent_rows`` rows; centre and scatter are those of both together.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in batches:
            rows = []
            for r in groups.itertuples(index=False):
                centre = scatter = None
                for own in sorted(r.chain, key=lambda e: -e["depth"]):
                    at, spread = np.array(own["centre"]), consistency(own["m"] / own["n"]) * _square(own["scatter"]) + _FLOOR
                    if centre is None:
                        centre, scatter = at, spread
                        continue
                    share = own["n"] / (own["n"] + parent_rows)
                    apart = at - centre
                    scatter = share * spread + (1 - share) * scatter + share * (1 - share) * np.outer(apart, apart)
                    centre = centre + share * apart
                inverse = np.linalg.inv(scatter)
                rows.append((r.g1, r.g2, centre.tolist(), [inverse[p] for p in PAIRS]))
            yield pd.DataFrame(rows, columns=[*GROUP, "centre", "precision"])

    return run


GROUP = ["g1", "g2"]
MODEL = "g1 string, g2 string, centre array<double>, precision array<double>"


def _levels() -> Column:
    """The group of a row and those around it, by depth, each named by one text."""
    own = F.concat(F.lit("2:"), F.length("g1").cast("string"), F.lit(":"), F.col("g1"), F.col("g2"))
    named = (own, F.concat(F.lit("1:"), F.col("g1")), F.lit("0"))
    return F.array(*[F.struct(F.lit(i).alias("depth"), g.alias("g")) for i, g in enumerate(named)])


def _flat(values: Column, name: str, n: int) -> list[Column]:
    """The elements of an array as columns that are never NULL, which keeps the code made from long sums of them short."""
    return [F.coalesce(values[i], F.lit(0.0)).alias(f"{name}{i}") for i in range(n)]


def _known(name: str, n: int) -> list[Column]:
    return [F.coalesce(F.col(f"{name}{i}"), F.lit(0.0)) for i in range(n)]


def _moments(at: list[Column]) -> list[Column]:
    """Centre and scatter of vectors, as aggregates."""
    rows = F.count("*")
    means = F.array(*[F.sum(x) / rows for x in at])
    return [means.alias("centre"), F.array(*[F.sum(at[i] * at[j]) / rows for i, j in PAIRS]).alias("twos")]


def _scatter() -> Column:
    """Of ``twos`` and ``centre``."""
    return F.array(*[F.col("twos")[k] - F.col("centre")[i] * F.col("centre")[j] for k, (i, j) in enumerate(PAIRS)]).alias("scatter")


def _starts(wide: DataFrame) -> DataFrame:
    """(g, start, n, m, centre, scatter): moments of all rows; medians with quartiles; medians with directions from them."""
    moments = wide.groupBy("g").agg(F.count("*").alias("n"), *_moments(_known("a", DIMENSIONS)))
    moments = stored(moments.select("g", "n", "centre", _scatter()), "quality-moments")
    # Quartiles come from counts of narrow classes of each statistic.
    widths = [x / FINE for x in LEAST_SPREAD]
    classes = F.array(*[F.floor(F.col(f"a{i}") / widths[i]) for i in range(DIMENSIONS)])
    counts = wide.select("g", F.posexplode(classes).alias("i", "class")).groupBy("g", "i", "class").count()
    by = Window.partitionBy("g", "i")
    counts = counts.withColumn("upto", F.sum("count").over(by.orderBy("class"))).withColumn("n", F.sum("count").over(by))
    width = F.get(F.array(*map(F.lit, widths)), F.col("i"))
    quarters = counts.groupBy("g", "i").agg(
        *[((F.min(F.when(4 * F.col("upto") >= q * F.col("n"), F.col("class"))) + 0.5) * F.first(width)).alias(f"q{q}") for q in (1, 2, 3)]
    )
    spread = F.greatest((F.col("q3") - F.col("q1")) / 1.349, F.get(F.array(*map(F.lit, LEAST_SPREAD)), F.col("i")))
    quarters = quarters.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("i", F.col("q2").alias("middle"), spread.alias("spread")))).alias("q"))
    quarters = quarters.select("g", F.transform("q", lambda x: x["middle"]).alias("centre"), F.transform("q", lambda x: x["spread"]).alias("spread"))
    quarters = stored(quarters.join(moments.select("g", "n"), "g"), "quality-quarters")
    plain = F.array(*[F.col("spread")[i] * F.col("spread")[i] if i == j else F.lit(0.0) for i, j in PAIRS])
    away = [(F.col(f"a{i}") - F.col("centre")[i]) / F.col("spread")[i] for i in range(DIMENSIONS)]
    signs = wide.join(quarters, "g").select("g", "n", "centre", "spread", *[a.alias(f"away{i}") for i, a in enumerate(away)])
    away = _known("away", DIMENSIONS)
    square = F.greatest(sum([a * a for a in away[1:]], away[0] * away[0]), F.lit(1e-12))
    ones = [F.sum(away[i] * away[j] / square) / F.count("*") for i, j in PAIRS]
    signs = signs.groupBy("g").agg(F.first("n").alias("n"), F.first("centre").alias("centre"), F.first("spread").alias("spread"), F.array(*ones).alias("ones"))
    turned = F.array(*[DIMENSIONS * F.col("ones")[k] * F.col("spread")[i] * F.col("spread")[j] for k, (i, j) in enumerate(PAIRS)])
    named = [(moments, F.col("scatter")), (quarters, plain), (signs, turned)]
    starts = [
        df.select("g", F.lit(i).alias("start"), "n", F.col("n").alias("m"), "centre", scatter.alias("scatter")) for i, (df, scatter) in enumerate(named)
    ]
    return starts[0].unionByName(starts[1]).unionByName(starts[2])


def _concentrated(wide: DataFrame, state: DataFrame) -> DataFrame:
    """One step: centre and scatter of the half of a group's rows that is nearest by each state, whole classes of distance."""
    models = state.select("g", "start", "n", *_flat(F.col("centre"), "c", DIMENSIONS), *_flat(F.col("precision"), "p", len(PAIRS)))
    measure = _distance(_known("a", DIMENSIONS), _known("c", DIMENSIONS), _known("p", len(PAIRS)))
    far = wide.join(models, "g").withColumn("far", measure)
    far = far.select("g", "start", "n", *[f"a{i}" for i in range(DIMENSIONS)], F.floor(CLASSES * F.log2(F.col("far") + 1e-9)).alias("class"))
    counts = far.groupBy("g", "start", "class").agg(F.count("*").alias("rows"), F.first("n").alias("n"))
    upto = F.sum("rows").over(Window.partitionBy("g", "start").orderBy("class"))
    edges = counts.withColumn("upto", upto).groupBy("g", "start").agg(F.min(F.when(2 * F.col("upto") >= F.col("n"), F.col("class"))).alias("edge"))
    # Stored, its size is known before the join, and rows need not be moved to meet it.
    inner = far.join(stored(edges, "quality-edges"), ["g", "start"]).where(F.col("class") <= F.col("edge"))
    moments = inner.groupBy("g", "start").agg(F.first("n").alias("n"), F.count("*").alias("m"), *_moments(_known("a", DIMENSIONS)))
    return moments.select("g", "start", "n", "m", "centre", _scatter()).mapInPandas(_estimated, STATE)


def fit(rows: DataFrame, parent_rows: int = 100, most_steps: int = 30) -> DataFrame:
    """Centre and inverse scatter for each group of ``rows`` (g1, g2, at).

    Returns g1, g2, centre, precision: a row for each g1 and g2, whatever its size. Each group, each g1 and the whole
    table have an estimate from all their rows: of three starts, steps are taken from each until its determinant does not fall
    any more (``most_steps`` at most), and the least determinant is kept. LEAST_SPREAD, added to each scatter, makes that of
    a few rows invertible and keeps the rule that a step does not raise the determinant. At the end a group is
    blended with its g1, which counts as ``parent_rows`` rows, as is g1 with the whole table.
    """
    at = _flat(F.col("at"), "a", DIMENSIONS)
    rows = stored(rows.select("g1", "g2", *at), "quality-vectors")
    names = [f"a{i}" for i in range(DIMENSIONS)]
    wide = rows.select(F.explode(_levels()).alias("level"), *names).select("level.g", *names)
    state = stored(_starts(wide).mapInPandas(_estimated, STATE).withColumn("determinant", F.lit(math.inf)), "quality-starts")
    found = []
    for _ in range(most_steps):
        before = state.select("g", "start", F.col("determinant").alias("before"))
        now = _concentrated(wide, state).join(before, ["g", "start"]).where(F.col("determinant") < F.col("before") * (1 - 1e-9))
        state = stored(now.drop("before"), "quality-steps")
        if state.isEmpty():
            break
        found.append(state)
    if not found:
        return rows.sparkSession.createDataFrame([], MODEL)
    every = reduce(DataFrame.unionByName, found)
    best = every.groupBy("g").agg(F.min(F.struct("determinant", "start", "n", "m", "centre", "scatter")).alias("b")).select("g", "b.*")
    around = rows.select("g1", "g2").distinct().select("g1", "g2", F.explode(_levels()).alias("level")).select("g1", "g2", "level.*")
    chain = F.collect_list(F.struct("depth", "n", "m", "centre", "scatter")).alias("chain")
    chains = around.join(best, "g").groupBy("g1", "g2").agg(chain)
    return stored(chains.mapInPandas(_blended(parent_rows), MODEL), "quality-model")


def _free(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has."""
    while any(c.lower() == name.lower() for c in columns):
        name += "_"
    return name


def judged(
    docs: DataFrame,
    columns: list[str] | None = None,
    by: tuple[str, str] = ("lang", "source"),
    text: str = "text",
    tail: float = TAIL,
    least_words: int = 50,
    most_repeated: int = 50,
    model: DataFrame | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with a struct ``quality``: counts, base_failed, distance, kept.

    base_failed: fewer than ``least_words`` words, or over ``most_repeated`` percent of the words in
    repeated windows of three words. kept: not base_failed, and a squared robust distance under the estimate of
    the row's group (see ``fit``) that all but ``tail`` of a normal sample are below. Estimates come from all rows that
    are not base_failed. Rows of a group without estimate are kept.

    NULL and empty texts have no words and fail. A NULL language or source forms a group. Repeated
    rows all stay and count. An empty table gives an empty result. A column called ``quality`` is
    replaced.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c != "quality"]
    counts = _free("quality counts", columns)
    of = [_free(f"quality {g}", columns) for g in GROUP]
    # A NULL language or source is a group of its own.
    group = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in by]
    named = [F.col(f"`{c}`") for c in columns]
    # Texts are counted once; what follows reads the counts.
    rows = stored(with_counts(docs, [*named, *[g.alias(n) for g, n in zip(group, of)]], text, counts), "quality-counts")
    s = F.col(f"`{counts}`")
    failed = base_failed(s, least_words, most_repeated)
    if model is None:
        passed = rows.where(~failed)
        model = fit(passed.select(*[F.col(f"`{n}`").alias(g) for n, g in zip(of, GROUP)], F.array(*vector(s)).alias("at")))
    model = model.select(*[F.col(g).alias(_free(f"model {g}", rows.columns)) for g in GROUP], F.struct("centre", "precision").alias(_free("model", rows.columns)))
    rows = rows.join(model, [F.col(f"`{n}`") == F.col(f"`{m}`") for n, m in zip(of, model.columns)], "left")
    fitted = F.col(f"`{model.columns[-1]}`")
    measure = _distance(F.array(*vector(s)), fitted["centre"], fitted["precision"])
    quality = F.struct(
        *[s[c].alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        measure.alias("distance"),
        (~failed & F.coalesce(measure <= chi2_quantile(tail, DIMENSIONS), F.lit(True))).alias("kept"),
    )
    return rows.select(*named, quality.alias("quality"))
