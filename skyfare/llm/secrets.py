"""Secret scans in DataFrame functions: fixed patterns, and Markov models of random strings.

Two models of character pairs, one of random strings and one of ordinary identifiers, are trained
from labelled samples. Of what fixed patterns leave of a long run of identifier characters, the stretches are
secrets whose log-likelihood ratio between the two is high enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns, the group whose length counts, and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}
KINDS = (*BASE, "markov")
#: Texts without one of these cannot hold an assignment; a cheap test before the pattern.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Runs that the models judge, and their least length.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
LEAST = 16
MARKS_FROM = ALPHABET.index("+")
#: Log-likelihood ratio that a stretch of a run needs, and by how much its sum may fall within, as at two usual pairs.
EVIDENCE, DROP = 6.0, 16.0
#: Kinds of characters: lower case, upper case, digits, marks; and how often one follows another in identifiers in general.
KINDS_OF = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_-")
FOLLOWS = ((0.85, 0.07, 0.05, 0.03), (0.45, 0.45, 0.05, 0.05), (0.15, 0.10, 0.65, 0.10), (0.60, 0.20, 0.15, 0.05))
#: Most weight of the pairs seen in ordinary samples, and of how many samples of a character half of that is given.
SEEN, HALF = 0.7, 200
SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Code-point spans of all matches, left to right, whose group is ``least`` long or longer."""
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.arrays_zip(pieces.alias("before"), whole.alias("whole"), part.alias("part"))
    rows = F.filter(rows, lambda r: r["whole"].isNotNull())

    def step(state: Column, r: Column) -> Column:
        start = state["at"] + F.length(r["before"])
        end = start + F.length(r["whole"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        added = F.when(F.length(r["part"]) >= least, F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), added.otherwise(state["spans"]).alias("spans"))

    empty = F.array().cast(f"array<{SPAN}>")
    zero = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.aggregate(rows, zero, step, lambda state: state["spans"])


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    empty = F.array().cast(f"array<{SPAN}>")
    low = F.lower(text)
    may = {
        "assign": F.greatest(*[F.contains(low, F.lit(w)) for w in WORDS]),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": text.rlike(r"[0-9a-f]{24}"),
    }
    found = [
        F.when(may[k], _spans(text, pattern, group, least, i)).otherwise(empty)
        for i, (k, (pattern, group, least)) in enumerate(BASE.items())
    ]
    return F.array_sort(F.concat(*found))


def _clear_of(spans: Column, others: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])))


def _free(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has."""
    while any(c.lower() == name.lower() for c in columns):
        name += "_"
    return name


def _with_base(docs: DataFrame, columns: list[Column], text: str, scanned: str = "scanned text", base: str = "base spans") -> DataFrame:
    rows = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias(scanned))
    return rows.withColumn(base, base_spans(F.col(f"`{scanned}`")))


def labelled_samples(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_docs: int = 2000) -> DataFrame:
    """(value, random) samples labelled by the fixed patterns.

    Random strings: what all texts have under the fixed patterns for access keys, hex runs and
    values of assignments with a digit. Ordinary identifiers: words of eight letters, digits or underscores and more
    that no fixed pattern touches, from the ``sample_docs`` texts of least hashed id and text.
    """
    rows = _with_base(docs, [], text)
    spans = F.col("base spans")
    hit = rows.where(F.size(spans) > 0).select("scanned text", F.explode(spans).alias("s"))
    found = hit.select(F.substr("scanned text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("m"))
    random = found.select(F.regexp_extract("m", r"([A-Za-z0-9+/_-]+)$", 1).alias("value"))
    random = random.where(F.col("value").rlike("[0-9]") & (F.length("value") >= 8))
    order = F.xxhash64(key, text)
    # the hashes first, so that no text is moved to find the least of them: sample_docs numbers
    least = docs.where(F.length(text) > 0).select(order.alias("h")).distinct().orderBy("h").limit(sample_docs)
    few = docs.select(order.alias("h"), F.col(text).alias("sampled")).join(F.broadcast(least), "h")
    few = _with_base(few.groupBy("h").agg(F.any_value("sampled").alias("sampled")), [], "sampled")
    words = few.select(
        F.explode(_clear_of(_spans(F.col("scanned text"), r"[A-Za-z0-9_]{8,}", 0, 8, 0), spans)).alias("s"), "scanned text"
    )
    plain = words.select(F.substr("scanned text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("value"))
    # Digits among letters of both cases are taken for neither.
    plain = plain.where(~(F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")))
    return random.select("value", F.lit(True).alias("random")).unionByName(plain.select("value", F.lit(False).alias("random")))


def train(samples: DataFrame, smoothing: float = 0.5, backoff: float = 4.0, prior: float = 2000.0) -> list[float]:
    """Log-likelihood ratios of all pairs of characters, random over ordinary.

    ``samples``: value, random. Pairs are counted where the samples are; only the counts, as many as
    there are pairs of characters, come to the driver. The random model starts from ``prior`` pairs of evenly spread
    characters, so it is that of even strings where there are no random samples. The ordinary model mixes the pairs
    seen with how kinds of characters follow one another, as seen and in general, so that words of another language
    are not random. Without ordinary samples no pair tells anything, and nothing is found.
    """
    pairs = samples.where(F.length("value") > 1).select(
        "random", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("i"), "value"
    )
    pairs = pairs.select("random", F.substr("value", F.col("i"), F.lit(2)).alias("pair"))
    counts = {(r["random"], r["pair"]): r["count"] for r in pairs.groupBy("random", "pair").count().collect()}
    size = len(ALPHABET)
    if not any(not kind for kind, _ in counts):
        return [0.0] * (size * size)

    even = prior / size**2
    rows = [[counts.get((True, a + b), 0) + even for b in ALPHABET] for a in ALPHABET]
    seen = [sum(r[i] for r in rows) + smoothing for i in range(size)]
    # A pair not seen is as likely as its second character.
    random = [[(c + backoff * p / sum(seen)) / (sum(r) + backoff) for c, p in zip(r, seen)] for r in rows]

    rows = [[counts.get((False, a + b), 0) for b in ALPHABET] for a in ALPHABET]
    kind = [next(k for k, letters in enumerate(KINDS_OF) if c in letters) for c in ALPHABET]
    changes = [[0.0] * len(KINDS_OF) for _ in KINDS_OF]
    for i, r in enumerate(rows):
        for j, c in enumerate(r):
            changes[kind[i]][kind[j]] += c

    every = sum(map(sum, changes))
    share = [sum(c[m] for c in changes) / every for m in range(len(KINDS_OF))]

    def ordinary(i: int, j: int) -> float:
        k, m, n = kind[i], kind[j], sum(rows[i])
        total = sum(changes[k])
        known = total / (total + HALF)
        # Kinds that are rare in the samples are rare after one another, too.
        learned = known * changes[k][m] / max(total, 1) + (1 - known) * share[m]
        taken = (1 + known) / 4
        general = (taken * FOLLOWS[k][m] + (1 - taken) * learned) / len(KINDS_OF[m])
        weight = SEEN * n / (n + HALF)
        return weight * (rows[i][j] / n if n else 0.0) + (1 - weight) * general

    return [math.log(random[i][j] / ordinary(i, j)) for i in range(size) for j in range(size)]


def _rests(run: Column, others: Column) -> Column:
    """The parts of a span that ``others``, by start, leave uncovered."""
    zero = F.struct(run["start"].alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def part(start: Column, end: Column) -> Column:
        return F.array(F.struct(start.alias("start"), run["kind"].alias("kind"), end.alias("end")))

    def step(state: Column, o: Column) -> Column:
        out = F.when(o["start"] > state["at"], F.concat(state["out"], part(state["at"], o["start"])))
        return F.struct(F.greatest(state["at"], o["end"]).alias("at"), out.otherwise(state["out"]).alias("out"))

    def last(state: Column) -> Column:
        return F.when(state["at"] < run["end"], F.concat(state["out"], part(state["at"], run["end"]))).otherwise(state["out"])

    inside = F.filter(others, lambda o: (o["start"] < run["end"]) & (run["start"] < o["end"]))
    return F.aggregate(inside, zero, step, last)


STRETCH = "struct<start:int,end:int>"


def _stretches(value: Column, model: list[float], least_ratio: float) -> Column:
    """(start, end) of what is random in a run of characters of the alphabet.

    These are the stretches in which log-likelihood ratios exceed ``least_ratio`` by EVIDENCE in sum: the
    sum starts again at 0 where it falls to 0 or by DROP from its height, where a stretch ends. Stretches are
    widened to the letters and digits next to them, and those of LEAST characters or more then are found.
    """
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    none = F.array().cast(f"array<{STRETCH}>")
    zero = F.struct(
        F.lit(-1).alias("last"), F.lit(0).alias("at"), F.lit(0.0).alias("sum"),
        F.lit(0).alias("start"), F.lit(0.0).alias("top"), F.lit(0).alias("end"), none.alias("out"),
    )

    def closed(state: Column) -> Column:
        enough = state["top"] >= EVIDENCE
        found = F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))
        return F.when(enough, F.concat(state["out"], found)).otherwise(state["out"])

    def step(state: Column, c: Column) -> Column:
        code = F.instr(F.lit(ALPHABET), c) - 1
        first = state["last"] < 0
        gain = F.when(first, F.lit(0.0)).otherwise(F.get(table, state["last"] * size + code) - least_ratio)
        # Identifiers of the samples have no marks within, so pairs with one tell nothing of a stretch.
        plain = (state["last"] < MARKS_FROM) & (code < MARKS_FROM)
        now = state["sum"] + F.when(plain, gain).otherwise(F.lit(0.0))
        ends = (now <= 0) | (now <= state["top"] - DROP)
        higher = ~ends & (now > state["top"])
        at = state["at"] + 1
        return F.struct(
            code.alias("last"),
            at.alias("at"),
            F.when(ends, F.lit(0.0)).otherwise(now).alias("sum"),
            F.when(ends, state["at"]).otherwise(state["start"]).alias("start"),
            F.when(ends, F.lit(0.0)).when(higher, now).otherwise(state["top"]).alias("top"),
            F.when(ends, at).when(higher, at).otherwise(state["end"]).alias("end"),
            F.when(ends, closed(state)).otherwise(state["out"]).alias("out"),
        )

    def widened(s: Column) -> Column:
        before = F.regexp_extract(F.substr(value, F.lit(1), s["start"]), "[A-Za-z0-9]*$", 0)
        after = F.regexp_extract(F.substr(value, s["end"] + 1, F.length(value)), "^[A-Za-z0-9]*", 0)
        return F.struct((s["start"] - F.length(before)).alias("start"), (s["end"] + F.length(after)).alias("end"))

    found = F.aggregate(F.split(value, ""), zero, step, closed)
    return F.filter(F.array_distinct(F.transform(found, widened)), lambda s: s["end"] - s["start"] >= LEAST)


def scanned(
    docs: DataFrame,
    model: list[float],
    columns: list[str] | None = None,
    text: str = "text",
    least_ratio: float = 0.2,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with a struct ``secrets``.

    Fields: base and spans, arrays of (start, kind, end) in code points, end exclusive, by start
    and kind, where kind numbers KINDS. base: the fixed patterns, leftmost and non-overlapping within a kind.
    spans: those and, in the candidates less what those cover, the parts that are random (see
    ``_stretches``), such as a secret in a path or next to an access key. NULL and empty texts have no spans; rows of equal content stay; an empty table gives an
    empty result. A column called ``secrets`` is replaced.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c != "secrets"]
    scanned, base, more_spans = (_free(n, columns) for n in ("scanned text", "base spans", "more spans"))
    rows = _with_base(docs, [F.col(f"`{c}`") for c in columns], text, scanned, base)
    body, known = F.col(f"`{scanned}`"), F.col(f"`{base}`")
    markov = len(BASE)
    runs = _spans(body, CANDIDATE, 0, LEAST, markov)
    rests = F.flatten(F.transform(runs, lambda s: _rests(s, known)))
    rests = F.filter(rests, lambda s: s["end"] - s["start"] >= LEAST)

    def random_parts(s: Column) -> Column:
        found = _stretches(F.substr(body, s["start"] + 1, s["end"] - s["start"]), model, least_ratio)
        return F.transform(
            found,
            lambda x: F.struct((s["start"] + x["start"]).alias("start"), F.lit(markov).alias("kind"), (s["start"] + x["end"]).alias("end")),
        )

    judged = F.flatten(F.transform(rests, random_parts))
    more = F.when(body.rlike(CANDIDATE), judged).otherwise(F.array().cast(f"array<{SPAN}>"))
    rows = rows.withColumn(more_spans, more)
    spans = F.array_sort(F.concat(known, F.col(f"`{more_spans}`")))
    secrets = F.struct(known.alias("base"), spans.alias("spans"))
    return rows.select(*[F.col(f"`{c}`") for c in columns], secrets.alias("secrets"))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with ``mark`` in place of every span; spans that overlap give one mark."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    joined = F.aggregate(spans, zero, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, joined).otherwise(text)
