"""Repair of conversations: cheapest edits that leave alternating turns, by a run-length min-plus DP.

A turn is a symbol: its role (system, user, assistant or other) and its fault. The states of the DP are those of the
grammar, ``(s?(ua)+)?`` over the initials of roles: nothing yet, after s, after u, after a. A symbol is
a matrix of costs from state to state, edits before it included, and a row of turns is the min-plus
product of theirs. Equal symbols in a row are one run, whose product comes from binary powers of its
matrix that are kept for the next run.

Turns are dealt out by ranges of conversation and turn, so a long conversation is in several ranges. Its part
in a range is a segment. The products of segments give the least cost from each border on; from them each segment
is unrolled into edits where its runs are, once for every state it may begin in, which tells the
states at the borders, and once for good. Between edits of equal cost the first in the order of
their initials is taken, so that audits are the least of all cheapest ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.llm.store import partitions, stored

#: Costs of edits; of a turn that ends in the middle of a sentence and stays.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: A turn without any of these is blank; a turn whose last such character is none of ENDINGS is truncated.
INK, ENDINGS = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
FAULTS = BLANK, DUPLICATE, TRUNC = "blank", "duplicate", "truncated"
#: Symbols: 2 * role + (1 if truncated), roles as in ROLES, others as its length; GONE has to be deleted.
ROLES = "sua"
GONE = 2 * len(ROLES) + 2
BEFORE, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
NEVER = 1 << 60
#: State -> where the one turn that may be inserted there leads, and by a kept role, where that leads.
_NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_KEPT = {"s": {BEFORE: AFTER_S}, "u": {BEFORE: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: Cost of the inserts that end a conversation in each state.
END = (0, 2 * INSERT, INSERT, 0)
#: Edits as they are kept: delete, keep; rerole to user or assistant; insert a user or assistant turn. All but the first two
#: are told apart by the role they give; in audits they are R and I.
REROLED, INSERTED = {AFTER_U: "U", AFTER_A: "A"}, {AFTER_U: "u", AFTER_A: "a"}

Matrix = tuple[tuple[int, ...], ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def onto(a: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(a[i][k] + v[k] for k in STATES) for i in STATES)


def _kept_state(symbol: int, state: int) -> int | None:
    role = symbol // 2
    return _KEPT[ROLES[role]].get(state) if role < len(ROLES) else None


def _matrix(symbol: int) -> Matrix:
    """Costs of one turn and of the inserts before it."""
    inserts = [[NEVER] * 4 for _ in STATES]
    edits = [[NEVER] * 4 for _ in STATES]
    stays = TRUNCATED * (symbol % 2)
    for state in STATES:
        cost, at = 0, state
        while inserts[state][at] == NEVER:
            inserts[state][at] = cost
            cost, at = cost + INSERT, _NEXT[at]
        edits[state][state] = DELETE
        if symbol != GONE:
            edits[state][_NEXT[state]] = REROLE + stays
            kept = _kept_state(symbol, state)
            if kept is not None:
                edits[state][kept] = stays
    return times(tuple(map(tuple, inserts)), tuple(map(tuple, edits)))


@lru_cache(maxsize=None)  # symbols times bits of a length
def power(symbol: int, bit: int) -> Matrix:
    """The matrix of 2 ** bit turns of a symbol."""
    if not bit:
        return _matrix(symbol)
    half = power(symbol, bit - 1)
    return times(half, half)


def run_onto(symbol: int, length: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs before a run, from those after it."""
    bit = 0
    while length >> bit:
        if length >> bit & 1:
            v = onto(power(symbol, bit), v)
        bit += 1
    return v


def product(runs: list[tuple[int, int]]) -> Matrix:
    columns = [tuple(0 if i == j else NEVER for i in STATES) for j in STATES]
    for symbol, length in reversed(runs):
        columns = [run_onto(symbol, length, c) for c in columns]
    return tuple(tuple(min(x, NEVER) for x in row) for row in zip(*columns))


def _turn(symbol: int, after: tuple[int, ...], state: int, out: list[str]) -> int:
    """Adds the first of the cheapest edits of one turn, and returns the state after it."""
    best = onto(power(symbol, 0), after)[state]
    stays = TRUNCATED * (symbol % 2)
    while True:
        if DELETE + after[state] == best:
            out.append("D")
            return state
        then = _NEXT[state]
        if INSERT + onto(power(symbol, 0), after)[then] == best:
            out.append(INSERTED[then])
            state, best = then, best - INSERT
            continue
        kept = _kept_state(symbol, state)
        if kept is not None and stays + after[kept] == best:
            out.append("K")
            return kept
        out.append(REROLED[then])
        return then


def unrolled(runs: list[tuple[int, int]], after: tuple[int, ...], state: int, ends: bool) -> tuple[str, int]:
    """The first of the cheapest edits of runs from ``state``, and the state they lead to.

    ``after``: least costs by state from the end of the runs on; ``ends``: the conversation is closed there. A run is halved
    until one turn is left; the costs in its middle come from powers of its matrix.
    """
    out: list[str] = []
    costs = [after]
    for symbol, length in reversed(runs):
        costs.append(run_onto(symbol, length, costs[-1]))
    costs.reverse()
    for (symbol, length), end in zip(runs, costs[1:]):
        todo = [(length, end)]
        while todo:
            n, last = todo.pop()
            if n == 1:
                state = _turn(symbol, last, state, out)
            else:
                todo += [(n - n // 2, last), (n // 2, run_onto(symbol, n - n // 2, last))]
    while ends and END[state]:
        state = _NEXT[state]
        out.append(INSERTED[state])
    return "".join(out), state


def encoded(symbols: list[int]) -> list[tuple[int, int]]:
    """Runs (symbol, length)."""
    runs: list[list[int]] = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    return [(s, n) for s, n in runs]


def _by_row(rows: DataFrame, schema: str, one: Callable) -> DataFrame:
    """``one`` of each row."""
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(r) for r in batch.itertuples(index=False)], columns=names)

    return rows.mapInPandas(run, schema)


def _runs(r) -> list[tuple[int, int]]:
    return list(zip(r.symbols.tolist(), r.lengths.tolist()))


def _ordered(rows: DataFrame) -> DataFrame:
    """Turns (conv, turn, role, text) in order, with ``row`` and ``place``, whose upper bits are the range of a turn."""
    # The row key deals out repeated rows, and tells the first of them.
    named = stored(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    order = ["conv", "turn", "role", "text", "row"]
    placed = named.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return stored(placed.withColumn("place", F.monotonically_increasing_id()), "ordered-turns")


def _marked(placed: DataFrame) -> DataFrame:
    """(conv, turn, place, initial, fault, symbol) of ordered turns."""
    same = F.sha2(F.concat("role", F.lit("\n"), "text"), 256)
    first = placed.groupBy("conv", same).agg(F.min(F.struct("turn", "row")).alias("first")).select(F.col("first.row").alias("first row"))
    marks = placed.select(
        "conv", "turn", "place", "row",
        F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(INK)).alias("empty"), (~F.col("text").rlike(ENDINGS)).alias("open"),
    ).join(first, F.col("row") == F.col("first row"), "left")
    fault = F.when(F.col("empty"), BLANK).when(F.col("first row").isNull(), DUPLICATE).when(F.col("open"), TRUNC).otherwise("none")
    number = F.lit(len(ROLES))
    for i, r in enumerate(ROLES):
        number = F.when(F.col("initial") == r, F.lit(i)).otherwise(number)
    marks = marks.select("conv", "turn", "place", "initial", fault.alias("fault"), number.alias("number"))
    symbol = F.when(F.col("fault").isin(BLANK, DUPLICATE), F.lit(GONE)).otherwise(2 * F.col("number") + (F.col("fault") == TRUNC).cast("int"))
    return marks.withColumn("symbol", symbol)


def _segments(marks: DataFrame) -> DataFrame:
    """One row for each conversation in each range: its first place, counts, borders, runs and their min-plus product."""
    at = F.struct("place", "symbol", "initial")
    rows = marks.withColumn("part", F.shiftright("place", 33)).groupBy("conv", "part").agg(
        F.min("place").alias("start"),
        F.min("turn").alias("least"),
        F.max("turn").alias("most"),
        F.size(F.collect_set("turn")).cast("long").alias("numbers"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in FAULTS],
        F.array_sort(F.collect_list(at)).alias("turns"),
    )
    initials = F.transform("turns", lambda t: t["initial"])
    pairs = F.zip_with(F.slice(initials, 1, F.size("turns") - 1), F.slice(initials, 2, F.size("turns")), lambda a, b: F.concat(a, b))
    rows = rows.select(
        "conv", "start", "least", "most", "numbers", *FAULTS,
        F.size(F.filter(pairs, _illegal)).cast("long").alias("illegal"),
        F.get(initials, 0).alias("opens"),
        F.try_element_at(initials, F.lit(-1)).alias("closes"),
        F.transform("turns", lambda t: t["symbol"].cast("int")).alias("symbols"),
    )
    kept = [f"`{c}` {t}" for c, t in rows.dtypes[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [encoded(s.as_py()) for s in batch.column(batch.num_columns - 1)]
            columns = [
                pa.array([[s for s, _ in r] for r in runs], pa.list_(pa.int32())),
                pa.array([[n for _, n in r] for r in runs], pa.list_(pa.int64())),
                pa.array([[x for row in product(r) for x in row] for r in runs], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "symbols", "lengths", "matrix"])

    schema = ", ".join([*kept, "symbols array<int>", "lengths array<bigint>", "matrix array<bigint>"])
    return stored(rows.mapInArrow(run, schema), "repair-segments")


def _illegal(pair: Column) -> Column:
    return ~pair.isin("su", "ua", "au")


def _costs_after(matrices: Column) -> Column:
    """Of the matrices of segments, last first: least costs by state after each, and before the last of them."""

    def step(done: Column, m: Column) -> Column:
        v = F.try_element_at(done, F.lit(-1))
        before = [F.least(*[F.get(m, F.lit(4 * i + k)) + F.get(v, F.lit(k)) for k in STATES]) for i in STATES]
        return F.concat(done, F.array(F.array(*before)))

    return F.aggregate(matrices, F.array(F.array(*[F.lit(x).cast("long") for x in END])), step)


def _chained(parts: DataFrame) -> DataFrame:
    """Per conversation its segments in order, and the least costs after each and before the first.

    There are no more segments than ranges, and they meet as borders and matrices alone.
    """
    fields = ["start", "least", "most", "numbers", *FAULTS, "illegal", "opens", "closes", "matrix"]
    chain = F.array_sort(F.collect_list(F.struct(*fields)))
    chains = parts.groupBy("conv").agg(chain.alias("chain"))
    costs = F.reverse(_costs_after(F.transform(F.reverse("chain"), lambda s: s["matrix"])))
    return stored(chains.withColumn("costs", costs), "repair-chains")


def _edited(parts: DataFrame, chains: DataFrame) -> DataFrame:
    """(conv, start, edits): the edits of each segment."""
    n = F.size("chain")
    each = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(F.get("chain", i)["start"].alias("at"), F.get("costs", i + 1).alias("after"), (i == n - 1).alias("ends"), (n > 1).alias("several")),
    )
    each = chains.select(F.explode(each).alias("s")).select("s.*")
    runs = parts.select("conv", "start", "symbols", "lengths")
    rows = stored(runs.join(each, F.col("start") == F.col("at")).drop("at"), "repair-runs")
    # Of conversations in several ranges: where a segment leads to from each state it may begin in.
    leads = _by_row(
        rows.where("several").select("start", "symbols", "lengths", "after"),
        "start long, leads array<int>",
        lambda r: (r.start, [unrolled(_runs(r), tuple(r.after.tolist()), s, False)[1] for s in STATES]),
    )
    leads = stored(leads, "repair-leads").join(rows.select("conv", "start"), "start")
    states = leads.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("start", "leads"))).alias("chain"))
    begins = F.aggregate(
        "chain", F.array(F.lit(BEFORE)), lambda done, s: F.concat(done, F.array(F.get(s["leads"], F.try_element_at(done, F.lit(-1)))))
    )
    begins = F.transform(F.col("chain"), lambda s, i: F.struct(s["start"].alias("at"), F.get(begins, i).alias("state")))
    begins = states.select(F.explode(begins).alias("s")).select("s.*")
    rows = rows.join(begins, F.col("start") == F.col("at"), "left").withColumn("state", F.coalesce("state", F.lit(BEFORE)))
    edits = _by_row(
        rows.select("start", "symbols", "lengths", "after", "state", "ends"),
        "of long, edits string",
        lambda r: (r.start, unrolled(_runs(r), tuple(r.after.tolist()), int(r.state), bool(r.ends))[0]),
    )
    return stored(runs.select("conv", "start").join(edits, F.col("start") == F.col("of")).drop("of"), "repair-edits")


def repaired(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Repaired turns, and one row for each conversation that tells what was wrong and was done.

    Turns: conv, place, step, edit, role, text, in order of place and step; edit is K (kept), R (given another role) or
    I (inserted, with an empty text). Conversations: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, where
    gaps are numbers missing between the least and the largest turn, illegal the neighbours whose initials
    are not su, ua or au, and audit has the initials of all edits, D for a deleted turn included.

    A turn has its first fault: blank; duplicate, if its role and text came earlier; truncated. Blank and duplicate turns
    go. Of all cheapest edits that make ``(s?(ua)+)?`` of the initials of the roles, the first in the order of audits is done.

    Turns are ordered by number, NULL first, then role and text. NULL roles and texts are empty. A NULL
    conversation is one of its own. Repeated rows are duplicates. An empty table gives empty results. Other
    columns are left out, whatever their names.
    """
    named = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    placed = _ordered(named)
    parts = _segments(_marked(placed))
    chains = _chained(parts)
    edits = _edited(parts, chains)

    def joints(count: Callable[[Column, Column], Column]) -> Column:
        pairs = F.zip_with(F.slice("chain", 1, F.size("chain") - 1), F.slice("chain", 2, F.size("chain")), count)
        return F.size(F.filter(pairs, lambda x: x)).cast("long")

    def total(field: str) -> Column:
        return F.aggregate("chain", F.lit(0).cast("long"), lambda n, s: n + s[field])

    span = F.array_max(F.transform("chain", lambda s: s["most"])) - F.array_min(F.transform("chain", lambda s: s["least"])) + 1
    again = joints(lambda a, b: F.coalesce(a["most"] == b["least"], F.lit(False)))
    across = joints(lambda a, b: _illegal(F.concat(a["closes"], b["opens"])))
    audits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "edits"))), lambda s: s["edits"]), "")
    audits = edits.groupBy(F.col("conv").alias("of")).agg(F.translate(audits, "UAua", "RRII").alias("audit"))
    told = chains.select(
        "conv",
        F.coalesce(span - (total("numbers") - again), F.lit(0)).cast("long").alias("gaps"),
        *[total(f).alias(f) for f in FAULTS],
        (total("illegal") + across).alias("illegal"),
        F.get(F.get("costs", 0), BEFORE).alias("cost"),
    )
    told = told.join(audits, F.col("conv").eqNullSafe(F.col("of"))).drop("of")

    done = F.regexp_extract_all("edits", F.lit("([ua]*[DKUA]|[ua]+$)"), F.lit(1))
    steps = edits.select("conv", "start", F.posexplode(done).alias("n", "done"))
    steps = steps.select("conv", (F.col("start") + F.col("n")).alias("place"), F.posexplode(F.split("done", "")).alias("step", "code"))
    steps = steps.where("code <> 'D'")
    texts = placed.select(F.col("place").alias("at"), F.col("role").alias("old"), "text")
    turns = steps.join(texts, (F.col("place") == F.col("at")) & F.col("code").isin("K", "U", "A"), "left")
    given = F.when(F.lower("code") == "u", "user").when(F.lower("code") == "a", "assistant").otherwise(F.col("old"))
    turns = turns.select(
        "conv", "place", "step", F.translate("code", "UAua", "RRII").alias("edit"), given.alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns, told


def hashed(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of repaired turns: ``role:text`` of each, joined by newlines; a task reads turn by turn."""
    dealt = turns.repartition("conv").sortWithinPartitions("conv", "place", "step")
    line = F.concat("role", F.lit(":"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            done = []
            for conv, text in zip(batch.column(0), batch.column(1)):
                conv = conv.as_py()
                if sha is not None and conv == now:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                sha.update(text.as_py().encode())
            if done:
                yield out(done)
        if sha is not None:
            yield out([(now, sha.hexdigest())])

    kind = dict(turns.dtypes)["conv"]
    of = pa.int64() if kind == "bigint" else pa.string()

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], of), pa.array([r[1] for r in rows])], ["conv", "repaired_sha256"])

    key = F.col("conv") if kind == "bigint" else F.col("conv").cast("string").alias("conv")
    return dealt.select(key, line).mapInArrow(run, f"conv {'bigint' if kind == 'bigint' else 'string'}, repaired_sha256 string")
