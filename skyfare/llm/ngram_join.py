"""N-gram Jaccard join: prefix filters under several token orders, then exact verification.

A document is the set of its five-word shingles, hashed to 48 bits. Two documents whose sets are
at least 80 percent alike share a token among the first ``n - ceil(0.8 n) + 1`` tokens of each, in
whichever order all tokens are put. Of the smaller one ``n - ceil(1.6 n / 1.8) + 1`` tokens do, its short
prefix. Three orders are used. All put tokens found in one document
only first, which need not be moved at all; the first two go on from rare to frequent tokens, with
different orders among equals, and the third goes on in a hashed order.

How often a token occurs is counted over all documents without moving a frequent one often. A task
puts its documents together in blocks. A token found ``local`` times or more in any block is
frequent, and the block keeps its occurrences and sends their number; all others go to the bucket of their
hash, at most ``local - 1`` times from a block, where tokens are counted exactly. Buckets answer each block which of
its tokens are shared and how often. A document with too few shared tokens has no partner and ends here.

The documents of a token's list are first compared with one of them, its centre, and linked documents
put in components. Then the pairs of a list that are still in different components are compared, if the
list is of the smaller one's short prefix, but for those that cannot be alike by their places in the list, by their
distances from the centre or by parities of their tokens (see ``_open_pairs``). Groups of copies are so not compared pair by pair, nor are
texts made from one form, whose common tokens are the most frequent ones, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.components import components
from skyfare.llm.packing_bytes import TOKEN_BITS, narrow, pack, unpack, widen
from skyfare.llm.store import partitions, stored
from skyfare.llm.words import chunks, mix, shingle_hashes

#: Tokens and documents that a task puts in one block.
BLOCK_TOKENS, BLOCK_DOCS = 1_500_000, 60_000
#: Words of 64 parities that sum up the shared tokens of a set.
WORDS = 8
_ORDER_SALTS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def required(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set of ``n`` that have to be in any set at least ``percent`` alike."""
    return (n * percent + 99) // 100


def required_together(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that sets of ``n`` and ``m`` tokens have in common if they are at least ``percent`` alike."""
    return ((n + m) * percent + 99 + percent) // (100 + percent)


def _sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, bounds, keys) of runs of texts; texts with equal sets have equal keys."""
    for _, _, data, offsets in chunks(texts):
        hashes, bounds = shingle_hashes(data, offsets)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes ^ _ORDER_SALTS[0]), dtype=np.uint64)))
        keys = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
        yield hashes >> np.uint64(64 - TOKEN_BITS), bounds, keys.view(np.int64)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but the last, a text, and its key and number of shingles."""
    for batch in batches:
        found = [(keys, np.diff(bounds)) for _, bounds, keys in _sets(batch.column(batch.num_columns - 1))]
        keys, counts = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), ())))
        names = [*batch.schema.names[:-1], "key", "n"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(keys), pa.array(counts)], names)


ROW = "bucket int, kind int, block long, a binary, b binary, c binary"
#: Kinds of rows: tokens of a block for a bucket; frequent tokens of a block for itself; frequent
#: tokens and their counts in a block for a bucket to add; documents of a block.
TOKENS, OWN, KNOWN, DOCS = range(4)


def _blocks(buckets: int, local: int):
    def rows(number: int, sets: list[np.ndarray], keys: list[int]) -> Iterator[tuple]:
        block = TaskContext.get().partitionId() << 32 | number
        sizes = np.array([len(s) for s in sets])
        tokens, index = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes).astype(np.uint16)
        order = np.argsort(tokens, kind="stable")
        tokens, index = tokens[order], index[order]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        counts = np.diff(np.append(starts, len(tokens)))
        often = np.repeat(counts >= local, counts)
        if often.any():
            yield block % buckets, OWN, block, pack(tokens[often]), index[often].tobytes(), b""
            known, times = tokens[starts[counts >= local]], counts[counts >= local].astype(np.int32)
            for bucket, a, b in _spans(known, buckets):
                yield bucket, KNOWN, block, pack(known[a:b]), times[a:b].tobytes(), b""
        tokens, index = tokens[~often], index[~often]
        for bucket, a, b in _spans(tokens, buckets):
            yield bucket, TOKENS, block, pack(tokens[a:b]), index[a:b].tobytes(), b""
        ids = np.array(keys, np.int64)
        home = (ids.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        for bucket in np.unique(home).tolist():
            at = np.flatnonzero(home == bucket)
            yield bucket, DOCS, block, ids[at].tobytes(), at.astype(np.uint16).tobytes(), sizes[at].astype(np.int32).tobytes()

    def batch(found: Iterator[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(zip(*found), kinds)]
        return pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in ROW.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, sets, keys, seen = 0, 0, [], [], set()
        for texts in batches:
            for tokens, bounds, found in _sets(texts.column(0)):
                for a, b, key in zip(bounds[:-1].tolist(), bounds[1:].tolist(), found.tolist()):
                    if a == b or key in seen:
                        continue
                    seen.add(key)
                    sets.append(tokens[a:b].copy())
                    keys.append(key)
                    size += b - a
                    if size >= BLOCK_TOKENS or len(sets) >= BLOCK_DOCS:
                        yield batch(rows(number, sets, keys))
                        number, size, sets, keys, seen = number + 1, 0, [], [], set()
        if sets:
            yield batch(rows(number, sets, keys))

    return run


def _spans(tokens: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of ascending tokens, which go to buckets by range of their hash."""
    edges = [((i << TOKEN_BITS) + buckets - 1) // buckets for i in range(buckets + 1)]
    at = np.searchsorted(tokens, np.array(edges, np.uint64)).tolist()
    for bucket in range(buckets):
        if at[bucket] < at[bucket + 1]:
            yield bucket, at[bucket], at[bucket + 1]


ANSWER = "block long, kind int, a binary, b binary, c binary"


def _answered(table: pa.Table) -> pa.Table:
    """What a bucket tells the blocks: their shared tokens with classes, and the documents they keep."""
    kinds = table.column("kind").to_numpy()
    blocks = table.column("block").to_numpy()
    a, b, c = (table.column(x) for x in "abc")
    out: list[tuple] = []
    for i in np.flatnonzero(kinds == OWN).tolist():
        out.append((blocks[i], OWN, a[i].as_py(), b[i].as_py(), b""))
    at = np.flatnonzero((kinds == TOKENS) | (kinds == KNOWN)).tolist()
    if at:
        parts = [unpack(a[i].as_py()) for i in at]
        tokens = np.concatenate(parts)
        times = np.ones(len(tokens), np.int64)
        first = 0
        for i, part in zip(at, parts):
            if kinds[i] == KNOWN:
                times[first : first + len(part)] = np.frombuffer(b[i].as_py(), np.int32)
            first += len(part)
        order = np.argsort(tokens)
        ranked = tokens[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        counts = np.add.reduceat(times[order], starts)
        classes = np.frexp(counts.astype(np.float64))[1]
        classes[counts < 2] = 0
        grade = np.empty(len(tokens), np.uint8)
        grade[order] = np.repeat(classes, np.diff(np.append(starts, len(ranked)))).astype(np.uint8)
        first = 0
        for i, part in zip(at, parts):
            own = grade[first : first + len(part)]
            first += len(part)
            shared = own > 0
            if kinds[i] == KNOWN:
                out.append((blocks[i], KNOWN, a[i].as_py(), b"", own.tobytes()))
            elif shared.any():
                index = np.frombuffer(b[i].as_py(), np.uint16)
                out.append((blocks[i], TOKENS, pack(part[shared]), index[shared].tobytes(), own[shared].tobytes()))
    at = np.flatnonzero(kinds == DOCS)
    if len(at):
        at = at[np.argsort(blocks[at], kind="stable")].tolist()
        keys = np.concatenate([np.frombuffer(a[i].as_py(), np.int64) for i in at])
        owner = np.repeat(at, [len(a[i].as_py()) // 8 for i in at])
        index = np.concatenate([np.frombuffer(b[i].as_py(), np.uint16) for i in at])
        sizes = np.concatenate([np.frombuffer(c[i].as_py(), np.int32) for i in at])
        _, first = np.unique(keys, return_index=True)
        for i in np.unique(owner[first]).tolist():
            own = first[owner[first] == i]
            out.append((blocks[i], DOCS, keys[own].tobytes(), index[own].tobytes(), sizes[own].tobytes()))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = [pa.array(x, t) for x, t in zip(zip(*out) if out else ((),) * 5, kinds)]
    return pa.Table.from_arrays(columns, [x.split(" ")[0] for x in ANSWER.split(", ")])


SET = "key long, n int, tokens binary, classes binary, prefix array<long>, short int, parities array<long>"


def _kept(percent: int):
    """The documents of a block that can have a partner, with their shared tokens in the first order.

    ``prefix`` are the shared tokens that a partner has one of, ``short`` how many of them do for larger partners.
    ``parities`` tell of each class of tokens whether their number is odd.
    """

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        a, b, c = (table.column(x) for x in "abc")
        keys = np.zeros(BLOCK_DOCS + 1, np.int64)
        sizes = np.zeros(BLOCK_DOCS + 1, np.int64)
        for i in np.flatnonzero(kinds == DOCS).tolist():
            at = np.frombuffer(b[i].as_py(), np.uint16)
            keys[at] = np.frombuffer(a[i].as_py(), np.int64)
            sizes[at] = np.frombuffer(c[i].as_py(), np.int32)
        rows: list[tuple] = []
        at = np.flatnonzero((kinds == TOKENS) | (kinds == OWN)).tolist()
        if at:
            told = np.flatnonzero(kinds == KNOWN).tolist()
            if told:
                known = np.concatenate([unpack(a[i].as_py()) for i in told])
                ranks = np.concatenate([np.frombuffer(c[i].as_py(), np.uint8) for i in told])
                order = np.argsort(known)
                known, ranks = known[order], ranks[order]
            parts = [unpack(a[i].as_py()) for i in at]
            index = np.concatenate([np.frombuffer(b[i].as_py(), np.uint16) for i in at])
            grade = np.concatenate(
                [
                    ranks[np.searchsorted(known, part)] if kinds[i] == OWN else np.frombuffer(c[i].as_py(), np.uint8)
                    for i, part in zip(at, parts)
                ]
            )
            tokens = np.concatenate(parts)
            shared = np.bincount(index, minlength=len(sizes))
            spare = shared - required(sizes, percent)
            short = np.maximum(shared - required_together(sizes, sizes, percent) + 1, 0)
            wanted = ((sizes > 0) & (spare >= 0))[index]
            tokens, index, grade = tokens[wanted], index[wanted], grade[wanted]
            order = np.lexsort((tokens, grade, index))
            tokens, index, grade = tokens[order], index[order], grade[order]
            starts = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1]))) if len(index) else []
            for s, e in zip(starts, np.append(starts[1:], len(index)) if len(index) else []):
                doc = index[s]
                first = tokens[s : s + spare[doc] + 1].view(np.int64)
                rows.append((keys[doc], sizes[doc], narrow(tokens[s:e]), grade[s:e].tobytes(), first, short[doc], _parities(tokens[s:e])))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64())]
        columns = [pa.array(x, t) for x, t in zip(zip(*rows) if rows else ((),) * 7, kinds)]
        return pa.Table.from_arrays(columns, ["key", "n", "tokens", "classes", "prefix", "short", "parities"])

    return run


def _parities(tokens: np.ndarray) -> np.ndarray:
    odd = np.bincount((tokens % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _other_orders(tokens: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
    """The shared tokens in the second and the third order."""
    second = np.lexsort((mix(tokens ^ _ORDER_SALTS[0]), classes))
    third = np.argsort(mix(tokens ^ _ORDER_SALTS[1]))
    return [tokens[second], tokens[third]]


def _verified(percent: int, all_pairs: bool):
    """(u, v, same, linked): tokens in common of pairs, and whether they are alike enough.

    Pairs that do not share prefix tokens in every order cannot be; they are left out, unless
    ``all_pairs`` asks for their common tokens as well. The prefixes are those that the two sizes ask for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            known: dict[int, tuple] = {}

            def opened(key: int, tokens: bytes, classes: bytes) -> tuple:
                if key not in known:
                    if len(known) > 200:
                        known.clear()
                    t = widen(tokens)
                    known[key] = np.sort(t), _other_orders(t, np.frombuffer(classes, np.uint8))
                return known[key]

            found = []
            for u, v, n, m, t, s, c, d in zip(*[rows[x] for x in ("u", "v", "un", "vn", "ut", "vt", "uc", "vc")]):
                (all_u, orders_u), (all_v, orders_v) = opened(u, t, c), opened(v, s, d)
                asked = required_together(n, m, percent)
                i, j = max(len(all_u) - asked + 1, 0), max(len(all_v) - asked + 1, 0)
                passed = all(_common(x[:i], np.sort(y[:j])) for x, y in zip(orders_u, orders_v))
                if passed or all_pairs:
                    same = _common(all_u, all_v)
                    found.append((u, v, same, passed and 100 * same >= percent * (n + m - same)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            columns = [pa.array(x, t) for x, t in zip(zip(*found) if found else ((),) * 4, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["u", "v", "same", "linked"])

    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """``_verified`` of pairs (u, v) of keys."""
    side = sets.select("key", "n", "tokens", "classes")
    u = side.withColumnsRenamed({"key": "u", "n": "un", "tokens": "ut", "classes": "uc"})
    v = side.withColumnsRenamed({"key": "v", "n": "vn", "tokens": "vt", "classes": "vc"})
    run = _verified(percent, all_pairs)
    both = pairs.join(u, "u").join(v, "v").select("u", "v", "un", "vn", "ut", "vt", "uc", "vc")
    return stored(both.mapInArrow(run, "u long, v long, same long, linked boolean"), "links")


def _open_pairs(
    sets: DataFrame, lists: DataFrame, centres: DataFrame, stars: DataFrame, found: DataFrame, percent: int
) -> DataFrame:
    """Pairs (u, v) of different components that share a list, of the smaller's short prefix, and can be alike.

    Of two documents of one size, the one of lower key counts as the smaller. At a token which ``at`` shared tokens
    of one precede, two sets have in common at most the lesser number before and the lesser number from there on.
    Each parity in which their shared tokens differ, and each token of one document only, is a token that just one has.

    With D the tokens in which a document differs from the centre of the list, x and y differ in
    |Dx| + |Dy| - 2 |Dx & Dy| tokens. A token that only x has is in Dx and not in Dy, so that with s
    the rest of D the last term is at most min(sx, sy). As integers, a is D and b is D - 2 s, times
    100 + percent, each less n times 100 - percent; x and y can be alike only if the b of the one with the smaller
    s and the a of the other are at most 0 together. Documents that cannot be so with any of their list leave
    it before pairs are made; the list is summed up for that in steps of s.
    """
    away = stars.select(F.col("u").alias("key"), F.col("v").alias("centre"), "same").unionByName(
        stars.select(F.col("v").alias("key"), F.col("u").alias("centre"), "same")
    )
    placed = lists.join(found, lists.key == found.node, "left").select(
        "token", "key", "n", "own", "at", "short", F.coalesce("component", "key").alias("component")
    )
    open_list = [F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("short").alias("asked")]
    spread = placed.groupBy("token").agg(*open_list).where("lo < hi and asked")
    spread = spread.select("token").join(centres, "token")
    rows = placed.join(spread, "token").join(away, ["key", "centre"], "left")
    apart = F.when(F.col("key") == F.col("centre"), 0).otherwise(F.col("n") + F.col("centre_n") - 2 * F.col("same"))
    rows = rows.withColumn("apart", apart).withColumn("s", F.col("apart") - F.col("own"))
    less = (100 - percent) * F.col("n")
    rows = stored(
        rows.select(
            "token", "key", "n", "own", "component", "s", "at", "short",
            (F.col("n") - F.col("own") - F.col("at")).alias("rest"),
            F.floor(8 * F.log2(F.col("s") + 1)).cast("int").alias("step"),
            ((100 + percent) * F.col("apart") - less).alias("a"),
            ((100 + percent) * (F.col("apart") - 2 * F.col("s")) - less).alias("b"),
        ),
        "open-lists",
    )
    steps = rows.groupBy("token", "step").agg(F.min("a").alias("a"), F.min("b").alias("b"))
    order = Window.partitionBy("token").orderBy("step")
    steps = steps.select(
        "token",
        "step",
        F.min("a").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("a_above"),
        F.min("b").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("b_below"),
    )
    left = rows.join(steps, ["token", "step"]).where("b + a_above <= 0 or a + b_below <= 0").drop("a_above", "b_below", "step")
    spread = left.groupBy("token").agg(*open_list).where("lo < hi and asked")
    left = left.join(spread.select("token"), "token")
    # A pair is made once, in the first of the lists that ask for it.
    shared = left.groupBy("key").agg(
        F.collect_list("token").alias("tokens"), F.collect_list(F.when(F.col("short"), F.col("token"))).alias("shorts")
    )
    words = [F.get("parities", i).alias(f"w{i}") for i in range(WORDS)]
    left = stored(left.join(shared, "key").join(sets.select("key", *words), "key"), "open-lists")
    # Of the component with most documents of a list only pairs with others are asked for.
    most = left.groupBy("token", "component").count().groupBy("token").agg(F.max_by("component", "count").alias("most"))
    left = left.join(most, "token")
    columns = ["key", "n", "own", "component", "s", "at", "rest", "a", "b", *[f"w{i}" for i in range(WORDS)]]
    larger = left.select("token", "most", *[F.col(c).alias(f"v_{c}") for c in [*columns, "tokens"]])
    smaller = left.where("short").select("token", *columns, "shorts", (F.col("component") == F.col("most")).alias("in_most"))
    odd = " + ".join(f"bit_count(w{i} ^ v_w{i})" for i in range(WORDS))
    can_be = (
        "component <> v_component and struct(n, key) < struct(v_n, v_key) "
        f"and 100 * n >= {percent} * v_n "
        "and ((s <= v_s and b + v_a <= 0) or (v_s <= s and v_b + a <= 0)) "
        f"and {100 + percent} * (least(at, v_at) + least(rest, v_rest)) >= {percent} * (n + v_n) "
        f"and {100 + percent} * (own + v_own + {odd}) <= {100 - percent} * (n + v_n) "
        "and token = array_min(array_intersect(shorts, v_tokens))"
    )
    outside = larger.where("v_component <> most")
    across = smaller.where("not in_most").join(larger, "token").where(can_be).select("key", "v_key")
    across = across.unionByName(smaller.where("in_most").join(outside, "token").where(can_be).select("key", "v_key"))
    pairs = across.select(F.least("key", "v_key").alias("u"), F.greatest("key", "v_key").alias("v"))
    return pairs.distinct().join(stars, ["u", "v"], "left_anti")


def similar_sets(docs: DataFrame, text: str, percent: int, local: int) -> DataFrame:
    """(node, component) of the keys of linked sets."""
    buckets = partitions(docs.sparkSession)
    asked = docs.select(text).mapInArrow(_blocks(buckets, local), ROW)
    answers = asked.groupBy("bucket").applyInArrow(_answered, ANSWER)
    sets = stored(answers.groupBy("block").applyInArrow(_kept(percent), SET), "sets")
    own = F.col("n") - F.octet_length("classes")
    lists = sets.select("key", "n", own.alias("own"), "short", F.posexplode("prefix").alias("at", "token"))
    lists = lists.withColumn("short", F.col("at") < F.col("short"))
    # The centre of a list has the fewest tokens of its own: in a group of copies, most likely the original.
    centre = F.struct((F.col("own") / F.col("n")).alias("share"), "key", "n")
    # A list that is in no short prefix asks for no pairs.
    centres = lists.groupBy("token").agg(F.min(centre).alias("c"), F.max("short").alias("asked")).where("asked")
    centres = centres.select("token", F.col("c.key").alias("centre"), F.col("c.n").alias("centre_n"))
    stars = lists.join(centres, "token").where("key <> centre")
    stars = stars.select(F.least("key", "centre").alias("u"), F.greatest("key", "centre").alias("v")).distinct()
    stars = _compared(stars, sets, percent, True)
    links = stars.where("linked").select("u", "v")
    found = stored(components(links), "components")
    more = _compared(_open_pairs(sets, lists, centres, stars, found, percent), sets, percent, False)
    return components(links.unionByName(more.where("linked").select("u", "v")))


def grouped(docs: DataFrame, columns: dict[str, Column], text: str = "text", percent: int = 80, local: int = 8) -> DataFrame:
    """``columns`` (not key, node, n or component) of every row, with n, its shingles, and component.

    Rows have one component if links (see ``joined``) connect them, whatever ids they have. It is
    NULL where there are no shingles.
    """
    members = docs.select(*[c.alias(name) for name, c in columns.items()], F.col(text).alias("member text"))
    kinds = [f"`{c}` {t}" for c, t in members.dtypes[:-1]]
    members = stored(members.mapInArrow(_members, ", ".join([*kinds, "key long, n long"])), "members")
    found = similar_sets(docs, text, percent, local)
    members = members.join(found, members.key == found.node, "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "key")).alias("component")
    return members.select(*columns, "n", component)


def joined(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, local: int = 8
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles and component_id.

    Two documents are linked if their sets of five-word shingles (A-Z as a-z; all words of a shorter
    text as one) are at least ``percent`` alike. component_id is the least id that links reach, the
    row's own included. NULL, empty and blank texts have no shingles and are linked with nothing.
    Repeated rows all stay. A row without id takes part; its component_id is NULL if no row of its
    component has an id. An empty table gives an empty result. Other columns are left out, and the
    id keeps its name.

    ``local``: how often a block has to hold a token for it to count as frequent; it changes the
    order of tokens and so the work, not the result.
    """
    members = grouped(docs, {"id": F.col(key).cast("long")}, text, percent, local)
    # Stored, so that the join below can be split where a component has a large part of all rows.
    least = members.where("n > 0").groupBy("component").agg(F.min("id").alias("component_id"))
    least = stored(least, "least")
    named = members.where("n > 0").join(least, "component").select("id", "n", "component_id")
    alone = members.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return named.unionByName(alone).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")
