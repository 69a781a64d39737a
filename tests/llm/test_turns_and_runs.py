"""Conversation repair, SimHash near-duplicates and periodic runs against plain versions."""

import hashlib
import itertools
import os
import random
import sys
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

SF = "/root/testdata/sf0.001"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- conversations ----------------------------------------------------------


def faults(turns):
    """First faults of (role, text) in order."""
    seen, out = set(), []
    for role, text in turns:
        ink = [c for c in text if c not in " \t\n\v\f\r"]
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, audit, repaired turns) by trying, at each turn, all edits; the least of (cost, audit) is kept by state."""
    good = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    now = {"": (0, "", ())}

    def insert(states):
        todo = sorted(states.items())
        while todo:
            at, (cost, audit, out) = todo.pop()
            for name in ("user", "assistant"):
                if name[0] in good[at]:
                    new = (cost + 5, audit + "I", (*out, (name, "")))
                    if name[0] not in states or new < states[name[0]]:
                        states[name[0]] = new
                        todo.append((name[0], new))

    for (role, text), fault in zip(turns, faults(turns)):
        insert(now)
        then = {}

        def offer(at, new):
            if at not in then or new < then[at]:
                then[at] = new

        for at, (cost, audit, out) in now.items():
            offer(at, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            stays = 5 * (fault == "truncated")
            if role[:1] in good[at]:
                offer(role[:1], (cost + stays, audit + "K", (*out, (role, text))))
            for name in ("user", "assistant"):
                if name[0] in good[at]:
                    offer(name[0], (cost + stays + 1, audit + "R", (*out, (name, text))))
        now = then
    insert(now)
    return min(v for k, v in now.items() if k in ("", "a"))


def told(turns):
    """What op11 tells of the (turn, role, text) of one conversation, in order."""
    numbers = [t for t, _, _ in turns if t is not None]
    pairs = [(r, x) for _, r, x in turns]
    found = faults(pairs)
    cost, audit, out = cheapest(pairs)
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    text = "\n".join(f"{r}:{x}" for r, x in out)
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def in_order(turns):
    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repair_rows(seed, n):
    r = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", "Well!", "So?", "é.", "a\tb"]
    return [
        (r.choice([1, 1, 1, 2, 3, None]), r.choice([*range(40), None]), r.choice(["user", "assistant", "system", "tool", ""]), r.choice(texts) + r.choice(["", str(r.randrange(9)) + "."]))
        for _ in range(n)
    ]


def repaired(df):
    from skyfare.llm.turn_repair import hashed
    from skyfare.llm.turn_repair import repaired as run

    turns, rows = run(df)
    hashes = {r.conv: r.repaired_sha256 for r in hashed(turns).collect()}
    out = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv, EMPTY_SHA)) for r in rows.collect()}
    return out, turns


@pytest.mark.parametrize("seed,n,width", [(1, 30, "4"), (2, 200, "4"), (3, 400, "13"), (4, 5, "2")])
def test_repair_of_conversations(spark, seed, n, width):
    rows = repair_rows(seed, n)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, edit int").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)  # more ranges: conversations in several segments
    try:
        got, turns = repaired(df)
        kept = turns.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r, x))
    assert got == {c: told(in_order(t)) for c, t in by.items()}
    for c, t in by.items():
        done = sorted((k.place, k.step, k.edit, k.role, k.text) for k in kept if k.conv == c)
        _, audit, out = cheapest([(r, x) for _, r, x in in_order(t)])
        assert [(r, x) for *_, r, x in done] == list(out)
        assert "".join(e for _, _, e, _, _ in done) == audit.replace("D", "")


def test_repair_of_runs_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(7, None if i % 9 == 0 else i, "user" if i < 300 else "assistant", "Again." if i % 2 else f"{i}!") for i in range(600)]
    got, _ = repaired(spark.createDataFrame(rows, schema))
    assert got == {7: told(in_order([r[1:] for r in rows]))}
    got, turns = repaired(spark.createDataFrame([], schema))
    assert got == {} and turns.collect() == []
    got, turns = repaired(spark.createDataFrame([(1, 1, None, None)], schema))
    assert got == {1: (0, 1, 0, 0, 0, 2, "D", EMPTY_SHA)} and turns.collect() == []


def test_products_of_runs():
    from skyfare.llm import turn_repair as tr

    for symbol, n in itertools.product(range(9), (1, 2, 3, 7, 12)):
        one = tr.power(symbol, 0)
        slow = one
        for _ in range(n - 1):
            slow = tr.times(slow, one)
        assert tr.product([(symbol, n)]) == slow
    for symbols in itertools.product((0, 2, 3, 4, 6, 8), repeat=4):
        names = {0: ("system", "."), 2: ("user", "."), 3: ("user", "x"), 4: ("assistant", "."), 6: ("tool", "."), 8: ("user", "")}
        turns = [(names[s][0], names[s][1] and f"{i}{names[s][1]}") for i, s in enumerate(symbols)]
        codes, _ = tr.unrolled(tr.encoded(list(symbols)), tr.END, tr.BEFORE, True)
        assert codes.translate(str.maketrans("UAua", "RRII")) == cheapest(turns)[1]


def test_op11_over_conversations(spark):
    from skyfare.llm.queries import op11_conversation_repair

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = {r[0]: [] for r in rows}
    for c, *t in damaged(rows):
        by[c].append(tuple(t))
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, SF).collect()}
    assert got == {c: told(in_order(t)) if t else (0, 0, 0, 0, 0, 0, "", EMPTY_SHA) for c, t in by.items()}


def test_op11_with_nulls(spark, tmp_path):
    from skyfare.llm.queries import op11_conversation_repair

    rows = [(c, t, None if t == 2 else "user", None if t == 1 else f"text {t}.") for c in (1, 2, None) for t in (*range(12), None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    by = {r[0]: [] for r in rows}
    for c, *t in damaged(rows):
        by[c].append(tuple(t))
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: told(in_order(t)) for c, t in by.items()}


# --- fingerprints -----------------------------------------------------------


def simhash(text):
    words = [w.translate(brute.LOWER) for w in brute.WORD.findall(text or "")]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(prints, most=4):
    """Component of each position: the least position reached."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= most:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_near_duplicates(spark):
    from test_documents import texts

    from skyfare.llm.gray_index import near_duplicates

    rows = [(None if i % 17 == 5 else 3 * i % 101, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id long, text string, fingerprint string, id int").repartition(3)
    prints = [simhash(t) for _, t in rows]
    parts = near(prints)
    ids = {}
    for (i, _), p in zip(rows, parts):
        if i is not None:
            ids[p] = min(i, ids.get(p, i))
    expected = [(i, f"{h:016x}", ids.get(p)) for (i, _), h, p in zip(rows, prints, parts)]
    assert sorted(map(tuple, near_duplicates(df).collect()), key=repr) == sorted(expected, key=repr)
    assert near_duplicates(spark.createDataFrame([], df.schema)).collect() == []


@pytest.mark.parametrize("group_rows", [20, 60, 10_000])
def test_links_of_dense_groups(spark, group_rows):
    from skyfare.llm.components import components
    from skyfare.llm.gray_index import near_links

    r = random.Random(group_rows)
    prints = set()
    for _ in range(4):
        centre = r.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in range(r.randint(0, 9)):
                x ^= 1 << r.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    links = near_links(df, group_rows=group_rows, batch_rows=50)
    assert all(bin((u ^ v) & (1 << 64) - 1).count("1") <= 4 for u, v in links.collect())
    found = {row.node: row.component for row in components(links).collect()}
    parts = near(prints)
    groups = {}
    for x, p in zip(signed, parts):
        groups.setdefault(p, set()).add(found.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


# --- runs -------------------------------------------------------------------


def runs(words, least=24, periods=3):
    """All maximal stretches of each period, less those of a smaller one."""
    number = {}
    x = np.array([number.setdefault(w, len(number)) for w in words])
    out = []
    for q in range(1, len(x) // periods + 1):
        same = np.concatenate(([False], x[q:] == x[:-q], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            n = e - s + q
            if n >= max(least, periods * q) and not any((x[s : s + n - p] == x[s + p : s + n]).all() for p in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def without(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("least,periods", [(4, 2), (6, 3), (24, 3)])
def test_runs_of_words(least, periods):
    from skyfare.llm.periodic_runs import runs_of

    r = random.Random(least)
    for _ in range(300):
        words = [r.randrange(r.choice([1, 2, 3, 8])) for _ in range(r.randint(0, 50))]
        at = r.randint(0, len(words))
        words[at:at] = words[: r.randint(0, 6)] * r.randint(0, 12)
        assert runs_of(words, least, periods) == runs(words, least, periods)


def periodic_texts(seed=11, n=150):
    r = random.Random(seed)
    out = [None, "", " \n\t", "a " * 23, "a " * 24, "é b " * 40, "x y\n" * 12, "a b c d e f g h " * 3, "long " * 20_000]
    for _ in range(n):
        words = [f"w{r.randrange(r.choice([2, 5, 300]))}" for _ in range(r.randint(0, 150))]
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(words))
            words[at:at] = words[: r.randint(0, 25)] * r.randint(0, 8)
        out.append(r.choice([" ", "\n", "\t "]).join(words))
    return out


def test_runs_in_texts(spark):
    from skyfare.llm.periodic_runs import with_runs

    rows = list(enumerate(periodic_texts()))
    df = spark.createDataFrame([(*r, "x", [1]) for r in rows], "doc_id long, text string, runs string, periodic array<int>").repartition(3)
    out = with_runs(df)
    assert sorted(out.columns) == sorted(df.columns)
    texts = dict(rows)
    for row in out.collect():
        words = brute.WORD.findall(texts[row.doc_id] or "")
        expected = runs(words) if len(words) < 2000 else [(0, len(words), 1)]
        assert [tuple(x) for x in row.periodic.runs] == expected
        assert row.periodic.collapsed == without(words, expected)
    assert with_runs(spark.createDataFrame([], df.schema)).collect() == []


def test_op13_over_documents(spark):
    from skyfare.llm.queries import op13_periodic_runs

    got = {r.doc_id: tuple(r)[1:] for r in op13_periodic_runs(spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    some = 0
    for i, text in rows:
        words = brute.WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        found = runs(words) if n < 3000 else None
        if found is None:
            continue
        some += len(found)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        assert got[i] == (
            len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(without(words, found).encode()).hexdigest(),
        )
    assert some


def test_op13_without_ids(spark, tmp_path):
    from skyfare.llm.queries import op13_periodic_runs

    rows = [(None, "a b " * 30, 1), (7, None, 2), (8, "", 3), (8, "", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r)[:6] for r in op13_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(None, 1, 0, 60, 2, 30000), (7, 0, None, None, None, None), *[(8, 0, None, None, None, None)] * 2], key=repr)
