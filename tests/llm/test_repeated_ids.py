"""Rows that share an id or have none: each is judged by its own text."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

SCHEMA = "doc_id long, text string, place string, tie string"


def prose(r, n):
    return " ".join(f"w{r.randrange(40_000)}" for _ in range(n))


def in_order(spark, rows):
    """Distinct rows as the operator orders them: by id, without id last, then by a hash of the text."""
    df = spark.createDataFrame([(*x, "p", "t") for x in rows], SCHEMA)
    tie = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 63) - 1))
    unnamed = tie.bitwiseAND(F.lit((1 << 62) - 1))
    found = df.select("doc_id", "text", tie.alias("h"), unnamed.alias("u")).distinct().collect()
    found.sort(key=lambda x: (x.doc_id is None, x.doc_id if x.doc_id is not None else x.u, x.h))
    return df, [(x.doc_id, x.text) for x in found]


@pytest.mark.parametrize("some", ["unique", "shared", "hot"])
def test_repeated_strings_of_rows_with_one_id(spark, some):
    from skyfare.llm.suffix_dedup import deduplicated

    r = random.Random(len(some))
    passage, other = prose(r, 60), prose(r, 80)
    rows = [(1, passage), (5, passage), (5, prose(r, 100)), (None, other), (None, passage + " " + other), (3, None), (3, "")]
    if some == "shared":
        rows += [(5, prose(r, 20) + " " + passage), (5, passage), (2, other), (2, other + " x"), (None, other)]
    if some == "hot":
        rows += [(9, prose(r, r.randint(10, 60)) + (" " + passage if i % 5 == 0 else "")) for i in range(80)]
    df, ordered = in_order(spark, rows)
    numbered = brute.without_repeats(list(enumerate(t for _, t in ordered)))
    expected = [
        (i, *numbered[n]) for n, (i, t) in enumerate(ordered) for _ in range(rows.count((i, t)))
    ]
    got = [tuple(x)[:5] for x in deduplicated(df.repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def drawn(spark, rows, share=0.6, epochs=1):
    """(rows drawn, tokens of all, tokens of the rows drawn, largest row) with one leaf."""
    from skyfare.llm.mixing import mixed

    df = spark.createDataFrame(rows, "doc_id long, text string, epoch string").repartition(3)
    out = [tuple(r) for r in mixed(df, {"a": F.lit("x"), "b": F.lit("y")}, {}, share, epochs).collect()]
    words = [len(brute.WORD.findall(t or "")) for _, t, _ in rows]
    return out, sum(words), sum(len(brute.WORD.findall(r[1] or "")) for r in out), max(words)


@pytest.mark.parametrize("share", [0.0, 0.3, 0.6, 1.0])
@pytest.mark.parametrize("kind", ["no ids", "one id", "equal rows", "mixed"])
def test_budgets_are_met_without_ids(spark, kind, share):
    r = random.Random(len(kind))
    if kind == "equal rows":
        rows = [(None, "a b c", "e")] * 100
    else:
        rows = [({"no ids": None, "one id": 7, "mixed": r.choice([None, 7, i])}[kind], prose(r, r.randint(0, 30)), "e") for i in range(100)]
        rows += rows[:20] + [(None, None, "e"), (None, "", "e")]
    out, total, got, largest = drawn(spark, rows, share)
    budget = int(total * share)
    assert budget - largest < got <= budget
    assert all(out.count(x) <= rows.count((*x[:2], "e")) for x in set(out))


def test_epochs_without_ids(spark):
    rows = [(None, f"w{i % 10} x", "e") for i in range(50)]
    out, total, got, largest = drawn(spark, rows, 2.5, 3)
    assert int(total * 2.5) - largest < got <= int(total * 2.5)
    assert sum(e == 0 for *_, e in out) == sum(e == 1 for *_, e in out) == 50
