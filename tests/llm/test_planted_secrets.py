"""Recall on planted secrets and ordinary identifiers left alone, with models trained on the corpus itself."""

import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
WORDS = ["request", "handler", "stream", "buffer", "parser", "value", "config", "session", "account", "index", "manager", "service", "update", "version"]


@pytest.fixture(scope="module")
def model(spark):
    from skyfare.llm import secrets

    return secrets.train(secrets.labelled_samples(spark.read.parquet(f"{SF}/documents.parquet")))


def texts(seed):
    """(text, secrets in it): bare, in paths, in joined names, in long runs, and without any."""
    r = random.Random(seed)

    def key(n, letters=BASE62):
        while True:
            k = "".join(r.choice(letters) for _ in range(n))
            if any(c.isdigit() for c in k) and any(c.isupper() for c in k):
                return k

    def words(n, mark):
        return mark.join(r.choice(WORDS) for _ in range(n))

    out = []
    for _ in range(60):
        for n in (24, 32, 40):
            k = key(n)
            out.append((f"the key {k} works", [k]))
            out.append((f"see /srv/{words(3, '/')}/{k}/{words(2, '/')} there", [k]))
            out.append((f"{words(8, '_')}_{k}", [k]))
            out.append((f"é {words(4, '-')}-{k}-{words(9, '-')}.", [k]))
        k = key(40, BASE62 + "+/")
        out.append((f"set {k} now", [k]))
    plain = [words(r.randint(2, 12), r.choice("/_-")) for _ in range(300)] + [f"{w}{v.title()}{x.title()}" for w in WORDS for v in WORDS for x in WORDS[:3]]
    return out, [f"a {p} b" for p in plain]


def scanned(spark, model, lines):
    from skyfare.llm import secrets

    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(lines)], "doc_id long, text string, `base spans` string, `More Spans` int")
    rows = secrets.scanned(df, model)
    assert rows.columns == [*df.columns, "secrets"]
    rows = rows.withColumn("clean", secrets.redacted(F.col("text"), F.col("secrets.spans"))).collect()
    assert all((r["base spans"], r["More Spans"]) == ("x", 1) for r in rows)
    return {r.doc_id: r for r in rows}


def test_recall_and_precision(spark, model):
    planted, plain = texts(3)
    got = scanned(spark, model, [t for t, _ in planted] + plain)
    missed = [t for i, (t, keys) in enumerate(planted) for k in keys if k in got[i].clean or k[6:-6] in got[i].clean]
    touched = [t for i, t in enumerate(plain, len(planted)) if got[i].secrets.spans]
    print(len(missed), len(planted), len(touched), len(plain))
    assert len(missed) <= 0.1 * len(planted)
    assert len(touched) <= 0.02 * len(plain)
    # what is around a secret stays: no span is much longer than what it was made of
    wide = [s for i, (t, keys) in enumerate(planted) for s in got[i].secrets.spans if s.kind == 3 and s.end - s.start > len(keys[0]) + 12]
    assert len(wide) <= 0.03 * len(planted)


def test_long_ordinary_runs_are_not_one_secret(spark, model):
    k = "q7Rk2ZtV9mXw4LpB8sNc3HdY"
    lines = ["request_handler_session_account_config_service_manager_index_" + k, "/".join(WORDS * 20) + "/" + k, "_".join(WORDS * 700)]
    got = scanned(spark, model, lines)
    for i in range(2):
        assert k not in got[i].clean and "handler" in got[i].clean
        assert sum(s.end - s.start for s in got[i].secrets.spans) <= len(k) + 12
    assert got[2].secrets.spans == []


def test_without_labelled_secrets_or_ids(spark):
    from skyfare.llm import secrets

    r = random.Random(5)
    keys = ["".join(r.choice(BASE62) for _ in range(26)) for _ in range(40)]
    plain = [" ".join(r.choice(WORDS) + "_" + r.choice(WORDS) for _ in range(20)) for _ in range(80)]
    rows = [(None, f"{p} {k}") for p, k in zip(plain, keys)] + [(None, p) for p in plain[40:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.train(secrets.labelled_samples(docs))
    got = secrets.scanned(docs, model).collect()
    hit = sum(any(s.kind == 3 for s in x.secrets.spans) for x in got[:40])
    assert hit >= 36, hit
    none = secrets.train(secrets.labelled_samples(spark.createDataFrame([], docs.schema)))
    assert all(not x.secrets.spans for x in secrets.scanned(docs, none).collect())
