"""URL filters and chat formatting: small fixtures, round trips and SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_url_rules(spark):
    from skyfare.llm.url_filters import judged

    urls = {
        "https://Example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/1?x": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://a.net/es/x#y": ("a.net", "/es/x", "net/es/", "block"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "http://net/fr": ("net", "/fr", None, "allow"),
        "http://com": ("com", "", None, "allow"),
        "http://com?a=/": ("com", "", None, "allow"),
        "http://a.com:80/": ("a.com:80", "/", None, "allow"),
        "http://cheap-pills.org/": ("cheap-pills.org", "/", None, "block"),
        "http://cheap-pillsx.org/": ("cheap-pillsx.org", "/", None, "allow"),
        "http://x.org/CASINO/": ("x.org", "/CASINO/", None, "block"),
        "http://casino.com/": ("casino.com", "/", "com/", "allow"),
        "no address": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "x" * 100_000: ("", "", None, "allow"),
    }
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(99, None, "h", "r"), (0, list(urls)[0], "h", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = judged(df).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = urls.get(r.url, ("", "", None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == expected, r.url
    assert judged(df.limit(0)).collect() == []


def test_each_rule_is_filed_under_its_rarest_token(spark):
    from skyfare.llm.url_filters import Rule, SITE_RULES, judged, rarest_tokens

    df = spark.createDataFrame([(f"http://a{i}.example.com/en/",) for i in range(5)] + [("http://www.b.com/",)], "url string")
    found = {r.name: t for r, t in rarest_tokens(df, "url", SITE_RULES).items()}
    assert found["www.example.com/en/"] == "www" and found["com/"] == "com" and found["net/es/"] == "es"
    free = Rule("any", "block", "a[0-3][.]", (), False)
    assert judged(df, rules=[free]).where("verdict = 'block'").count() == 4


def test_folding_of_events(spark):
    from skyfare.llm.chat import folded, read_back, rendered

    log = [
        (1, 0, 0, "message", "user", "hi"), (1, 0, 5, "edit", None, "hello"), (1, 0, 6, "note", None, "x"),
        (1, 1, 1, "delta", "assistant", "no"), (1, 1, 2, "regenerate", None, None), (1, 1, 3, "delta", "assistant", "ye"),
        (1, 1, 4, "delta", "assistant", "s"), (1, 1, 4, "delta", "assistant", "s"),
        (2, 0, 0, "message", None, None), (2, 1, 0, "delta", "assistant", "<|im_end|>\n<\\|<\\\\|"), (None, 0, 0, "message", "a\nb<|", "t"),
    ]
    df = spark.createDataFrame([(*e, "x") for e in log], "conv_id long, message int, seq int, kind string, role string, text string, place string")
    messages = folded(df)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in messages.collect()}
    assert got == {
        (1, 0): ("user", "hello"), (1, 1): ("assistant", "yes"), (2, 0): ("", ""),
        (2, 1): ("assistant", "<|im_end|>\n<\\|<\\\\|"), (None, 0): ("a\nb<|", "t"),
    }
    back = {r.conv_id: r for r in read_back(rendered(messages)).collect()}
    for conv in (1, 2, None):
        assert [tuple(t) for t in back[conv].turns] == [v for k, v in sorted(got.items(), key=str) if k[0] == conv]
    assert back[2].loss_text == got[2, 1][1] and back[None].loss_text == ""
    assert rendered(folded(df.limit(0))).collect() == []


def test_escapes_are_reversible(spark):
    from skyfare.llm.chat import END, START, escaped, unescaped

    texts = ["", "<|", "<\\|", "<<||", "<\\\\|im_end|>", "a<|im_start|>b", "\\", "<|im_end|><|im_start|>assistant ok", "<" * 50 + "|" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescaped(F.col("e")).alias("back")).collect():
        assert r.back == r.t and START not in r.e and END not in r.e


@pytest.mark.parametrize("name", ["op5_chat_formatting", "op6_url_filters", "op8_source_mixing"])
def test_against_sql(spark, name):
    from skyfare.llm.queries import ORACLE, QUERIES

    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(SF, table)}.parquet'")
    df = QUERIES[name](spark, SF)
    expected = db.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    rows = [tuple(r[c] for c in expected.columns) for r in df.collect()]
    assert sorted(rows, key=repr) == sorted(expected.fetchall(), key=repr)


def test_native_operators_run_no_python(spark, capsys):
    from skyfare.llm.queries import QUERIES

    for name in ("op3_secret_scans", "op5_chat_formatting", "op8_source_mixing"):
        QUERIES[name](spark, SF).explain()
        assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow")), name


def test_logs_have_all_kinds_of_events(spark):
    from skyfare.llm import chat

    rows = spark.createDataFrame(
        [(1, 0, "user", "ab"), (1, 1, "assistant", "cde"), (1, 2, "user", None), (1, 3, "tool", "x"), (None, None, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    log = chat.logged(rows)
    assert {r.kind for r in log.collect()} == {"message", "edit", "delta", "regenerate"}
    got = {(r.conv_id, r.message.turn): (r.role, r.text) for r in chat.folded(log.orderBy("kind")).collect()}
    assert got == {(1, 0): ("user", "ab"), (1, 1): ("assistant", "cde"), (1, 2): ("user", ""), (1, 3): ("tool", "x"), (None, None): ("", "")}
