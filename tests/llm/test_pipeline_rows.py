"""The pipeline's stages on rows without id, text, language or source, repeated rows and clashing columns."""

import os
import random
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

SF = "/root/testdata/sf0.001"
#: Columns beyond those of documents, called as the operators call theirs.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, component string, quality string, kept boolean, secrets string, shard int, cluster string, tie long, `base spans` string"
)
EXTRA = (1, "x", "good", False, "none", 0, "y", 7, "spans")


def prose(r, n):
    return " ".join(r.choice("alder birch cedar elm fir hazel larch maple oak pine rowan willow".split()) + f"{r.randrange(400)}" for _ in range(n))


def documents():
    r = random.Random(5)
    rows = [(i, prose(r, r.randrange(60, 160)), r.choice(["en", "de", None]), r.choice(["news", "wiki", None])) for i in range(60)]
    rows += [(None, prose(r, 90), "en", "news") for _ in range(25)]
    rows += [(7, prose(r, 90), "de", "wiki") for _ in range(10)]
    copy = prose(r, 120)
    rows += [(None, copy, "en", None)] * 5 + [(900, copy, "de", "wiki"), (901, copy + " end", None, None)]
    key = 'password = "hunter2hunter2"'
    rows += [(950, prose(r, 60) + " " + key, "en", "news"), (None, prose(r, 6000), "en", "wiki")]
    rows += [(960, None, "en", "news"), (960, None, "en", "news"), (961, "", None, None), (None, " \n\t", None, None), (None, None, None, None)]
    return [(*x, len(x[1]) if x[1] is not None else None) for x in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, *EXTRA) for d in documents()], SCHEMA).repartition(3)


def counted(df):
    import corpus_pipeline as pipeline

    return Counter(tuple(r) for r in df.select(*pipeline.COLUMNS).collect())


def test_quality_drops_rows_without_enough_words(spark, docs):
    import corpus_pipeline as pipeline

    out = counted(pipeline.quality_rules(spark, docs, SF))
    assert not out - Counter(documents())
    assert all(len(brute.WORD.findall(t or "")) >= 50 for _, t, *_ in out)
    assert any(i is None for i, *_ in out)


def test_one_row_of_each_group_stays(spark, docs):
    import corpus_pipeline as pipeline

    rows = documents()
    groups = brute.linked([(n, t) for n, (_, t, *_) in enumerate(rows)])
    out = counted(pipeline.near_duplicates(spark, docs, SF))
    assert not out - Counter(rows)
    kept = Counter(t for _, t, *_ in out.elements())
    by = {}
    for n, (i, t, *_) in enumerate(rows):
        by.setdefault(groups[n][1] if groups[n][0] else ("alone", n), []).append((i is None, i or 0, t))
    assert sum(out.values()) == len(by)
    assert kept == Counter(min(g, key=lambda x: x[:2])[2] for g in by.values())


def test_secrets_leave_all_rows(spark, docs):
    import corpus_pipeline as pipeline

    rows = documents()
    out = counted(pipeline.secret_scans(spark, docs, SF))
    assert sum(out.values()) == len(rows)
    safe = Counter(d for d in rows if d[1] is not None and not brute.secret_spans(d[1]))
    assert not safe - out
    assert all("hunter2" not in (t or "") for _, t, *_ in out)
    assert all(n == (None if t is None else len(t)) for _, t, _, _, n in out)


def test_drawn_tokens_meet_the_budget(spark, docs):
    import corpus_pipeline as pipeline

    rows = documents()
    out = counted(pipeline.source_mix(spark, docs, SF))
    assert not out - Counter(rows)
    tokens = sum(len(brute.WORD.findall(t or "")) for _, t, *_ in out.elements())
    every = sum(len(brute.WORD.findall(t or "")) for _, t, *_ in rows)
    assert 0 < tokens <= every


def test_packing_places_every_token(spark, docs):
    import corpus_pipeline as pipeline

    rows = documents()
    out = pipeline.packed_bins(spark, docs, SF).collect()
    words = Counter()
    for i, t, *_ in rows:
        words[i] += len(brute.WORD.findall(t or ""))
    placed = Counter()
    for p in out:
        placed[p.doc_id] += p.n_tokens
    assert placed == words
    assert sum(p.bin_id is None for p in out) == sum(not brute.WORD.findall(t or "") for _, t, *_ in rows)


def test_whole_pipeline(spark, docs, tmp_path):
    import corpus_pipeline as pipeline

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(p.bin_id is not None for p in out)
    assert out[0].__fields__ == [c.split()[0] for c in pipeline.packing.PLACED.split(", ")]
