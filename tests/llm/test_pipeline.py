"""The pipeline, stage by stage, against plain versions on the smallest tables."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    import corpus_pipeline as pipeline
    from skyfare.llm import mixing, quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*pipeline.COLUMNS).collect()]
    outputs = []
    for number, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        outputs.append(docs)
    good, alone, clean, drawn = ([tuple(r) for r in d.select(*pipeline.COLUMNS).collect()] for d in outputs[:4])

    judged = brute.quality([(i, t, lang, s) for i, t, lang, s, _ in rows], quality.LEAST_SPREAD)
    assert sorted(good) == sorted(r for r in rows if judged[r[0]][1])
    groups = brute.linked([(i, t) for i, t, *_ in good])
    assert sorted(alone) == sorted(r for r in good if groups[r[0]][1] == r[0])

    assert sorted(r[0] for r in clean) == sorted(r[0] for r in alone)
    before = {r[0]: r[1] for r in alone}
    for i, text, _, _, n_chars in clean:
        assert n_chars == len(text)
        assert bool(brute.secret_spans(before[i])) <= ("[secret]" in text)
        assert not [s for s in brute.secret_spans(text) if s[1] != 0]
    weights = [mixing.WEIGHTS["domain"], mixing.WEIGHTS["language"], {}]
    paths = [(i, t, (mixing.DOMAINS.get(s, "curated"), lang, s)) for i, t, lang, s, _ in clean]
    assert sorted((r[0], 0) for r in drawn) == brute.mixed(paths, weights, 0.6, 1)

    words = {i: len(brute.WORD.findall(t)) for i, t, *_ in drawn}
    source = {i: s for i, _, _, s, _ in drawn}
    packed: dict[int, int] = {}
    bins: dict[str, list] = {}
    for p in outputs[4].collect():
        packed[p.doc_id] = packed.get(p.doc_id, 0) + p.n_tokens
        bins.setdefault(p.bin_id, []).append((p.n_tokens, source[p.doc_id]))
    assert packed == words
    assert all(sum(n for n, _ in held) <= 2048 and len({s for _, s in held}) == len(held) for held in bins.values())
    assert sorted(map(tuple, pipeline.run(spark, SF).collect()), key=str) == sorted(map(tuple, outputs[4].collect()), key=str)


def test_empty_tables(spark):
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
