"""Quality estimates of small groups against a plain version without a least size."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402


def documents(small):
    """200 plain documents of two sources, ``small`` clean ones in capitals of a third, and one of junk in a fourth."""
    r = random.Random(small)
    words = ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(3, 8))) for _ in range(400)]

    def prose():
        return " ".join(r.choice(words) + r.choice(["", "", "", ",", ".\n"]) for _ in range(r.randint(60, 150)))

    rows = [(i, prose().capitalize(), "en", f"plain{i % 2}") for i in range(200)]
    rows += [(1000 + i, prose().upper(), "en", "capitals") for i in range(small)]
    return [*rows, (5000, " ".join(w + "!#$%!" for w in words[:90]).upper(), "en", "junk")]


def test_small_sources_are_judged_by_their_own_rows(spark):
    from skyfare.llm import quality

    for small in (8, 40, 99):
        rows = documents(small)
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
        got = {x.doc_id: x.quality.kept for x in quality.judged(df, ["doc_id"]).collect()}
        assert got == {i: kept for i, (_, kept) in brute.quality(rows, quality.LEAST_SPREAD).items()}
        assert all(got[1000 + i] for i in range(small)), small
        assert not got[5000]


def test_estimates_do_not_depend_on_how_rows_are_dealt(spark):
    from skyfare.llm import quality

    rows = documents(40)
    names = "doc_id long, text string, lang string, source string, `quality counts` int, `quality g1` int, centre int, g1 string, model int"
    df = spark.createDataFrame([(*r, 1, 2, 3, "g", 4) for r in rows], names)
    got = []
    for dealt in (df.repartition(1), df.repartition(7).orderBy("text")):
        out = quality.judged(dealt)
        assert set(out.columns) == {*df.columns, "quality"}
        got.append({x.doc_id: (x.quality.kept, round(x.quality.distance, 9)) for x in out.collect()})
        assert all(tuple(x)[4:9] == (1, 2, 3, "g", 4) for x in out.collect())
    assert got[0] == got[1]


def test_chi_square():
    from skyfare.llm import quality

    for share in (0.1, 0.5, 0.9):
        assert abs(quality.chi2_quantile(1 - share, 6) - brute.chi2_at(share, 6)) < 1e-3
        assert abs(quality.chi2_share(5.0 * share, 8) - brute.chi2_below(5.0 * share, 8)) < 1e-6
    assert quality.consistency(1.0) == 1.0 and 1.7 < quality.consistency(0.5) < 1.9


def test_a_step_never_raises_the_determinant(spark):
    """From starts spoiled by a third of odd rows, the estimate is that of the others."""
    import numpy as np

    from skyfare.llm import quality

    r = np.random.default_rng(2)
    good = r.normal(0, 0.3, (200, quality.DIMENSIONS))
    odd = r.normal(4, 0.1, (90, quality.DIMENSIONS))
    rows = [("a", "b", x.tolist()) for x in np.vstack([good, odd])]
    model = quality.fit(spark.createDataFrame(rows, "g1 string, g2 string, at array<double>").repartition(3), parent_rows=0).collect()
    assert len(model) == 1 and np.abs(np.array(model[0].centre)).max() < 0.15
    centre, s, _ = brute.least_determinant(np.vstack([good, odd]), np.array(quality.LEAST_SPREAD))
    assert np.allclose(model[0].centre, centre)
