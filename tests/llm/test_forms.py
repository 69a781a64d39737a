"""The Jaccard join on texts made from one form: no link lost, few pairs compared."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402


def forms(rows, fillings, seed=3, places=3, words=104):
    """(id, text) of one form with words changed at ``places`` places, each to one of ``fillings``."""
    r = random.Random(seed)
    form = [f"form{i}" for i in range(words)]
    out = []
    for i in range(rows):
        text = list(form)
        for at in r.sample(range(words), places):
            text[at] = f"fill{r.randrange(fillings)}"
        out.append((i, " ".join(text)))
    return out


def compared(spark, monkeypatch, rows, local=8):
    """What the join finds and how many pairs of sets it opens: with centres, and besides."""
    from skyfare.llm import ngram_join

    pairs, before = [], ngram_join._compared

    def counted(asked, *rest):
        pairs.append(asked.count())
        return before(asked, *rest)

    monkeypatch.setattr(ngram_join, "_compared", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.joined(df, local=local).collect()}
    monkeypatch.undo()
    return found, pairs


@pytest.mark.parametrize("fillings, local", [(1, 8), (1, 2), (10, 8), (200, 8)])
def test_texts_of_one_form(spark, monkeypatch, fillings, local):
    rows = forms(300, fillings)
    found, (centres, besides) = compared(spark, monkeypatch, rows, local)
    assert found == brute.linked(rows)
    assert centres + besides < 300 * 299 / 2 / 15


def test_forms_of_different_lengths(spark, monkeypatch):
    # Sizes differ, so that the short prefix of the smaller meets the long one of the larger.
    r = random.Random(8)
    rows = []
    for i, text in forms(240, 4, places=2):
        words = text.split(" ")
        rows.append((i, " ".join(words[r.randrange(8) : len(words) - r.randrange(10)] + [f"end{r.randrange(5)}"] * r.randrange(3))))
    found, _ = compared(spark, monkeypatch, rows)
    assert found == brute.linked(rows)
