"""Fingerprints against a plain version: shingles hashed one by one, bins and borrowing in plain loops."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

LOW64 = (1 << 64) - 1


def scrambled(x):
    from skyfare.llm.words import mix

    return int(mix(np.array([x & LOW64], np.uint64))[0])


def shingle_hash(shingle):
    from skyfare.llm import words

    total = 0
    for place, word in enumerate(shingle):
        data = word.encode()
        h = sum(int(words._BYTE[b]) * pow(words._BASE, i, 1 << 64) for i, b in enumerate(data))
        total += scrambled(h ^ len(data) * 0xD6E8FEB86659FD93) * int(words._PLACE[place])
    return scrambled(total + (len(shingle) if len(shingle) < 5 else 0))


def fingerprint(text):
    from skyfare.llm import fingerprints as f

    held: dict[int, int] = {}
    for shingle in brute.shingles(text):
        h = shingle_hash(shingle)
        held[h * f.BINS >> 64] = min(h, held.get(h * f.BINS >> 64, LOW64))
    if not held:
        return ""
    out = []
    for b in range(f.BINS):
        lender = b if b in held else next(int(p) for p in f._PROBES[b] if int(p) in held)
        out.append(scrambled(held[lender] + int(f._SALTS[b])) % (1 << f.BITS))
    return "".join(f"{v:x}" for v in out)


def alike(a, b):
    if not a or not b:
        return float(a == b)
    same = sum(x == y for x, y in zip(a, b)) / len(a)
    return min(1.0, max(0.0, (same - 1 / 16) / (15 / 16)))


def texts():
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(80)] + ["Ärger", "日本語", "UPPER", "a b", "🙂"]
    rows = [" ".join(r.choices(vocabulary, k=n)) for n in (1, 2, 4, 5, 6, 9, 40, 300, 900)]
    rows += [rows[7], rows[7].upper(), rows[7].replace(" ", "\n\t"), rows[8] + " more"]
    return rows + ["", " \n", None, "x" * 5000, "only one " * 400]


@pytest.mark.parametrize("parts", [1, 5])
def test_bins_and_likeness(spark, parts):
    from skyfare.llm.fingerprints import edited_by_next

    rows = list(enumerate(texts()))
    got = edited_by_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in rows:
        text, after = text or "", rows[i - 1][1] or ""
        cut = len(text) // 3
        own, edited = fingerprint(text), fingerprint(text[: len(text) - cut] + after[:cut])
        assert (by[i].fingerprint, by[i].edited_fingerprint) == (own, edited)
        assert by[i].near_edited == pytest.approx(alike(own, edited))
        assert by[i].near_next == pytest.approx(alike(own, fingerprint(after)))


def test_every_empty_bin_asks_all_bins():
    from skyfare.llm import fingerprints as f

    assert all(sorted(p) == list(range(f.BINS)) for p in f._PROBES.tolist())
