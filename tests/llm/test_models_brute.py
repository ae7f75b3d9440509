"""Both text models against plain versions of their features, steps and decoding."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lakeq.llm import langid, quality, textvec
from tests.llm import brute_models as plain

TEXTS = ["", " ", "a", "ab  ab ab", "one two three\tfour\n", "é ü", "  lead and trail  ", "x" * 50, "Same same same", "\x0b1 2"]


@pytest.mark.parametrize("cut", [1, 30, 1 << 20])
def test_quality_features_are_those_of_each_text(cut, monkeypatch):
    monkeypatch.setattr(textvec.slices, "__defaults__", (cut,))
    got = []
    for at, end, data, offs in textvec.slices(pa.array(TEXTS)):
        found = list(quality.features(data, offs))
        got += [sorted(np.concatenate([textvec.row_values(b, to, n, r) for b, to, n in found]).tolist())
                for r in range(end - at)]
    assert got == [sorted(plain.quality_features(t)) for t in TEXTS]


def _sentences(words, n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(3, 12))) for _ in range(n)]


def test_quality_scores_equal_plain_training(monkeypatch):
    monkeypatch.setattr(quality, "MIN_STEPS", 60)
    good = _sentences("clear useful words about rivers and their stones".split(), 9, 1)
    bad = _sentences("BUY now!!! cheap cheap w1n $$$ click".split(), 6, 2)
    train = [(t, 1) for t in good] + [(t, 0) for t in bad]
    model = quality.fit([y for _, y in train], pa.chunked_array([pa.array([t for t, _ in train])]))
    ask = [*TEXTS, *_sentences("clear cheap words click stones".split(), 8, 3), good[0], bad[0]]
    got = model.score(pa.array(ask))
    assert np.allclose(got, plain.quality_scores(train, ask, 60), atol=2e-4)
    assert got[-2] > 0.5 > got[-1]


def test_language_features_are_those_of_each_text():
    got = []
    low = [t.lower() for t in TEXTS]
    for at, end, data, offs in textvec.slices(pa.array(low)):
        flat, to = langid.squeezed(data, offs)
        found = [(textvec.ngrams(flat, n, langid.BITS), n) for n in langid.SIZES]
        got += [sorted(np.concatenate([textvec.row_values(b, to, n, r) for b, n in found]).tolist()) for r in range(end - at)]
    assert got == [sorted(plain.language_features(t)) for t in TEXTS]


@pytest.mark.parametrize("k", [2, 3, 4])
def test_languages_equal_plain_training_and_decoding(k):
    words = [["the", "river", "and", "stone"], ["der", "fluss", "und", "stein"], ["le", "fleuve", "et", "pierre"],
             ["rzeka", "kamień", "oraz", "góra"]]
    train = [(t, "defp"[i]) for i in range(k) for t in _sentences(words[i], 6, i)]
    model = langid.fit([lang for _, lang in train], pa.chunked_array([pa.array([t for t, _ in train])]))
    ask = _sentences(sum(words, []), 12, 9) + ["stone und pierre"]
    best, p, gap = model.decode(model.margins(pa.array(ask)))
    want = plain.languages(train, ask)
    assert [model.langs[b] for b in best] == [w[0] for w in want]
    assert np.allclose(p, [w[1] for w in want], atol=2e-3) and np.allclose(gap, [w[2] for w in want], atol=2e-3)
