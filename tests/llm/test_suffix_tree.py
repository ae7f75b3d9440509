import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeq.llm import suffix_tree

DOCS = "doc_id long, text string, block int, sums string, kind int, words long"


def plain(docs, depth, min_count, min_gain, prior, folds=7, held_out=2, whole=False):
    """The same tree with dictionaries of word tuples. Returns rows and the retained contexts."""
    cut = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % folds != held_out,
            [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]) for i, t in docs]
    n = Counter()
    for _, training, w in cut:
        for order in range(1, depth + 2):
            n.update(tuple(w[i:i + order]) for i in range(len(w) - order + 1) if training)
    total = sum(c for g, c in n.items() if len(g) == 1)
    distinct = sum(len(g) == 1 for g in n)
    kept = set()

    def p(w, i, longest):
        q = (n[(w[i],)] + 1) / (total + distinct + 1)
        for order in range(1, longest + 1):
            s = tuple(w[max(0, i - order):i])
            if len(s) == order and s in kept:
                q = (n[(*s, w[i])] + prior * q) / (n[s] + prior)
        return q

    for order in range(1, depth + 1):
        gain = defaultdict(float)
        for _, training, w in cut:
            for i in range(order, len(w)):
                s = tuple(w[i - order:i])
                if training and n[s] >= min_count:
                    q = p(w, i, order - 1)
                    gain[s] += math.log((n[(*s, w[i])] - 1 + prior * q) / (n[s] - 1 + prior) / q)
        kept |= {s for s, g in gain.items() if g > min_gain}
    rows = [(i, not training, len(w), sum(n[(x,)] > 0 for x in w), total,
             sum(math.log10((n[(x,)] + 1) / (total + distinct + 1)) for x in w),
             sum(math.log10(p(w, k, depth)) for k in range(len(w)))) for i, training, w in cut]
    return (rows, kept, p, [g[0] for g in n if len(g) == 1]) if whole else (rows, kept)


def sentences(rng, n):
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.integers(0, 12)):
            words += {0: ["der", "grosse", "Hund"], 1: ["der", "kleine", "hund"], 2: ["ein", "grosse", "baum"],
                      3: [str(rng.integers(40))], 4: ["und"]}[int(rng.integers(5))]
        out.append(" ".join(words))
    return out


def check(got, want):
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_scores_equal_plain_scores(spark, monkeypatch, depth):
    monkeypatch.setattr(suffix_tree, "BLOCK", 300)
    rng = np.random.default_rng(depth)
    docs = list(enumerate(sentences(rng, 150)))
    docs += [(3, docs[3][1]), (None, docs[4][1]), (600, None), (601, ""), (602, " \n"), (603, "UNSEEN unseen"), (604, "und " * 3000)]
    df = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs], DOCS).repartition(3)
    want, kept = plain(docs, depth, 4, 1.0, 2.0)
    assert {len(s) for s in kept} == set(range(1, depth + 1))
    check(suffix_tree.score(df, depth, min_count=4, min_gain=1.0, prior=2.0).collect(), want)


def test_states_help_on_held_out_texts(spark):
    docs = list(enumerate(sentences(np.random.default_rng(9), 400)))
    got = suffix_tree.score(spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs], DOCS)).where("held_out").collect()
    assert len(got) > 30 and sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)


def test_probabilities_of_a_state_sum_to_one():
    """Over all symbols seen in training and one that stands for every unseen word."""
    _, kept, p, vocabulary = plain(list(enumerate(sentences(np.random.default_rng(4), 100))), 2, 4, 0.5, 3.0, whole=True)
    assert len(kept) > 5
    for s in kept:
        assert sum(p([*s, a], len(s), len(s)) for a in [*vocabulary, "unseen"]) == pytest.approx(1)


def test_empty_table_and_no_training_texts(spark):
    assert suffix_tree.score(spark.createDataFrame([], DOCS)).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = suffix_tree.score(spark.createDataFrame([(held, "a b", 1, "x", 2, 3)], DOCS)).collect()
    assert [tuple(r) for r in got] == [(held, True, 3, 0, 0, 0.0, 0.0)]
