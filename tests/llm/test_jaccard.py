import random

import numpy as np
import pytest

from lakeq.llm import jaccard, textvec
from tests.llm import brute


def texts(rng, n, vocab):
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            w = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w))
        else:
            out.append(" ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 8, 30, 90]))))
    return out


def expected(rows, k, percent):
    sets = [brute.shingles(t, k) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if brute.linked(sets[a], sets[b], percent)]
    comp = brute.groups(len(rows), pairs)
    least = {}
    for (i, _), c in zip(rows, comp):
        least[c] = min(least.get(c, i), i)
    return sorted((i, len(s), least[c]) for (i, _), s, c in zip(rows, sets, comp)), pairs, sets


@pytest.mark.parametrize("frequent_from,k,percent", [(2, 4, 85), (10_000, 2, 80)])
def test_components_equal_all_pairs(spark, monkeypatch, frequent_from, k, percent):
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", frequent_from)
    rng = random.Random(frequent_from)
    rows = list(enumerate(texts(rng, 150, [f"W{i}" for i in range(400)])))
    rows += [(900, None), (901, ""), (902, " \t\n "), (903, "one"), (904, "ONE"), (905, "é É"), rows[3], (906, rows[3][1])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, set_key string, n long")
    got = jaccard.join_documents(df.repartition(5), k, percent)
    want, pairs, sets = expected(rows, k, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.documents.collect()) == want
    assert len(pairs) > 30
    every = jaccard.join_documents(df, k, percent, every_link=True)
    found = {tuple(sorted((r.n_a, r.n_b))) + (r.n_shared,) for r in every.links.collect()}
    different = {tuple(sorted((len(sets[a]), len(sets[b])))) + (len(sets[a] & sets[b]),)
                 for a, b in pairs if sets[a] != sets[b]}
    assert found == different
    n_links = len({frozenset((sets[a], sets[b])) for a, b in pairs if sets[a] != sets[b]})
    assert every.links.count() == n_links


@pytest.mark.parametrize("frequent_from,k,percent", [(1, 4, 85), (10_000, 4, 85), (1, 5, 80), (10_000, 5, 80)])
def test_set_within_a_set_one_token_larger(spark, monkeypatch, frequent_from, k, percent):
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", frequent_from)
    rows = []
    for n in range(1, 22):
        for side in range(2):
            w = [f"n{n}s{side}w{i}" for i in range(n + k - 1)]
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(["more", *w] if side else [*w, "more"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, pairs, _ = expected(rows, k, percent)
    assert len(pairs) == 2 * len([n for n in range(1, 22) if 100 * n >= percent * (n + 1)])
    got = jaccard.join_documents(df, k, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.documents.collect()) == want
    assert jaccard.join_documents(df, k, percent, every_link=True).links.count() == len(pairs)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(0)
    met = 0
    for _ in range(4000):
        universe = rng.integers(0, 2**63, 400, dtype=np.uint64)
        x = np.unique(rng.choice(universe, int(rng.integers(2, 200)), replace=False))
        y = np.delete(x, rng.choice(len(x), int(rng.integers(0, len(x) // 5 + 1)), replace=False))
        y = np.unique(np.concatenate((y, rng.integers(0, 2**63, int(rng.integers(0, len(x) // 12 + 2)), dtype=np.uint64))))
        percent, share = int(rng.choice([80, 85, 90])), int(rng.integers(0, 1001))
        shared = len(np.intersect1d(x, y))
        if 100 * shared < percent * (len(x) + len(y) - shared) or len(x) == len(y) == shared:
            continue
        signed = [jaccard.signatures(s, textvec.mix(s) % np.uint64(1000) < np.uint64(share), percent) for s in (x, y)]
        assert len(np.intersect1d(*signed))
        assert jaccard.may_link(jaccard.bitmap(x), jaccard.bitmap(y), len(x), len(y), percent)
        met += 1
    assert met > 1000


def test_bitmaps_rule_out_unlike_sets():
    rng = np.random.default_rng(1)
    x, y = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (520, 500))
    assert not jaccard.may_link(jaccard.bitmap(x), jaccard.bitmap(y), len(x), len(y), 80)


def test_large_group_of_near_copies(spark, monkeypatch):
    """A third of the rows are near copies of one text: one component, few comparisons."""
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", 16)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(600):
        if i % 3 == 0:
            w = list(base)
            w[rng.randrange(120)] = f"n{i}"
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(40))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    joined = jaccard.join_documents(df, 4, 85)
    comp = {r.doc_id: r.component_id for r in joined.documents.collect()}
    assert {comp[i] for i in range(0, 600, 3)} == {0}
    assert all(comp[i] == i for i in range(600) if i % 3)
    assert joined.links.count() < 200 * 20


def spread_copies(rng, m, changed, words=200):
    """Near copies of one text, each with its own words at ``changed`` places."""
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(m):
        w = list(base)
        for at in rng.sample(range(words), changed):
            w[at] = f"n{rng.randrange(50)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("changed,group,tile", [(2, 2, 7), (4, 48, 256), (4, 2, 256)])
def test_near_copies_with_spread_changes_equal_all_pairs(spark, monkeypatch, changed, group, tile):
    """Many components, within and beyond the groups that are paired one by one."""
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(changed)
    rows = spread_copies(rng, 90, changed, 100)
    rows += [(100 + i, t.replace("b", "c")) for i, t in spread_copies(rng, 40, changed + 1, 100)]
    want, _, _ = expected(rows, 4, 85)
    got = jaccard.join_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4, 85)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.documents.collect()) == want


def test_comparisons_grow_with_the_copies(spark, monkeypatch):
    """Three times the near copies: about three times the pairs that are looked at."""
    seen = []
    for name in ("_prefix_pairs", "_prefixes"):
        def counted(*args, made=getattr(jaccard, name)):
            out = made(*args)
            seen.append(out.count())
            return out
        monkeypatch.setattr(jaccard, name, counted)
    for m in (300, 900):
        df = spark.createDataFrame(spread_copies(random.Random(m), m, 5), "doc_id long, text string")
        jaccard.join_documents(df.repartition(4), 4, 85)
    assert seen[0] and seen[2] <= 5 * seen[0] + 1000 and seen[3] <= 5 * seen[1] + 1000, seen


def test_first_of_components(spark):
    rows = [(5, "a b c d e f"), (2, "A b c d e f"), (5, "other words in this one text"), (None, "a b c d e f"),
            (7, None), (7, None), (8, ""), (2, "A b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS stays", "2 AS nth", "3 AS listed_id")
    kept = jaccard.first_of_components(df, jaccard.join_documents(df))
    assert kept.columns == df.columns and {tuple(r)[2:] for r in kept.collect()} == {(1, 2, 3)}
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted(
        [(2, "A b c d e f"), (5, "other words in this one text"), (7, None), (7, None), (8, "")], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    joined = jaccard.join_documents(df)
    assert joined.documents.count() == 0 and joined.links.count() == 0
    assert jaccard.first_of_components(df, joined).count() == 0
