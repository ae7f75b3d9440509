import random
from collections import Counter, defaultdict

from lakeq.llm import packing
from tests.llm import brute


def test_plan_equals_placing_one_by_one():
    rng = random.Random(4)
    for _ in range(60):
        capacities = sorted(rng.sample(range(4, 40), rng.randint(1, 4)))
        lengths = [rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 120))]
        if rng.random() < 0.4:
            lengths += [lengths[0]] * 50
        planned = packing.plan(Counter(lengths), capacities)
        held = Counter()
        for capacity, b in planned:
            words = sum(x * n for x, n in b.held)
            assert capacity == next(c for c in capacities if c >= words)
            for x, n in b.held:
                held[x] += n * b.count
        assert held == Counter(lengths)
        # Bins with equal room are alike to best-fit, so the rooms tell whether it did the same.
        assert sorted(b.room for _, b in planned for _ in range(b.count)) == brute.best_fit(
            lengths, capacities, packing.sequence_cost)


def test_every_word_has_its_place(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * (7 if i % 3 == 0 else rng.randint(0, 90)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, "a b"), rows[4], rows[4], (1003, "w " * 500)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bin_id string").repartition(4)
    got = packing.pack(df, (8, 16, 32)).collect()
    want = Counter()
    for i, t in rows:
        n = len(brute.words(t))
        for piece in range(max(1, -(-n // 32))):
            want[(i, piece, piece * 32, min(32, n - piece * 32))] += 1
    assert Counter((r.doc_id, r.piece, r.start_word, r.n_words) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        if r.n_words:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r.bin_at):
            assert r.bin_at == at
            at += r.n_words
        assert {(r.bin_words, r.bin_capacity) for r in held} == {(at, next(c for c in (8, 16, 32) if c >= at))}
    lengths = [n for (_, _, _, n), c in want.items() for _ in range(c) if n]
    assert len(bins) == len(brute.best_fit(lengths, (8, 16, 32), packing.sequence_cost))


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
