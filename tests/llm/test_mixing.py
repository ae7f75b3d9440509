from collections import Counter

from lakeq.llm import mixing
from tests.llm import brute


def test_counts_equal_the_inverse_distribution(spark):
    rows = [(i, "x" * (i % 50), ["a", "a", "b", None, "empty"][i % 5] if i % 5 < 4 else "empty") for i in range(500)]
    rows = [(i, "" if s == "empty" else t, s) for i, t, s in rows] + [(None, "abc", "b"), rows[7], (9999, None, "a")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, copy int").repartition(3)
    weights = {"a": 1.0, "b": 6.0}
    got = mixing.mix_sources(df, weights, default_weight=0.5, budget=1.5, seed=3)
    assert got.columns == ["doc_id", "text", "source", "n_copies", "copy"]
    rate = brute.rates([(s, t) for _, t, s in rows], weights, 0.5, 1.5)
    want = Counter()
    for i, t, s in rows:
        n = brute.poisson_copies(3, i, rate[s])
        for c in range(1, n + 1):
            want[(i, t, s, n, c)] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_shares_reach_the_weights(spark):
    df = spark.createDataFrame([(i, "x" * 10, "hot" if i % 3 else f"s{i % 4}") for i in range(20_000)],
                               "doc_id long, text string, source string")
    n = dict(mixing.mix_sources(df, {"hot": 2.0}, seed=1).groupBy("source").count().collect())
    assert abs(n["hot"] / sum(n.values()) - 2 / 6) < 0.02 and abs(sum(n.values()) - 20_000) < 600


def test_large_means_and_empty_table(spark):
    for mean in (190.0, 250.0, 2000.0, 6e7):
        first, cdf = mixing.poisson_cdf(mean)
        assert abs(first + (cdf <= 0.5).sum() - mean) <= 1 and abs(cdf[-1] - 1) < 1e-9 and len(cdf) < 24 * mean**0.5 + 90
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string"), {}).collect() == []


def test_a_tiny_source_makes_many_copies_in_chunks(spark):
    rows = [(i, "x" * 1000, "hot") for i in range(300)] + [(900, "tiny text", "tiny"), (901, "small te", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix_sources(df, {}, seed=5)
    rate = brute.rates([(s, t) for _, t, s in rows], {}, 1.0)
    assert rate["tiny"] > 5 * mixing.CHUNK
    for doc in (900, 901):
        copies = sorted(r["copy"] for r in got.where(f"doc_id = {doc}").collect())
        assert copies == list(range(1, len(copies) + 1)) and abs(len(copies) - rate["tiny"]) < 6 * rate["tiny"] ** 0.5


def test_columns_with_the_names_of_steps_stay(spark):
    names = ["mix_source", "mix_cdf", "mix_rate", "mix_u", "mix_n", "mix_chunk", "mix_order"]
    df = spark.createDataFrame([(i, "text", "s", *[float(i)] * 7) for i in range(30)],
                               "doc_id long, text string, source string, " + ", ".join(f"{n} double" for n in names))
    got = mixing.mix_sources(df, {}, seed=2)
    assert got.columns == [*df.columns, "n_copies", "copy"]
    rows = got.collect()
    assert rows and all(r[n] == float(r.doc_id) for r in rows for n in names)
