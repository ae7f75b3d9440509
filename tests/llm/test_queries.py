from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from lakeq.llm import line_dedup, packing, quality, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(found.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_line_dedup_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("seq", line_dedup._sequence_id("doc_id", "text"))
    want = brute.copied_lines([(r.doc_id, r.seq, r.text) for r in docs.collect()], 50)
    got = queries.op1_line_dedup(spark, SF).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for (i, _, _), t in want.items())
    assert sum(r.n_removed for r in got) > 10


def test_packing_query_covers_every_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op3_best_fit_packing(spark, SF).collect()
    held = Counter()
    for r in got:
        held[r.doc_id] += r.n_words
    assert held == Counter({r.doc_id: len(brute.words(r.text)) for r in docs})


def test_pipeline_equals_its_plain_version(spark):
    """Every stage against a plain version on its own input (of the classifier: its
    scores taken one text at a time)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_jaccard_join", "poisson_mixing", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality_classifier"](spark, docs, SF).cache()
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [r for r in docs.collect() if model.score(pa.array([r.text]))[0] >= 0.3]
    assert kept.columns == columns and sorted(kept.collect()) == sorted(good) and 0 < len(good) < docs.count()

    deduped = stages["line_dedup"](spark, kept, SF).cache()
    seq = kept.withColumn("seq", line_dedup._sequence_id("doc_id", "text"))
    plain = brute.copied_lines([(r.doc_id, r.seq, r.text) for r in seq.collect()], 50)
    want = Counter((i, t) for (i, _, before), t in plain.items() if t.strip() or t == before)
    assert deduped.columns == columns and Counter((r.doc_id, r.text) for r in deduped.collect()) == want
    assert all(r.n_chars == len(r.text) for r in deduped.collect())

    single = stages["ngram_jaccard_join"](spark, deduped, SF).cache()
    rows = deduped.orderBy("doc_id").collect()
    sets = [brute.shingles(r.text, 5) for r in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if brute.linked(sets[a], sets[b], 80)]
    first = {}
    for r, c in zip(rows, brute.groups(len(rows), pairs)):
        first.setdefault(c, r)
    assert single.columns == columns and sorted(single.collect()) == sorted(first.values())

    mixed = stages["poisson_mixing"](spark, single, SF).cache()
    rate = brute.rates([(r.source, r.text) for r in single.collect()], queries.SOURCE_WEIGHTS, 1.0)
    copies = Counter({r: brute.poisson_copies(queries.MIX_SEED, r.doc_id, rate[r.source]) for r in single.collect()})
    assert mixed.columns == columns and Counter(mixed.collect()) == +copies

    packed = stages["best_fit_packing"](spark, mixed, SF).collect()
    lengths, words = [], Counter()
    for r in mixed.collect():
        n = len(brute.words(r.text))
        words[r.doc_id] += n
        lengths += [4096] * (n // 4096) + [n % 4096] * (n % 4096 > 0)
    held = Counter()
    for r in packed:
        held[r.doc_id] += r.n_words
    assert held == words
    bins = {r.bin_id for r in packed if r.bin_id is not None}
    assert len(bins) == len(brute.best_fit(lengths, queries.CAPACITIES, packing.sequence_cost))
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "piece", "n_words").collect()) == Counter(
        (r.doc_id, r.piece, r.n_words) for r in packed)


def test_stages_take_odd_rows(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None, "a"), (1, "", "en", "src0", 0, "b"), (1, "", "en", "src0", 0, "b"),
         (2, "x " * 30_000, "en", None, 60_000, "c"), (3, " \n\n ", None, "s", 4, "d"), (3, "other text", "en", "s", 10, "e")],
        "doc_id long, text string, lang string, source string, n_chars long, n_removed string")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "best_fit_packing":
                assert out.columns == odd.columns
            docs = out.cache()
            assert docs.count() >= 0
