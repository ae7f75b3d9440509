import numpy as np
import pytest

from lakeq.llm import langid, learn, quality, queries

SF = "/root/testdata/sf0.01"


def test_quality_of_held_out_documents(spark):
    got = queries.op7_quality_classifier(spark, SF).cache()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or score is null").count() == 0
    rows = got.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert len(good) > 20 and len(bad) > 5
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert (good >= 0.3).mean() > 0.97
    assert got.where("predicted <> cast(score >= 0.3 as int)").count() == 0


def test_quality_edges(spark):
    docs = spark.createDataFrame(
        [(i, "good words here " * 5 if i % 2 else "BAD!! BAD!! " * 5, "s") for i in range(40)]
        + [(50, None, "s"), (51, "", "s"), (52, "x" * 300_000, "s"), (None, "good words", "s"), (1, "good words here", "s")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1), (3, 0), (None, 1), (5, None), (7, 4)],
                                   "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model, out="q")
    assert got.columns == ["doc_id", "text", "score", "q"] and got.count() == docs.count()
    score = {r.doc_id: r.q for r in got.collect()}
    assert score[9] > 0.5 > score[10] and score[50] == score[51]
    assert quality.score(docs, model).columns == ["doc_id", "text", "score"]
    assert quality.score(docs.limit(0), model).collect() == []
    for some in (labels.limit(0), labels.where("quality = 1"), labels.where("quality = 0")):
        alike = {r.q for r in quality.score(docs, quality.train(docs, some), out="q").collect()}
        assert len(alike) == 1 and 0 <= alike.pop() <= 1


def test_sample_is_bounded_and_follows_no_partitioning(spark):
    rows = spark.createDataFrame([(i, 0 if i % 3 else 1) for i in range(3000)], "doc_id long, target int")
    a = {r.doc_id for r in learn.sample_ids(rows.repartition(7), 50).collect()}
    assert a == {r.doc_id for r in learn.sample_ids(rows.coalesce(1), 50).collect()} and len(a) == 100


def test_language_of_held_out_documents(spark):
    got = queries.op10_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and np.mean([r.lang_pred == r.lang for r in held]) > 0.98


def test_language_edges(spark):
    train = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog were in the house", "en"), ("der Hund und die Katze waren im Haus", "de")] * 20)]
    docs = spark.createDataFrame([*train, (90, "unknown language", None), (None, "the house", "en")],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs)
    ask = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "123 !?", "a"), (4, "THE DOG AND THE CAT", "a"),
                                 (5, "die katze und der hund " * 20_000, "a"), (5, "é", "a"), (6, "Ωμέγα", "a")],
                                "doc_id long, text string, score string")
    got = {(r.doc_id, (r.text or "")[:1]): r for r in langid.identify(ask, model).collect()}
    assert [got[k].lang_pred for k in ((1, ""), (2, ""), (3, "1"), (4, "T"), (5, "d"))] == ["und"] * 3 + ["en", "de"]
    assert got[(1, "")].score == 0.0 and got[(1, "")].ambiguous and got[(6, "Ω")].lang_pred in ("en", "de")
    assert langid.identify(ask.limit(0), model).collect() == []
    none = langid.identify(ask, langid.train(docs.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    one = langid.identify(ask, langid.train(docs.where("lang = 'en'")))
    assert {r.lang_pred for r in one.collect()} == {"und", "en"}


@pytest.mark.parametrize("k", [2, 3, 4, 6, 7, 40])
def test_codewords_differ(k):
    codes = langid.codewords(k)
    apart = (codes[:, None] != codes[None]).sum(2)[~np.eye(k, dtype=bool)]
    assert apart.min() >= (1 if k < 3 else 2 if k == 3 else 4)
    assert all(len(set(c)) == 2 for c in codes.T)


def test_folds_are_crc32_of_the_text(spark):
    import zlib
    df = spark.createDataFrame([(i,) for i in [0, 7, 123456, -3, None]], "doc_id long")
    got = {r.doc_id: r.f for r in df.select("doc_id", learn.fold("doc_id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 for i in got}
