import random

import pytest
from pyspark.sql import functions as F

from lakeq.llm import line_dedup
from tests.llm import brute


def check(spark, rows, min_words):
    df = spark.createDataFrame([(i, t, t, "x") for i, t in rows], "doc_id long, text string, n_removed string, pos string")
    df = df.withColumn("seq", F.xxhash64("doc_id", "text")).repartition(3)
    want = brute.copied_lines([(r.doc_id, r.seq, r.text) for r in df.collect()], min_words)
    got = line_dedup.drop_copied_lines(df.withColumnRenamed("n_removed", "before"), min_words).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.before is None:
            assert r.text is None and r.n_lines == 0 and r.n_removed == 0
        else:
            after = want[(r.doc_id, r.seq, r.before)]
            assert r.text == after and r.n_lines == r.before.count("\n") + 1
            if after:
                assert r.n_removed == r.n_lines - after.count("\n") - 1
    return got


@pytest.mark.parametrize("seed,vocab,min_words", [
    (1, ["a", "b b", "c c c"], 6), (2, ["a", "b b", "c c c", "d d d d", "", "e e"], 9)])
def test_equals_longest_earlier_match(spark, seed, vocab, min_words):
    rng = random.Random(seed)
    rows = []
    for i in range(16):
        rows.append((i, "\n".join(rng.choice(vocab) for _ in range(rng.randint(0, 14)))))
        if rng.random() < 0.5:
            src = rng.choice(rows)[1].split("\n")
            a = rng.randint(0, len(src))
            rows.append((i + 100 if rng.random() < 0.7 else i, "\n".join([*src[a:rng.randint(a, len(src))], rng.choice(vocab)])))
    assert sum(r.n_removed for r in check(spark, [*rows, (3, None), rows[0]], min_words)) > 10


def test_passage_of_many_documents(spark):
    """A passage of over 50 words, in many documents, stays once; shorter repeats stay."""
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(20)) for i in range(3))
    rows = [(i, f"own line {i}\n{passage}\nshort shared line") for i in range(60)]
    got = {r.doc_id: r for r in check(spark, rows, 50)}
    assert got[0].text == rows[0][1]
    # The short line follows the passage, so it belongs to the same maximal run.
    assert all(got[i].text == f"own line {i}" for i in range(1, 60))
    lone = check(spark, [(i, f"own line {i}\nshort shared line") for i in range(9)], 50)
    assert all(r.n_removed == 0 for r in lone)


def test_overlapping_runs_and_long_text(spark):
    long_text = "\n".join(f"line {i % 7} of a long text" for i in range(3000))
    got = {r.doc_id: r for r in line_dedup.drop_copied_lines(
        spark.createDataFrame([(1, long_text), (2, "x y z\r\n")], "doc_id long, text string"), 50).collect()}
    assert got[1].text.split("\n") == [f"line {i} of a long text" for i in range(7)]
    assert got[2].text == "x y z\r\n" and got[2].n_lines == 2


def test_null_ids_and_empty_table(spark):
    line = " ".join(["w"] * 60)
    df = spark.createDataFrame([(None, line), (4, line), (4, ""), (9, line)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.drop_copied_lines(df).collect()), key=str)
    assert (None, line) in got and (9, "") in got and (4, "") in got
    none = line_dedup.drop_copied_lines(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == [] and none.columns == ["doc_id", "text", "n_lines", "n_removed"]


def test_null_ids_take_part(spark):
    one, two = ("\n".join(f"{name}{i} of a passage" for i in range(6)) for name in ("one", "two"))
    rows = [(None, f"own\n{one}"), (5, f"{one}\nown too"), (None, f"{two}\nfirst"), (None, f"{two}\nsecond")]
    got = line_dedup.drop_copied_lines(spark.createDataFrame(rows, "doc_id long, text string"), 20)
    texts = sorted((str(r.doc_id), r.text) for r in got.collect())
    assert ("5", "own too") in texts and ("None", f"own\n{one}") in texts
    assert sum(two in t for _, t in texts) == 1
    assert len([t for _, t in texts if t in ("first", "second")]) == 1


def test_many_runs_of_one_document_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "THIN_ROWS", 2)
    parts = [f"p{i} a b c d e f g" for i in range(3)]
    df = spark.createDataFrame([(1, "\nx\n".join(parts)), (2, "\ny\n".join(parts))], "doc_id long, text string")
    got = line_dedup.drop_copied_lines(df, 8)
    assert "broadcast" not in got._jdf.queryExecution().analyzed().toString().lower()
    assert {r.doc_id: r.text for r in got.collect()}[2] == "y\ny"


def test_columns_with_the_names_of_steps_stay(spark):
    text = "\n".join(f"line {i} of a long passage" for i in range(20))
    df = spark.createDataFrame([(1, text, 1, 2, 3, 4), (2, text, 5, 6, 7, 8)],
                               "doc_id long, text string, run_doc int, run_seq int, runs int, own_seq int")
    got = line_dedup.drop_copied_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.run_doc, r.run_seq, r.runs, r.own_seq, r.n_removed) for r in got.collect()) == [
        (1, 1, 2, 3, 4, 0), (2, 5, 6, 7, 8, 20)]
