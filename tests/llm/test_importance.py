import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from lakeq.llm import importance

DOCS = "doc_id long, text string, rank int, weight string, part int, nth int"


def features(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, n, buckets, percent, min_words):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, n)[1])
    t = Counter(bucket(f) for x in target for f in features(x, n)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, text in docs:
        words, grams = features(text, n)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in grams)
        rows.append((i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    order = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    draw = percent * len(order) // 100
    return Counter([(*r[:4], k + 1 if k < draw else None) for k, r in enumerate(order)]
                   + [(*r[:4], None) for r in rows if r[4] < min_words])


def texts(rng, n):
    vocabulary = ["Apfel", "baum", "c3po", "dé", "日本語", "e" * 40, "f" * 33, "g" * 32, "h" * 31, "ij", "k", "NUL\x00x", "a-b"]
    return [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_weights_and_ranks_equal_plain_ones(spark, n):
    rng = np.random.default_rng(n)
    docs = list(enumerate(texts(rng, 120)))
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, docs[9][1]), (500, None), (501, ""), (502, " \t-"), (503, "Zz " * 5000)]
    target = [*texts(rng, 10), None, ""]
    df = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs], DOCS).repartition(3)
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), n=n, buckets=97, percent=30)
    assert Counter(map(tuple, got.collect())) == plain(docs, target, n, 97, 30, 20)


def test_drawn_documents_keep_their_columns(spark):
    docs = [(i, f"{'ziel ' * i}rest " * 25, 1, "x", 2, 3) for i in range(1, 11)] + [(None, "rest " * 30, 1, "x", 2, 3)]
    df = spark.createDataFrame(docs, DOCS)
    ranked = importance.resample(df, spark.createDataFrame([("ziel " * 50,)], "text string"), percent=20)
    drawn = importance.drawn_documents(df, ranked)
    assert drawn.columns == df.columns
    wanted = {r.doc_id for r in ranked.where("rank is not null").collect()}
    assert len(wanted) == 2 and Counter(r.doc_id for r in drawn.collect()) == Counter(wanted)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    target = spark.createDataFrame([], "text string")
    assert importance.resample(none, target).collect() == []
    one = spark.createDataFrame([(1, "a b c", 1, "x", 2, 3)], DOCS)
    assert [r.rank for r in importance.resample(one, target).collect()] == [None]


def test_hash_and_table_tell_all_ngrams_apart():
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 50)).astype(np.uint8)) for _ in range(3000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    length = np.array([len(w) for w in words])
    end = np.cumsum(length + 1) - 1
    start = end - length
    h = importance.xxh64(data, importance._eights(data), start, end)
    assert h.tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    # Hashes that all agree: bytes alone must tell the n-grams apart.
    for hashes in (None, np.full(len(words), 5, np.uint64)):
        held = importance.Interned(data, start, end, 1000, hashes)
        assert [held.count[s] for s in held.slot] == [Counter(words)[w] for w in words]
        assert [held.bucket[s] for s in held.slot] == [zlib.crc32(w) % 1000 for w in words]
