"""Registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.llm import (
    html_text,
    importance,
    jaccard,
    langid,
    learn,
    line_dedup,
    mixing,
    near_vectors,
    packing,
    quality,
    suffix_tree,
    topk,
    url_filter,
    vector_codes,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Packing: permitted sequence lengths, in words.
CAPACITIES = (512, 1024, 2048, 4096)

# Mixing: weights of sources in the mix; all others have weight 1.
SOURCE_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0, "src3": 0.5}
MIX_SEED = 17

# URL filter: host and path rules, then words that block a host.
URL_RULES = (
    url_filter.host_rule("com", "/", "allow"),
    url_filter.host_rule("example.com", "/en/", "block"),
    url_filter.host_rule("www.example.com", "/en/", "allow"),
    url_filter.host_rule("net", "/es/", "block"),
    url_filter.host_rule("net", "/fr/", "block"),
)
BLOCKED_HOST_WORDS = ("adult", "ads-track", "casino", "cheap-pills", "free-bets", "spam-farm")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of later copies of runs of 50 words or more."""
    return line_dedup.drop_copied_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_lines", "n_removed")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bins."""
    return packing.pack(_table(spark, sf_dir, "documents"), CAPACITIES)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products for every 50th vector, over all vectors."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document in the mix."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, seed=MIX_SEED)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under Jaccard >= 0.85 of 4-word shingles."""
    docs = _table(spark, sf_dir, "documents")
    return jaccard.join_documents(docs, k=4, percent=85).documents.select("doc_id", "n_shingles", "component_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and decision of every document; labels of the held-out fold
    (crc32 of the id modulo 5 = 0) are not learned from."""
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(learn.fold("doc_id", 5) != 0)
    model = quality.train(docs, labels)
    thin = docs.select("doc_id", "text", (learn.fold("doc_id", 5) == 0).alias("held_out"))
    return quality.score(thin, model).select(
        "doc_id", "held_out", "score",
        F.when(F.col("score") >= quality.KEEP_FROM, 1).otherwise(0).alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the held-out fold (crc32 of the id modulo 4 = 2)
    is not learned from."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(learn.fold("doc_id", 4) != 2))
    thin = docs.select("doc_id", "text", (learn.fold("doc_id", 4) == 2).alias("held_out"))
    return langid.identify(thin, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with one label at cosine >= 0.93."""
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    globs = [*URL_RULES, *(url_filter.host_word(w, "block") for w in BLOCKED_HOST_WORDS)]
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), globs).select(
        "page_id", "host", "path", "rule", "verdict")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: 8 parts, 16 entries, 6 rounds."""
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document; a tenth of those of 20 words or more
    is drawn towards the benchmark."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=1,
                               buckets=10_000, percent=10, min_words=20, seed=2024)


def op13_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, under the unigram base and the suffix tree."""
    return suffix_tree.score(_table(spark, sf_dir, "documents"), folds=7, held_out=2)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_html_extraction, op3_best_fit_packing, op4_exact_topk, op5_poisson_mixing,
    op6_ngram_jaccard_join, op7_quality_classifier, op8_embedding_near_dedup, op9_url_filter, op10_language_id,
    op11_vector_codes, op12_importance_resampling, op13_suffix_tree_scores)}

_WEIGHT_CASES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SOURCE_WEIGHTS.items())
_RULE_CASES = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{host}{path}'"
    for host, path in (("www.example.com", "/en/"), ("example.com", "/en/"), ("net", "/es/"), ("net", "/fr/"),
                       ("com", "/")))

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

# Product codes in SQL: parts, then for each round the assignment and the moved entries.
_ASSIGNED = """
a{i} AS MATERIALIZED (
  SELECT r, part, v, min(d) AS d, arg_min(entry, (d, entry)) AS entry
  FROM (SELECT p.r, p.part, p.v, c.entry,
               list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts p JOIN c{i} c ON c.part = p.part) GROUP BY r, part, v)"""
_MOVED = """
m{j} AS MATERIALIZED (
  SELECT part, entry, list(x ORDER BY pos) AS v
  FROM (SELECT part, entry, pos, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
        FROM (SELECT part, entry, unnest(v)::HUGEINT AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY part, entry, pos)
  GROUP BY part, entry),
c{j} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{j} m
                      ON m.part = c.part AND m.entry = c.entry)"""
_ROUNDS = ",".join(_ASSIGNED.format(i=i) + (("," + _MOVED.format(i=i, j=i + 1)) if i < 6 else "") for i in range(7))

# The words, noise and weights of resampling; crc32 by its bitwise rule, per distinct word.
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SAMPLE_WORDS = f"regexp_extract_all({_LOWERED.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = {
    "op11_vector_codes": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, part, v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8] AS v FROM kept, range(8) AS t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM parts WHERE r <= 16),{_ROUNDS},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM c6),
coded AS (SELECT r, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (r), books
""",
    "op12_importance_resampling": f"""
WITH bytes AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) AS x(i)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_SAMPLE_WORDS}, []) AS w FROM documents),
dw AS MATERIALIZED (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY r, w),
bw AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT unnest({_SAMPLE_WORDS}) AS w FROM benchmark) GROUP BY w),
vocabulary AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           range(0, octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM dw UNION SELECT w FROM bw), bytes),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN vocabulary USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN vocabulary USING (w) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(n), 0) FROM dw)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM bw)::DOUBLE AS t),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((coalesce(t.t, 0)::DOUBLE + 1) * (total.s + 10000)
                                 / ((s.s::DOUBLE + 1) * (total.t + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket), total),
weights AS (SELECT r, sum(dw.n * g)::BIGINT AS weight FROM dw JOIN vocabulary USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 10 * n // 100 THEN k END AS rank
FROM scored LEFT JOIN ranked USING (r)
""",
    "op4_exact_topk": f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE {_FINITE}),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
""",
    "op6_ngram_jaccard_join": r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                 ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS s FROM cut),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT s.doc_id, s.n AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM sizes s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
""",
    "op8_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE {_FINITE} AND label IS NOT NULL AND list_inner_product(embedding, embedding) > 0),
linked AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
           WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
degree AS (SELECT a, count(*) AS n FROM linked GROUP BY a),
reach AS (SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN degree d ON d.a = vec_id LEFT JOIN least_of l ON l.a = vec_id
""",
    "op5_poisson_mixing": f"""
WITH RECURSIVE held AS (
  SELECT source, coalesce(sum(length(text)), 0) AS chars,
         CASE source {_WEIGHT_CASES} ELSE 1.0 END::DOUBLE AS weight
  FROM documents GROUP BY source),
total AS (SELECT sum(chars)::DOUBLE AS chars, sum(weight) AS weight FROM held WHERE chars > 0),
rates AS (SELECT h.source, CASE WHEN h.chars = 0 THEN 1.0 ELSE t.chars * h.weight / t.weight / h.chars END AS rate
          FROM held h, total t),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS below FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), below + p * rate / (k + 1) FROM cdf
  WHERE k < rate + 12 * sqrt(rate) + 40),
drawn AS (
  SELECT *, ('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE AS u FROM documents),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         (SELECT count(*) FROM cdf c WHERE c.source IS NOT DISTINCT FROM d.source AND c.below <= d.u)::INTEGER AS n_copies
  FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, n_copies, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM counted
""",
    "op9_url_filter": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {_RULE_CASES} END AS rule FROM parts)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '{"|".join(BLOCKED_HOST_WORDS)}') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
}
