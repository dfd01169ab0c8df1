"""Queries of the language check and of similarity retrieval over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import language, similarity, splits
from .queries import _SHINGLES, _bucket_sql, _docs, _texts, query

_LETTERS = r"' ' || trim(regexp_replace(lower({}), '[^\p{{L}}]+', ' ', 'g')) || ' '"


@query(rf"""WITH d AS (SELECT doc_id, text, lang, {_bucket_sql("'language:' || doc_id")} < 20 AS held FROM documents),
  c AS (SELECT lang, gram, count(*) AS n FROM (SELECT lang, substr(p, i::INT, 3) AS gram FROM (SELECT lang, p, unnest(range(1, length(p) - 1)) AS i FROM (SELECT lang, {_LETTERS.format("text")} AS p FROM d WHERE NOT held AND text IS NOT NULL AND lang IS NOT NULL) WHERE length(p) > 2)) GROUP BY 1, 2),
  k AS (SELECT gram FROM c GROUP BY 1 ORDER BY sum(n) DESC, gram LIMIT {language.FEATURES}), kc AS (SELECT c.* FROM c JOIN k USING (gram)),
  t AS (SELECT lang, sum(n)::DOUBLE + (SELECT count(*) FROM k) + 1 AS total FROM kc GROUP BY 1), m AS (SELECT k.gram, t.lang, round(ln((coalesce(n, 0) + 1) / total) * 1000000)::BIGINT AS w FROM k CROSS JOIN t LEFT JOIN kc ON kc.gram = k.gram AND kc.lang = t.lang),
  s AS (SELECT doc_id, unnest(CASE WHEN length(text) <= 1800 THEN [text] ELSE [left(text, 1800), substr(text, greatest(0, length(text) // 2 - 900) + 1, 1800), right(text, 1800)] END) AS body, unnest(range(CASE WHEN length(text) <= 1800 THEN 1 ELSE 3 END)) AS sample FROM d WHERE text IS NOT NULL),
  g AS (SELECT doc_id, sample, gram, count(*) AS n FROM (SELECT doc_id, sample, substr(p, i::INT, 3) AS gram FROM (SELECT doc_id, sample, p, unnest(range(1, length(p) - 1)) AS i FROM (SELECT doc_id, sample, {_LETTERS.format("body")} AS p FROM s) WHERE length(p) > 2)) GROUP BY 1, 2, 3),
  x AS (SELECT doc_id, sample, lang, sum(n * w) AS score FROM g JOIN m USING (gram) GROUP BY 1, 2, 3),
  f AS (SELECT a.doc_id, a.sample, 1 / sum(exp((b.score - a.score)::DOUBLE / 1000000)) AS confidence FROM x a JOIN x b USING (doc_id, sample) WHERE a.lang = 'en' GROUP BY 1, 2),
  e AS (SELECT doc_id, CASE WHEN count(f.confidence) < count(*) THEN 0 ELSE min(f.confidence) END AS confidence FROM s LEFT JOIN f USING (doc_id, sample) GROUP BY 1),
  b AS (SELECT doc_id, lang AS detected FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY sum(score) DESC, lang) AS r FROM x GROUP BY 1, 2) WHERE r = 1)
  SELECT doc_id, lang, held, detected, round(coalesce(confidence, 0), 4) AS confidence, coalesce(confidence, 0) >= 0.8 AS accepted FROM d LEFT JOIN e USING (doc_id) LEFT JOIN b USING (doc_id)""")
def language_check(spark, sf):
    """The language of every document, learned from four in five of them; `held` are the others."""
    rows = _docs(spark, sf, "doc_id", "text", "lang").withColumn("held", splits.hash_bucket(F.concat(F.lit("language:"), F.col("doc_id").cast("string"))) < 20)
    model = language.train_language_model(rows.where("NOT held"))
    found = language.language_confidences(rows, model, "en", "doc_id").withColumnRenamed("id", "doc_id")
    return rows.drop("text").join(found, "doc_id").select("doc_id", "lang", "held", "detected", F.round("confidence", 4).alias("confidence"), (F.col("confidence") >= 0.8).alias("accepted"))


@query(f"WITH {_SHINGLES} SELECT first, second, round(1 - pow(1 - pow(jaccard, {similarity.ROWS}), {similarity.BANDS}), 6) AS retrieved FROM j")
def retrieval_probability(spark, sf):
    """How likely each pair of similar documents is to share a band."""
    found = similarity.similar_pairs(_texts(spark, sf), 0.8).where("jaccard < 1")
    return found.select("first", "second", F.round(t.lsh_probability(F.col("jaccard"), similarity.ROWS, similarity.BANDS), 6).alias("retrieved"))
