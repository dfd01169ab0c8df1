"""A language check: naive Bayes over character n-grams, learned from labelled rows by a distributed count and scored in the JVM.

The n-grams are those of the lower-cased words, one blank around each. Weights are whole micro-nats, so sums are the same in any order and on any
partitioning. A model holds the FEATURES most frequent n-grams (ties by value), each with one weight a language: its size has that bound, whatever
the input, so it is broadcast. Other n-grams say nothing.

As a check, a text is scored in up to three samples (first, middle, last), each against all languages with equal priors; the confidence of a language is
the least one of its samples.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import materialise

GRAM = 3
FEATURES = 50_000
#: Weights of one natural unit of log probability.
SCALE = 1_000_000


def grams(text: Column, size: int = GRAM) -> Column:
    """All n-grams of a text's letters, lower-cased, with one blank around and between words; none for a text without letters."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))
    return F.coalesce(F.regexp_extract_all(plain, F.lit(f"(?=(.{{{size}}}))"), F.lit(1)), F.array().cast("array<string>"))


@dataclass(frozen=True)
class LanguageModel:
    """weights (gram, weights: one for each language), and the languages in order."""

    weights: DataFrame
    languages: tuple[str, ...]
    size: int


def train_language_model(rows: DataFrame, text: str = "text", language: str = "lang", features: int = FEATURES, size: int = GRAM) -> LanguageModel:
    """The model of rows labelled with their language; null labels and texts teach nothing."""
    each = rows.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(F.col(language).alias("language"), F.explode(grams(F.col(text), size)).alias("gram"))
    counts = materialise(each.groupBy("language", "gram").agg(F.count("*").alias("n")), "grams")
    kept = counts.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(features).select("gram")
    counts = materialise(counts.join(F.broadcast(kept), "gram"), "kept-grams")
    totals = dict(sorted(tuple(r) for r in counts.groupBy("language").agg(F.sum("n")).collect()))  # one row a label
    distinct = counts.agg(F.count_distinct("gram")).first()[0] + 1
    weight = lambda n, total: F.round(F.log(n / F.lit(float(total + distinct))) * SCALE).cast("long")
    row = counts.groupBy("gram").agg(*[F.coalesce(F.sum(F.when(F.col("language") == name, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, name in enumerate(totals)])
    weights = row.select("gram", F.array(*[weight(F.col(f"n{k}") + 1.0, total) for k, total in enumerate(totals.values())]).alias("weights"))
    return LanguageModel(materialise(weights, "language-model"), tuple(totals), size)


def sample_scores(rows: DataFrame, model: LanguageModel, id: str = "id", text: str = "text") -> DataFrame:
    """(id, sample, scores): the summed weights of each language, in order, of every sample of a text. Texts that are null have no sample.

    `id` must be one of a kind. The n-grams of a sample are counted where it is read, so only sums are shuffled.
    """
    samples = rows.select(F.col(id).alias("id"), F.posexplode(t.language_samples(F.col(text))).alias("sample", "body"))
    each = samples.select("id", "sample", F.explode_outer(grams(F.col("body"), model.size)).alias("gram"))
    known = each.join(F.broadcast(model.weights), "gram", "left")
    sums = [F.sum(F.coalesce(F.col("weights")[k], F.lit(0))) for k in range(len(model.languages))]
    return known.groupBy("id", "sample").agg(F.array(*sums).alias("scores"))


def confidence(scores: Column, place: int) -> Column:
    """The share of one language when all are as likely beforehand."""
    others = F.aggregate(scores, F.lit(0.0), lambda total, s: total + F.exp((s - scores[place]) / F.lit(float(SCALE))))
    return 1 / others


def language_confidences(rows: DataFrame, model: LanguageModel, language: str = "en", id: str = "id", text: str = "text") -> DataFrame:
    """(id, detected, confidence) of every row: the language of the greatest summed score (of equal ones the first), and the least
    confidence in `language` among the samples. A null text, and one without known n-grams, has neither language nor confidence above 0."""
    place = model.languages.index(language)
    scored = sample_scores(rows, model, id, text)
    ranked = [F.struct(F.sum(F.col("scores")[k]).alias("score"), F.lit(-k).alias("place"), F.lit(name).alias("language")) for k, name in enumerate(model.languages)]
    least = F.when(F.col("scores")[place] < 0, confidence(F.col("scores"), place)).otherwise(0.0)  # a sample without known n-grams has sums of 0
    found = scored.groupBy("id").agg(F.when(F.sum(F.col("scores")[0]) < 0, F.array_max(F.array(*ranked))["language"]).alias("detected"), F.min(least).alias("confidence"))
    out = rows.select(F.col(id).alias("id")).join(found.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left")
    return out.select("id", "detected", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def accuracy(found: DataFrame, label: str = "lang") -> DataFrame:
    """(label, rows, hits): how many rows of each label were detected as it."""
    return found.groupBy(label).agg(F.count("*").alias("rows"), F.count_if(F.col("detected") == F.col(label)).alias("hits"))
