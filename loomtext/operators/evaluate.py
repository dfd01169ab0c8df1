"""Evaluation of a classifier's scores: thresholds, slices with Wilson intervals, cluster bootstrap."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import materialise


def join_scores(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows with `score` (null where missing). Unknown or repeated ids and scores outside [0, 1] fail the job."""
    bad = scores.where(F.coalesce(~F.col("score").between(0, 1) | F.isnan("score"), F.lit(True)))
    repeated = scores.groupBy("id").count().where("count > 1")
    unknown = scores.join(rows.select("id"), "id", "left_anti")
    for name, found in (("invalid score", bad), ("repeated score id", repeated), ("unknown score id", unknown)):
        if not found.isEmpty():
            raise ValueError(f"{name}: {found.first()[0]}")
    return rows.join(scores.select("id", "score"), "id", "left")


def _slices() -> Column:
    or_none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    names = [F.lit("all"), F.concat(F.lit("length:"), t.length_bucket(F.col("whitespace_words")))]
    for prefix, column in (("dataset", "dataset"), ("origin", "authorship"), ("engine", "engine"), ("domain", "domain"), ("source_language", "source_language")):
        names.append(F.concat(F.lit(prefix + ":"), or_none(column)))
    return F.array(*names)


def missing_scores(scored: DataFrame, split: str) -> DataFrame:
    return scored.where((F.col("split") == split) & F.col("binary_target").isNotNull()).agg(F.count_if(F.col("score").isNull()).alias("missing_eligible_scores"))


def evaluate(scored: DataFrame, threshold: float, split: str) -> DataFrame:
    """One row for each slice: confusion counts, human false-positive rate, machine recall, their intervals, and by words.

    `scored` has split, binary_target, score, whitespace_words and the slice columns (domain defaults to "unspecified").
    """
    if not (math.isfinite(threshold) and 0 <= threshold <= 1):
        raise ValueError("the threshold must be in [0, 1]")
    if "domain" not in scored.columns:
        scored = scored.withColumn("domain", F.lit("unspecified"))
    rows = scored.where((F.col("split") == split) & F.col("binary_target").isNotNull() & F.col("score").isNotNull())
    one = rows.select(F.explode(_slices()).alias("slice"), (F.col("binary_target") == 1).alias("y"), (F.col("score") >= threshold).alias("hit"), F.col("whitespace_words").alias("w"))
    y, hit = F.col("y"), F.col("hit")
    words = lambda condition: F.sum(F.when(condition, F.col("w")))
    counts = one.groupBy("slice").agg(
        F.count("*").alias("scored_records"), F.count_if(~y & ~hit).alias("tn"), F.count_if(~y & hit).alias("fp"), F.count_if(y & ~hit).alias("fn"), F.count_if(y & hit).alias("tp"),
        words(~y).alias("hw"), words(y).alias("mw"), F.coalesce(words(~y & hit), F.lit(0)).alias("hw_hit"), F.coalesce(words(y & hit), F.lit(0)).alias("mw_hit"),
    )
    rate = lambda a, b: F.when(b > 0, a / b)
    negatives, positives = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    fpr, recall = t.wilson(F.col("fp"), negatives), t.wilson(F.col("tp"), positives)
    return counts.select(
        "slice", "scored_records", "tn", "fp", "fn", "tp",
        rate(F.col("fp"), negatives).alias("human_false_positive_rate"), fpr["low"].alias("fpr_low"), fpr["high"].alias("fpr_high"),
        rate(F.col("tp"), positives).alias("machine_recall"), recall["low"].alias("recall_low"), recall["high"].alias("recall_high"),
        rate(F.col("hw_hit"), F.col("hw")).alias("human_word_weighted_fpr"), rate(F.col("mw_hit"), F.col("mw")).alias("machine_word_weighted_recall"),
    )


def choose_threshold(rows: DataFrame, maximum_fpr: float = 0.01, label: str = "binary_target", score: str = "score") -> float:
    """The least threshold (score >= threshold is machine) whose observed human false-positive rate is allowed.

    The pick is an order statistic; equal scores are counted first, ranges of the distinct values are summed, and only the range that
    holds the pick is ranked.
    """
    if not 0 <= maximum_fpr < 1:
        raise ValueError("the false-positive rate must be in [0, 1)")
    values = rows.where(F.col(label) == 0).groupBy(F.col(score).cast("double").alias("s")).count()
    ranged = materialise(values.repartitionByRange(F.desc("s")).withColumn("block", F.spark_partition_id()), "scores")
    totals = sorted(ranged.groupBy("block").agg(F.sum("count")).collect())
    if not totals:
        raise ValueError("validation needs human rows")
    allowed = math.floor(sum(n for _, n in totals) * maximum_fpr)
    before = 0
    for block, n in totals:
        if before + n > allowed:
            break
        before += n
    reach = F.sum("count").over(Window.partitionBy("block").orderBy(F.desc("s"))) + before
    picked = ranged.where(F.col("block") == block).withColumn("reach", reach).where(F.col("reach") > allowed).agg(F.max("s")).first()[0]
    threshold = math.nextafter(picked, math.inf)
    if threshold > 1:
        raise ValueError("no threshold in [0, 1] is low enough")
    return threshold


def cluster_counts(scored: DataFrame, threshold: float, group: str = "split_group") -> DataFrame:
    """(group, fp, negatives, tp, positives); a row without a score fails the job."""
    whole = F.when(F.col("score").isNull(), F.raise_error(F.lit("cluster evaluation needs every score")).cast("double")).otherwise(F.col("score"))
    hit, y = whole >= threshold, F.col("binary_target")
    return scored.groupBy(group).agg(F.count_if((y == 0) & hit).alias("fp"), F.count_if(y == 0).alias("negatives"), F.count_if((y == 1) & hit).alias("tp"), F.count_if(y == 1).alias("positives"))


def cluster_bootstrap(scored: DataFrame, threshold: float, repetitions: int = 2000, seed: int = 42, group: str = "split_group") -> dict:
    """Rates with 95 % percentile intervals from resampling whole groups. Groups' four counts (not rows) go to the driver."""
    rows = sorted(cluster_counts(scored, threshold, group).collect(), key=lambda r: r[0])
    if not rows:
        raise ValueError("no groups")
    matrix = np.array([r[1:] for r in rows], dtype=np.int64)
    draw = np.random.default_rng(seed)
    at_once = max(1, 1_000_000 // len(matrix))
    sums = np.concatenate([matrix[draw.integers(0, len(matrix), size=(min(at_once, repetitions - r), len(matrix)))].sum(axis=1) for r in range(0, repetitions, at_once)])
    out = {"work_groups": len(matrix), "bootstrap_repetitions": repetitions, "seed": seed}
    for name, k in (("human_fpr", 0), ("machine_recall", 2)):
        of = sums[sums[:, k + 1] > 0]
        total = matrix.sum(axis=0)
        values = of[:, k] / of[:, k + 1]
        out[name] = {"value": float(total[k] / total[k + 1]) if total[k + 1] else None, "cluster_percentile95": np.quantile(values, [0.025, 0.975]).tolist() if len(values) else None, "valid_resamples": len(of)}
    return out


def poisson_bootstrap(scored: DataFrame, threshold: float, repetitions: int = 200, seed: int = 42, group: str = "split_group") -> DataFrame:
    """The same interval for any number of groups: each group enters each resample Poisson(1) times, drawn from a hash; all in one pass."""
    counts = cluster_counts(scored, threshold, group)
    draws = counts.select("*", F.explode(F.sequence(F.lit(1), F.lit(repetitions))).alias("r"))
    u = F.pmod(F.xxhash64(group, "r", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    bounds = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])
    times = sum(((u >= float(b)).cast("int") for b in bounds), F.lit(0))
    sums = draws.withColumn("k", times).groupBy("r").agg(*[F.sum(F.col(c) * F.col("k")).alias(c) for c in ("fp", "negatives", "tp", "positives")])
    each = sums.select((F.col("fp") / F.nullif("negatives", F.lit(0))).alias("fpr"), (F.col("tp") / F.nullif("positives", F.lit(0))).alias("recall"))
    return each.agg(*[F.percentile(c, F.array(F.lit(0.025), F.lit(0.975))).alias(f"{c}_interval") for c in ("fpr", "recall")])
