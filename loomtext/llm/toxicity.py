"""Operator 7: toxicity grades by cumulative-link ordinal regression.

Grades are 0 not toxic, 1 toxic, 2 severely toxic. The labels tell 0 from the rest. No label says severe, so grade 2 is a pseudo-label, made
by cross-fitting: the sample is cut into FOLDS folds, and a toxic text is severe when it holds at least as many features that go with
toxicity in the other folds as the median toxic text of its fold; no text's own label has a part in its grade 2. The model is P(grade >= k) = sigmoid(w.x - t_k) with ordered thresholds t_1 <= t_2 and one weight vector shared by both. Features are the
presence of words (maximal runs of word characters, lower case) and of word beginnings of 4, 5 and 6 characters, kept where
their association with toxicity in the sample is beyond chance. It is fitted on a bounded sample: the FIT_DOCUMENTS labelled
documents of least hash, equal texts once. Features are counted and chosen by a distributed aggregate; the driver gets
the chosen ones, whose number that sample bounds, and the sample's rows in terms of them. The threshold for rejecting is calibrated on a
held-out fold of that sample. Every document is then scored on its whole text.

Defined cases: a null or empty text has no features and the grade of the thresholds alone; labels of unknown documents
are ignored; of repeated labels the most toxic counts; with no toxic or no clean label nothing is rejected; repeated rows are scored
alike; an empty table gives an empty result. Ids are passed on untouched, null ones too. Other columns may have any names: scoring
ignores them and filtering returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from ..session import discard, materialise, materialise_small, table
from .textcore import flat_words, released

FIT_DOCUMENTS = 20_000
#: Texts whose features are in a worker's memory at once.
TEXTS_AT_ONCE = 50
MIN_DOCUMENTS = 3
PREFIXES = (4, 5, 6)
#: Standard deviations from what chance gives that a feature's toxic documents must be.
BEYOND_CHANCE = 6.0
RIDGE = 0.02
#: A clean document wrongly rejected costs as much as this many toxic ones missed.
CLEAN_COST = 3.0
GRADES = 3
#: Folds of the sample; the first is held out for the threshold.
FOLDS = 5


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def features_of(text: str | None) -> set[str]:
    """The words of a text and, marked by a hyphen, the beginnings of its longer words."""
    words = set(flat_words(text).decode("utf-8", "surrogatepass").split())
    return words.union(*[{w[:n] + "-" for w in words if len(w) > n} for n in PREFIXES])


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thresholds: np.ndarray  # ordered, one fewer than grades
    reject_at: float = 2.0

    def probabilities(self, text: str | None) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        score = sum(self.weights[w] for w in sorted(self.weights.keys() & features_of(text))) if self.weights else 0.0
        return _sigmoid(score - self.thresholds)


def fit_cumulative_link(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, features: int, ridge: float = RIDGE, steps: int = 1200, rate: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds for binary features given as (row, column) pairs; Adam on the penalised likelihood."""
    n, cuts = len(grades), GRADES - 1
    share = np.array([np.clip((grades >= k).mean(), 1e-4, 1 - 1e-4) for k in range(1, GRADES)])
    start = np.log((1 - share) / share)
    # t_1 and the logs of the gaps between thresholds keep the order
    free = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    w, at = np.zeros(features), free.copy()
    moment = [np.zeros(features), np.zeros(features), np.zeros(cuts), np.zeros(cuts)]
    for step in range(1, steps + 1):
        t = np.concatenate(([at[0]], at[0] + np.cumsum(np.exp(at[1:]))))
        score = np.bincount(rows, weights=w[columns], minlength=n)
        upper = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - t[None, :]), np.zeros((n, 1))], axis=1)
        own = np.maximum(upper[np.arange(n), grades] - upper[np.arange(n), grades + 1], 1e-12)
        slope = upper * (1 - upper)  # d sigmoid; 0 at both ends
        d_score = (slope[np.arange(n), grades] - slope[np.arange(n), grades + 1]) / own
        d_t = np.zeros(cuts)
        for k in range(1, GRADES):
            d_t[k - 1] = -(slope[grades == k, k] / own[grades == k]).sum() + (slope[grades == k - 1, k] / own[grades == k - 1]).sum()
        g_w = (-np.bincount(columns, weights=d_score[rows], minlength=features) + ridge * w) / n
        d_t = -d_t / n
        gaps = np.exp(at[1:])
        g_at = np.concatenate(([d_t.sum()], np.cumsum(d_t[::-1])[::-1][1:] * gaps))
        for i, (value, gradient) in enumerate(((w, g_w), (at, g_at))):
            m, v = moment[2 * i], moment[2 * i + 1]
            m += 0.1 * (gradient - m)
            v += 0.001 * (gradient**2 - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w, np.concatenate(([at[0]], at[0] + np.cumsum(np.exp(at[1:]))))


def _chosen(counted: DataFrame, side: str, toxic: int, clean: int, only_up: bool = False) -> list[str]:
    """Features whose presence goes with toxicity (or against it, unless only_up) beyond chance."""
    with_1, with_0 = F.col(f"{side}_toxic"), F.col(f"{side}_clean")
    seen, p = with_1 + with_0, toxic / (toxic + clean)
    above = with_1 - seen * p
    beyond = (above if only_up else F.abs(above)) > BEYOND_CHANCE * F.sqrt(seen * p * (1 - p))
    return [r["feature"] for r in counted.where((seen >= MIN_DOCUMENTS) & beyond).select("feature").collect()]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", documents: int = FIT_DOCUMENTS) -> OrdinalModel:
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("grade"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = slim.join(F.broadcast(known), "doc_id")  # `documents` rows at most
    sample = sample.groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("key")).agg(F.max("grade").alias("grade"), F.first("text").alias("text"))

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), TEXTS_AT_ONCE):
                few = frame.iloc[start : start + TEXTS_AT_ONCE]
                yield pd.DataFrame({"key": few["key"], "grade": few["grade"], "features": [sorted(features_of(t)) for t in few["text"]]})

    rows = materialise_small(sample.mapInPandas(released(featured), "key string, grade int, features array<string>"), "toxicity-sample")
    sampled = rows
    rows = rows.withColumn("fold", F.conv(F.substring("key", 1, 4), 16, 10).cast("int") % FOLDS)
    sizes = {(r["fold"], r["bad"]): r["n"] for r in rows.groupBy("fold", (F.col("grade") > 0).alias("bad")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = (sum(n for (_, bad), n in sizes.items() if bad == side) for side in (True, False))
    if not toxic or not clean:
        return OrdinalModel({}, np.array([2.0, 4.0]))
    each = rows.select((F.col("grade") > 0).alias("bad"), "fold", F.explode("features").alias("feature"))
    without = [F.count_if(side & (F.col("fold") != k)).alias(f"{k}_{name}") for k in range(FOLDS) for side, name in ((F.col("bad"), "toxic"), (~F.col("bad"), "clean"))]
    counted = each.groupBy("feature").agg(F.count_if("bad").alias("all_toxic"), F.count_if(~F.col("bad")).alias("all_clean"), *without)
    counted = materialise(counted.where(F.col("all_toxic") + F.col("all_clean") >= MIN_DOCUMENTS), "toxicity-counts")
    whole = _chosen(counted, "all", toxic, clean)
    outside = {k: tuple(sum(n for (fold, bad), n in sizes.items() if bad == side and fold != k) for side in (True, False)) for k in range(FOLDS)}
    others = {k: _chosen(counted, str(k), *outside[k]) if all(outside[k]) else [] for k in range(FOLDS)}
    goes_up = {k: _chosen(counted, str(k), *outside[k], only_up=True) if all(outside[k]) else [] for k in range(FOLDS)}
    part = others[0]
    names = sorted({*whole, *chain(*others.values())})
    place = {w: i for i, w in enumerate(names)}

    def compact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "grade": frame["grade"], "fold": frame["fold"], "at": [[place[w] for w in ws if w in place] for ws in frame["features"]]})

    got = sorted(rows.mapInPandas(released(compact), "key string, grade int, fold int, at array<int>").collect())
    grades, fold = np.array([r["grade"] for r in got], dtype=np.int64), np.array([r["fold"] for r in got], dtype=np.int64)
    held = fold == 0
    row_of = np.repeat(np.arange(len(got)), [len(r["at"]) for r in got])
    column = np.array([i for r in got for i in r["at"]], dtype=np.int64)

    grades = grades + _severe(grades > 0, fold, row_of, column, {k: np.array([w in up for w in names], dtype=bool) for k, up in ((k, set(v)) for k, v in goes_up.items())})

    def fitted(use: np.ndarray, chosen: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Weights of all names (0 where not chosen) and thresholds."""
        ids = np.array([place[w] for w in chosen], dtype=np.int64)
        inner = np.full(len(names), -1)
        inner[ids] = np.arange(len(ids))
        keep = use[row_of] & (inner[column] >= 0)
        w, t = fit_cumulative_link((np.cumsum(use) - 1)[row_of[keep]], inner[column[keep]], grades[use], len(ids))
        full = np.zeros(len(names))
        full[ids] = w
        return full, t

    reject = CLEAN_COST / (1 + CLEAN_COST)
    if part and held.any():
        w, t = fitted(~held, part)
        p = _sigmoid(np.bincount(row_of, weights=w[column], minlength=len(got)) - t[0])
        reject = _calibrated(p[held], grades[held] > 0)
    w, t = fitted(np.ones(len(got), dtype=bool), whole)
    discard(sampled, counted)
    return OrdinalModel({name: float(w[place[name]]) for name in whole}, t, reject)


def _severe(bad: np.ndarray, fold: np.ndarray, row_of: np.ndarray, column: np.ndarray, up: dict[int, np.ndarray]) -> np.ndarray:
    """1 for toxic rows with at least as many of the other folds' features as the median toxic row of their fold, and with one."""
    severe = np.zeros(len(bad), dtype=np.int64)
    for k, names in up.items():
        count = np.bincount(row_of, weights=names[column].astype(float), minlength=len(bad))
        mine = bad & (fold == k)
        if mine.any():
            severe[mine] = count[mine] >= max(1.0, float(np.median(count[mine])))
    return severe


def _calibrated(p: np.ndarray, toxic: np.ndarray) -> float:
    """The probability from which rejecting costs least on held-out rows; the costs' own if it has no toxic row.

    Differences of less than one clean document are no evidence, so of the cuts that come this close to the best, the
    one nearest to the probability that the costs themselves ask for is taken.
    """
    asked = CLEAN_COST / (1 + CLEAN_COST)
    if not toxic.any() or toxic.all():
        return asked
    order = np.argsort(-p, kind="stable")
    value, hit = p[order], toxic[order]
    gain = np.cumsum(np.where(hit, 1.0, -CLEAN_COST))
    below = np.append(value[1:], 0.0)
    near = (below < value) & (gain > 0) & (gain >= gain.max() - CLEAN_COST)
    if not near.any():
        return 2.0
    cuts = np.clip(asked, np.nextafter(below[near], 1.0), value[near])
    return float(cuts[np.argmin(np.abs(cuts - asked))])


def score_toxicity(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, p_toxic, p_severe, expected_severity, grade (the likeliest) and toxic (rejected)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            p = np.array([model.probabilities(t) for t in batch.column("text").to_pylist()]).reshape(-1, GRADES - 1)
            each = np.concatenate([np.ones((len(p), 1)), p], axis=1) - np.concatenate([p, np.zeros((len(p), 1))], axis=1)
            made = [p[:, 0], p[:, 1], p.sum(axis=1), each.argmax(axis=1).astype(np.int32), p[:, 0] >= model.reject_at]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, made)], ["doc_id", *kinds])

    kinds = {"p_toxic": DoubleType(), "p_severe": DoubleType(), "expected_severity": DoubleType(), "grade": IntegerType(), "toxic": BooleanType()}
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return materialise_small(slim.mapInArrow(released(run), StructType([slim.schema["doc_id"], *[StructField(n, k) for n, k in kinds.items()]])), "toxicity")


def drop_toxic(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """docs without the rows whose text the model rejects."""

    @F.pandas_udf("boolean")
    def rejected(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(model.probabilities(t)[0] >= model.reject_at) for t in texts], dtype=bool)

    return materialise_small(docs.where(~rejected(F.col(text))), "not-toxic")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of every document, by a model of the labels table."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
