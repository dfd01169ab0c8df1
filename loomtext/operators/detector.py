"""A text-only baseline: character n-gram TF-IDF and balanced logistic regression, on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, small_batches
from .evaluate import choose_threshold, evaluate

FEATURES, MIN_DOCUMENTS, LENGTHS = 75_000, 3, (3, 4, 5)
#: Texts, and their bytes, whose n-grams a worker holds at a time; they take some two hundred times the memory of the text.
BATCH_ROWS, BATCH_BYTES = 64, "256k"


@F.pandas_udf(T.ArrayType(T.StringType()))
def character_ngrams(text: pd.Series) -> pd.Series:
    """All character 3- to 5-grams of the lower-cased text with single blanks."""

    def of(body: str | None) -> list[str]:
        plain = " ".join((body or "").lower().split())
        return [plain[i : i + n] for n in LENGTHS for i in range(len(plain) - n + 1)]

    return text.map(of)


@F.udf(returnType=VectorUDT())
def _sublinear(v):
    import numpy as np

    return SparseVector(v.size, v.indices, 1.0 + np.log(v.values))


@dataclass
class Detector:
    counts: CountVectorizerModel
    idf: PipelineModel
    classifier: LogisticRegressionModel
    threshold: float = 0.5

    def features(self, rows: DataFrame, text: str = "text") -> DataFrame:
        grams = rows.withColumn("_grams", character_ngrams(F.col(text)))
        return self.idf.transform(self.counts.transform(grams).withColumn("_tf", _sublinear("_counts"))).drop("_grams", "_counts", "_tf", "_idf")

    def score(self, rows: DataFrame, text: str = "text") -> DataFrame:
        scored = self.classifier.transform(self.features(rows, text))
        return scored.withColumn("score", vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")

    def save(self, path: str) -> None:
        PipelineModel([self.counts, self.idf, self.classifier]).write().save(path)

    def audit(self, k: int = 30) -> dict[str, list[tuple[str, float]]]:
        """The features of the largest coefficients on both sides."""
        ranked = sorted(zip(self.classifier.coefficients.toArray().tolist(), self.counts.vocabulary, strict=True))
        name = lambda part: [(feature, weight) for weight, feature in part]
        return {"most_machine_associated": name(ranked[-k:][::-1]), "most_human_associated": name(ranked[:k])}


def fit(training: DataFrame, text: str = "text", label: str = "binary_target", features: int = FEATURES) -> Detector:
    """Features and classifier from the training rows alone; classes weigh the same. N-grams are made of small Arrow batches."""
    with small_batches(training.sparkSession, BATCH_ROWS, BATCH_BYTES):
        return _fitted(training, text, label, features)


def _fitted(training: DataFrame, text: str, label: str, features: int) -> Detector:
    kinds = {r[0]: r[1] for r in training.groupBy(label).count().collect()}
    if set(kinds) != {0, 1}:
        raise ValueError("both classes are needed")
    total = sum(kinds.values())
    weight = F.create_map(*[F.lit(x) for k, n in kinds.items() for x in (k, total / (2.0 * n))])[F.col(label)]
    grams = training.withColumn("_grams", character_ngrams(F.col(text))).withColumn("_weight", weight)
    counts = CountVectorizer(inputCol="_grams", outputCol="_counts", vocabSize=features, minDF=MIN_DOCUMENTS).fit(grams)
    counted = counts.transform(grams).withColumn("_tf", _sublinear("_counts"))
    # one more than the logarithm, so that a feature of all documents still counts; at most one number a feature
    inverse = Vectors.dense(IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf.toArray() + 1.0)
    shaped = PipelineModel([ElementwiseProduct(scalingVec=inverse, inputCol="_tf", outputCol="_idf"), Normalizer(inputCol="_idf", outputCol="_features")])
    # the penalty is on the coefficients as they are
    classifier = LogisticRegression(featuresCol="_features", labelCol=label, weightCol="_weight", regParam=1.0 / total, standardization=False, maxIter=1000, tol=1e-8).fit(shaped.transform(counted))
    return Detector(counts, shaped, classifier)


def train_and_report(rows: DataFrame, maximum_fpr: float = 0.01, **options) -> tuple[Detector, DataFrame]:
    """Fit on train, choose the threshold on validation, report on test (rows have the slice columns of evaluate)."""
    model = fit(rows.where("split = 'train' AND binary_target IS NOT NULL"), **options)
    with small_batches(rows.sparkSession, BATCH_ROWS, BATCH_BYTES):
        scored = materialise(model.score(rows.where("split <> 'train' AND binary_target IS NOT NULL")).drop("text"), "scored")
    model.threshold = choose_threshold(scored.where("split = 'validation'"), maximum_fpr)
    return model, evaluate(scored, model.threshold, "test")
