"""The detector reads its texts in small batches."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.operators import detector


@F.pandas_udf(T.StringType())
def _few(text: pd.Series) -> pd.Series:
    if len(text) > 64:
        raise ValueError(f"{len(text)} texts at a time")
    return text


def test_texts_come_in_small_batches(spark):
    rows = [(i, f"{'good fine' if i % 2 else 'bad awful'} text {i % 7}", i % 2, ("train", "validation", "test")[i % 3], "a", "en") for i in range(600)]
    frame = spark.createDataFrame(rows, "id long, text string, binary_target int, split string, dataset string, source_language string").repartition(1)
    frame = frame.withColumn("text", _few("text"))
    model = detector.fit(frame.where("split = 'train'"), features=200)
    assert len(model.counts.vocabulary) > 20 and model.classifier.numFeatures == len(model.counts.vocabulary)
