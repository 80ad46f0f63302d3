"""Image classification on score and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.scalars import softmax
from quern.operators.shape import argmax_index


def class_confidence(df: DataFrame, logits: str | Column, classes: Sequence[str] | None = None) -> DataFrame:
    """Best class of raw scores and its softmax share in percent with two decimals."""
    shares = df.withColumn("_p", softmax(logits)).withColumn("class_index", argmax_index("_p"))
    out = shares.withColumn("confidence", F.round(F.array_max("_p") * 100, 2)).drop("_p")
    if classes is None:
        return out
    return out.withColumn("class", F.get(F.array(*[F.lit(c) for c in classes]), F.col("class_index")))


def vector_classifier(
    train: DataFrame, vec: str, label: str, n_classes: int, hidden: int = 128, epochs: int = 10, seed: int = 42
):
    """A network with one dense layer on precomputed vectors."""
    rows = train.select(array_to_vector(vec).alias("features"), F.col(label).cast("double").alias("label"))
    width = len(rows.first()["features"])
    return MultilayerPerceptronClassifier(
        layers=[width, hidden, n_classes], maxIter=epochs, seed=seed
    ).fit(rows)


def classifier_accuracy(model, df: DataFrame, vec: str, label: str) -> float:
    rows = df.select(array_to_vector(vec).alias("features"), F.col(label).cast("double").alias("label"))
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(rows))
