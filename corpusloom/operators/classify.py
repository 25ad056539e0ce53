"""Classifiers: multinomial Naive Bayes and linear scores. ``svm`` and ``head`` fit linear weights."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.columns import argmax
from corpusloom.operators.vectorize import constant_array, long_features

ALPHA = 1.0


def weighted_sum(features: str, weights: list[float]) -> Column:
    """Sum of value times weight over a sparse row."""
    table = constant_array(weights)
    parts = F.zip_with(F.col(f"{features}.indices"), F.col(f"{features}.values"), lambda i, v: v * table[i])
    return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)


@dataclass(frozen=True)
class NaiveBayes:
    """Multinomial Naive Bayes over counted features; classes in ascending order."""

    classes: list[int]
    log_prior: list[float]
    log_prob: list[list[float]]
    alpha: float = ALPHA

    def priors(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.classes, self.log_prior)), "pos int, log_prior double")

    def weights(self, spark: SparkSession) -> DataFrame:
        """``(pos, idx, logp)`` for every class and feature."""
        rows = [
            (label, idx, value)
            for label, values in zip(self.classes, self.log_prob)
            for idx, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, "pos int, idx int, logp double")

    def predict(self, docs: DataFrame, features: str, column: str = "prediction") -> DataFrame:
        """Scores each document inside its own row, so nothing is joined or shuffled.

        A document without known terms gets the prior; of equal scores the lower class wins.
        """
        scores = []
        for prior, logp in zip(self.log_prior, self.log_prob):
            scores.append(F.lit(prior) + weighted_sum(features, logp))
        labels = F.array(*[F.lit(c) for c in self.classes])
        scored = docs.withColumn("scores", F.array(*scores))
        return scored.withColumn(column, labels[argmax(F.col("scores"))])

    def save(self, spark: SparkSession, path: str) -> None:
        self.priors(spark).withColumn("alpha", F.lit(self.alpha)).coalesce(1).write.parquet(f"{path}/priors")
        self.weights(spark).coalesce(1).write.parquet(f"{path}/weights")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "NaiveBayes":
        priors = sorted(spark.read.parquet(f"{path}/priors").collect(), key=lambda r: r["pos"])
        rows = sorted(spark.read.parquet(f"{path}/weights").collect(), key=lambda r: (r["pos"], r["idx"]))
        return NaiveBayes(
            [r["pos"] for r in priors], [r["log_prior"] for r in priors],
            [[r["logp"] for r in rows if r["pos"] == p["pos"]] for p in priors], priors[0]["alpha"],
        )


def class_totals(train: DataFrame, features: str, label: str) -> DataFrame:
    """``(label, idx, total)``: how often each feature occurs in each class."""
    return long_features(train, features, [label], "tf").groupBy(label, "idx").agg(F.sum("tf").alias("total"))


def fit_naive_bayes(train: DataFrame, features: str, label: str, n_features: int, alpha: float = ALPHA) -> NaiveBayes:
    """Smoothed log probabilities; the class priors are not smoothed.

    One pass over the data. What reaches the driver is the model: classes times features. An
    ``alpha`` below 1e-10 counts as 1e-10, so that no logarithm is of zero.
    """
    alpha = max(alpha, 1e-10)
    known = train.where(F.col(label).isNotNull())
    no_term = F.array(F.struct(F.lit(-1).alias("i"), F.lit(1.0).alias("v")))
    pairs = F.arrays_zip(F.col(f"{features}.indices").alias("i"), F.col(f"{features}.values").alias("v"))
    # Index -1 counts the documents of the class, next to the features, in the same pass.
    rows = known.select(F.col(label).cast("int").alias("c"), F.explode(F.concat(no_term, pairs)).alias("p"))
    totals = rows.groupBy("c", F.col("p.i").alias("i")).agg(F.sum("p.v").alias("n")).collect()

    classes = sorted({r["c"] for r in totals})
    counts = {(r["c"], r["i"]): r["n"] for r in totals}
    docs = {c: counts[(c, -1)] for c in classes}
    all_docs = sum(docs.values())
    log_prob = []
    for c in classes:
        smoothed = [counts.get((c, i), 0.0) + alpha for i in range(n_features)]
        log_all = math.log(sum(smoothed)) if smoothed else 0.0
        log_prob.append([math.log(s) - log_all for s in smoothed])
    return NaiveBayes(classes, [math.log(docs[c] / all_docs) for c in classes], log_prob, alpha)


def predict_linear(coefficients: list[float], intercept: float, docs: DataFrame, features: str, column: str = "prediction") -> DataFrame:
    """Class 1 where the ``margin``, the weighted sum of the sparse row plus the intercept, is positive."""
    margin = weighted_sum(features, [float(w) for w in coefficients]) + F.lit(float(intercept))
    return docs.withColumn("margin", margin).withColumn(column, F.when(F.col("margin") > 0, 1).otherwise(0))


def timed(fit, *args, **kwargs):
    """``(result, seconds)`` of a training call."""
    start = time.perf_counter()
    result = fit(*args, **kwargs)
    return result, time.perf_counter() - start
