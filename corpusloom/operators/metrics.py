"""Confusion counts, quality measures, model comparison and selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.columns import timestamp_text

# The columns of the two result tables.
TEST_COLUMNS = ["timestamp", "model", "TP", "FP", "TN", "FN", "accuracy", "precision", "recall", "f-score"]
VALIDATION_COLUMNS = TEST_COLUMNS + ["training_time_seconds"]

COUNTS = ["TP", "FP", "TN", "FN"]


def confusion_counts(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """True and false positives and negatives for the labels 0 and 1, in one aggregation."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = [
        F.count_if((y == 1) & (p == 1)).alias("TP"),
        F.count_if((y == 0) & (p == 1)).alias("FP"),
        F.count_if((y == 0) & (p == 0)).alias("TN"),
        F.count_if((y == 1) & (p == 0)).alias("FN"),
    ]
    return df.groupBy(*(by or [])).agg(*counts)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where the denominator is 0."""
    return F.when(bottom > 0, top.cast("double") / F.greatest(bottom, F.lit(1))).otherwise(F.lit(0.0))


def with_quality(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F-score of the positive class."""
    tp, fp, tn, fn = (F.col(c) for c in COUNTS)
    return (
        counts.withColumn("accuracy", ratio(tp + tn, tp + fp + tn + fn))
        .withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f-score", ratio(2 * tp, 2 * tp + fp + fn))
    )


def evaluate(
    predictions: DataFrame, model: str, label: str = "pos", prediction: str = "prediction",
    training_seconds: float | None = None,
) -> DataFrame:
    """One result row for one model, with the columns of the result tables in their order."""
    row = with_quality(confusion_counts(predictions, label, prediction))
    row = row.withColumn("timestamp", timestamp_text()).withColumn("model", F.lit(model))
    if training_seconds is None:
        return row.select(*TEST_COLUMNS)
    return row.withColumn("training_time_seconds", F.lit(float(training_seconds))).select(*VALIDATION_COLUMNS)


def compare(rows: list[DataFrame]) -> DataFrame:
    """One table with one row per model."""
    return reduce(DataFrame.unionByName, rows)


def compare_predictions(df: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """Result rows of several prediction columns from a single pass over the table."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.col(column).cast("int").alias("prediction"))
        for model, column in predictions.items()
    ]))
    long = df.select(F.col(label).alias("label"), pairs.alias("m")).select("label", "m.model", "m.prediction")
    return with_quality(confusion_counts(long, "label", "prediction", ["model"]))


def best_run(runs: DataFrame, measure: str = "f-score", by: list[str] | None = None) -> DataFrame:
    """The whole row with the highest measure; of equal rows the first model name wins."""
    row = F.struct(*[F.col(c) for c in runs.columns])
    best = F.min_by(row, F.struct((-F.col(measure)).alias("m"), F.col("model")))
    return runs.groupBy(*(by or [])).agg(best.alias("run")).select("run.*")


def run_metadata(
    metrics: DataFrame, *, model_name: str, max_length: int, epochs: int, lr: float, weight_decay: float,
    train_size: int, val_size: int, training_seconds: float,
) -> DataFrame:
    """One nested row about a training run, ready for the JSON sink."""
    # The names of the published metadata.
    measures = F.map_from_arrays(
        F.array(*[F.lit(f"eval_{m}") for m in ("accuracy", "precision", "recall", "f1")]),
        F.array("accuracy", "precision", "recall", "f-score"),
    )
    return metrics.select(
        F.lit(model_name).alias("model_name"),
        F.lit(max_length).alias("max_length"),
        F.lit(epochs).alias("epochs"),
        F.lit(float(lr)).alias("lr"),
        F.lit(float(weight_decay)).alias("weight_decay"),
        F.lit(train_size).alias("train_size"),
        F.lit(val_size).alias("val_size"),
        F.lit(float(training_seconds)).alias("training_time_seconds"),
        measures.alias("metrics"),
        F.array(F.array("TN", "FP"), F.array("FN", "TP")).alias("confusion_matrix"),
    )
