"""A logistic classification head on given vectors, fitted by Newton steps from sums over all rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.svm import Factored
from corpusloom.operators.vectorize import constant_array
from corpusloom.session import materialise

WEIGHT_DECAY = 0.01


@dataclass(frozen=True)
class VectorHead:
    """Weights by position and the intercept; ``steps`` and the norm of the gradient at the end tell about the fit."""

    weights: list[float]
    intercept: float
    loss: float
    gradient_norm: float
    steps: int

    def predict(self, df: DataFrame, vector: str, column: str = "prediction") -> DataFrame:
        """``probability`` of class 1, and the likelier class; null where the vector is null or of another length."""
        v = F.col(vector).cast("array<double>")
        products = F.zip_with(v, constant_array(self.weights), lambda x, w: x * w)
        margin = F.aggregate(products, F.lit(self.intercept), lambda a, x: a + x)
        scored = df.withColumn("probability", F.when(F.size(v) == len(self.weights), 1 / (1 + F.exp(-margin))))
        return scored.withColumn(column, F.when(F.col("probability") > 0.5, 1).when(F.col("probability").isNotNull(), 0))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(self.weights, self.intercept, self.loss, self.gradient_norm, self.steps)]
        spark.createDataFrame(rows, "weights array<double>, intercept double, loss double, gradient_norm double, steps int").coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "VectorHead":
        return VectorHead(**spark.read.parquet(path).first().asDict())


def _sums(rows: DataFrame, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log loss, gradient and Hessian at ``w`` over all rows; a task gives one row of sums, and tasks add these up."""
    size = len(w)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.ones((len(y), size))
            x[:, :-1] = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            f = x @ w
            p = np.exp(-np.logaddexp(0, -f))
            total[0] += (np.logaddexp(0, f) - y * f).sum()
            total[1 : 1 + size] += x.T @ (p - y)
            total[1 + size :] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["group", "part"])

    def added(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer(), np.float64) for p in parts["part"])
        return pa.table({"part": pa.array([total.tobytes()], pa.binary())})

    found = rows.mapInArrow(partial, "group int, part binary").groupBy("group").applyInArrow(added, "part binary").first()
    total = np.frombuffer(found.part, np.float64) if found else np.zeros(1 + size + size * size)
    return float(total[0]), total[1 : 1 + size], total[1 + size :].reshape(size, size)


def fit_vector_head(
    train: DataFrame, vector: str, label: str, weight_decay: float = WEIGHT_DECAY, tolerance: float = 1e-9, max_steps: int = 50
) -> VectorHead:
    """The minimum of the mean log loss plus ``weight_decay / 2`` times the squared weights (not the intercept).

    Each step solves for the zero of the gradient with the exact Hessian, a square as wide as the vectors, which
    Spark sums up over all rows; a few steps end the fit. Rows whose label is not 0 or 1, and vectors that are null, of
    another length than most, or hold a null or non-finite component take no part; without rows all weights are 0.
    """
    rows = train.select(F.col(label).cast("int").alias("y"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = materialise(rows.where(F.col("y").isin(0, 1) & F.col("v").isNotNull() & finite), "head-rows")
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return VectorHead([], 0.0, 0.0, 0.0, 0)
    rows, n, size = rows.where(F.size("v") == common["size"]), common["count"], common["size"] + 1
    decay = np.full(size, weight_decay)
    decay[-1] = 0

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, hessian = _sums(rows, w)
        return loss / n + 0.5 * (decay * w * w).sum(), gradient / n + decay * w, hessian / n + np.diag(decay)

    w, steps = np.zeros(size), 0
    loss, gradient, hessian = at(w)
    while np.sqrt(gradient @ gradient) > tolerance and steps < max_steps:
        # A little on the diagonal keeps a class-free direction solvable.
        step = -Factored(hessian + 1e-12 * np.eye(size)).solve(gradient)
        tried = at(w + step)
        while tried[0] > loss + 1e-12 * abs(loss) and np.abs(step).max() > 1e-12:
            step = step / 2
            tried = at(w + step)
        w, steps = w + step, steps + 1
        loss, gradient, hessian = tried
    return VectorHead(w[:-1].tolist(), float(w[-1]), float(loss), float(np.sqrt(gradient @ gradient)), steps)
