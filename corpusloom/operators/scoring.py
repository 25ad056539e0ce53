"""Batch inference with a model that lives outside Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_SIZE = 32

Model = Callable[[Sequence[str]], np.ndarray]


def score_batches(
    df: DataFrame, text: str, load_model: Callable[[], Model], batch_size: int = BATCH_SIZE,
    column: str = "prediction",
) -> DataFrame:
    """``df`` with the class that the model ranks first for each text.

    ``load_model`` runs once per task and returns a function from a list of texts to an array
    of scores, one row per text and one column per class. Only the text goes to Python.
    """

    @F.pandas_udf(T.IntegerType())
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for part in parts:
            texts = part.tolist()
            classes = [
                np.asarray(model(texts[i:i + batch_size])).argmax(axis=1)
                for i in range(0, len(texts), batch_size)
            ]
            yield pd.Series(np.concatenate(classes) if classes else [], dtype="int32")

    return df.withColumn(column, predict(F.coalesce(F.col(text), F.lit(""))))
