"""Fitted tables applied to a stream of documents.

Cleaning, vectorizing and prediction are row-level expressions over fixed tables, so a
streaming DataFrame takes them as it is: no state, no watermark, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.tokens import preprocess_text
from corpusloom.operators.classify import NaiveBayes
from corpusloom.operators.vectorize import bow_features
from corpusloom.operators.vocabulary import Vocabulary


def predict_stream(docs: DataFrame, text: str, vocab: Vocabulary, model: NaiveBayes, clean: bool = True) -> DataFrame:
    """Streaming or static ``docs`` with the predicted class of each text."""
    ready = docs.withColumn("_text", preprocess_text(F.col(text)) if clean else F.col(text))
    return model.predict(bow_features(ready, "_text", vocab), "bow").drop("_text", "bow", "scores")
