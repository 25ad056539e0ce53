"""A corpus from documents to token ids: language, near duplicates, secrets, mixing, pieces.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of the stage before. All but the last
return the columns of ``docs``. ``run`` writes each stage as Parquet in the shared folder and reads it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bagminhash, language, mixing, pieces, secret_scan
from corpusloom.llm.queries import tokenizer_path
from corpusloom.session import materialise

#: Texts whose language is less certain than this go.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: not null, with a letter, and predicted with some certainty."""
    model = language.fit_held(docs)
    judged = language.with_language(docs, model, prediction="__language", score="__language_score")
    kept = judged.filter((F.col("__language") != language.UNKNOWN) & (F.col("__language_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id."""
    return bagminhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: a row for each copy of a document that the mix takes, in order."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, and whether these decode to the text."""
    return pieces.encode_documents(docs, pieces.read_model(spark, tokenizer_path("piece_bpe_32k.model")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language_id),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Separators fitted by Spark and hashed signatures have no SQL form; tests check the run against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
