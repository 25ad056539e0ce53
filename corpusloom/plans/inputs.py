"""The tables of a data folder, and the labelled-text views made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.columns import composite_id, folder_of_label, prefix_of_label


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give every core some rows of a small table scan.

    Text work is bound by the CPU, and a small Parquet file is one split. A scan that already
    has a partition per core, as any large table has, is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: ``pos`` is the quality label."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("int").alias("pos"))
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars")
    return spread(docs, "doc_id").join(labels, "doc_id")


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """A file path per labelled document, some of them malformed, made from the tables."""
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    split = F.when(F.col("lang") == "en", "train").otherwise("test")
    suffix = F.when(F.col("toxic") == 1, "_x.md").otherwise(".txt")
    path = F.concat(
        F.lit("/corpus/"), split, F.lit("/"), folder_of_label(F.col("quality")), F.lit("/"),
        F.col("doc_id"), F.lit("_"), F.col("n_chars") % 12, suffix,
    )
    return docs.join(labels, "doc_id").select("doc_id", path.alias("path"))


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with the columns of a raw table; the score is the length's last digit."""
    rows = reviews(spark, folder)
    return rows.select(
        F.col("pos").alias("POS"),
        composite_id(prefix_of_label(F.col("pos")), F.col("doc_id")).alias("Unique_ID"),
        (1 + F.col("n_chars") % 10).cast("int").alias("Score"),
        F.col("text").alias("Review"),
    )
