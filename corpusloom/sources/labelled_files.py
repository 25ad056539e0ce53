"""Folders of one text per file, ``{train,test}/{pos,neg}/{id}_{score}.txt``."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.columns import composite_id, label_of_folder, prefix_of_label
from corpusloom.functions.text import decode_bytes
from corpusloom.operators.quality import parse_path
from corpusloom.sources import folders


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of every file below ``root``; contents are not read."""
    return folders.list_below(spark, root) if folders.reachable(root) else _binary(spark, root).select("path", "length")


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` of a file or of all files below a folder."""
    return _contents(spark, path).select("path", "content")


def _contents(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``(path, length, content)``: listed and read by tasks, or by Spark in a store that only Spark can open."""
    if folders.reachable(root):
        return folders.with_contents(folders.list_below(spark, root, pattern or "*"))
    return _binary(spark, root, pattern)


def _binary(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``(path, length, content)`` of all files.

    Spark's file sources leave out files of length zero. The scan still knows their paths, so
    they are added back: an empty text must show up in the checks, not vanish. Contents are
    read only where a query uses them.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(root).select("path", "length", "content")
    listed = spark.createDataFrame([(unquote(p),) for p in found.inputFiles()], "path string")
    one_slash = F.regexp_replace("path", "^file:/+", "file:/")
    empty = listed.select(one_slash.alias("path")).join(found.select(one_slash.alias("path")), "path", "left_anti")
    return found.unionByName(
        empty.select("path", F.lit(0).cast("long").alias("length"), F.lit("").cast("binary").alias("content"))
    )


def read_text_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, split, folder, number_text, number, score, text)`` of all ``*.txt`` files."""
    files = _contents(spark, root, "*.txt")
    part = parse_path(F.col("path"))
    return files.select(
        "path", part["split"].alias("split"), part["folder"].alias("folder"),
        part["id_text"].alias("number_text"), part["number"].alias("number"), part["score"].alias("score"),
        decode_bytes(F.col("content")).alias("text"),
    )


def read_labelled_text(spark: SparkSession, root: str) -> DataFrame:
    """``(split, POS, Unique_ID, Score, Review)`` from the pos and neg folders."""
    files = read_text_files(spark, root).where(F.col("folder").isin("pos", "neg"))
    return files.select("split", label_of_folder(F.col("folder")).alias("POS"), "number_text", "score", "text").select(
        "split", "POS",
        composite_id(prefix_of_label(F.col("POS")), F.col("number_text")).alias("Unique_ID"),
        F.col("score").alias("Score"), F.col("text").alias("Review"),
    )


def sort_by_id(df: DataFrame, unique_id: str = "Unique_ID") -> DataFrame:
    """Sort by prefix, then by number: ``NEG`` before ``POS`` and 2 before 10."""
    from corpusloom.functions.columns import id_number, id_prefix

    return df.orderBy(id_prefix(F.col(unique_id)), id_number(F.col(unique_id)))
