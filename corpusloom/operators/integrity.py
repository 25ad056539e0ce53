"""Do the texts of a table still equal the files they came from?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.columns import folder_of_label, id_number, sha256_text, yes_no

MATCH_KEYS = ["_split", "_folder", "_number", "_score"]


def source_hashes(files: DataFrame, text: str = "text") -> DataFrame:
    """``(keys, hash_original_file)`` of parsed source files; the text stays behind."""
    return files.select(
        F.col("split").alias("_split"), F.col("folder").alias("_folder"),
        F.col("number").cast("long").alias("_number"), F.col("score").cast("int").alias("_score"),
        sha256_text(F.col(text)).alias("hash_original_file"),
    )


def hash_check(table: DataFrame, files: DataFrame, split: str | None = None, strict: bool = False) -> DataFrame:
    """The table with the hash of its text, the hash of the source file and ``TRUE``/``FALSE``.

    Rows meet their file on split, label, number and score. Files are hashed before the join,
    so only their hashes are shuffled. A row without a file has a null file hash and counts as
    a mismatch; with ``strict`` it raises. Further columns of the table pass through.
    """
    which = F.lit(split) if split is not None else F.col("split")
    keyed = table.withColumns({
        "_split": which,
        "_folder": folder_of_label(F.col("POS")),
        "_number": id_number(F.col("Unique_ID")),
        "_score": F.trim(F.col("Score").cast("string")).cast("int"),
        "hash_csv_review": sha256_text(F.coalesce(F.col("Review"), F.lit(""))),
    })
    joined = keyed.join(source_hashes(files), MATCH_KEYS, "left")
    original = F.col("hash_original_file")
    if strict:
        missing = F.raise_error(F.concat(F.lit("source file missing for "), F.col("Unique_ID")))
        joined = joined.withColumn("hash_original_file", F.when(original.isNull(), missing.cast("string")).otherwise(original))
    same = F.coalesce(F.col("hash_csv_review") == F.col("hash_original_file"), F.lit(False))
    return joined.select(*table.columns, "hash_csv_review", "hash_original_file", yes_no(same).alias("hash_match"))


def match_counts(checked: DataFrame) -> DataFrame:
    """How many rows match and how many do not."""
    return checked.agg(
        F.count_if(F.col("hash_match") == "TRUE").alias("match_true"),
        F.count_if(F.col("hash_match") == "FALSE").alias("match_false"),
    )


def checksum_report(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files against a manifest ``(name, md5)``: case-insensitive, missing files fail."""
    found = files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.md5("content").alias("found_md5")
    )
    same = F.coalesce(F.col("found_md5") == F.lower(F.trim("md5")), F.lit(False))
    return manifest.join(found, "name", "left").select("name", "found_md5", same.alias("ok"))
