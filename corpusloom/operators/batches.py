"""Batches of texts of nearly equal length, so that padding wastes little."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Hex digits of the hash that deals rows of one length into parts.
_PART_DIGITS = 3


def batch_by_length(docs: DataFrame, length: str, key: str, size: int) -> DataFrame:
    """``docs`` with ``batch`` and ``width``, the longest length in the batch.

    Rows are ranked by length, then by the MD5 of the key, then by key, and every ``size`` ranks make a batch. Ranks are
    sums of counts: of shorter lengths (a table of one row per length), of earlier parts of the length (4,096 at most), and
    the place in the part, so rows of one length, however many, are ranked in many tasks. A null length comes
    first, with width 0 beside others of its kind; null keys come before others; rows that repeat get ranks of their own.
    """
    hashed = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.withColumn("_hash", hashed).withColumn("_part", F.substring("_hash", 1, _PART_DIGITS))
    parts = rows.groupBy(F.col(length).alias("_l"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    lengths = parts.groupBy("_l").agg(F.sum("_n").alias("_rows"))
    earlier = W.orderBy(F.col("_l").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    lengths = lengths.select(F.col("_l").alias("_m"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shorter"))
    within = W.partitionBy("_l").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(lengths, F.col("_l").eqNullSafe(F.col("_m")))
    starts = starts.select("_l", "_p", (F.col("_shorter") + F.col("_before")).alias("_start"))
    place = F.row_number().over(W.partitionBy(length, "_part").orderBy("_hash", F.col(key).asc_nulls_first()))
    ranked = rows.withColumn("_place", place).join(starts, F.col(length).eqNullSafe(F.col("_l")) & (F.col("_part") == F.col("_p")))
    ranked = ranked.withColumn("batch", F.floor((F.col("_start") + F.col("_place") - 1) / size).cast("long"))
    width = F.coalesce(F.max(length).over(W.partitionBy("batch")), F.lit(0))
    return ranked.withColumn("width", width).select(*docs.columns, "batch", "width")


def padding(docs: DataFrame, length: str, batch: str) -> DataFrame:
    """One row: number of batches, tokens, tokens with padding, and the share that is padding."""
    each = docs.groupBy(batch).agg(F.count("*").alias("n"), F.sum(length).alias("tokens"), F.max(length).alias("width"))
    total = each.agg(F.count("*").alias("batches"), F.sum("tokens").alias("tokens"), F.sum(F.col("n") * F.col("width")).alias("padded"))
    return total.withColumn("waste", F.round(1 - F.col("tokens") / F.col("padded"), 6))
