"""Exact-size, class-balanced, repeatable validation split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Fixed value: the seed of the published split.
SEED = 20260225
VALIDATION_FRACTION = 0.20

# Keys are counted per leading hex digits of their hash before any key is ranked.
_PREFIX_DIGITS = 4


def order_hash(key: str, seed: int = SEED) -> Column:
    """The fixed pseudo-random order of the rows."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


@dataclass(frozen=True)
class SplitRule:
    """Per class, the last ``(hash, key)`` that belongs to the validation set.

    A class without an entry has no validation rows. Applying the rule is a row-level
    expression: no shuffle, and it also works on rows that arrive later or on a stream.
    """

    key: str
    label: str
    seed: int
    cuts: dict[int, tuple[str, str]]
    key_type: str

    def is_validation(self) -> Column:
        place = F.struct(order_hash(self.key, self.seed).alias("h"), F.col(self.key).alias("k"))
        picked = F.lit(False)
        for label, (cut_hash, cut_key) in sorted(self.cuts.items()):
            cut = F.struct(F.lit(cut_hash).alias("h"), F.lit(cut_key).cast(self.key_type).alias("k"))
            picked = F.when(F.col(self.label) == label, place <= cut).otherwise(picked)
        return F.coalesce(picked, F.lit(False))

    def apply(self, df: DataFrame, column: str = "validation_set") -> DataFrame:
        return df.withColumn(column, F.when(self.is_validation(), 1).otherwise(0))


def fit_split(
    df: DataFrame,
    key: str,
    label: str,
    fraction: float = VALIDATION_FRACTION,
    seed: int = SEED,
    classes: tuple[int, ...] = (0, 1),
) -> SplitRule:
    """Find the cut that puts exactly ``int(n * fraction)`` rows of each class in validation.

    Ranking a whole class would sort it in one task. The rows are first counted per hash
    prefix; the counts tell which prefix holds the cut, and only that prefix is ranked.
    Both passes read the key and the label alone.
    """
    rows = df.where(F.col(label).isin(*classes)).select(
        F.col(label).cast("int").alias("c"), F.col(key).alias("k"), order_hash(key, seed).alias("h")
    )
    prefix = F.substring("h", 1, _PREFIX_DIGITS)
    counts = rows.groupBy("c", prefix.alias("p")).count()
    before = F.sum("count").over(W.partitionBy("c").orderBy("p")) - F.col("count")
    wanted = F.floor(F.sum("count").over(W.partitionBy("c")) * F.lit(float(fraction)))
    placed = counts.select("c", "p", "count", before.alias("before"), wanted.alias("wanted"))
    edges = placed.where((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("count")))
    found = edges.select("c", "p", (F.col("wanted") - F.col("before")).alias("nth")).collect()

    cuts: dict[int, tuple[str, str]] = {}
    if found:
        in_edge = F.lit(False)
        nth = F.lit(0)
        for row in found:
            here = (F.col("c") == row["c"]) & (prefix == row["p"])
            in_edge = in_edge | here
            nth = F.when(F.col("c") == row["c"], row["nth"]).otherwise(nth)
        # Counting per key first keeps a repeated key from filling the window.
        keys = rows.where(in_edge).groupBy("c", "h", "k").count()
        upto = F.sum("count").over(W.partitionBy("c").orderBy("h", "k"))
        last = keys.withColumn("upto", upto).where((F.col("upto") >= nth) & (F.col("upto") - F.col("count") < nth))
        cuts = {r["c"]: (r["h"], r["k"]) for r in last.select("c", "h", F.col("k").cast("string")).collect()}
    return SplitRule(key, label, seed, cuts, df.schema[key].dataType.simpleString())


def add_validation_split(df: DataFrame, key: str, label: str, **options) -> DataFrame:
    """``df`` with an integer ``validation_set`` column."""
    return fit_split(df, key, label, **options).apply(df)


def train_rows(df: DataFrame, column: str = "validation_set") -> DataFrame:
    return df.where(F.col(column).cast("int") == 0)


def validation_rows(df: DataFrame, column: str = "validation_set") -> DataFrame:
    return df.where(F.col(column).cast("int") == 1)
