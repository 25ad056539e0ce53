"""Bag-of-words and TF-IDF features as one sparse row per document.

A feature row is a struct ``(indices array<int>, values array<double>)``. It is built from the
document's own row with the vocabulary at hand, so vectorizing needs no join and no shuffle;
the long form (one row per document and term) is an explode of it.
"""

from __future__ import annotations

import json

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.columns import let, safe_name
from corpusloom.functions.tokens import ngrams, tokens_of
from corpusloom.operators.vocabulary import Vocabulary
from corpusloom.session import fresh_path


def constant_array(values: list[float]) -> Column:
    """A constant ``array<double>``, folded into the plan and read by position."""
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def bow_features(docs: DataFrame, text: str, vocab: Vocabulary, column: str = "bow") -> DataFrame:
    """``docs`` with the term counts of each document; unknown terms are dropped.

    ``text`` names a text column or an array of feature tokens.
    """
    if not len(vocab):
        empty = F.struct(F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values"))
        return docs.withColumn(column, empty)
    grams = docs.withColumn("_grams", ngrams(tokens_of(docs, text), vocab.low, vocab.high))
    counter = CountVectorizerModel.from_vocabulary(vocab.terms, inputCol="_grams", outputCol="_counts")
    counted = counter.transform(grams).withColumn("_counts", F.unwrap_udt("_counts"))
    pair = F.struct(F.col("_counts.indices").alias("indices"), F.col("_counts.values").alias("values"))
    return counted.withColumn(column, pair).drop("_grams", "_counts")


def sublinear_tf(count: Column) -> Column:
    return 1 + F.log(count)


def l2_normalised(values: Column) -> Column:
    """Values scaled to length one; a zero vector stays as it is."""

    def scale(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
        return let(norm, lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))

    return let(values, scale)


def tfidf_features(
    docs: DataFrame, bow: str, vocab: Vocabulary, column: str = "tfidf", sublinear: bool = True
) -> DataFrame:
    """``docs`` with TF-IDF weights made from the counts in ``bow``."""
    idf = constant_array(vocab.idf)
    weigh = lambda i, v: (sublinear_tf(v) if sublinear else v) * idf[i]
    raw = F.zip_with(F.col(f"{bow}.indices"), F.col(f"{bow}.values"), weigh)
    return docs.withColumn(
        column, F.struct(F.col(f"{bow}.indices").alias("indices"), l2_normalised(raw).alias("values"))
    )


def long_features(docs: DataFrame, features: str, keep: list[str], value: str) -> DataFrame:
    """One row per document and feature: ``keep`` columns, ``idx`` and ``value``."""
    pairs = F.explode(F.arrays_zip(F.col(f"{features}.indices").alias("i"), F.col(f"{features}.values").alias("v")))
    return docs.select(*keep, pairs.alias("p")).select(
        *keep, F.col("p.i").alias("idx"), F.col("p.v").alias(value)
    )


def with_terms(rows: DataFrame, vocab: Vocabulary, *columns: str) -> DataFrame:
    """Rows with an ``idx`` column joined to the vocabulary's ``term`` and further columns."""
    table = vocab.table(rows.sparkSession).select("idx", "term", *columns)
    return rows.join(table, "idx")


def counted_terms(terms: Column) -> Column:
    """``array<struct<term, tf>>``: the distinct entries of an array and how often each occurs."""

    def runs(s: Column) -> Column:
        is_start = lambda i: (i == 0) | (s[i] != s[F.greatest(i - 1, F.lit(0))])
        positions = F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>"))
        return let(F.filter(positions, is_start), lambda starts: lengths(s, starts))

    def lengths(s: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(s)))
        pairs = F.arrays_zip(starts.alias("a"), F.slice(ends, F.lit(1), F.size(starts)).alias("b"))
        return F.transform(pairs, lambda p: F.struct(s[p["a"]].alias("term"), (p["b"] - p["a"]).cast("long").alias("tf")))

    return let(F.sort_array(terms), runs)


def term_counts(docs: DataFrame, text: str, key: str, ngram_range: tuple[int, int] = (1, 3)) -> DataFrame:
    """``(key, term, tf)`` over all n-grams of one row per document, without a vocabulary.

    The terms are counted inside the document's row, so no n-gram is shuffled.
    """
    grams = ngrams(tokens_of(docs, text), *ngram_range)
    return docs.select(key, F.explode(counted_terms(grams)).alias("c")).select(key, "c.term", "c.tf")


def wide_names(vocab: Vocabulary, spark: SparkSession) -> list[str]:
    """Safe column names by feature index; a repeated name gets ``_<idx>`` appended."""
    table = vocab.table(spark).select("idx", safe_name(F.col("term")).alias("name"))
    names: list[str] = []
    seen: set[str] = set()
    for row in sorted(table.collect(), key=lambda r: r["idx"]):
        name = row["name"]
        while name in seen:
            name = f"{name}_{row['idx']}"
        seen.add(name)
        names.append(name)
    return names


def dense_array(features: str, size: int, as_type: str) -> Column:
    """All ``size`` values of a sparse row, zeros included, as one array."""

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0).cast(as_type), n)

    indices, values = F.col(f"{features}.indices"), F.col(f"{features}.values")
    before = F.concat(F.array(F.lit(-1)), F.slice(indices, F.lit(1), F.greatest(F.size(indices) - 1, F.lit(0))))
    cells = F.transform(
        F.arrays_zip(indices.alias("i"), before.alias("b"), values.alias("v")),
        lambda p: F.concat(zeros(p["i"] - p["b"] - 1), F.array(p["v"].cast(as_type))),
    )
    rest = zeros(F.lit(size - 1) - F.element_at(indices, -1))
    return F.when(F.size(indices) > 0, F.concat(F.flatten(cells), rest)).otherwise(zeros(F.lit(size)))


def wide_features(docs: DataFrame, features: str, vocab: Vocabulary, as_type: str = "bigint") -> DataFrame:
    """The original columns plus one column per feature, for export.

    The row's values are laid out as one array, and each column takes its place of it: thousands of
    columns come from one expression, without a pivot and without text.
    """
    names = wide_names(vocab.require_features(), docs.sparkSession)
    kept = [c for c in docs.columns if c != features]
    wide = docs.withColumn("_row", dense_array(features, len(names), as_type))
    return wide.select(*kept, *[F.get("_row", F.lit(i)).alias(name) for i, name in enumerate(names)])


def filled_cells(wide: DataFrame, key: str, names: list[str], value: str = "tf") -> DataFrame:
    """``(key, ngram_column, value)``: the cells above zero of the columns ``names`` of a wide table.

    Names are given to the few cells above zero only, so a zero costs a comparison and builds nothing.
    """
    labels = F.from_json(F.lit(json.dumps(names)), "array<string>")
    places = F.sequence(F.lit(0), F.lit(len(names) - 1))

    def above_zero(row: Column) -> Column:
        filled = F.filter(places, lambda i: F.get(row, i) > 0)
        return F.transform(filled, lambda i: F.struct(F.get(labels, i).alias("ngram_column"), F.get(row, i).alias(value)))

    cells = let(F.array(*[F.col(name).cast("long") for name in names]), above_zero)
    return wide.select(key, F.explode(cells).alias("c")).select(key, "c.*")


def feature_names(columns: list[str], prefix: str = "bow_") -> list[str]:
    """The feature columns of a wide table, by their name prefix."""
    found = [c for c in columns if c.startswith(prefix)]
    if not found:
        raise ValueError("no feature columns")
    return found


def as_vectors(docs: DataFrame, features: str, size: int, keep: list[str], path: str | None = None) -> DataFrame:
    """``keep`` columns and a sparse ``features`` vector, stored as Parquet and read back.

    Training reads its rows many times, so they are written once to the shared folder; the
    stored struct has the layout of a vector and is read as one, all inside the JVM.
    """
    spark = docs.sparkSession
    target = path or fresh_path(spark, "vectors")
    layout = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
        F.col(f"{features}.indices").alias("indices"), F.col(f"{features}.values").alias("values"),
    )
    docs.select(*keep, layout.alias("features")).write.parquet(target)
    fields = [docs.schema[name] for name in keep] + [T.StructField("features", VectorUDT())]
    return spark.read.schema(T.StructType(fields)).parquet(target)
