"""The strongest n-grams of each class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions.columns import without_prefix
from corpusloom.operators.vectorize import long_features, wide_names
from corpusloom.operators.vocabulary import Vocabulary

TOP_K = 50

# Means are sums of doubles whose order depends on the partitions. Ranking looks at this many
# decimals, so that equal means stay ties and the order is the same on every run.
SCORE_DIGITS = 12


def term_totals(docs: DataFrame, features: str, label: str, vocab: Vocabulary) -> DataFrame:
    """``(idx, term, ngram_column, pos_total, neg_total)`` for every term of the vocabulary.

    Both classes come from one aggregation by feature index, combined in the map tasks; the
    result has one row per feature, whatever the number of documents.
    """
    spark = docs.sparkSession
    long = long_features(docs, features, [label], "v")
    of = lambda c: F.sum(F.when(F.col(label) == c, F.col("v")).otherwise(0.0))
    sums = long.groupBy("idx").agg(of(1).alias("pos_total"), of(0).alias("neg_total"))
    rows = list(zip(range(len(vocab)), vocab.terms, wide_names(vocab, spark)))
    terms = spark.createDataFrame(rows, "idx int, term string, ngram_column string")
    zero = {"pos_total": 0.0, "neg_total": 0.0}
    return terms.join(sums, "idx", "left").fillna(zero)


def class_sizes(docs: DataFrame, label: str) -> tuple[int, int]:
    """Number of positive and negative documents."""
    row = docs.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    return row["pos"], row["neg"]


def term_means(docs: DataFrame, features: str, label: str, vocab: Vocabulary) -> DataFrame:
    """Totals and means per class; documents without the term count as zero."""
    n_pos, n_neg = class_sizes(docs, label)
    totals = term_totals(docs, features, label, vocab)
    mean = lambda total, n: F.col(total) / F.lit(float(n)) if n else F.lit(None).cast("double")
    return totals.withColumns({"mean_pos": mean("pos_total", n_pos), "mean_neg": mean("neg_total", n_neg)})


def top_per_class(scored: DataFrame, pos: Column, neg: Column, k: int = TOP_K, name: str = "score") -> DataFrame:
    """Ranks 1..k per class by score, ties in alphabetical order."""
    both = F.explode(F.array(
        F.struct(F.lit("POS").alias("class"), pos.alias(name)),
        F.struct(F.lit("NEG").alias("class"), neg.alias(name)),
    ))
    rows = scored.withColumn("_c", both).select("_c.*", *scored.columns)
    order = W.partitionBy("class").orderBy(F.desc(F.round(F.col(name), SCORE_DIGITS)), "term")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rows_of(docs: DataFrame, rows: str, split: str) -> DataFrame:
    if rows not in ("all", "train"):
        raise ValueError("rows is 'all' or 'train'")
    return docs if rows == "all" else docs.where(F.col(split) == 0)


def top_bow_total(
    docs: DataFrame, features: str, label: str, vocab: Vocabulary, k: int = TOP_K, rows: str = "all",
    split: str = "validation_set",
) -> DataFrame:
    """Top n-grams by total count."""
    totals = term_totals(_rows_of(docs, rows, split), features, label, vocab.require_features())
    ranked = top_per_class(totals, F.col("pos_total"), F.col("neg_total"), k, "total")
    return ranked.select(
        "class", "rank", "ngram_column", without_prefix(F.col("ngram_column")).alias("ngram"),
        F.col("total").cast("long").alias("bow_total_count"),
    )


def top_bow_distinctive(
    docs: DataFrame, features: str, label: str, vocab: Vocabulary, k: int = TOP_K, rows: str = "all",
    split: str = "validation_set",
) -> DataFrame:
    """Top n-grams by the difference of the mean counts."""
    means = term_means(_rows_of(docs, rows, split), features, label, vocab.require_features())
    pos, neg = F.col("mean_pos"), F.col("mean_neg")
    ranked = top_per_class(means, pos - neg, neg - pos, k, "distinctiveness_score")
    return ranked.select(
        "class", "rank", "ngram_column", without_prefix(F.col("ngram_column")).alias("ngram"),
        pos.alias("mean_bow_pos"), neg.alias("mean_bow_neg"), "distinctiveness_score",
    )


def top_tfidf(
    docs: DataFrame, features: str, label: str, vocab: Vocabulary, k: int = TOP_K, rows: str = "train",
    split: str = "validation_set",
) -> DataFrame:
    """Top n-grams by mean TF-IDF."""
    means = term_means(_rows_of(docs, rows, split), features, label, vocab.require_features())
    ranked = top_per_class(means, F.col("mean_pos"), F.col("mean_neg"), k, "mean_tfidf")
    return ranked.select("class", "rank", F.col("term").alias("ngram"), "mean_tfidf")


def top_tfidf_distinctive(
    docs: DataFrame, features: str, label: str, vocab: Vocabulary, k: int = TOP_K, rows: str = "train",
    split: str = "validation_set",
) -> DataFrame:
    """Top n-grams by the difference of the mean TF-IDF."""
    means = term_means(_rows_of(docs, rows, split), features, label, vocab.require_features())
    pos, neg = F.col("mean_pos"), F.col("mean_neg")
    ranked = top_per_class(means, pos - neg, neg - pos, k, "distinctiveness_score")
    return ranked.select(
        "class", "rank", F.col("term").alias("ngram"), pos.alias("mean_tfidf_pos"),
        neg.alias("mean_tfidf_neg"), "distinctiveness_score",
    )
