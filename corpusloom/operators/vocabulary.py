"""The n-gram vocabulary: counting, bounding, indexing, saving."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.columns import let
from corpusloom.functions.tokens import ngrams, tokens_of

MAX_FEATURES = 7500
MIN_DF = 2
MAX_DF = 0.95
NGRAM_RANGE = (1, 3)

# The vocabulary travels with every task; a request for more features is refused before any work.
LARGEST_MAX_FEATURES = 1_000_000

#: Cells of the sketch of n-gram counts: a bit of each travels with the second pass, 128 KiB.
CELLS = 1 << 20

_SCHEMA = "term string, idx int, df long, cf long, idf double"


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary, at most ``max_features`` terms in alphabetical order."""

    terms: list[str]
    df: list[int]
    cf: list[int]
    n_docs: int
    params: dict = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.terms)

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.n_docs) / (1 + d)) + 1 for d in self.df]

    @property
    def low(self) -> int:
        return self.params.get("ngram_range", NGRAM_RANGE)[0]

    @property
    def high(self) -> int:
        return self.params.get("ngram_range", NGRAM_RANGE)[1]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(term, idx, df, cf, idf)``, one row per feature."""
        rows = list(zip(self.terms, range(len(self.terms)), self.df, self.cf, self.idf))
        return spark.createDataFrame(rows, _SCHEMA)

    def require_features(self) -> "Vocabulary":
        if not self.terms:
            raise ValueError("no feature columns")
        return self

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the ``vocab`` and ``params`` tables below ``path``."""
        self.table(spark).coalesce(1).write.parquet(f"{path}/vocab")
        params = [(self.n_docs, json.dumps(self.params))]
        spark.createDataFrame(params, "n_docs long, params string").coalesce(1).write.parquet(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Vocabulary":
        """A saved vocabulary; it has at most ``LARGEST_MAX_FEATURES`` rows, as it was fitted here."""
        params = spark.read.parquet(f"{path}/params").first()
        table = spark.read.parquet(f"{path}/vocab")
        rows = sorted(table.collect(), key=lambda r: r["idx"])
        return Vocabulary(
            [r["term"] for r in rows], [r["df"] for r in rows], [r["cf"] for r in rows],
            params["n_docs"], json.loads(params["params"]),
        )


def _occurrences(docs: DataFrame, grams: Column) -> DataFrame:
    """``(term, first)``: one row per n-gram occurrence; ``first`` is 1 once per document.

    Sorting a document's array brings equal terms together, so the head of each run stands for
    the document. Nothing is grouped by document, which would shuffle every n-gram.
    """
    ordered = docs.select(F.sort_array(grams).alias("s"))
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.slice("s", F.lit(1), F.greatest(F.size("s") - 1, F.lit(0))))
    pairs = ordered.select(F.explode(F.arrays_zip(F.col("s").alias("term"), shifted.alias("prev"))).alias("z"))
    # The shifted array of an empty document still has its null head: a row without a term.
    first = F.when(F.col("z.prev") == F.col("z.term"), 0).otherwise(1).cast("long")
    return pairs.where(F.col("z.term").isNotNull()).select(F.col("z.term").alias("term"), first.alias("first"))


def _count(occurrences: DataFrame) -> DataFrame:
    """``(term, df, cf)``. Spark combines inside each map task, so a frequent term is no hot key."""
    return occurrences.groupBy("term").agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("cf"))


def term_statistics(docs: DataFrame, text: str, ngram_range: tuple[int, int] = NGRAM_RANGE) -> DataFrame:
    """Document and corpus frequency of every n-gram of ``docs``."""
    return _count(_occurrences(docs, ngrams(tokens_of(docs, text), *ngram_range)))


def _hashes(tokens: Column, low: int, high: int) -> Column:
    """A hash of each run of ``low`` to ``high`` tokens, shorter runs first, made from hashes of tokens: no run is built."""

    def extend(one: Column, runs: Column, n: int, done: tuple[Column, ...]) -> Column:
        done = (*done, runs) if n >= low else done
        if n == high:
            return F.concat(*done)
        count = F.greatest(F.size(one) - n, F.lit(0))
        longer = F.zip_with(F.slice(runs, F.lit(1), count), F.slice(one, F.lit(n + 1), count), lambda a, b: F.xxhash64(a, b))
        return let(longer, lambda r: extend(one, r, n + 1, done))

    return let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda one: extend(one, one, 1, ()))


def _cell(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(CELLS)).cast("int")


def _fullest_cells(docs: DataFrame, text: str, ngram_range: tuple[int, int], n: int) -> tuple[list[int], int]:
    """The cells with at least ``least`` n-gram occurrences, fewer than ``n``, and ``least``.

    Every occurrence is counted in the cell of its hash, so an n-gram that occurs ``least`` times or more
    is in one of these cells. Counts of cells add up like any, and are as many however large the corpus.
    """
    cells = docs.select(F.explode(_hashes(tokens_of(docs, text), *ngram_range)).alias("h")).groupBy(_cell(F.col("h")).alias("cell")).count()
    # Collecting a limit merges the best rows of every partition on the driver; with an exchange
    # on top a task merges them, and the driver gets the final rows only.
    fullest = cells.orderBy(F.desc("count"), "cell").limit(n).repartition(1).collect()
    # Of cells as full as the last one some may be missing.
    least = min(r["count"] for r in fullest) + 1 if len(fullest) == n else 1
    return [r["cell"] for r in fullest if r["count"] >= least], least


def _grams_in(docs: DataFrame, text: str, ngram_range: tuple[int, int], cells: list[int]) -> Column:
    """The n-grams of a row whose cells are among ``cells``; only these are built."""
    words = [0] * (CELLS // 64)
    for cell in cells:
        words[cell >> 6] |= 1 << (cell & 63)
    signed = [w - (1 << 64) if w >> 63 else w for w in words]
    table = F.from_json(F.lit(json.dumps(signed)), "array<bigint>")
    low, high = ngram_range

    def listed(hashed: Column) -> Column:
        return F.getbit(table[F.shiftright(_cell(hashed), 6)], _cell(hashed) % 64) == 1

    def build(tokens: Column, hashes: Column) -> Column:
        runs = lambda places, n: F.transform(places, lambda i: F.concat_ws(" ", F.slice(tokens, i + 1, F.lit(n))))
        size, before, found = F.size(tokens), F.lit(0), []
        for n in range(low, high + 1):
            count = F.greatest(size - (n - 1), F.lit(0))
            places = F.filter(
                F.transform(F.slice(hashes, before + 1, count), lambda h, i: F.when(listed(h), i)), lambda i: i.isNotNull()
            )
            found.append(runs(places, n))
            before = before + count
        return F.concat(*found)

    return let(tokens_of(docs, text), lambda t: let(_hashes(t, low, high), lambda h: build(t, h)))


def _best(stats: DataFrame, n_docs: int, max_features: int, min_df: int, max_df: float) -> list:
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * F.lit(float(n_docs))))
    return kept.orderBy(F.desc("cf"), "term").limit(max_features).repartition(1).collect()


def _frequent(
    docs: DataFrame, text: str, ngram_range: tuple[int, int],
    n_docs: int, max_features: int, min_df: int, max_df: float,
) -> list:
    """The best terms by exact counts of those n-grams only that a sketch cannot rule out.

    One pass counts all n-grams by cell of their hash; a second builds and counts those of the fullest
    cells, so neither rare n-grams nor their text are ever shuffled. The outcome is exact, ties included: what
    was left out occurs less than ``least`` times, which must be less than the last of the best; else more
    cells are looked at, all of them in the end.
    """
    n = 2 * max_features + 1024
    while True:
        cells, least = _fullest_cells(docs, text, ngram_range, n)
        stats = _count(_occurrences(docs, _grams_in(docs, text, ngram_range, cells)))
        best = _best(stats, n_docs, max_features, min_df, max_df)
        if least == 1 or (len(best) == max_features and min(r["cf"] for r in best) >= least):
            return best
        n *= 4


def fit_vocabulary(
    train: DataFrame,
    text: str,
    *,
    max_features: int = MAX_FEATURES,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
) -> Vocabulary:
    """Vocabulary of the training rows; ``text`` is a text column or an array of feature tokens.

    Keeps n-grams in at least ``min_df`` documents and at most the fraction ``max_df`` of them,
    then the ``max_features`` most frequent (ties: alphabetical). ``max_features`` is at most
    ``LARGEST_MAX_FEATURES``.
    """
    if max_features > LARGEST_MAX_FEATURES:
        raise ValueError(f"max_features is {max_features}; {LARGEST_MAX_FEATURES} is the most")
    n_docs = train.count()
    if n_docs == 0:
        raise ValueError("no training rows to fit the vocabulary on")
    best = _frequent(train, text, ngram_range, n_docs, max_features, min_df, max_df)
    best = sorted(best, key=lambda r: r["term"])
    params = {
        "ngram_range": list(ngram_range), "min_df": min_df, "max_df": max_df, "max_features": max_features,
    }
    return Vocabulary([r["term"] for r in best], [r["df"] for r in best], [r["cf"] for r in best], n_docs, params)
