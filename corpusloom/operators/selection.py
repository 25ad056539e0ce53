"""Choice of Naive Bayes settings by cross-validation in two passes over the rows, whatever the grid."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.metrics import confusion_counts, with_quality
from corpusloom.session import materialise

PRIORS = ("counted", "equal")

#: Entries of sparse rows that are weighed at once.
ENTRIES = 1 << 18


def fold_of(key: str, folds: int, seed: int = 20260301) -> Column:
    """A fold from 0 by the MD5 of the seed and the key: the same in every run, and spread evenly."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % folds).cast("int")


def _likelihoods(counts: np.ndarray, alphas: Sequence[float]):
    """``(fold, indices, values) -> array<double>``: the sum over a row's terms of value times log of count plus alpha.

    ``counts`` is by fold, class and feature. An array has the classes of the first alpha, then those of the next. A row's
    terms are added in their order; a row without arrays has no sums.
    """

    def some(fold: pa.Array, indices: pa.Array, values: pa.Array) -> np.ndarray:
        sizes = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at, value = indices.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        seen = counts[fold.to_numpy(zero_copy_only=False)[row], :, at]
        sums = [np.bincount(row, value * np.log(seen[:, y] + a), minlength=len(sizes)) for a in alphas for y in (0, 1)]
        return np.stack(sums, axis=1)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def weigh(fold: pa.Array, indices: pa.Array, values: pa.Array) -> pa.Array:
        ends, width, made, start = np.cumsum(indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), 2 * len(alphas), [], 0
        while start < len(fold):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
            made.append(some(*(c.slice(start, stop - start) for c in (fold, indices, values))).reshape(-1))
            start = stop
        sums = pa.array(np.concatenate(made) if made else np.zeros(0))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(fold) + 1) * width, pa.int32()), sums, mask=indices.is_null())

    return weigh


def grid_scores(
    rows: DataFrame, features: str, label: str, key: str, n_features: int, alphas: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    priors: Sequence[str] = PRIORS, folds: int = 5,
) -> DataFrame:
    """``alpha``, ``prior``, ``fold``, confusion counts and measures of Naive Bayes trained without the fold and tested on it.

    The counts that a model needs are sums, so those of the other folds are all counts less those of the fold: one
    aggregate by fold, class and feature serves every setting. A second pass scores each row under all settings with the
    model of its fold. Both read the counted rows from one stored copy, so that ``features`` is made once. ``prior`` is ``counted`` (shares of the classes) or ``equal``. The model tables, ``folds`` times
    two times ``n_features`` counts, are what reaches the driver. Rows without a label or key take no part; a class
    that the other folds lack is never predicted; equal scores give class 0. Labels are 0 and 1.
    """
    known = rows.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(label).cast("int").alias("y"), fold_of(key, folds).alias("fold"),
        F.col(f"{features}.indices").alias("i"), F.col(f"{features}.values").alias("v"),
    )
    known = materialise(known, "grid_rows")
    # Index -1 counts the rows.
    no_term = F.array(F.struct(F.lit(-1).alias("i"), F.lit(1.0).alias("v")))
    pairs = known.select("y", "fold", F.explode(F.concat(no_term, F.arrays_zip("i", "v"))).alias("p"))
    sums = pairs.groupBy("fold", "y", "p.i").agg(F.sum("p.v").alias("n")).collect()
    counts = [[[0.0] * (n_features + 1) for _ in range(2)] for _ in range(folds)]
    for r in sums:
        for fold in range(folds):
            if fold != r["fold"]:
                counts[fold][r["y"]][r["i"]] += r["n"]  # rows are counted in the last place
    sizes = [[c[-1] for c in of_fold] for of_fold in counts]
    totals = [[sum(c[:-1]) for c in of_fold] for of_fold in counts]
    held = np.array(counts)[:, :, :-1]

    def constant(values: list[list[float]], y: int) -> Column:
        return F.from_json(F.lit(json.dumps(values)), "array<array<double>>")[F.col("fold")][y]

    def likelihood(alpha: float, y: int, seen: Column) -> Column:
        size = [[math.log(t + alpha * n_features) if n_features else 0.0 for t in of_fold] for of_fold in totals]
        lacking = [[0.0 if n else -1e300 for n in s] for s in sizes]
        return constant(lacking, y) + seen - F.col("length") * constant(size, y)

    settings = [(float(max(a, 1e-10)), p) for a in alphas for p in priors]
    # The sums over terms depend on alpha alone, the priors are added to them.
    kinds = list(dict.fromkeys(a for a, _ in settings))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    weighed = known.select("y", "fold", length.alias("length"), _likelihoods(held, kinds)("fold", "i", "v").alias("seen"))
    likely = {a: [likelihood(a, y, F.get("seen", F.lit(2 * n + y))) for y in (0, 1)] for n, a in enumerate(kinds)}
    scored = weighed.select("y", "fold", *[c.alias(f"s{n}_{y}") for n, (a, cs) in enumerate(likely.items()) for y, c in enumerate(cs)])
    place = {a: n for n, a in enumerate(likely)}
    counted = [[math.log(n / sum(s)) if n else 0.0 for n in s] for s in sizes]

    def predicted(alpha: float, prior: str) -> Column:
        sides = [F.col(f"s{place[alpha]}_{y}") + (constant(counted, y) if prior == "counted" else 0.0) for y in (0, 1)]
        return F.struct(F.lit(alpha).alias("alpha"), F.lit(prior).alias("prior"), F.when(sides[1] > sides[0], 1).otherwise(0).alias("prediction"))

    long = scored.select("y", "fold", F.explode(F.array(*[predicted(*s) for s in settings])).alias("p")).select("y", "fold", "p.*")
    return with_quality(confusion_counts(long, "y", "prediction", ["alpha", "prior", "fold"]))


def best_setting(scores: DataFrame, measure: str = "f-score") -> DataFrame:
    """The one row ``alpha``, ``prior``, mean measure over the folds: highest mean (12 digits), then larger alpha, then prior by name."""
    means = scores.groupBy("alpha", "prior").agg(F.avg(measure).alias(measure))
    return means.orderBy(F.desc(F.round(measure, 12)), F.desc("alpha"), "prior").limit(1)
