"""Hard negatives of anchors by Fagin's threshold algorithm over per-dimension sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusloom.session import materialise

#: Rows whose sorted lists one task holds at a time, and anchors that meet them there.
BLOCK_ROWS = 4096
BLOCK_ANCHORS = 1024

#: Entries that are read from every list before the threshold is looked at for the first time.
FIRST_DEPTH = 64


class SortedLists:
    """The rows of a block with one list per dimension, ascending by component."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | float | None]]:
        """Rows met newly, their scores, and the threshold: no row not yet met scores more. None at the end.

        Lists are read from the end that the sign of the anchor's component prefers; dimensions in which
        the anchor is 0 are not read. Depths double, so an anchor takes few rounds.
        """
        n, used = len(self.ids), np.flatnonzero(anchor != 0)
        weights, seen = anchor[used], np.zeros(n, bool)
        up, down = used[weights > 0], used[weights < 0]
        weights = np.concatenate([anchor[up], anchor[down]])
        done, depth = 0, FIRST_DEPTH if len(used) else n
        while done < n:
            depth = min(depth, n)
            met = np.zeros(n, bool)
            if len(used):
                met[self.order[n - depth : n - done, up].ravel()] = True
                met[self.order[done:depth, down].ravel()] = True
            else:
                met[:] = True
            rows = np.flatnonzero(met & ~seen)
            seen |= met
            edge = np.concatenate([self.sorted[n - depth, up], self.sorted[depth - 1, down]])
            yield rows, self.vectors[rows] @ anchor, None if depth == n else (edge * weights).sum()
            done, depth = depth, depth * 2


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort((ids, -scores))[:k]


def nearest_same(lists: SortedLists, labels: np.ndarray, anchor: np.ndarray, own: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best other rows of a label."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, lists.vectors.dtype)
    for rows, score, threshold in lists.walk(anchor):
        fits = (labels[rows] == label) & (lists.ids[rows] != own)
        ids, scores = np.concatenate([ids, lists.ids[rows[fits]]]), np.concatenate([scores, score[fits]])
        top = best(scores, ids, k)
        ids, scores = ids[top], scores[top]
        if threshold is None or (len(ids) == k and threshold < scores[-1]):
            break
    return ids, scores


def in_windows(
    lists: SortedLists, labels: np.ndarray, anchor: np.ndarray, label: int, windows: list[tuple], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window ``(low, high)``, both ends in it, ids and scores of the ``k`` best rows of other labels."""
    kept = [(np.zeros(0, np.int64), np.zeros(0, lists.vectors.dtype)) for _ in windows]
    least = min((low for low, high in windows if low <= high), default=None)
    if least is None:
        return kept
    for rows, score, threshold in lists.walk(anchor):
        # A score below every window is of no use to any.
        fits = (labels[rows] != label) & (score >= least)
        met_ids, met = lists.ids[rows[fits]], score[fits]
        for at, (low, high) in enumerate(windows):
            inside = (met >= low) & (met <= high)
            if inside.any():
                ids, scores = np.concatenate([kept[at][0], met_ids[inside]]), np.concatenate([kept[at][1], met[inside]])
                top = best(scores, ids, k)
                kept[at] = ids[top], scores[top]
        if threshold is None or all(
            threshold < low or (len(s) == k and threshold < s[-1]) for (low, high), (_, s) in zip(windows, kept) if low <= high
        ):
            break
    return kept


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores ``n`` with ``low * positive <= 100 * n <= high * positive``."""
    return -((-low * positive) // 100), (high * positive) // 100


def _matrix(column: pa.ChunkedArray, length: int) -> list[list[int]]:
    return [v + [0] * (length - len(v)) for v in column.to_pylist()]


def _vectors(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Whole components of both sides, shorter vectors filled with 0, in a type that holds every score exactly."""
    columns = [rows["v"].combine_chunks(), anchors["v"].combine_chunks()]
    length = max([int(c.value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for c in columns] + [1])
    if all(not len(c) or (c.value_lengths().to_numpy(zero_copy_only=False) == length).all() for c in columns):
        both = [c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), length) for c in columns]
    else:
        both = [np.array(_matrix(c, length), np.int64).reshape(len(c), length) for c in columns]
    largest = [int(max(m.max(initial=0), -int(m.min(initial=0)))) for m in both]
    most = largest[0] * largest[1] * length
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
    return both[0].astype(kind), both[1].astype(kind)


def _long(scores: list) -> list[int]:
    """As 64-bit numbers; a score beyond them becomes the end of their range."""
    return [min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores]


def prepared(rows: DataFrame, key: str, vector: str, label: str, scale: int, label_rule: Column | None = None) -> DataFrame:
    """``id``, ``label``, ``v`` (whole components) of the rows that take part, one an id."""
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    whole = F.transform("v", lambda x: F.floor(scale * x).cast("long"))
    chosen = rows.select("id", F.coalesce(label_rule, F.col("label")).alias("label") if label_rule is not None else "label", whole.alias("v"))
    return chosen.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def mine(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100, positives: int = 5,
    k: int = 10, low: int = 30, high: int = 90, scale: int = 256, label_rule: Column | None = None,
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Anchors are the rows whose id is divisible by ``every``. A component x counts as ``floor(scale * x)``; a
    score is the whole-number inner product with the anchor; higher comes first, ties by smaller id.
    Positives are the first ``positives`` other rows of the anchor's label. Negatives are the first ``k`` rows of
    other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score``. ``label_rule`` may
    rewrite ``label`` from the columns ``id`` and ``label``.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part. Rows
    that repeat an id count once (least label, then vector). A shorter vector counts as filled with zeros.
    Scores beyond 64 bits are given as the end of their range. Other columns are not read; an anchor
    without positives or negatives gives no row, nor does an empty table.

    All rows are dealt into blocks by a hash of the id, whatever their labels, and the anchors, a stated
    query set, meet each block: there sorted lists are walked until the threshold shows that no row left
    can enter, and only the few best of a block are shuffled and merged. Positives come first, since their
    scores make the windows of the negatives.
    """
    spark = rows.sparkSession
    vectors = materialise(prepared(rows, key, vector, label, scale, label_rule), "negatives-vectors")
    is_anchor = F.col("id") % every == 0
    n, n_anchors = vectors.agg(F.count("*"), F.count_if(is_anchor)).first()
    blocks, parts = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_anchors // BLOCK_ANCHORS))

    def dealt(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def meet(anchors: DataFrame, work, schema: str) -> DataFrame:
        left = vectors.withColumn("block", dealt(blocks, 1)).withColumn("part", everywhere(parts))
        right = anchors.withColumn("part", dealt(parts, 2)).withColumn("block", everywhere(blocks))
        return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(work, schema)

    def find_positives(found: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if found.num_rows and anchors.num_rows:
            matrix, asked = _vectors(found, anchors)
            lists, labels = SortedLists(matrix, found["id"].to_numpy()), found["label"].to_numpy()
            for own, anchor_label, a in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), asked):
                ids, scores = nearest_same(lists, labels, a, own, anchor_label, positives)
                out += zip([own] * len(ids), ids.tolist(), _long(scores.tolist()))
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], ["anchor_id", "positive_id", "positive_score"])

    anchors = vectors.filter(is_anchor)
    near = meet(anchors, find_positives, "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = near.withColumn("place", place).filter(F.col("place") <= positives)
    known = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = materialise(anchors.join(known, "id"), "negatives-anchors")

    def find_negatives(found: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if found.num_rows and anchors.num_rows:
            matrix, wanted = _vectors(found, anchors)
            lists, labels = SortedLists(matrix, found["id"].to_numpy()), found["label"].to_numpy()
            columns = anchors["id"].to_pylist(), anchors["label"].to_pylist(), anchors["positives"].to_pylist()
            for own, anchor_label, near, a in zip(*columns, wanted):
                windows = [window_of(p["positive_score"], low, high) for p in near]
                for p, (ids, scores) in zip(near, in_windows(lists, labels, a, anchor_label, windows, k)):
                    out += [(own, p["positive_id"], i, p["positive_score"], s) for i, s in zip(ids.tolist(), _long(scores.tolist()))]
        names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], names)

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    negatives = meet(asked, find_negatives, schema)
    rank = F.row_number().over(W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = negatives.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def moved_labels() -> Column:
    """The label rule of the registered query: the next of ten labels where the id is divisible by 7."""
    return F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


ORACLE = """
WITH kept AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding::DOUBLE[] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), whole AS (SELECT id, label, list_transform(v, lambda x: floor(256 * x)::BIGINT) AS v FROM kept),
scored AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, b.id AS other, b.label AS label,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole a JOIN whole b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
  SELECT anchor_id, anchor_label, other AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
