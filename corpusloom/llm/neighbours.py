"""Approximate nearest neighbours by cosine, from a kd-tree over a few stable random projections.

For unit vectors at distance d, the squared distance of their projections on ``m`` Gaussian directions is
d**2 times a chi-square variable with m degrees of freedom. A search takes points in the order of their
projected distance and verifies them on the original vectors. Once the squared projected distance of all
points still to come is above x * d_k**2, where d_k is the distance of the k-th best so far and x the
``sure`` quantile of that distribution, each of them would be among the k nearest with a probability of
``1 - sure`` at most, and the search stops.

The upper levels of the tree cut the projections into cells of similar size, the unit of distribution;
each cell's own tree is built in the task that searches it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import materialise

#: Rows of the sample from which the cells are cut, at most.
SAMPLE = 100_000
#: Cells, at most; their boxes are sent to every task.
MAX_CELLS = 1 << 14
LEAF = 64


def chi_square_quantile(share: float, m: int) -> float:
    """The value that a chi-square variable with an even number ``m`` of degrees stays below with probability ``share``."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    low, high = 0.0, 1.0
    while below(high) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def split_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and threshold of every inner node of a balanced kd-tree, in heap order."""
    axis, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    parts = {0: points}
    for node in range(len(axis)):
        own = parts.pop(node)
        if len(own):
            axis[node] = np.argmax(own.max(0) - own.min(0))
            cut[node] = np.median(own[:, axis[node]])
        side = own[:, axis[node]] > cut[node]
        parts[2 * node + 1], parts[2 * node + 2] = own[~side], own[side]
    return axis, cut


def leaf_of(points: np.ndarray, axis: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    while len(axis) and node.size and node[0] < len(axis):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] > cut[node])
    return node - len(axis)


def box_distance(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point from each box."""
    gap = np.maximum(low - query, 0) + np.maximum(query - high, 0)
    return (gap * gap).sum(1)


class Tree:
    """A kd-tree over the projections of one cell; leaves are runs of rows with a box each."""

    def __init__(self, projected: np.ndarray):
        depth = max(0, math.ceil(math.log2(max(1, len(projected) / LEAF))))
        leaf = leaf_of(projected, *split_tree(projected, depth))
        self.order = np.argsort(leaf, kind="stable")
        self.starts = np.flatnonzero(np.diff(leaf[self.order], prepend=-1))
        self.ends = np.append(self.starts[1:], len(leaf))
        self.low = np.minimum.reduceat(projected[self.order], self.starts)
        self.high = np.maximum.reduceat(projected[self.order], self.starts)

    def nearest(self, vectors: np.ndarray, units: np.ndarray, query: np.ndarray, projected: np.ndarray, k: int, bound: float, x: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the ``k`` nearest found; ``bound`` is a known squared distance of the k-th."""
        away = box_distance(projected, self.low, self.high)
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        for leaf in np.argsort(away, kind="stable"):
            if away[leaf] > x * bound:
                break
            new = self.order[self.starts[leaf] : self.ends[leaf]]
            rows, scores = np.append(rows, new), np.append(scores, units[new] @ query)
            if len(rows) >= 4 * k or len(new) < LEAF:
                # Rows that tie with the k-th stay, whatever their number: their ids decide later.
                best = scores >= np.partition(scores, -min(k, len(scores)))[-min(k, len(scores))] - 1e-12
                rows, scores = rows[best], scores[best]
            if len(rows) >= k:
                bound = min(bound, max(0.0, 2 - 2 * np.partition(scores, -k)[-k]) + 1e-12)
        return rows, scores


@dataclass
class Projection:
    """Random directions, the tree that cuts cells, and the boxes of the cells."""

    directions: np.ndarray
    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return unit(vectors) @ self.directions


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``v`` (doubles) of the rows that take part: an id, and a vector of the commonest length, finite and not zero."""
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (length.n if length else 0))


def index(vectors: DataFrame, m: int = 8, cell_rows: int = 8192, copies: int = 6, seed: int = 11) -> tuple[DataFrame, Projection] | None:
    """Cells of distinct vectors: ``cell``, ``ids`` (the ``copies`` smallest), ``v``, ``p``; and the projection. None without vectors.

    ``vectors``: ``id``, ``v``. Only the cuts between cells come from a sample (of ``SAMPLE`` vectors at
    most, by hash); every vector is indexed. Copies of a vector are one point.
    """
    place = F.row_number().over(W.partitionBy("v").orderBy("id"))
    firsts = vectors.distinct().withColumn("place", place).filter(F.col("place") <= copies)
    points = materialise(firsts.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "ann-points")
    n = points.count()
    if not n:
        return None
    share = min(1.0, SAMPLE / n)
    drawn = points.select("v").filter(F.pmod(F.xxhash64("v", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = np.array([r.v for r in drawn.toLocalIterator()])
    directions = np.random.default_rng(seed).standard_normal((sample.shape[1] if len(sample) else len(points.first().v), m))
    depth = max(0, min(round(math.log2(max(1, n / cell_rows))), int(math.log2(MAX_CELLS))))
    tree = split_tree(unit(sample) @ directions, depth) if len(sample) else split_tree(np.zeros((0, m)), 0)
    found = Projection(directions, *tree)
    sent = points.sparkSession.sparkContext.broadcast(found)

    def run(batches):
        for batch in batches:
            p = sent.value.project(_matrix(batch.column("v")))
            cell = leaf_of(p, sent.value.axis, sent.value.cut)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("ids"), batch.column("v"), lists], ["cell", "ids", "v", "p"])

    cells = materialise(points.mapInArrow(run, "cell long, ids array<long>, v array<double>, p array<double>"), "ann-cells")
    at = [f(F.col("p")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(m)]
    boxes = {r.cell: r for r in cells.groupBy("cell").agg(*at).collect()}  # at most MAX_CELLS rows
    found.low, found.high = np.full((1 << depth, m), np.inf), np.full((1 << depth, m), np.inf)
    for cell, box in boxes.items():
        found.low[cell] = [box[f"low{i}"] for i in range(m)]
        found.high[cell] = [box[f"high{i}"] for i in range(m)]
    return cells, found


def _search(cells: DataFrame, visits: DataFrame, k: int, x: float, block: int = 2048) -> DataFrame:
    """``q``, ``ids``, ``score``, at most ``k`` a visit; ``visits``: ``cell``, ``q``, ``p``, ``bound``. Queries of a cell go in blocks."""
    blocks = visits.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int")
    asked = visits.join(blocks, "cell").select(F.col("cell").alias("place"), dealt.alias("part"), "q", F.col("p").alias("at"), "bound")
    points = cells.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def compare(points: pa.Table, asked: pa.Table) -> pa.Table:
        q_out, row_out, score_out = [], [], []
        if points.num_rows and asked.num_rows:
            vectors, queries = _matrix(points["v"]), _matrix(asked["q"])
            units, wanted, projected = unit(vectors), unit(queries), _matrix(asked["at"])
            tree, bounds = Tree(_matrix(points["p"])), asked["bound"].to_numpy()
            smallest = np.array([x[0] for x in points["ids"].to_pylist()])
            for i in range(len(queries)):
                rows, _ = tree.nearest(vectors, units, wanted[i], projected[i], k, bounds[i], x)
                score = cosine(vectors[rows], queries[i])
                best = np.lexsort((smallest[rows], -score))[:k]
                q_out += [i] * len(best)
                row_out += rows[best].tolist()
                score_out += score[best].tolist()
        return pa.table({"q": asked["q"].take(pa.array(q_out, pa.int64())), "ids": points["ids"].take(pa.array(row_out, pa.int64())), "score": pa.array(score_out, pa.float64())})

    grouped = points.groupBy("cell", "block").cogroup(asked.groupBy("place", "part"))
    return grouped.applyInArrow(compare, "q array<double>, ids array<long>, score double")


def cosine(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, on the vectors as they are."""
    return (vectors * query).sum(1) / (np.sqrt((vectors * vectors).sum(1)) * np.sqrt((query * query).sum()))


def nearest(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, m: int = 8,
    sure: float = 0.99, cell_rows: int = 8192,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each id divisible by ``every`` its ``k`` nearest other rows found.

    Nearest is the largest cosine, ties to the smaller id. Rows without an id and vectors that are null,
    zero, of another length than most, or hold a null or non-finite component take no part. Rows that
    repeat count once; rows with the query's id are not its neighbours; copies of a vector are all
    candidates. A query first searches its own cell; the distance of its k-th best there then rules
    out, by the chi-square test, the cells whose boxes are too far. An empty table gives an empty table.
    """
    vectors = materialise(usable(rows, key, vector), "ann-vectors")
    empty = "query_id long, rank int, vec_id long, score double"
    made = index(vectors, m, cell_rows, k + 1)
    if made is None:
        return rows.sparkSession.createDataFrame([], empty)
    cells, projection = made
    x = chi_square_quantile(sure, m)
    queries = vectors.filter(F.col("id") % every == 0).distinct()
    wanted = queries.select("v").distinct().join(cells.select("v", "cell", "p"), "v")
    home = wanted.select("cell", F.col("v").alias("q"), "p", F.lit(4.0).alias("bound"))
    first = materialise(_search(cells, home, k + 1, x), "ann-home")
    far = first.groupBy("q").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    bound = F.when(F.col("n") > k, F.greatest(F.lit(0.0), 2 - 2 * F.col("least")) + 1e-12).otherwise(F.lit(4.0))
    known = home.drop("bound").join(far, "q", "left").select("cell", "q", "p", F.coalesce(bound, F.lit(4.0)).alias("bound"))
    sent = rows.sparkSession.sparkContext.broadcast(projection)

    def others(batches):
        for batch in batches:
            p, home_cell, bounds = _matrix(batch.column("p")), batch.column("cell").to_numpy(), batch.column("bound").to_numpy()
            near = [np.flatnonzero(box_distance(v, sent.value.low, sent.value.high) <= x * b) for v, b in zip(p, bounds)]
            near = [c[c != h] for c, h in zip(near, home_cell)]
            at = pa.array(np.repeat(np.arange(len(near)), [len(c) for c in near]))
            cell = pa.array(np.concatenate(near) if near else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([cell] + [batch.column(c).take(at) for c in ("q", "p", "bound")], ["cell", "q", "p", "bound"])

    visits = known.mapInArrow(others, "cell long, q array<double>, p array<double>, bound double")
    found = first.union(_search(cells, visits, k + 1, x)).select("q", "score", F.explode("ids").alias("vec_id"))
    best = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("place", best).filter(F.col("place") <= k + 1)
    pairs = queries.join(found, queries.v == found.q).filter(F.col("id") != F.col("vec_id"))
    rank = F.row_number().over(W.partitionBy("id", "v").orderBy("place"))
    return (
        pairs.withColumn("rank", rank).filter(F.col("rank") <= k)
        .select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
    )
