"""Linear SVM with squared hinge loss, fitted by a truncated Newton method.

The objective is ``|w|^2 / 2 + c * sum(weight * max(0, 1 - y * f)^2)`` with ``f`` the weighted sum of a row and
a constant 1, whose weight, the intercept, is regularised like the others. Spark computes every
objective, gradient and product with the Hessian, over all rows; the driver holds vectors of the length of the
model and, to speed up the inner conjugate gradients, the curvature of all rows as a square over the features, which
tasks add up and later steps correct by the rows whose state has changed, or else that of a bounded sample of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.classify import predict_linear
from corpusloom.session import materialise

# Inverse regularization and stopping tolerance of the published model.
SVM_C = 0.1
TOLERANCE = 1e-4

#: Rows whose curvature the driver holds as preconditioner, at most. They steer the search, not its outcome.
SAMPLE_ROWS = 4096

#: Features, constant included, up to which the driver holds the curvature of all rows as a square over the features
#: (512 MB, and half of that for its lower triangle), and tasks that add up one such triangle each, at most.
SQUARE_SIZE = 8192
SQUARE_TASKS = 32

#: Entries of rows that have become active or ceased to be, up to which they are sent to the driver; beyond, the tasks
#: add up their part of the square, once a step has taken more than this many products with the Hessian.
MOVED = 1 << 22
STALE = 4

#: Blocks that a task of a pass reads, where there are more tasks than cores: a task of one block costs more to start than to run.
BLOCKS = 16

#: Numbers that the driver adds up from the tasks of a pass; where there are more, they are added up by tasks first.
MERGED = 1 << 22

#: Entries of a vector that one task adds up.
CHUNK = 1 << 16

#: Step lengths whose objective is looked at in one pass.
STEPS = tuple(2.0**-k for k in range(12))


def _sums(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of values by place; without any they would be whole numbers."""
    return np.bincount(places, values, size).astype(np.float64)


@dataclass
class Block:
    """Rows of one Arrow batch in compressed sparse row form; ``y`` is 1 or -1, ``cost`` the weight of each."""

    y: np.ndarray
    cost: np.ndarray
    row: np.ndarray
    indices: np.ndarray
    values: np.ndarray

    def times(self, v: np.ndarray) -> np.ndarray:
        """Rows times ``v``, whose last entry belongs to the constant 1."""
        return _sums(self.row, self.values * v[self.indices], len(self.y)) + v[-1]

    def transposed(self, u: np.ndarray, size: int) -> np.ndarray:
        out = _sums(self.indices, self.values * u[self.row], size)
        out[-1] += u.sum()
        return out


def _blocks(batches: Iterator[pa.RecordBatch], costs: tuple[float, float]) -> Iterator[Block]:
    for batch in batches:
        for y, lengths, indices, values in zip(*(batch.column(i) for i in range(4))):
            y = np.frombuffer(y.as_buffer(), np.int8).astype(np.float64)
            lengths = np.frombuffer(lengths.as_buffer(), np.int32)
            row = np.repeat(np.arange(len(y)), lengths)
            cost = np.where(y > 0, costs[1], costs[0])
            yield Block(y, cost, row, np.frombuffer(indices.as_buffer(), np.int32), np.frombuffer(values.as_buffer(), np.float64))


class Triangle:
    """The lower triangle of a sum of outer products of rows, as stripes that end with the diagonal."""

    STRIPE, ROWS = 512, 1024

    def __init__(self, size: int):
        self.size = size
        self.stripes = [np.zeros((min(self.STRIPE, size - k), min(k + self.STRIPE, size))) for k in range(0, size, self.STRIPE)]
        self.dense, self.sign, self.filled = np.zeros((0, size), np.float32), np.zeros(self.ROWS, np.float32), 0

    def add(self, block: Block, weight: np.ndarray) -> None:
        """Rows times their weights, which may be below 0; the sum is complete after ``flush``."""
        if not len(self.dense):
            self.dense = np.zeros((self.ROWS, self.size), np.float32)
        lengths = np.bincount(block.row, minlength=len(block.y))
        starts, rows = np.cumsum(lengths) - lengths, np.flatnonzero(weight)
        while len(rows):
            now, rows = rows[: self.ROWS - self.filled], rows[self.ROWS - self.filled :]
            to, n = self.filled + np.arange(len(now)), lengths[now]
            at = np.repeat(starts[now] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            root = np.sqrt(np.abs(weight[now]))
            self.dense[np.repeat(to, n), block.indices[at]] = block.values[at] * np.repeat(root, n)
            self.dense[to, -1], self.sign[to] = root, np.sign(weight[now])
            self.filled += len(now)
            if self.filled == self.ROWS:
                self.flush()

    def flush(self) -> None:
        dense, sign = self.dense[: self.filled], self.sign[: self.filled, None]
        signed = dense if (sign > 0).all() else dense * sign
        for stripe in self.stripes if self.filled else ():
            rows, e = stripe.shape
            stripe += signed[:, e - rows : e].T @ dense[:, :e]
        dense.fill(0.0)
        self.filled = 0

    def pieces(self, length: int) -> Iterator[np.ndarray]:
        """Views of the stripes laid end to end, each ``length`` entries at most."""
        for stripe in self.stripes:
            flat = stripe.reshape(-1)
            for i in range(0, len(flat), length):
                yield flat[i : i + length]


def packed(rows: DataFrame, label: str, features: str) -> DataFrame:
    """Rows with a label as blocks of binary columns, stored once: a pass over them costs little but the sums."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, indices, values = batch.columns
            y = np.where(y.to_numpy(zero_copy_only=False) == 1, 1, -1).astype(np.int8)
            lengths = indices.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            arrays = (y, lengths, indices.flatten().to_numpy(zero_copy_only=False).astype(np.int32), values.flatten().to_numpy(zero_copy_only=False))
            columns = [pa.array([a.tobytes()], pa.binary()) for a in arrays] + [pa.array([len(y)]), pa.array([int((y > 0).sum())])]
            yield pa.RecordBatch.from_arrays(columns, ["y", "lengths", "indices", "entries", "n", "n_pos"])

    known = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("int"), f"{features}.indices", f"{features}.values")
    return materialise(known.mapInArrow(pack, "y binary, lengths binary, indices binary, entries binary, n long, n_pos long"), "svm-rows")


@dataclass
class Passes:
    """Sums over all rows, each one Spark job."""

    blocks: DataFrame
    size: int
    c: float
    costs: tuple[float, float]
    jobs: int = field(default=0)
    tasks: int = field(default=0)

    def __post_init__(self) -> None:
        self.tasks = self.blocks.rdd.getNumPartitions()

    def _sum(self, work: Callable[[Block, list[np.ndarray]], np.ndarray], vectors: list[np.ndarray], width: int) -> np.ndarray:
        """The sum over blocks of ``work(block, vectors)``, of length ``width``; tasks add up chunks of it."""
        sent, costs = self.blocks.sparkSession.sparkContext.broadcast(vectors), self.costs
        self.jobs += 1

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, found = np.zeros(width), False
            for block in _blocks(batches, costs):
                total += work(block, sent.value)
                found = True
            parts = [total[i : i + CHUNK].tobytes() for i in range(0, width if found else 0, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "part"])

        sums = self.blocks.select("y", "lengths", "indices", "entries").mapInArrow(partial, "chunk int, part binary")
        if self.tasks * width > MERGED:
            sums = sums.groupBy("chunk").applyInArrow(_added, "chunk int, part binary")
        parts = sums.collect()
        sent.destroy()
        total = np.zeros(width)
        for p in parts:
            total[p.chunk * CHUNK : (p.chunk + 1) * CHUNK] += np.frombuffer(p.part, np.float64)
        return total

    def search(self, w: np.ndarray, direction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Objectives at ``w + step * direction`` for all ``STEPS``, and the gradient at the first."""
        size, c = self.size, self.c

        def work(block: Block, sent: list[np.ndarray]) -> np.ndarray:
            at, along = block.times(sent[0]), block.times(sent[1])
            slack = [np.maximum(0.0, 1 - block.y * (at + step * along)) for step in STEPS]
            losses = [c * (block.cost * s * s).sum() for s in slack]
            return np.concatenate([block.transposed(-2 * c * block.cost * block.y * slack[0], size), losses])

        sums = self._sum(work, [w, direction], size + len(STEPS))
        norms = np.array([0.5 * ((w + step * direction) ** 2).sum() for step in STEPS])
        return norms + sums[size:], w + direction + sums[:size]

    def curvature(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The generalised Hessian at ``w`` times ``v``."""
        size, c = self.size, self.c

        def work(block: Block, sent: list[np.ndarray]) -> np.ndarray:
            active = block.y * block.times(sent[0]) < 1
            return block.transposed(np.where(active, 2 * c * block.cost * block.times(sent[1]), 0.0), size)

        return v + self._sum(work, [w, v], size)

    def moved(self, old: np.ndarray | None, w: np.ndarray) -> tuple[Block, np.ndarray] | None:
        """The rows that are active at one of ``old`` and ``w`` only, with weights below 0 for those of ``old``.

        None where they have more than ``MOVED`` entries, or those of one task more than twice its share. Nothing is
        active at an ``old`` of None.
        """
        sent, costs, c, share = self.blocks.sparkSession.sparkContext.broadcast([old, w]), self.costs, self.c, 2 * MOVED // max(self.tasks, 1)
        self.jobs += 1

        def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, entries = [], 0
            for block in _blocks(batches, costs):
                weight = _change(block, c, *sent.value)
                of = weight[block.row] != 0
                entries += int(of.sum())
                rows = weight != 0
                if entries <= share and rows.any():
                    lengths = np.bincount(block.row, minlength=len(weight))[rows].astype(np.int32)
                    found.append([a.tobytes() for a in (block.y[rows].astype(np.int8), lengths, block.indices[of], block.values[of], weight[rows])])
            columns = list(zip(*found)) if entries <= share and found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()) for a in columns] + [pa.array([0] * len(columns[0]), pa.int64())], names)
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary())] * 5 + [pa.array([entries], pa.int64())], names)

        names = ["y", "lengths", "indices", "entries", "weight", "n"]
        rows = self.blocks.select(*names[:4]).mapInArrow(changed, "y binary, lengths binary, indices binary, entries binary, weight binary, n long")
        rows = rows.toArrow()
        sent.destroy()
        n = rows["n"].to_numpy()
        if n.sum() > MOVED or (n > share).any():
            return None
        found = rows.filter(rows["y"].is_valid()).to_batches()
        blocks = list(_blocks(iter(found), costs))
        weights = [np.frombuffer(weight.as_buffer(), np.float64) for batch in found for weight in batch.column(4)]
        firsts = np.cumsum([0] + [len(b.y) for b in blocks])
        both = lambda arrays, kind: np.concatenate([np.zeros(0, kind), *arrays])
        row = both([b.row + first for b, first in zip(blocks, firsts)], np.int64)
        block = Block(both([b.y for b in blocks], float), both([b.cost for b in blocks], float), row, both([b.indices for b in blocks], np.int32), both([b.values for b in blocks], float))
        return block, both(weights, float)

    def add_square(self, triangle: Triangle, old: np.ndarray | None, w: np.ndarray) -> None:
        """Adds to ``triangle`` what the generalised Hessian gains from ``old`` to ``w``; tasks add up a triangle each."""
        spark, size, costs, c = self.blocks.sparkSession, self.size, self.costs, self.c
        sent = spark.sparkContext.broadcast([old, w])
        self.jobs += 1

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = Triangle(size)
            for block in _blocks(batches, costs):
                part.add(block, _change(block, c, *sent.value))
            part.flush()
            for i, piece in enumerate(part.pieces(CHUNK)):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["chunk", "part"])

        few = self.blocks.select("y", "lengths", "indices", "entries").coalesce(min(SQUARE_TASKS, spark.sparkContext.defaultParallelism))
        sums = few.mapInArrow(partial, "chunk int, part binary").groupBy("chunk").applyInArrow(_added, "chunk int, part binary")
        pieces = list(triangle.pieces(CHUNK))
        for p in sums.toLocalIterator():  # a partition at a time
            pieces[p.chunk] += np.frombuffer(p.part, np.float64)
        sent.destroy()


def _added(parts: pa.Table) -> pa.Table:
    """The sum of the parts of one chunk."""
    total = sum(np.frombuffer(p.as_buffer(), np.float64) for p in parts["part"])
    return pa.table({"chunk": parts["chunk"].slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})


def _change(block: Block, c: float, old: np.ndarray | None, w: np.ndarray) -> np.ndarray:
    """The weights that rows have in the Hessian at ``w``, less those at ``old``."""
    active = lambda at: (block.y * block.times(at) < 1).astype(float)
    return 2 * c * block.cost * (active(w) - (0.0 if old is None else active(old)))


def _inverse(low: np.ndarray) -> np.ndarray:
    """The inverse of a lower triangle, by halves: the threads of a larger LU may wait for ever in a process that has forked."""
    n, half = len(low), len(low) // 2
    if n <= 32:
        return np.linalg.inv(low)
    out = np.zeros((n, n))
    out[:half, :half], out[half:, half:] = _inverse(low[:half, :half]), _inverse(low[half:, half:])
    out[half:, :half] = -out[half:, half:] @ (low[half:, :half] @ out[:half, :half])
    return out


class Factored:
    """A positive definite matrix as the product of a triangle and its transpose, in blocks; overwrites its argument."""

    STEP = 256

    def __init__(self, a: np.ndarray):
        self.low, self.inverse = a, []
        for k in range(0, len(a), self.STEP):
            e = k + self.STEP
            a[k:e, k:e] = np.linalg.cholesky(a[k:e, k:e])
            self.inverse.append(_inverse(a[k:e, k:e]))
            a[e:, k:e] = a[e:, k:e] @ self.inverse[-1].T
            for r in range(e, len(a), 4 * self.STEP):  # only what lies below the diagonal is read again
                to = r + 4 * self.STEP
                a[r:to, e:to] -= a[r:to, k:e] @ a[e:to, k:e].T

    def solve(self, v: np.ndarray) -> np.ndarray:
        x = v.copy()
        for b, inverse in enumerate(self.inverse):
            k, e = b * self.STEP, (b + 1) * self.STEP
            x[k:e] = inverse @ (x[k:e] - self.low[k:e, :k] @ x[:k])
        for b, inverse in reversed(list(enumerate(self.inverse))):
            k, e = b * self.STEP, (b + 1) * self.STEP
            x[k:e] = inverse.T @ (x[k:e] - self.low[e:, k:e].T @ x[e:])
        return x


class SampleCurvature:
    """The inverse Hessian of a sample of rows, each of which stands for ``share`` of them."""

    def __init__(self, block: Block, size: int, c: float, share: float):
        self.block, self.size, self.weight = block, size, 2 * c * share * block.cost
        n = len(block.y)
        self.gram = np.ones((n, n))
        order = np.argsort(block.indices, kind="stable")
        indices, rows, values = block.indices[order], block.row[order], block.values[order]
        for start in range(0, size, 4096):
            a, b = np.searchsorted(indices, [start, start + 4096])
            dense = np.zeros((n, 4096))
            dense[rows[a:b], indices[a:b] - start] = values[a:b]
            self.gram += dense @ dense.T

    def at(self, w: np.ndarray, must: bool = True) -> Callable[[np.ndarray], np.ndarray]:
        """``v -> inverse Hessian at w times v``, by a factored matrix of the size of the active rows."""
        active = np.flatnonzero(self.block.y * self.block.times(w) < 1)
        inner = self.gram[np.ix_(active, active)]
        inner[np.diag_indices(len(active))] += 1 / self.weight[active]
        inner = Factored(inner)

        def apply(v: np.ndarray) -> np.ndarray:
            inside = np.zeros(len(self.block.y))
            inside[active] = inner.solve(self.block.times(v)[active])
            return v - self.block.transposed(inside, self.size)

        return apply


class SquareCurvature:
    """The inverse Hessian of all rows, from a square over the features that is kept up to date."""

    def __init__(self, passes: Passes):
        self.passes, self.triangle, self.old = passes, Triangle(passes.size), None
        self.square, self.solve = np.empty((passes.size, passes.size)), None

    def at(self, w: np.ndarray, must: bool = True) -> Callable[[np.ndarray], np.ndarray]:
        """``v -> inverse Hessian at w times v``; what an earlier call gave is void.

        With many rows whose state has changed since the last square, that one's inverse stays in use unless ``must``.
        """
        moved = self.passes.moved(self.old, w)
        if moved:
            self.triangle.add(*moved)
            self.triangle.flush()
        elif must or self.solve is None:
            self.passes.add_square(self.triangle, self.old, w)
        else:
            return self.solve
        self.old, shift = w, 0.0
        while True:
            for stripe in self.triangle.stripes:
                rows, e = stripe.shape
                self.square[e - rows : e, :e] = stripe
            self.square[np.diag_indices(len(w))] *= 1 + shift
            self.square[np.diag_indices(len(w))] += 1.0
            try:
                self.solve = Factored(self.square).solve
                return self.solve
            except np.linalg.LinAlgError:  # by the rounding of its products; what is near enough steers the search as well
                if shift > 1 or not np.isfinite(self.square.diagonal()).all():
                    raise
                shift = max(1e-7, 10 * shift)


@dataclass(frozen=True)
class LinearSVM:
    """Weights by feature index, the intercept, and what the fit ended with."""

    weights: list[float]
    intercept: float
    objective: float
    gradient_norm: float
    passes: int
    c: float

    def predict(self, docs: DataFrame, features: str, column: str = "prediction") -> DataFrame:
        """``margin``, and class 1 where it is positive; in the row, without join or shuffle."""
        return predict_linear(self.weights, self.intercept, docs, features, column)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(idx, weight)`` of every feature."""
        return spark.createDataFrame(list(enumerate(self.weights)), "idx int, weight double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.parquet(f"{path}/weights")
        rest = [(self.intercept, self.objective, self.gradient_norm, self.passes, self.c)]
        spark.createDataFrame(rest, "intercept double, objective double, gradient_norm double, passes int, c double").coalesce(1).write.parquet(f"{path}/fit")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearSVM":
        rows = sorted(spark.read.parquet(f"{path}/weights").collect(), key=lambda r: r["idx"])
        return LinearSVM([r["weight"] for r in rows], **spark.read.parquet(f"{path}/fit").first().asDict())


def _solve(
    passes: Passes, near: Callable[[np.ndarray], np.ndarray], w: np.ndarray, gradient: np.ndarray, tolerance: float
) -> tuple[np.ndarray, int]:
    """A step towards the zero of the gradient, and its products: conjugate gradients until the rest is at most ``tolerance``."""
    step, rest, products = np.zeros(len(w)), -gradient, 0
    z = near(rest)
    direction, inner = z, rest @ z
    for products in range(1, len(w) + 1):
        product = passes.curvature(w, direction)
        length = inner / (direction @ product)
        step, rest = step + length * direction, rest - length * product
        if np.sqrt(rest @ rest) <= tolerance:
            break
        z = near(rest)
        direction, inner = z + (rest @ z) / inner * direction, rest @ z
    return step, products


def fit_squared_hinge(
    train: DataFrame, label: str, features: str, size: int, c: float = SVM_C, class_weight: str | None = None,
    tolerance: float = TOLERANCE, max_steps: int = 100,
) -> LinearSVM:
    """The weights of the objective's only minimum, where the norm of its gradient is at most ``tolerance``.

    ``features`` is a sparse row of indices below ``size`` and values; label 1 is the positive class, any other
    the negative one, and rows without a label take no part. ``class_weight="balanced"`` gives both classes the
    same total weight. Without rows all weights are 0. Rows are packed into blocks once; a step takes a few passes
    over them, whatever their number, and ``max_steps`` bounds the steps.
    """
    spark = train.sparkSession
    blocks = packed(train, label, features)
    n, positive, stored = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_pos"), F.lit(0)), F.count("n")).first()
    blocks = blocks.coalesce(max(1, spark.sparkContext.defaultParallelism, -(-stored // BLOCKS)))
    costs = (1.0, 1.0)
    if class_weight == "balanced" and 0 < positive < n:
        costs = (n / (2 * (n - positive)), n / (2 * positive))
    passes = Passes(blocks, size + 1, c, costs)
    if n > SAMPLE_ROWS and size + 1 <= SQUARE_SIZE:
        near = SquareCurvature(passes)
    else:
        near = _sample(train, label, features, n, costs, size + 1, c)
    w, products = np.zeros(size + 1), 0
    objectives, gradient = passes.search(w, w)
    objective = objectives[0]
    for _ in range(max_steps):
        norm = float(np.sqrt(gradient @ gradient))
        if norm <= tolerance:
            break
        # The rest shrinks faster than the gradient, so the last steps are nearly exact.
        step, products = _solve(passes, near.at(w, products > STALE), w, gradient, max(min(0.1, norm) * norm, 0.1 * tolerance))
        slope = gradient @ step
        objectives, gradient = passes.search(w, step)
        # Close to the minimum the objective changes by less than its rounding error.
        falls = np.flatnonzero(objectives <= objective + 1e-4 * np.array(STEPS) * slope + 1e-12 * abs(objective))
        best = int(falls[0]) if len(falls) else 0
        w = w + STEPS[best] * step
        if best:
            _, gradient = passes.search(w, np.zeros(size + 1))
        objective = objectives[best]
    norm = float(np.sqrt(gradient @ gradient))
    return LinearSVM(w[:-1].tolist(), float(w[-1]), float(objective), norm, passes.jobs, c)


def _sample(train: DataFrame, label: str, features: str, n: int, costs: tuple[float, float], size: int, c: float) -> SampleCurvature:
    """Curvature of a bounded sample of rows, picked by a hash of their features."""
    share = min(1.0, 0.9 * SAMPLE_ROWS / max(n, 1)) if n > SAMPLE_ROWS else 1.0
    known = train.where(F.col(label).isNotNull())
    drawn = known.where(F.pmod(F.xxhash64(f"{features}.indices", f"{features}.values"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = drawn.select(F.col(label).cast("int").alias("y"), f"{features}.indices", f"{features}.values").limit(SAMPLE_ROWS).toArrow()
    y = np.where(rows["y"].to_numpy() == 1, 1.0, -1.0) if rows.num_rows else np.zeros(0)
    lists = [rows[name].combine_chunks() for name in ("indices", "values")]
    lengths = lists[0].value_lengths().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, int)
    flat = [a.flatten().to_numpy(zero_copy_only=False) for a in lists]
    block = Block(y, np.where(y > 0, costs[1], costs[0]), np.repeat(np.arange(len(y)), lengths), flat[0].astype(np.int64), flat[1])
    return SampleCurvature(block, size, c, n / max(len(y), 1))
