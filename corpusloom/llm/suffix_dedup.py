"""Removal of long repeated passages with a family of sampled suffix arrays of growing size.

A suffix array over every byte would be many times the corpus, so suffixes are sampled by content: an
anchor is the place of the smallest hash of 16 bytes among ``window`` places in a row. Equal passages of
``length`` bytes have an equal anchor in their first ``window`` places, with ``PREFIX`` equal bytes after
it. A level of the family holds one entry for each distinct anchor context, in the order of (a hash of)
the anchor's first bytes, so suffixes that begin alike lie side by side; a batch is matched by merging
its entries with those of the levels. Every shared beginning is then compared byte window by byte window,
on the bytes themselves, which makes the result exact (up to equal 64-bit hashes).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_text import add_columns, mix, slices, text_bytes
from corpusloom.session import fresh_path, materialise

LENGTH = 200
PREFIX = 64
SEED = 16
#: Contexts of one beginning that are compared in one task; beginnings with more go through a shuffle of windows.
GROUP = 20_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Lets Spark delete the shuffle files of a finished query at once; each query below runs once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _stored(df: DataFrame, name: str) -> DataFrame:
    with _tidy(df.sparkSession):
        return materialise(df, name)


class Hashes:
    """64-bit hashes of any stretch of a byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        values = mix(np.arange(256, dtype=np.uint64) + _U(1))  # a fixed random value for each byte
        power = np.full(len(data) + 1, _BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.inverse = np.full(len(data) + 1, _INVERSE, np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * power[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start])


def _sliding_argmin(value: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct places of the leftmost smallest value in each ``width`` values in a row."""
    n = len(value)
    if n < width:
        return np.zeros(0, np.int64)
    bits = _U(max(24, int(n - 1).bit_length()))  # the same for all but the longest texts
    low = (_U(1) << bits) - _U(1)
    least = (value & ~low) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n - width + 1], least[width - span :])
    return np.unique((least & low).astype(np.int64))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Anchors of texts of at least ``length`` bytes: ``doc``, ``at``, ``low``, ``high`` (context, in the text), ``key``, ``whole``.

    ``key`` is a hash of the ``PREFIX`` bytes from the anchor on; ``whole`` one of the context, which holds
    all windows of ``length`` bytes that begin at the anchor or at most ``window - 1`` bytes before it.
    """
    window = length - PREFIX + 1
    hashes = Hashes(data)
    seeds = np.arange(max(0, len(data) - SEED + 1))
    at = _sliding_argmin(hashes.of(seeds, seeds + SEED), window)
    doc = np.searchsorted(offsets, at, "right") - 1
    begin, end = offsets[doc], offsets[doc + 1]
    low, high = np.maximum(at - window + 1, begin), np.minimum(at + length, end)
    use = (at + PREFIX <= end) & (high - low >= length)
    at, doc, low, high, begin = at[use], doc[use], low[use], high[use], begin[use]
    shape = (at - low).astype(np.uint64) << _U(32) | (high - at).astype(np.uint64)
    whole = mix(hashes.of(low, high) + shape)
    return {"doc": doc, "at": at - begin, "low": low - begin, "high": high - begin, "key": hashes.of(at, at + PREFIX), "whole": whole}


_ENTRY = "key long, whole long, id {id}, text_hash long, at int, low int, high int"


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("__text"))


def _entries(rows: DataFrame, length: int) -> DataFrame:
    """The anchors of every row (``id``, ``text_hash``, ``__text``), one row each."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "__text"):
                found = anchors(*text_bytes(piece.column(2)), length)
                doc = pa.array(found["doc"])
                columns = [pa.array(found["key"].astype(np.int64)), pa.array(found["whole"].astype(np.int64)), piece.column(0).take(doc), piece.column(1).take(doc)]
                columns += [pa.array(found[c].astype(np.int32)) for c in ("at", "low", "high")]
                yield pa.RecordBatch.from_arrays(columns, ["key", "whole", "id", "text_hash", "at", "low", "high"])

    return rows.mapInArrow(run, _ENTRY.format(id=kind))


def _merged(entries: DataFrame) -> DataFrame:
    """One entry for each (``key``, ``whole``): its number of places ``n`` and the first of them."""
    return entries.groupBy("key", "whole").agg(F.sum("n").alias("n"), F.min("place").alias("place"))


class SuffixFamily:
    """Levels of sampled suffix arrays; level ``k`` has the entries of ``2**k`` batches.

    ``add`` sorts a batch into a level-0 table and, while two levels have the same size, merges them, as in
    the logarithmic method: after ``n`` batches there are at most ``log2(n) + 1`` levels, and every entry
    has been rewritten as often at most. Levels are Parquet tables bucketed and sorted by ``key`` in the
    shared folder, so that merging and matching read them in order, without a shuffle.
    """

    def __init__(self, spark: SparkSession, length: int = LENGTH):
        self.spark, self.length = spark, length
        self.levels: dict[int, DataFrame] = {}
        self.batches: list[DataFrame] = []

    def _level(self, entries: DataFrame, size: int) -> DataFrame:
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"suffix_level_{uuid.uuid4().hex}"
        rows = _merged(entries).repartition(n, "key").sortWithinPartitions("key", "whole")
        with _tidy(self.spark):
            rows.write.bucketBy(n, "key").sortBy("key", "whole").option("path", fresh_path(self.spark, f"suffix-level-{size}")).saveAsTable(name)
        return self.spark.table(name)

    def add(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> None:
        rows = _named(docs, key, text)
        self.batches.append(rows)
        one = _entries(rows, self.length).select(
            "key", "whole", F.lit(1).cast("long").alias("n"), F.struct("id", "text_hash", "at", "low", "high").alias("place"))
        level, size = self._level(one, 0), 0
        while size in self.levels:
            level, size = self._level(level.union(self.levels.pop(size)).select("key", "whole", "n", "place"), size + 1), size + 1
        self.levels[size] = level

    def matches(self) -> DataFrame:
        """Entries whose context, or whose beginning, has another place: (``key``, ``whole``, ``n``, ``place``, ``kinds``).

        ``n`` counts the places of the whole context, ``kinds`` the contexts that begin alike.
        """
        entries = _merged(reduce(DataFrame.union, self.levels.values())) if len(self.levels) > 1 else next(iter(self.levels.values()))
        kinds = entries.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("places")).filter(F.col("places") > 1)
        return entries.join(kinds, "key").filter((F.col("n") > 1) | (F.col("kinds") > 1)).select("key", "whole", "n", "place", "kinds")

    def repeated(self) -> DataFrame:
        """``id``, ``text_hash``, ``low``, ``high``: stretches of all batches covered by repeated strings of ``length`` bytes."""
        found = _stored(self.matches(), "suffix-matches")
        rows = reduce(DataFrame.union, self.batches)
        again = found.filter(F.col("n") > 1).select("key", "whole")
        covered = _entries(rows, self.length).join(again, ["key", "whole"]).select("id", "text_hash", "low", "high")
        covered = _stored(covered, "suffix-covered")
        asked = found.filter(F.col("kinds") > 1).select("key", "whole", "n", "kinds", "place.*")
        contexts = _stored(_contexts(asked, rows), "suffix-contexts")
        few = _compared(contexts.filter(F.col("kinds") <= GROUP), self.length)
        many = _compared_by_window(contexts.filter(F.col("kinds") > GROUP), self.length)
        return covered.union(_stored(few.union(many), "suffix-stretches"))


def _contexts(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of each asked context, cut out of the texts."""
    per_text = asked.groupBy("id", "text_hash").agg(F.collect_list(F.struct("key", "n", "kinds", "at", "low", "high")).alias("asked"))
    one_text = rows.join(per_text.withColumnsRenamed({"id": "id_", "text_hash": "hash_"}), F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "__text"):
                data, offsets = text_bytes(piece.column(2))
                lists = piece.column(3)
                flat = lists.flatten()
                of = np.repeat(np.arange(piece.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                low, high = (flat.field(c).to_numpy() for c in ("low", "high"))
                whole = data.tobytes()
                start = offsets[of]
                cut = [whole[a:b] for a, b in zip((start + low).tolist(), (start + high).tolist())]
                doc = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [flat.field("key"), flat.field("n"), flat.field("kinds"), piece.column(0).take(doc), piece.column(1).take(doc),
                     flat.field("at"), flat.field("low"), pa.array(cut, pa.binary())],
                    ["key", "n", "kinds", "id", "text_hash", "at", "low", "context"],
                )

    out = one_text.select("id", "text_hash", "__text", "asked").mapInArrow(
        run, f"key long, n long, kinds long, id {kind}, text_hash long, at int, low int, context binary")
    # Rows that repeat have the same id and text: one of them stands for all.
    return out.dropDuplicates(["id", "text_hash", "key", "at"])


def _windows(batch: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the text and hash of every window of ``length`` bytes; equal only at equal places before the anchor."""
    contexts = batch.column("context")
    data, offsets = text_bytes(contexts.combine_chunks() if isinstance(contexts, pa.ChunkedArray) else contexts)
    low, at = (batch.column(c).to_numpy() for c in ("low", "at"))
    n = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + step
    before = (at - low)[row] - step
    return row, low[row] + step, mix(Hashes(data).of(start, start + length) + before.astype(np.uint64))


def _stretches(batch, row: np.ndarray, place: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of windows in a row, as stretches of bytes."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    owner = pa.array(row[first])
    columns = [batch.column("id").take(owner), batch.column("text_hash").take(owner)]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays(
        columns + [pa.array(place[first].astype(np.int32)), pa.array((place[last] + length).astype(np.int32))], ["id", "text_hash", "low", "high"])


def _compared(contexts: DataFrame, length: int) -> DataFrame:
    """Stretches of contexts that another context with the same beginning shares; groups come whole to a task."""
    kind = contexts.schema["id"].dataType.simpleString()

    def whole_groups(batches) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left")) if keys[0] <= keys[-1] else 0
            if cut:
                yield pa.Table.from_batches(held + [batch.slice(0, cut)])
                held = []
            elif held and held[-1].column("key")[-1].as_py() != keys[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        for table in whole_groups(batches):
            row, place, value = _windows(table, length)
            key = table.column("key").to_numpy().astype(np.uint64)[row]
            _, where, times = np.unique(mix(value + mix(key)), return_inverse=True, return_counts=True)
            use = (times[where] > 1) & (table.column("n").to_numpy()[row] == 1)
            yield _stretches(table, row[use], place[use], length)

    ordered = contexts.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, f"id {kind}, text_hash long, low int, high int")


def _compared_by_window(contexts: DataFrame, length: int) -> DataFrame:
    """The same for beginnings with very many contexts: windows are counted by hash, summed in tasks first."""
    kind = contexts.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            row, place, value = _windows(batch, length)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(owner), pa.array(value.astype(np.int64)), batch.column("id").take(owner), batch.column("text_hash").take(owner), pa.array(place.astype(np.int32))],
                ["key", "value", "id", "text_hash", "low"])

    windows = contexts.mapInArrow(run, f"key long, value long, id {kind}, text_hash long, low int")
    again = windows.groupBy("key", "value").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    shared = windows.join(again, ["key", "value"])
    return shared.select("id", "text_hash", "low", (F.col("low") + length).alias("high"))


def _union_of(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint stretches with gaps between them, covering the same bytes."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return low[first], reach[np.append(first[1:], len(low)) - 1]


def removed(docs: DataFrame, stretches: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (from, to) of every row."""
    lists = stretches.groupBy("id", "text_hash").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    lists = lists.withColumnsRenamed({"id": "id_", "text_hash": "hash_"})
    rows = _named(docs, key, text)
    rows = rows.join(lists, F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")), "left")
    span = T.StructType([T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType())])
    fields = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    fields += [T.StructField("kept_sha256", T.StringType()), T.StructField("spans", T.ArrayType(span))]

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_bytes(piece.column(1))
        whole, found = data.tobytes(), piece.column(2)
        gone, spans, sha = [], [], []
        for i in range(piece.num_rows):
            body, part = whole[offsets[i] : offsets[i + 1]], found[i].values
            if part is None or not len(part):
                gone.append(0), spans.append([]), sha.append(hashlib.sha256(body).hexdigest())
                continue
            low, high = _union_of(part.field("low").to_numpy(), part.field("high").to_numpy())
            kept, at = hashlib.sha256(), 0
            for a, b in zip(low.tolist(), high.tolist()):
                kept.update(body[at:a])
                at = b
            kept.update(body[at:])
            gone.append(int((high - low).sum())), sha.append(kept.hexdigest())
            spans.append([{"low": a, "high": b} for a, b in zip(low.tolist(), high.tolist())])
        return [
            pa.array(np.diff(offsets)), pa.array(gone, pa.int64()), pa.array([len(x) for x in spans], pa.int64()), pa.array(sha, pa.string()),
            pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
        ]

    rows = rows.select(F.col("id").alias(key), "__text", F.col("found").alias("__found"))
    return add_columns(rows, "__text", fields, work, keep=[key])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, batches: int = 1) -> DataFrame:
    """Every row's bytes without those covered by a string of ``length`` bytes that starts anywhere else too.

    Columns: ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` of what
    is left, ``spans``. Matches never cross texts; overlapping places count; all strings are judged on
    the input. ``batches`` deals the rows by their hash into batches of the family. Null counts as empty;
    a text that a row repeats is removed as a whole if it is long enough; an empty table gives an empty
    table. Other columns are not read.
    """
    family = SuffixFamily(docs.sparkSession, length)
    for k in range(batches):
        family.add(docs.filter(F.pmod(F.xxhash64(key, text), F.lit(batches)) == k) if batches > 1 else docs, key, text)
    return removed(docs, family.repeated(), key, text)
