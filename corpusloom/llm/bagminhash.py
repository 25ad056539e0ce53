"""Near-duplicate documents by BagMinHash signatures of their 5-word shingles, counted with repeats.

Each shingle has a Poisson process over (weight, time) that is the same wherever the shingle occurs.
Its weight axis is cut into blocks 1, 2, 3-4, 5-8, ...; a block of length L has points at rate L, and
each point has a random weight inside the block and a random place in the signature. A document that
holds the shingle w times sees the points of weight up to w. A place of the signature is the earliest
point seen there, so two documents agree in a place with the probability of their weighted Jaccard
similarity. Points are drawn in order of time and only until every place has one, so a document costs
one draw for each of its shingles and block, and a number of further draws that depends on the length
of the signature alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_text import Words, add_columns, coded, hash_bytes, mix, text_bytes, words_of
from corpusloom.session import materialise

SHINGLE = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 5
PLACES = BANDS * ROWS

_U = np.uint64


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 5-word shingles (one shingle for a shorter text) and their documents, in order."""
    value = hash_bytes(words.distinct)[words.code]
    n_of = words.per_doc()
    first = np.cumsum(n_of) - n_of
    starts = np.maximum(n_of - SHINGLE + 1, np.minimum(n_of, 1))
    doc = np.repeat(np.arange(words.n_docs), starts)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts) + first[doc]
    out = np.full(len(doc), _U(SHINGLE))
    last = (first + n_of)[doc]
    for k in range(SHINGLE):
        inside = at + k < last
        out[inside] = mix(out[inside] * _U(31) + value[np.minimum(at + k, len(value) - 1)][inside] + _U(k))
    return out, doc


def multisets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, shingle hash and count, sorted by document and hash."""
    value, doc = shingles(words)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(value)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1], from 53 bits."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(doc: np.ndarray, value: np.ndarray, count: np.ndarray, n_docs: int, places: int = PLACES) -> np.ndarray:
    """Signature of every document: in each place a 64-bit name of its earliest point; 0 without shingles."""
    best_t = np.full(n_docs * places, np.inf)
    best = np.zeros(n_docs * places, np.uint64)
    weight = np.bincount(doc, count, minlength=n_docs)
    blocks = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(doc)), blocks)
    block = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    length = np.where(block < 2, 1.0, 2.0 ** np.maximum(block - 1, 0))
    start = np.where(block == 0, 0.0, length)
    start = np.where(block == 1, 1.0, start)
    state = mix(value[owner] + block.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    clock = np.zeros(len(owner))
    todo = np.arange(len(owner))
    # Time by which all places have a point with a probability of about 0.99; longer where they don't.
    horizon = np.where(weight > 0, places * (np.log(places) + 4.6) / np.maximum(weight, 1), 0.0)
    while True:
        active = todo
        while len(active):
            gap = mix(state[active] + _U(1))
            nxt = clock[active] - np.log(_uniform(gap)) / length[active]
            late = nxt > horizon[doc[owner[active]]]
            active, gap, nxt = active[~late], gap[~late], nxt[~late]
            if not len(active):
                break
            clock[active] = nxt
            state[active] = gap
            draw = mix(gap + _U(2))
            seen = start[active] + _uniform(draw) * length[active] <= count[owner[active]]
            point, t = active[seen], nxt[seen]
            cell = doc[owner[point]] * places + (mix(gap[seen] + _U(3)) % _U(places)).astype(np.int64)
            order = np.lexsort((state[point], t, cell))
            cell, t, name = cell[order], t[order], state[point][order]
            lead = np.ones(len(cell), bool)
            lead[1:] = cell[1:] != cell[:-1]
            cell, t, name = cell[lead], t[lead], name[lead]
            earlier = t < best_t[cell]
            best_t[cell[earlier]], best[cell[earlier]] = t[earlier], name[earlier]
        open_ = np.isinf(best_t.reshape(n_docs, places)).any(1) & (weight > 0)
        if not open_.any():
            return best.reshape(n_docs, places)
        horizon = np.where(open_, horizon * 2, -1.0)
        todo = np.flatnonzero(open_[doc[owner]])


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    part = signature.reshape(len(signature), BANDS, ROWS)
    key = np.zeros(part.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * _U(31) + part[:, :, k])
    return key


def similarity(a: Words, b: Words) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of each pair of texts; 0 if neither has one."""
    sides = [multisets(a), multisets(b)]
    doc, value, count = (np.concatenate(x) for x in zip(*sides))
    order = np.lexsort((value, doc))
    doc, value, count = doc[order], value[order], count[order]
    both = np.flatnonzero((doc[1:] == doc[:-1]) & (value[1:] == value[:-1]))
    shared = np.bincount(doc[both], np.minimum(count[both], count[both + 1]), minlength=a.n_docs)
    total = np.bincount(doc, count, minlength=a.n_docs)
    return shared / np.maximum(total - shared, 1)


def text_name(key: Column, body: Column) -> Column:
    """MD5 of the text; of a text without words a longer name, which no text has, that belongs to its key."""
    alone = F.concat(F.unhex(F.md5(F.coalesce(key.cast("string"), F.lit("")))), F.unhex(F.lit("00")))
    return F.when(body.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(body))).otherwise(alone)


#: Bytes of text that are worked on at once.
SLICE_BYTES = 2 << 20


def entries(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``id``, ``copy`` (equal for equal texts, unique without words), ``n`` shingles, ``bands``."""
    fields = [T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        words = words_of(*text_bytes(piece.column(2)))
        doc, value, count = multisets(words)
        n = np.bincount(doc, count, minlength=words.n_docs).astype(np.int64)
        signature = signatures(doc, value, count, words.n_docs)
        keys = band_keys(signature).astype(np.int64)
        some = n > 0
        offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].ravel()))
        return [pa.array(n), bands]

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), text_name(F.col(key), body).alias("copy"), body.alias("__text"))
    return add_columns(rows, "__text", fields, work, keep=["id", "copy"], most=SLICE_BYTES)


def star_pairs(members: DataFrame) -> DataFrame:
    """``a``, ``b``: each text of a bucket with the bucket's hub, the one that shares most buckets with others.

    ``members``: ``band``, ``node``, ``n``, ``size`` of the bucket. As many pairs as members at most.
    """
    shared = members.groupBy("node", "n").agg(F.sum("size").alias("shared"))
    hubs = members.join(shared, ["node", "n"]).groupBy("band").agg(F.max_by(F.struct("node", "n"), F.struct("shared", "node")).alias("hub"))
    return _likely(members.join(hubs, "band").select("node", "n", "hub"))


def _likely(rows: DataFrame) -> DataFrame:
    """Distinct pairs whose numbers of shingles allow the similarity."""
    near = F.least("n", "hub.n") >= SIMILAR * F.greatest("n", "hub.n")
    pairs = rows.filter((F.col("node") != F.col("hub.node")) & near)
    return pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose multisets of shingles are similar; ``texts``: ``node``, ``text``, one row per node."""

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(similarity(*(words_of(*text_bytes(piece.column(k))) for k in (2, 3))))]

    rows = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    rows = rows.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").select("a", "b", "a_text", "b_text")
    scored = add_columns(rows, "a_text", [T.StructField("similar", T.DoubleType())], work, keep=["a", "b"], most=SLICE_BYTES)
    return scored.filter(F.col("similar") >= SIMILAR).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node) for every node of an edge ``a``, ``b``.

    Alternates large-star and small-star steps; every step is written, so no lineage grows and a lost
    executor costs no more than a step. The number of steps grows with the logarithm of a component.
    """
    edges = materialise(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")

    def mark(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.filter(F.col("a") != F.col("b")).distinct(), "edges")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = materialise(small.filter(F.col("a") != F.col("b")).distinct(), "edges")
        if (now := mark(edges)) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


#: Rows of a bucket that are compared with as many others in one task.
BLOCK = 512


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``node`` and its ``shingles``: the 64-bit hash of each shingle and repeat number, end to end."""

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        words = words_of(*text_bytes(piece.column(1)))
        doc, value, count = multisets(words)
        row = np.repeat(np.arange(len(doc)), count)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        name = mix(value[row] + turn.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc[row], minlength=words.n_docs))]) * 8
        raw = name.tobytes()
        return [pa.array([raw[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())]

    return add_columns(texts, "text", [T.StructField("shingles", T.BinaryType())], work, keep=["node"], most=SLICE_BYTES)


def _numbers(column: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(column).cast("long") - 1)


def _links(outside: list[np.ndarray], members: list[np.ndarray], outside_root: np.ndarray, member_root: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (outside, member) that are similar by the test of ``verified``, enough of them to join what they join."""
    owner = np.repeat(np.arange(len(members)), [len(x) for x in members])
    name = np.concatenate(members) if members else np.zeros(0, np.uint64)
    order = np.argsort(name, kind="stable")
    name, owner = name[order], owner[order]
    size = np.array([len(x) for x in members])
    parent = np.arange(max(member_root.max(initial=0), outside_root.max(initial=0)) + 1)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for i, own in enumerate(outside):
        low, high = np.searchsorted(name, own, "left"), np.searchsorted(name, own, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(owner[at], minlength=len(members))
        for j in np.flatnonzero(shared / np.maximum(size + len(own) - shared, 1) >= SIMILAR).tolist():
            a, b = root(outside_root[i]), root(member_root[j])
            if a != b:
                parent[a] = b
                found.append((i, j))
    return found


def left_over_pairs(members: DataFrame, labels: DataFrame, shingles: DataFrame) -> DataFrame:
    """Similar pairs of a bucket that are not in one component yet.

    Outside the bucket's largest component, every member is compared with all members, in blocks of rows.
    The task counts shared shingles exactly and reports only pairs that join components, so there are
    fewer of them in a block than components.
    """
    rows = members.join(labels, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    groups = rows.groupBy("band", "root").agg(F.count("*").alias("rows"))
    of_band = groups.groupBy("band").agg(
        F.sum("rows").alias("size"), F.count("*").alias("groups"), F.max_by("root", F.struct("rows", "root")).alias("largest"),
        (F.sum("rows") - F.max("rows")).alias("outside"),
    ).filter(F.col("groups") > 1)
    rows = rows.join(of_band, "band").join(shingles, "node")
    rows = rows.withColumn("left_blocks", F.ceil(F.col("outside") / BLOCK)).withColumn("right_blocks", F.ceil(F.col("size") / BLOCK))
    spot = F.xxhash64("node", F.lit(7))
    put = ["band", "node", "root", "shingles"]
    left = rows.filter(F.col("root") != F.col("largest")).select(
        *put, F.lit(True).alias("outside"), F.pmod(spot, F.col("left_blocks")).alias("l"), F.explode(_numbers("right_blocks")).alias("r"))
    right = rows.select(
        *put, F.lit(False).alias("outside"), F.explode(_numbers("left_blocks")).alias("l"), F.pmod(spot, F.col("right_blocks")).alias("r"))

    def compare(table: pa.Table) -> pa.Table:
        outside = table["outside"].to_numpy().astype(bool)
        one, many = np.flatnonzero(outside), np.flatnonzero(~outside)
        names = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        root, _ = coded(table["root"].combine_chunks())
        found = _links([names[i] for i in one], [names[i] for i in many], root[one], root[many])
        node = table["node"]
        return pa.table({"a": node.take(pa.array([one[i] for i, _ in found], pa.int64())), "b": node.take(pa.array([many[j] for _, j in found], pa.int64()))})

    pairs = left.union(right).groupBy("band", "l", "r").applyInArrow(compare, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``copy``, ``root``, ``class_id`` (smallest key of its class), ``class_size`` of every row.

    A class is a connected set of texts of which linked ones have a weighted Jaccard similarity of at
    least 0.8 over their 5-word shingles; a shorter text is one shingle. Equal texts are one node, so a
    group of copies of any size is one row from there on. Texts in one bucket of a band are linked to
    the bucket's hub first; members that this leaves in different components are then compared with all
    members of the bucket, and what joins components is verified.
    Texts that are null, empty or without words are alone in their class. Rows that repeat share one.
    ``copy`` names the text, ``root`` the class. An empty table gives an empty table; other columns are not read.
    """
    rows = materialise(entries(docs, key, text), "near-entries")
    nodes = materialise(rows.filter(F.col("n") > 0).groupBy("copy").agg(F.first("n").alias("n"), F.first("bands").alias("bands")), "near-nodes")
    buckets = nodes.select(F.col("copy").alias("node"), "n", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    members = materialise(buckets.join(sizes, "band"), "near-members")
    wanted = members.select(F.col("node").alias("copy")).distinct()
    body = F.col(text)
    texts = docs.select(F.unhex(F.md5(body)).alias("copy"), body.alias("text")).join(wanted, "copy", "left_semi")
    texts = materialise(texts.groupBy("copy").agg(F.first("text").alias("text")).select(F.col("copy").alias("node"), "text"), "near-texts")
    labels = components(verified(star_pairs(members), texts))
    shingles = materialise(shingle_sets(texts), "near-shingles")
    pairs = materialise(left_over_pairs(members, labels, shingles), "near-pairs")
    labels = components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).union(verified(pairs, texts)))
    placed = rows.select("id", "copy").join(labels.select(F.col("node").alias("copy"), "root"), "copy", "left")
    placed = placed.withColumn("root", F.coalesce("root", "copy"))
    firsts = placed.groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(firsts, "root").select(F.col("id").alias(key), "copy", "root", "class_id", "class_size")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``class_id``, ``class_size`` and ``kept`` (the row of the class's smallest key) of every row; see ``classes``."""
    found = classes(docs, key, text)
    return found.select(key, "class_id", "class_size", F.col(key).eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each class: that of the smallest key, of equal keys that of the smallest text hash."""
    found = classes(docs, key, text)
    chosen = found.filter(F.col(key).eqNullSafe(F.col("class_id"))).groupBy("root", "class_id").agg(F.min("copy").alias("copy"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("id"), text_name(F.col(key), body).alias("copy"))
    right = chosen.select(F.col("class_id").alias("id_"), F.col("copy").alias("copy_"))
    rows = rows.join(right, (F.col("copy") == F.col("copy_")) & F.col("id").eqNullSafe(F.col("id_")))
    place = F.row_number().over(W.partitionBy("copy_", "id_").orderBy("copy_"))
    return rows.withColumn("place", place).filter(F.col("place") == 1).select("row.*")
