"""Weighted fair queueing of documents: every source gets its share of the words, in one global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
REPEATS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS) -> DataFrame:
    """Per source: ``rank`` by name (null last), ``source_size`` and ``target`` words.

    Targets share ``share`` of all words by weight; none is above ``repeats`` times its source. With
    sources sorted by that limit per weight, those before the water line stop at their limit and the
    others divide the rest, which is where resharing the excess again and again ends. One row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    everything = W.partitionBy()
    rows = (
        per_source.withColumn("rank", F.row_number().over(named))
        .withColumn("weight", pick)
        .withColumn("most", repeats * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("weights", F.sum("weight").over(everything))
    )
    before = W.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    line = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    rows = rows.withColumn("line", line).withColumn("free", F.col("line") * F.col("weight") <= F.col("most"))
    first = F.first(F.when(F.col("free"), F.col("line")), ignorenulls=True).over(
        W.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    rows = rows.withColumn("level", first)
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double")))
    return rows.select("source", "rank", "source_size", target.alias("target"))


def _queued(rows: DataFrame, sized: DataFrame, targets: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``before``: words of the source's shuffled queue ahead of the row.

    The queue of a source is cut into 4,096 buckets by the shuffle key; words of earlier buckets come
    from a table of sums, so a source of any share of the rows is ranked by many tasks.
    """
    keyed = sized.join(targets.select("source", "rank"), sized.source.eqNullSafe(targets.source)).drop(targets.source)
    ahead = W.partitionBy("rank").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = keyed.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("earlier"))
    placed = rows.join(targets, rows.source.eqNullSafe(targets.source)).drop(targets.source)
    within = W.partitionBy("rank", "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = placed.withColumn("through", F.sum("size").over(within))
    return placed.join(sums, ["rank", "bucket"]).withColumn("before", F.col("earlier") + F.col("through") - F.col("size"))


def served(epoch: Column) -> Column:
    """Words of the row's copy of ``epoch`` that the source's target still has room for."""
    room = F.floor(F.col("target")) - epoch * F.col("source_size") - F.col("before")
    return F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long")


def virtual_finish(epoch: Column) -> Column:
    """When the row's copy of ``epoch`` is through: words of its source up to then, by the target weight."""
    words = epoch * F.col("source_size") + F.col("before") + F.col("size")
    return F.when(F.col("target") > 0, words / F.col("target"))


def _prepared(docs: DataFrame, key: str, source: str, text: str, seed: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    shuffled = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), F.col(source).alias("source"),
                       F.col(key).alias("id"), n_words(F.col(text)).alias("size"), shuffled.alias("turn"))
    rows = rows.withColumn("bucket", F.conv(F.substring("turn", 1, 3), 16, 10).cast("int"))
    return rows, materialise(rows.select("source", "id", "size", "turn", "bucket"), "mix-sizes")


def mix_counts(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS, seed: str = "mix:",
) -> DataFrame:
    """``key``, ``size``, ``source_size``, ``target`` and ``taken`` words of every row, in the order of the mix.

    A document's virtual finish time is the words of its source up to and with it, divided by the
    source's target. Sorted by that time over all sources, the mix ends when the budget is used up;
    there each source is inside one document, of which only the words served by then are taken. So a
    source takes its target, rounded down, whatever the lengths of its documents. Up to ``repeats``
    rounds of a source's queue are served. Null texts have size 0, null sources are a source of their
    own (the last), equal keys and repeated rows are queued one after the other, an empty table gives an
    empty table. The shuffle is a hash of ``seed`` and the key, so reruns agree.
    """
    _, sized = _prepared(docs, key, source, text, seed, [key])
    targets = materialise(source_targets(sized, weights, share, repeats), "mix-targets")
    placed = _queued(sized, sized, targets, ["turn", "id", "size"])
    taken = sum((served(F.lit(e)) for e in range(1, repeats)), served(F.lit(0)))
    finish = virtual_finish(F.lit(0))
    return (
        placed.select(F.col("id").alias(key), "size", "source_size", "target", taken.alias("taken"), finish.alias("finish"), "turn")
        .orderBy(F.col("finish").asc_nulls_last(), "turn", key, "size")
        .drop("finish", "turn")
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word; ``n`` of at least 1 and below the number of words."""
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    parts = F.split(text, r"[\x20\x09-\x0D]+", (n + lead + 1).cast("int"))
    kept = F.length(text) - F.length(F.element_at(parts, -1))
    return F.regexp_replace(F.substring(text, F.lit(1), kept), r"[\x20\x09-\x0D]+$", "")


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS, seed: str = "mix:",
) -> DataFrame:
    """The mix itself: a row of ``docs`` for every copy taken, sorted by virtual finish time.

    Columns are those of ``docs``. The document in which a source's budget ends is cut after its last
    served word (and ``n_chars``, where there is such a column, counts what is left). Documents without
    words take part in no copy and are left out. Otherwise as ``mix_counts``.
    """
    columns = docs.columns
    rows, sized = _prepared(docs, key, source, text, seed, columns)
    targets = materialise(source_targets(sized, weights, share, repeats), "mix-targets")
    placed = _queued(rows, sized, targets, ["turn", "id", "size"])
    epoch = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("epoch")
    copies = placed.select("row", "id", "size", "source_size", "target", "before", "turn", epoch)
    copies = copies.select("row", "id", "size", "turn", served(F.col("epoch")).alias("words"), virtual_finish(F.col("epoch")).alias("finish"))
    copies = copies.filter(F.col("words") > 0).orderBy("finish", "turn", "id", "size")
    whole = F.col("words") >= F.col("size")
    body = F.when(whole, F.col(f"row.`{text}`")).otherwise(first_words(F.col(f"row.`{text}`"), F.col("words")))
    out = []
    for c in columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = body
        elif c == "n_chars":
            value = F.when(whole, value).otherwise(F.length(body).cast(docs.schema[c].dataType))
        out.append(value.alias(c))
    return copies.select(*out)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS turn,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM per
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM ranked
), lined AS (
  SELECT *, (total - coalesce(sum(most) OVER before, 0)) / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0)) AS line,
         most / weight AS ratio
  FROM weighed WINDOW before AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT line FROM lined WHERE line * weight <= most ORDER BY ratio, rank LIMIT 1
), targets AS (
  SELECT source, source_size,
         least(CAST(most AS DOUBLE), coalesce((SELECT line FROM level) * weight, CAST(most AS DOUBLE))) AS target
  FROM lined
), queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.doc_id, s.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(
         greatest(0, least(size, CAST(floor(target) AS BIGINT) - before))
       + greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - before))
       + greatest(0, least(size, CAST(floor(target) AS BIGINT) - 2 * source_size - before)) AS BIGINT) AS taken
FROM queued
"""
