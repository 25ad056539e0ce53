"""Checks over files and tables, as report rows ``(subset, check, ok, violations, sample)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions.columns import is_digits
from corpusloom.functions.text import is_blank

# What the published corpus is expected to hold.
SUBSETS = ("train_pos", "train_neg", "test_pos", "test_neg")
FILES_PER_SUBSET = 12_500
ID_RANGE = (0, 12_499)
SCORE_RANGE = (1, 10)
EXPECTED_ROWS = 25_000
EXPECTED_PER_CLASS = 12_500

REPORT_COLUMNS = ["subset", "check", "ok", "violations", "sample"]


class QualityError(AssertionError):
    """A check failed."""


def require(report: DataFrame) -> DataFrame:
    """Raise when a report row is not ok. A report has a few rows per subset."""
    failed = report.where(~F.col("ok")).orderBy("subset", "check").collect()
    if failed:
        raise QualityError("; ".join(
            f"[{r['subset']}] {r['check']}: {r['violations']} (e.g. {r['sample']})" for r in failed
        ))
    return report


def _rows(aggregated: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One report row per check from one row of counts per subset."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("check"), F.coalesce(count, F.lit(0)).cast("long").alias("violations"),
                 sample.cast("string").alias("sample"))
        for name, (count, sample) in checks.items()
    ])
    return aggregated.select("subset", F.explode(entries).alias("e")).select(
        "subset", "e.check", (F.col("e.violations") == 0).alias("ok"), "e.violations", "e.sample"
    )


def parse_path(path: Column) -> dict[str, Column]:
    """The parts of ``…/{split}/{folder}/{id}_{score}.txt``; unparsable numbers are null."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1")
    parts = F.split(stem, "_")
    two = F.size(parts) == 2
    id_text, score_text = F.when(two, parts[0]), F.when(two, F.try_element_at(parts, F.lit(2)))
    return {
        "split": F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1),
        "folder": F.regexp_extract(path, r"([^/]+)/[^/]+$", 1),
        "name": name,
        "n_parts": F.size(parts),
        "id_text": id_text,
        "score_text": score_text,
        "number": F.when(is_digits(id_text), id_text.try_cast("long")),
        "score": F.when(is_digits(score_text), score_text.try_cast("int")),
    }


def _file_flags(files: DataFrame, id_range: tuple[int, int], score_range: tuple[int, int]) -> DataFrame:
    parsed = files.select(*[c.alias(n) for n, c in parse_path(F.col("path")).items()])
    c = F.col
    flags = {
        "not_txt": ~F.lower("name").rlike(r".\.txt$"),
        "name_parts": c("n_parts") != 2,
        "id_not_digits": ~is_digits(c("id_text")),
        "score_not_digits": ~is_digits(c("score_text")),
        # Digits that no number type holds are out of any range.
        "id_out_of_range": is_digits(c("id_text")) & ~F.coalesce(c("number").between(*id_range), F.lit(False)),
        "score_out_of_range": is_digits(c("score_text")) & ~F.coalesce(c("score").between(*score_range), F.lit(False)),
    }
    parsed = parsed.withColumn("subset", F.concat_ws("_", "split", "folder"))
    return parsed.withColumns({f: F.coalesce(flag, F.lit(False)) for f, flag in flags.items()})


FILE_FLAGS = ("not_txt", "name_parts", "id_not_digits", "score_not_digits", "id_out_of_range", "score_out_of_range")


def file_report(
    files: DataFrame,
    expected_count: int = FILES_PER_SUBSET,
    id_range: tuple[int, int] = ID_RANGE,
    score_range: tuple[int, int] = SCORE_RANGE,
    subsets: tuple[str, ...] = SUBSETS,
) -> DataFrame:
    """All structure checks on a listing with a ``path`` column, in one scan.

    Rows are first combined per subset and id, which finds repeated ids (compared as
    numbers), and then per subset.
    """
    flagged = _file_flags(files, id_range, score_range)
    per_id = flagged.groupBy("subset", "number").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f)).alias(f) for f in FILE_FLAGS],
        *[F.min(F.when(F.col(f), F.col("name"))).alias(f"{f}_name") for f in FILE_FLAGS],
        F.min("name").alias("any_name"),
    )
    repeated = F.col("number").isNotNull() & (F.col("n") > 1)
    per_subset = per_id.groupBy("subset").agg(
        F.sum("n").alias("n"),
        *[F.sum(f).alias(f) for f in FILE_FLAGS],
        *[F.min(f"{f}_name").alias(f"{f}_name") for f in FILE_FLAGS],
        F.sum(F.when(repeated, F.col("n") - 1).otherwise(0)).alias("repeated"),
        F.min(F.when(repeated, F.col("any_name"))).alias("repeated_name"),
    )
    expected = files.sparkSession.createDataFrame([(s,) for s in subsets], "subset string")
    known = expected.join(per_subset, "subset", "left")
    c = F.col
    none = F.lit(None)
    checks = {"folder_missing": (c("n").isNull().cast("int"), none)}
    checks |= {f: (c(f), c(f"{f}_name")) for f in FILE_FLAGS}
    checks["file_count"] = (F.abs(F.coalesce(c("n"), F.lit(0)) - expected_count), F.coalesce(c("n"), F.lit(0)))
    checks["duplicate_id"] = (c("repeated"), c("repeated_name"))
    return _rows(known, checks)


def first_offenders(files: DataFrame, flag: str = "not_txt", limit: int = 5) -> DataFrame:
    """The first few names per subset that break one rule."""
    flagged = _file_flags(files, ID_RANGE, SCORE_RANGE).where(F.col(flag))
    rank = F.row_number().over(W.partitionBy("subset").orderBy("name"))
    return flagged.select("subset", "name", rank.alias("rank")).where(F.col("rank") <= limit)


def _table_totals(df: DataFrame, columns: dict[str, str], score_range: tuple[int, int]) -> DataFrame:
    """One row of counts for the whole table: one scan, one shuffle by id.

    A null id is an ordinary value, as it would be in a text file; the per-id counts are
    combined in the map tasks, so one id holding many rows does no harm.
    """
    c = {role: F.col(name) for role, name in columns.items()}
    label = c["label"].cast("string")
    score = c["score"].cast("string").try_cast("int")
    flags = {
        "empty_text": is_blank(c["text"]),
        "label_not_0_1": ~F.coalesce(label.isin("0", "1"), F.lit(False)),
        "score_not_int": score.isNull(),
        "score_out_of_range": F.coalesce(~score.between(*score_range), F.lit(False)),
        "pos": F.coalesce(label == "1", F.lit(False)),
        "neg": F.coalesce(label == "0", F.lit(False)),
    }
    rows = df.select(c["id"].cast("string").alias("id"), *[flag.alias(f) for f, flag in flags.items()])
    per_id = rows.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f)).alias(f) for f in flags]
    )
    again = F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("n_ids"),
        *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags],
        *[F.min(F.when(F.col(f) > 0, F.col("id"))).alias(f"{f}_id") for f in flags],
        F.coalesce(F.sum(again), F.lit(0)).alias("repeated"),
        F.min(F.when(F.col("n") > 1, F.col("id"))).alias("repeated_id"),
    )


DEFAULT_COLUMNS = {"id": "Unique_ID", "label": "POS", "score": "Score", "text": "Review"}


def table_report(
    df: DataFrame,
    subset: str,
    columns: dict[str, str] | None = None,
    expected_rows: int = EXPECTED_ROWS,
    expected_pos: int = EXPECTED_PER_CLASS,
    expected_neg: int = EXPECTED_PER_CLASS,
    score_range: tuple[int, int] = SCORE_RANGE,
) -> DataFrame:
    """All checks on a table of labelled texts, in one scan."""
    totals = _table_totals(df, columns or DEFAULT_COLUMNS, score_range).withColumn("subset", F.lit(subset))
    c = F.col
    checks = {"duplicate_id": (c("repeated"), c("repeated_id"))}
    checks |= {
        f: (c(f), c(f"{f}_id")) for f in ("empty_text", "label_not_0_1", "score_not_int", "score_out_of_range")
    }
    checks["row_count"] = (F.abs(c("n") - expected_rows), c("n"))
    checks["pos_count"] = (F.abs(c("pos") - expected_pos), c("pos"))
    checks["neg_count"] = (F.abs(c("neg") - expected_neg), c("neg"))
    return _rows(totals, checks)


def table_summary(
    df: DataFrame, columns: dict[str, str] | None = None, score_range: tuple[int, int] = SCORE_RANGE
) -> DataFrame:
    """The measured values of a table in one row."""
    totals = _table_totals(df, columns or DEFAULT_COLUMNS, score_range)
    return totals.select(
        F.col("n").alias("row_count"), F.col("pos").alias("pos_count"), F.col("neg").alias("neg_count"),
        (F.col("empty_text") == 0).alias("all_have_text"), F.col("n_ids").alias("unique_ids"),
        F.concat(F.lit(f"[{score_range[0]}-{score_range[1]}]")).alias("score_range"),
    )


def split_report(df: DataFrame, column: str = "validation_set", fraction: float = 0.20, label: str | None = None) -> DataFrame:
    """The split column holds 0/1 only, both sides have rows, and the size is the expected one.

    With ``label`` the expected size is the sum of the per-class sizes, else ``int(fraction * n)``.
    """
    value = F.lower(F.col(column).cast("string"))
    is_val, is_train = value.isin("1", "true"), value.isin("0", "false")
    share = F.floor(F.col("n") * F.lit(float(fraction)))
    counts = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(value.isNull()).alias("nulls"),
        F.count_if(~is_val & ~is_train).alias("invalid"),
        F.count_if(is_val).alias("n_val"),
        F.count_if(is_train).alias("n_train"),
    ]
    per = df.groupBy(*([label] if label else [])).agg(*counts).withColumn("expected", share)
    sums = ["n", "nulls", "invalid", "n_val", "n_train", "expected"]
    total = per.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sums]).withColumn("subset", F.lit("train"))
    c = F.col
    return _rows(total, {
        "split_null": (c("nulls"), F.lit(None)),
        "split_invalid": (c("invalid"), F.lit(None)),
        "no_train_rows": ((c("n_train") == 0).cast("int"), c("n_train")),
        "no_validation_rows": ((c("n_val") == 0).cast("int"), c("n_val")),
        "validation_count": (F.abs(c("n_val") - c("expected")), c("n_val")),
    })


def count_empty(df: DataFrame, column: str) -> DataFrame:
    """Number of empty texts in a column."""
    return df.agg(F.count_if(F.length(column) == 0).alias("empty_count"), F.count(F.lit(1)).alias("row_count"))


def require_columns(columns: list[str], needed: list[str]) -> None:
    missing = [c for c in needed if c not in columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
