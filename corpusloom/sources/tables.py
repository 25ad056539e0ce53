"""CSV, Parquet and JSON tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The header of a table of labelled texts, and its optional last column.
FOUR_NAMES = ("POS", "Unique_ID", "Score", "Review")
SPLIT_NAME = "validation_set"

RAW_SCHEMA = T.StructType([
    T.StructField("POS", T.IntegerType()),
    T.StructField("Unique_ID", T.StringType()),
    T.StructField("Score", T.IntegerType()),
    T.StructField("Review", T.StringType()),
])

BAD_ROW = "_bad_row"

# Quotes inside a field are doubled, and line breaks may occur inside quotes. A CSV file is
# therefore read by one task; tables of many part files, as written here, read in parallel.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"}


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "errorifexists") -> None:
    """CSV with a header; fields are quoted where needed, or all of them. Space is kept."""
    options = {
        "header": "true", "escape": '"', "quoteAll": str(quote_all).lower(),
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    df.write.mode(mode).options(**options).csv(path)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def require_header(spark: SparkSession, path: str) -> list[str]:
    """The header, if the path is an existing CSV with an allowed header."""
    if not path.rstrip("/").lower().endswith(".csv"):
        raise AssertionError(f"{path} does not end in .csv")
    header = csv_header(spark, path)
    if not header:
        raise AssertionError(f"{path}: no header")
    if tuple(header[:4]) != FOUR_NAMES or header[4:] not in ([], [SPLIT_NAME]):
        raise AssertionError(f"{path}: header {header}, expected {FOUR_NAMES} and {SPLIT_NAME} or nothing after them")
    return header


def read_csv_strict(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, plus ``_bad_row``: the raw row if its number of fields is wrong."""
    header = require_header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, BAD_ROW]])
    rows = (
        spark.read.options(**CSV_OPTIONS).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW).schema(schema).csv(path)
    )
    # Spark refuses to read the raw row alone, so it is tied to the first column, which stays in the scan.
    first_read = F.hash(header[0]).bitwiseAND(F.lit(0)) == 0
    return rows.withColumn(BAD_ROW, F.when(first_read, F.col(BAD_ROW)))


def count_bad_rows(strict: DataFrame) -> int:
    """Rows with too few or too many fields."""
    return strict.where(F.col(BAD_ROW).isNotNull()).count()


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; an empty field reads as an empty string."""
    columns = csv_header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path).fillna("")


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed columns from the given schema, nothing inferred; text nulls become empty."""
    df = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").schema(schema).csv(path)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("", subset=texts) if texts else df


def append_run(row: DataFrame, path: str, run: str) -> None:
    """Put the result rows of a run into a results table; the same run again replaces its rows.

    A run has a folder of its own, so other runs are neither read nor rewritten, and it counts from when Spark
    puts its marker there, at the end. ``run`` is a name of letters, digits, ``.``, ``-`` and ``_``.
    """
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"{run!r} cannot name a run")
    write_csv(row, f"{path}/run={run}", mode="overwrite")


def read_runs(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of all finished runs, with the column ``run`` first; runs are as many as their folders."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/_SUCCESS")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    folders = sorted(f.getPath().getParent().toString() for f in found)
    typed = spark.createDataFrame([], schema).schema
    names = ["run", *typed.names]
    if not folders:
        return spark.createDataFrame([], T.StructType([T.StructField("run", T.StringType()), *typed.fields]))
    options = {**CSV_OPTIONS, "mode": "FAILFAST", "basePath": path}
    wide = T.StructType([*typed.fields, T.StructField("run", T.StringType())])
    return spark.read.options(**options).schema(wide).csv(folders).select(*names)


def write_json(row: DataFrame, path: str) -> None:
    """One JSON document per row, for run metadata of a few rows."""
    row.coalesce(1).write.json(path)


def rewrite(df: DataFrame, path: str) -> DataFrame:
    """Store a changed table at a new path and read it back.

    Spark must not overwrite the files it is reading, so an input path is refused.
    """
    target = path.rstrip("/") + "/"
    if any(f.split(":", 1)[-1].lstrip("/").startswith(target.split(":", 1)[-1].lstrip("/")) for f in df.inputFiles()):
        raise ValueError(f"{path} is an input of this table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
