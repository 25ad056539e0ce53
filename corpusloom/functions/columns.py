"""Small column rules: ids, names, flags, hashes, arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Java's ``\s`` is ASCII only. This class holds the characters Python's ``str.isspace`` accepts.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"

FEATURE_PREFIX = "bow_"
MAX_NAME_LENGTH = 80


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression that is used several times inside array functions would be computed each
    time. As the only element of an array it becomes a lambda variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def label_of_folder(folder: Column) -> Column:
    return F.when(folder == "pos", 1).otherwise(0)


def prefix_of_label(label: Column) -> Column:
    return F.when(label == 1, "POS").otherwise("NEG")


def folder_of_label(label: Column) -> Column:
    """``pos`` for the text ``1``, anything else is ``neg``; surrounding space is ignored."""
    return F.when(F.trim(label.cast("string")) == "1", "pos").otherwise("neg")


def composite_id(prefix: Column, number: Column) -> Column:
    return F.concat(prefix, number.cast("string"))


def id_prefix(unique_id: Column) -> Column:
    return F.substring(F.trim(unique_id), 1, 3)


def id_number(unique_id: Column) -> Column:
    """The number of a composite id. A bad number raises, as any strict cast does."""
    return F.substr(F.trim(unique_id), F.lit(4)).cast("long")


def is_digits(text: Column) -> Column:
    return text.rlike(r"^\p{Nd}+$")


def yes_no(flag: Column) -> Column:
    """``TRUE`` or ``FALSE``."""
    return F.upper(flag.cast("string"))


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def md5_bytes(content: Column) -> Column:
    return F.md5(content)


def safe_name(term: Column, prefix: str = FEATURE_PREFIX, max_length: int = MAX_NAME_LENGTH) -> Column:
    """A term as a column name: lower case, spaces to ``_``, other signs dropped, cut to length."""
    name = F.lower(F.regexp_replace(term, rf"^{SPACE}+|{SPACE}+$", ""))
    name = F.regexp_replace(F.regexp_replace(name, SPACE + "+", "_"), "[^a-z0-9_]+", "")
    return F.substring(F.concat(F.lit(prefix), name), 1, max_length)


def without_prefix(name: Column, prefix: str = FEATURE_PREFIX) -> Column:
    """The name without its leading prefix, removed once."""
    return F.when(name.startswith(prefix), F.substr(name, F.lit(len(prefix) + 1))).otherwise(name)


def argmax(scores: Column) -> Column:
    """Position of the largest score, the first one if several are equal."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def timestamp_text() -> Column:
    """The current time to the second, ISO 8601."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def pad_batches(df: DataFrame, tokens: str, batch: str, pad: str = "<pad>") -> DataFrame:
    """Pad the token arrays of each batch to the longest one in it.

    ``batch`` names a column of fixed-size batch numbers, so a window group is never large.
    """
    longest = F.max(F.size(tokens)).over(W.partitionBy(batch))
    width = df.withColumn("_longest", longest)
    return width.withColumn(
        tokens, F.concat(tokens, F.array_repeat(F.lit(pad), F.col("_longest") - F.size(tokens)))
    ).drop("_longest")
