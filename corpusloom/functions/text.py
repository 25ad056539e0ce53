"""Text cleaning: tags, entities, Unicode form, whitespace, case."""

from __future__ import annotations

import html
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.columns import SPACE, let

#: Texts that are decoded at once.
DECODED_ROWS = 64

BREAK_TAG = rf"(?i)<br{SPACE}*/?>"
ANY_TAG = r"<[^>]+>"

# Text made only of these characters has no entity to decode and is already in NFKC form:
# Latin-1 without '&' and without the characters that have a compatibility form, plus the
# common dashes, quotes and the euro sign. It holds no combining marks, so nothing composes.
PLAIN_TEXT = (
    r"^[\x00-\x25\x27-\x9f¡-§©«-®°±¶·»"
    r"¿-ÿ–—‘-„€]*+$"
)


def decode_bytes(content: Column) -> Column:
    """Bytes as text: invalid UTF-8 becomes U+FFFD, and CRLF or CR becomes LF."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), r"\r\n?", "\n")


def strip_breaks(text: Column) -> Column:
    return F.regexp_replace(text, BREAK_TAG, " ")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, ANY_TAG, " ")


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


@F.arrow_udf(T.StringType())
def _unescape_nfkc(texts: pa.Array) -> pa.Array:
    """Few texts at a time are Python strings; the rest of the batch stays Arrow."""

    def decoded(part: pa.Array) -> pa.Array:
        return pa.array([t if t is None else unicodedata.normalize("NFKC", html.unescape(t)) for t in part.to_pylist()], pa.string())

    parts = [decoded(texts.slice(start, DECODED_ROWS)) for start in range(0, len(texts), DECODED_ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def decode_entities(text: Column) -> Column:
    """HTML entities decoded, then NFKC.

    Spark has neither as a built-in, so this is an Arrow UDF; rows that neither step could
    change are sent to it as null and keep their text, so plain text never leaves the JVM.
    """
    changed = _unescape_nfkc(let(text, lambda t: F.when(~t.rlike(PLAIN_TEXT), t)))
    return F.coalesce(changed, text)


def heavy_clean(text: Column, lowercase: bool = True) -> Column:
    """Cleaning for the bag-of-words models. A null text counts as empty."""
    text = strip_tags(strip_breaks(F.coalesce(text, F.lit(""))))
    text = collapse_space(decode_entities(text))
    return F.lower(text) if lowercase else text


def light_clean(text: Column) -> Column:
    """Cleaning for models that read running text: as ``heavy_clean``, keeping the case."""
    return heavy_clean(text, lowercase=False)


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(collapse_space(text) == "", F.lit(True))
