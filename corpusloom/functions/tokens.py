"""Tokens, lemmas, stop words and n-grams, all as array columns of one row per document."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.columns import let
from corpusloom.functions.wordlists import CLITICS, LEMMAS, NEGATIONS

FEATURE_TOKEN = r"[\p{L}\p{N}_]{2,}"

#: Rows whose tokens are looked up at once.
LOOKUP_ROWS = 64

_CLITIC = "|".join(CLITICS)
# Clitics are split off and marked with U+2019, after every other U+2019 became "'".
_NEGATED = r"(\p{L})n't"
_ATTACHED = rf"([\p{{L}}\p{{N}}])'({_CLITIC})([^\p{{L}}\p{{N}}_]|$)"
_WORD_OR_SYMBOL = rf"n't|'(?:{_CLITIC})|[\p{{L}}\p{{N}}_]+|\p{{S}}"

def feature_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(FEATURE_TOKEN), F.lit(0))


def tokens_of(df: DataFrame, column: str) -> Column:
    """Feature tokens of a column: made from text, or taken as they are from an array of tokens."""
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    return F.col(column) if is_array else feature_tokens(F.col(column))


def words_and_symbols(text: Column) -> Column:
    """Tokens of running text without spaces and punctuation; ``n't`` and ``'s`` stand alone."""
    text = F.translate(F.coalesce(text, F.lit("")), "’", "'")
    text = F.regexp_replace(text, _NEGATED, "$1 n’t")
    text = F.regexp_replace(text, _ATTACHED, "$1 ’$2$3")
    # The apostrophes that are left are quotes; the marked ones become apostrophes.
    text = F.translate(text, "'’", " '")
    return F.regexp_extract_all(text, F.lit(_WORD_OR_SYMBOL), F.lit(0))


def inline_lookup(entries: Mapping[str, str]):
    """``word column -> value column`` (null if absent) for a dictionary held by the caller.

    The dictionary becomes one constant array of small maps, picked by checksum, so that a
    lookup inside an array expression takes the same time however many entries there are.
    """
    n_slots = max(1, len(entries))
    slots: list[dict[str, str]] = [{} for _ in range(n_slots)]
    for word, value in entries.items():
        slots[crc32(word.encode()) % n_slots][word] = value
    table = F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")
    return lambda word: table[(F.crc32(word) % n_slots).cast("int")][word]


def lemmatize(tokens: Column, lemmas: Mapping[str, str] | None = None, lowered: bool = False) -> Column:
    """Lower-cased lemma of each token, in order; unknown forms stay, empty results go.

    ``lowered`` says that the tokens are in lower case already.
    """
    entries = LEMMAS if lemmas is None else lemmas
    lookup = inline_lookup(entries)

    def lemma(t: Column) -> Column:
        return F.when(t.isin(list(entries)), F.lower(lookup(t))).otherwise(t)

    low = tokens if lowered else F.transform(tokens, lambda t: F.lower(t))
    replaced = F.transform(low, lemma)
    return F.filter(replaced, lambda t: t != "") if "" in entries.values() else replaced


@F.arrow_udf(T.ArrayType(T.StringType()))
def _looked_up(tokens: pa.Array, own: pa.Array) -> pa.Array:
    """Each row's tokens replaced by the row's own entries, in time that grows with both, not with their product."""
    made = []
    for start in range(0, len(tokens), LOOKUP_ROWS):
        rows, entries = tokens.slice(start, LOOKUP_ROWS).to_pylist(), own.slice(start, LOOKUP_ROWS).to_pylist()
        tables = ({e["form"]: e["lemma"] for e in row or ()} for row in entries)
        made.append(pa.array([row and [table.get(t, t) for t in row] for row, table in zip(rows, tables)], pa.list_(pa.string())))
    return pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.string()))


def lemmatize_with_table(df: DataFrame, tokens: str, lemmas: DataFrame) -> DataFrame:
    """``lemmatize`` of the array column ``tokens`` with a dictionary table ``(form, lemma)`` of any size.

    Equal token arrays have equal lemmas, so arrays are joined by their digest and rows need no key.
    A form that the table has twice gets its smallest lemma. Null arrays stay null.
    """
    low = F.transform(tokens, lambda t: F.lower(t))
    keyed = df.withColumn("_digest", F.md5(F.to_json(F.col(tokens))))
    # The digest and the forms are made before the explode: beside it they would be made anew for each form.
    arrays = keyed.where(F.col(tokens).isNotNull()).select("_digest", F.array_distinct(low).alias("_forms"))
    forms = arrays.dropDuplicates(["_digest"]).select("_digest", F.explode("_forms").alias("form"))
    known = lemmas.groupBy("form").agg(F.lower(F.min("lemma")).alias("lemma"))
    own = forms.join(known, "form").groupBy("_digest").agg(F.collect_list(F.struct("form", "lemma")).alias("_own"))
    joined = keyed.join(own, "_digest", "left").withColumn("_low", low)
    looked_up = _looked_up(F.when(F.col("_own").isNotNull(), F.col("_low")), F.col("_own"))
    replaced = joined.withColumn("_lemmas", F.coalesce(looked_up, F.col("_low")))
    return replaced.withColumn(tokens, F.filter("_lemmas", lambda t: t != "")).select(*df.columns)


def effective_stop_words(words: Iterable[str], keep: Iterable[str] = NEGATIONS) -> list[str]:
    """The stop list without the words to keep."""
    return sorted(set(words) - set(keep))


def default_stop_words() -> list[str]:
    """Spark's English stop words. Needs a running session."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))


def drop_stop_words(tokens: Column, words: Iterable[str], keep: Iterable[str] = NEGATIONS) -> Column:
    """Tokens that are not stop words; negations always stay, repeats too."""
    stop = effective_stop_words(words, keep)
    return F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens


def drop_stop_words_joined(df: DataFrame, token: str, words: DataFrame, word: str = "word") -> DataFrame:
    """The same on one row per token, for stop lists kept as a table."""
    stop = words.where(~F.col(word).isin(*NEGATIONS)).select(F.col(word).alias(token)).distinct()
    return df.join(stop, token, "left_anti")


def preprocess_text(
    text: Column,
    *,
    lowercase: bool = True,
    use_lemmas: bool = True,
    use_stop_words: bool = True,
    lemmas: Mapping[str, str] | None = None,
    stop_words: Iterable[str] | None = None,
    lightly_cleaned: bool = False,
) -> Column:
    """Cleaned text as space-joined lemmas without punctuation and stop words.

    ``lightly_cleaned`` text went through ``light_clean``, which is as far as ``heavy_clean`` but for the case.
    """
    from corpusloom.functions.text import heavy_clean

    if lightly_cleaned:
        tokens = words_and_symbols(F.lower(text) if lowercase else text)
    else:
        tokens = words_and_symbols(heavy_clean(text, lowercase))
    if use_lemmas:
        tokens = lemmatize(tokens, lemmas, lowered=lowercase)
    if use_stop_words:
        tokens = drop_stop_words(tokens, default_stop_words() if stop_words is None else stop_words)
    return F.array_join(tokens, " ")


def _join_pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b))


def _starts(tokens: Column, n: int) -> Column:
    """Number of places where ``n`` tokens start."""
    return F.greatest(F.size(tokens) - (n - 1), F.lit(0))


def _longer(shorter: Column, tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens from the runs of ``n - 1`` and the token after each."""
    count = _starts(tokens, n)
    return _join_pairs(F.slice(shorter, F.lit(1), count), F.slice(tokens, F.lit(n), count))


def ngrams_of(tokens: Column, n: int) -> Column:
    """All runs of exactly ``n`` tokens joined by a space."""

    def build(t: Column) -> Column:
        grams = t
        for size in range(2, n + 1):
            grams = _longer(grams, t, size)
        return grams

    return tokens if n == 1 else let(tokens, build)


def ngrams(tokens: Column, low: int = 1, high: int = 3) -> Column:
    """All runs of ``low`` to ``high`` tokens, shorter runs first."""

    def extend(t: Column, runs: Column, n: int, done: tuple[Column, ...]) -> Column:
        done = (*done, runs) if n >= low else done
        if n == high:
            return F.concat(*done)
        return let(_longer(runs, t, n + 1), lambda longer: extend(t, longer, n + 1, done))

    return let(tokens, lambda t: extend(t, t, 1, ()))


def truncate_tokens(tokens: Column, max_length: int = 500) -> Column:
    """The first ``max_length`` tokens."""
    return F.slice(tokens, 1, max_length)
