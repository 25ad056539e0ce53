"""Quality rules: rule counts of a text, and the perplexity of its bytes under a Kneser-Ney model.

The model is a modified Kneser-Ney model over the bytes of words joined by single spaces, so its n-grams
reach over the edges of words. Spark counts the n-grams of all texts and works out discounts, back-off
weights and probabilities by grouping and joining; the model is a table with a row per n-gram of the
corpus and grows with it. An n-gram's code is its bytes in one number, so equal codes are equal n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_text import Words, add_columns, coded, runs, slices, sums_between, text_bytes, white_bytes, words_of
from corpusloom.session import materialise

#: Bytes in an n-gram.
ORDER = 5
#: Symbols that count as noise.
SYMBOLS = b"#*$%&|<>"
#: A model of up to so many n-grams (16 bytes each) is sent to tasks as sorted arrays; a larger one is joined with the texts' n-grams.
SENT_ROWS = 4_000_000
#: Places of a text that are looked at together, and n-grams a task holds before it passes their counts on.
PART, HELD = 2 << 20, 2 << 20
#: Bytes of text worked on at once; a stream has up to one byte more per text, so most slices are one part.
_SLICE = 3 << 19


def stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with one space after each, end to end, and the number of bytes of each text."""
    keep = ~white_bytes(data)
    last = keep.copy()
    last[:-1] &= ~keep[1:]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    last[ends] = keep[ends]
    times = keep.astype(np.int8) + last
    out = np.repeat(data, times)
    out[np.cumsum(times, dtype=np.int64)[last] - 1] = 0x20
    return out, sums_between(times, offsets)


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the n-grams of all texts, one for each byte of ``stream`` with those before it, and each one's text.

    Zeros stand before a text. Long texts come in parts of ``PART`` places.
    """
    body, length = stream(data, offsets)
    lead = ORDER - 1
    line = np.zeros(len(body) + lead * (len(length) + 1), np.uint8)
    ends = np.cumsum(length)

    def docs_of(start: int, stop: int) -> np.ndarray:
        first, last = np.searchsorted(ends, [start, stop - 1], "right")
        inside = slice(first, last + 1)
        return np.repeat(np.arange(first, last + 1), np.minimum(ends[inside], stop) - np.maximum(ends[inside] - length[inside], start))

    spans = [(start, min(start + PART, len(body))) for start in range(0, len(body), PART)]
    for start, stop in spans:
        line[np.arange(start, stop) + (docs_of(start, stop) + 1) * lead] = body[start:stop]
    for start, stop in spans:
        doc = docs_of(start, stop)
        at = np.arange(start, stop) + (doc + 1) * lead
        low, high = at[0], at[-1] + 1
        code = np.zeros(high - low, np.int64)
        for back in range(lead, -1, -1):
            code = code << 8 | line[low - back : high - back]
        yield code[at - low], doc


def text_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, code and count of the distinct n-grams of each text."""
    found = []
    for code, doc in grams(data, offsets):
        # A part has fewer texts than 2**23 and a code has 40 bits, so both fit one number, which sorts fast.
        docs = doc[np.append(True, doc[1:] != doc[:-1])]
        both, n = np.unique((np.searchsorted(docs, doc) << 8 * ORDER) + code, return_counts=True)
        found.append((docs[both >> 8 * ORDER], both & ((1 << 8 * ORDER) - 1), n))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    doc, code, n = map(np.concatenate, zip(*found))
    if len(found) > 1:  # a text may go on in the next part
        order = np.lexsort((code, doc))
        code, doc, n = code[order], doc[order], n[order]
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])))
        doc, code, n = doc[first], code[first], np.add.reduceat(n, first)
    return doc, code, n


def looked_up(code: np.ndarray, codes: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """``log_p`` of every code, by sorting codes and places as one number, so that the table is read in order."""
    bits = int(PART).bit_length()
    both = np.sort((code << bits) + np.arange(len(code)))
    code, place = both >> bits, both & ((1 << bits) - 1)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    values = log_p[np.searchsorted(codes, code[first])]
    out = np.empty(len(code))
    out[place] = np.repeat(values, np.diff(np.append(first, len(code))))
    return out


def ngram_counts(docs: DataFrame, text: str) -> DataFrame:
    """``code``, ``n``: how many rows' texts have each n-gram; summed in tasks first.

    A text counts once, so that no text vouches for what it repeats itself.
    """

    def summed(codes: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        code, where = np.unique(np.concatenate(codes), return_inverse=True)
        n = np.bincount(where, np.concatenate(times), minlength=len(code)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    def run(batches):
        codes, times = [], []
        for batch in batches:
            for piece in slices(batch, text, _SLICE):
                _, code, _ = text_grams(*text_bytes(piece.column(0)))
                code, n = np.unique(code, return_counts=True)
                codes.append(code), times.append(n)
                if sum(map(len, codes)) >= HELD:
                    yield summed(codes, times)
                    codes, times = [], []
        if codes:
            yield summed(codes, times)

    return docs.select(text).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(have: list[int]) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more, from the numbers of n-grams with counts 1 to 4."""
    if min(have) == 0:
        return [0.5, 0.75, 0.9]
    y = have[0] / (have[0] + 2 * have[1])
    return [min(max(k - (k + 1) * y * have[k] / have[k - 1], 0.1), k - 0.05) for k in (1, 2, 3)]


def _ending(code: Column, order: int) -> Column:
    return code.bitwiseAND(F.lit((1 << 8 * order) - 1))


def fit_kneser_ney(counts: DataFrame) -> DataFrame:
    """``code``, ``log_p``: natural log probability of the last byte of every n-gram after those before it.

    ``counts`` has ``code`` and ``n``. Lower orders count in how many ways an n-gram is continued to the
    left. From order 2 on, n-grams with a count of 1 are discounted as a whole, as in a model pruned of
    them, and have the probability of the order below. Contexts have at most 256 continuations, so
    no key of these joins is hot.
    """
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        ways = levels[order + 1].groupBy(_ending(F.col("code"), order).alias("code")).agg(F.count("*").alias("n"))
        levels[order] = materialise(ways, f"ngrams-{order}")
    below = None
    for order in range(1, ORDER + 1):
        level = levels[order]
        have = level.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in range(1, 5)]).first()  # four numbers
        cut = discounts(list(have))
        if order > 1:
            cut[0] = 1.0
        cut_of = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        level = level.withColumn("context", F.shiftright("code", 8))
        kinds = [F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1)), F.count(F.when(F.col("n") > 2, 1))]
        taken = sum((c * k for c, k in zip(cut[1:], kinds[1:])), cut[0] * kinds[0])
        contexts = level.groupBy("context").agg(F.sum("n").alias("total"), taken.alias("taken"))
        rows = level.join(contexts.hint("merge"), "context")  # a broadcast would grow with the corpus
        if below is None:
            rows = rows.withColumn("lower", F.lit(1 / 256))
        else:
            lower = below.select(F.col("code").alias("ending"), F.exp("log_p").alias("lower"))
            rows = rows.join(lower.hint("merge"), _ending(F.col("code"), order - 1) == F.col("ending"))
        p = (F.col("n") - cut_of) / F.col("total") + F.col("taken") / F.col("total") * F.col("lower")
        below = materialise(rows.select("code", F.log(p).alias("log_p")), f"probabilities-{order}")
    return below


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document."""
    lines, doc = runs(data, offsets, data != 0x0A)
    code, distinct = coded(lines)
    body, ends = text_bytes(distinct)
    wordy = sums_between(~np.isin(body, (0x20, 0x09, 0x0B, 0x0C, 0x0D)), ends) > 0 if len(distinct) else np.zeros(0, bool)
    use = wordy[code]
    pair, n = np.unique(doc[use] * max(1, len(distinct)) + code[use], return_counts=True)
    return np.bincount(pair // max(1, len(distinct)), n - 1, minlength=words.n_docs).astype(np.int64)


def repeated_words(words: Words) -> np.ndarray:
    """Words that lie in a 3-word window which their document holds at least twice."""
    n = len(words.code)
    out = np.zeros(words.n_docs, np.int64)
    if n < 3:
        return out
    start = np.flatnonzero(words.doc[2:] == words.doc[:-2])
    base = len(words.distinct)
    _, two = np.unique(words.code[:-1] * base + words.code[1:], return_inverse=True)
    _, three = np.unique(two[start] * base + words.code[start + 2], return_inverse=True)
    _, where, times = np.unique(words.doc[start] * n + three, return_inverse=True, return_counts=True)
    again = start[times[where] > 1]
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[again + k] = True
    return np.bincount(words.doc[covered], minlength=words.n_docs)


def base_counts(docs: DataFrame, key: str, text: str, lang: str, model: DataFrame | None = None) -> DataFrame:
    """``key``, ``lang``, ``text_hash`` and the counts of ``quality_rules``; with a ``model`` small enough to be sent, ``log_perplexity`` too."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [T.StructField(c, T.LongType()) for c in names]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("log_perplexity", T.DoubleType())]
    sent = None
    if model is not None:
        table = model.orderBy("code").toArrow()  # SENT_ROWS rows at most
        sent = docs.sparkSession.sparkContext.broadcast((table["code"].to_numpy(), table["log_p"].to_numpy()))
        del table

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_bytes(piece.column(3))
        words = words_of(data, offsets)
        n = words.per_doc()
        chars = sums_between(~white_bytes(data) & (data & 0xC0 != 0x80), offsets)
        symbols = sums_between(np.isin(data, list(SYMBOLS)), offsets)
        repeats = repeated_words(words)
        failed = (n < 50) | (100 * repeats > 50 * n)
        total, places = np.zeros(len(n)), np.zeros(len(n))
        if sent is not None:
            codes, log_p = sent.value
            for code, doc in grams(data, offsets):
                total += np.bincount(doc, looked_up(code, codes, log_p), minlength=len(n))
                places += np.bincount(doc, minlength=len(n))
        value = -total / np.maximum(places, 1)
        return [
            pa.array(n.astype(np.int64)), pa.array(chars), pa.array(symbols), pa.array(duplicate_lines(data, offsets, words)),
            pa.array(repeats.astype(np.int64)), pa.array(failed), pa.array(value, mask=places == 0),
        ]

    rows = docs.select(F.col(key).alias(key), F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("__text"))
    return add_columns(rows, "__text", fields, work, keep=[key, "lang", "text_hash"], most=_SLICE)


def joined_perplexity(docs: DataFrame, text: str, model: DataFrame) -> DataFrame:
    """``name``, ``log_perplexity`` of the distinct texts, by joining their n-grams with a model of any size.

    Every text has an n-gram once, so no n-gram has a large share of the rows. Rows of equal texts add
    to both sums alike and don't change their quotient.
    """

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text, _SLICE):
                doc, code, n = text_grams(*text_bytes(piece.column(1)))
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(doc)), pa.array(code), pa.array(n)], ["name", "code", "n"])

    asked = docs.select(F.xxhash64(F.col(text)).alias("name"), text).mapInArrow(run, "name long, code long, n long")
    value = -F.sum(F.col("n") * F.col("log_p")) / F.sum("n")
    return asked.join(model.hint("merge"), "code").groupBy("name").agg(value.alias("log_perplexity"))


def quality_counts(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``key``, ``lang`` and the counts of ``quality_rules``, with ``log_perplexity`` (null without words) by the model of all texts."""
    model = fit_kneser_ney(materialise(ngram_counts(docs, text), "ngram-counts"))
    if model.count() <= SENT_ROWS:
        return base_counts(docs, key, text, lang, model)
    by_text = materialise(joined_perplexity(docs, text, model), "perplexities")
    counts = base_counts(docs, key, text, lang).drop("log_perplexity")
    return counts.join(by_text, counts.text_hash == by_text.name, "left").drop("name")


def perplexity_bands(counts: DataFrame, width: float = 6.0, least: float = 0.15) -> DataFrame:
    """``lang``, ``low``, ``high``: the band of log perplexity of each language, from all rows.

    Quartiles come from counts of log perplexity in steps of 0.001, which need one row per step. The
    band reaches ``width`` times the distance between a quartile and the median beyond the median, and
    ``least`` at least, on each side. Rows that fail the rules have no say; without a language, rows
    form a group of their own.
    """
    steps = (
        counts.filter(~F.col("base_failed") & F.col("log_perplexity").isNotNull())
        .groupBy("lang", F.floor(F.col("log_perplexity") * 1000).alias("step")).count()
    )
    so_far = W.partitionBy("lang").orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
    share = steps.withColumn("share", F.sum("count").over(so_far) / F.sum("count").over(W.partitionBy("lang")))
    at = [F.min(F.when(F.col("share") >= q, F.col("step"))).alias(f"q{k}") for k, q in enumerate((0.25, 0.5, 0.75), 1)]
    quartiles = share.groupBy("lang").agg(*at)
    down = F.greatest(width * (F.col("q2") - F.col("q1")) / 1000, F.lit(least))
    up = F.greatest(width * (F.col("q3") - F.col("q2")) / 1000, F.lit(least))
    return quartiles.select(F.col("lang").alias("band_lang"), (F.col("q2") / 1000 - down).alias("low"), (F.col("q2") / 1000 + up).alias("high"))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts of every row, whether it fails the base rules, and whether it is kept.

    Kept are rows that pass the base rules and whose log perplexity (natural, per byte and word end, by
    the model of all texts of ``docs``) lies in the band of their language, both ends included. Columns: ``key``, ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``,
    ``log_perplexity``, ``low``, ``high``. Null texts count as empty: no words, failed. Rows without a
    language share a band; repeated rows are judged each; long texts are worked on in parts; an empty
    table gives an empty table. Columns but these three are not read.
    """
    counts = materialise(quality_counts(docs, key, text, lang), "quality-counts")
    bands = materialise(perplexity_bands(counts), "perplexity-bands")
    out = counts.join(bands, counts.lang.eqNullSafe(bands.band_lang), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return out.select(key, *names, (~F.col("base_failed") & inside).alias("kept"), "log_perplexity", "low", "high")
