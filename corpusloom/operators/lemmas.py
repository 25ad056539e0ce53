"""Lemmas by detachment rules whose results count only where the corpus itself uses them as words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.tokens import lemmatize_with_table
from corpusloom.functions.wordlists import DETACHMENTS, LEMMAS
from corpusloom.session import materialise

#: Letters a lemma has at least, and how often the corpus has to use it.
SHORTEST = 3
MIN_COUNT = 2


def candidate(form: Column, ending: str, put: str, doubled: bool) -> Column:
    """What is left of ``form`` without ``ending``, and ``put`` after it; null where the rule does not apply.

    A ``doubled`` rule takes one of two equal last consonants away as well. A plural ``s`` does not follow s, u or i.
    """
    stem = F.substring(form, F.lit(1), F.length(form) - len(ending))
    fits = F.endswith(form, F.lit(ending)) & F.rlike(form, F.lit(r"^\p{L}+$"))
    last = F.right(stem, F.lit(1))
    if doubled:
        fits &= (last == F.left(F.right(stem, F.lit(2)), F.lit(1))) & ~last.isin(*"aeiou")
        stem = F.substring(stem, F.lit(1), F.length(stem) - 1)
    if ending == "s":
        fits &= ~last.isin("s", "u", "i")
    found = F.concat(stem, F.lit(put))
    return F.when(fits & (F.length(found) >= SHORTEST), found)


def lemma_table(
    docs: DataFrame, tokens: str, exceptions: Mapping[str, str] | None = None, min_count: int = MIN_COUNT,
    rules: tuple[tuple[str, str, bool], ...] = DETACHMENTS,
) -> DataFrame:
    """``form``, ``lemma``, ``rule`` for every form of the array column ``tokens`` that has another lemma.

    A form in ``exceptions`` (by default the irregular forms) takes its lemma from there, and ``rule`` is 0. Any
    other takes the first rule, numbered from 1, whose candidate occurs ``min_count`` times or more in ``docs``
    as a word; a form without one is its own lemma and has no row. Forms are compared in lower case; null
    arrays and tokens have none. Candidates meet the words of the corpus in a join, whatever their number.
    """
    entries = LEMMAS if exceptions is None else exceptions
    words = docs.select(F.explode(tokens).alias("t")).select(F.lower("t").alias("form")).where(F.col("form") != "").groupBy("form").count()
    words = materialise(words, "word-counts")
    irregular = docs.sparkSession.createDataFrame(sorted(entries.items()), "form string, lemma string")
    ways = F.array(*[
        F.struct(F.lit(n).alias("rule"), candidate(F.col("form"), *rule).alias("lemma")) for n, rule in enumerate(rules, 1)
    ])
    regular = words.join(irregular, "form", "left_anti").select("form", F.explode(F.filter(ways, lambda w: w["lemma"].isNotNull())).alias("w"))
    used = words.where(F.col("count") >= min_count).select(F.col("form").alias("lemma"))
    attested = regular.select("form", "w.rule", "w.lemma").join(used, "lemma").groupBy("form").agg(F.min(F.struct("rule", "lemma")).alias("w"))
    listed = words.join(irregular, "form").where(F.col("form") != F.col("lemma")).select("form", "lemma", F.lit(0).alias("rule"))
    return attested.select("form", "w.lemma", "w.rule").unionByName(listed)


def lemmatize_by_rules(docs: DataFrame, tokens: str, **options) -> DataFrame:
    """``docs`` with lower-cased lemmas in ``tokens``, by the table made from ``docs`` itself; see ``lemma_table``."""
    table = lemma_table(docs, tokens, **options)
    return lemmatize_with_table(docs, tokens, table.select("form", "lemma"))
