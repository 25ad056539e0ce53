from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import classify, head, metrics, ranking, scoring, split, vectorize
from corpusloom.operators.vocabulary import Vocabulary, fit_vocabulary, term_statistics
from corpusloom.session import materialise

# ---- split -----------------------------------------------------------------------------------


def expected_validation(rows, fraction=0.2, seed=split.SEED):
    picked = set()
    for label in (0, 1):
        keys = [k for k, y in rows if y == label]
        keys.sort(key=lambda k: (hashlib.md5(f"{seed}|{k}".encode()).hexdigest(), k))
        picked |= set(keys[: math.floor(len(keys) * fraction)])
    return picked


@pytest.mark.parametrize("sizes", [(1, 4), (5, 35), (0, 5), (700, 3000)])
def test_split_is_exact_and_matches_a_full_sort(spark, sizes):
    rows = [(i, int(i >= sizes[0])) for i in range(sum(sizes))] + [(-1, None)]
    df = spark.createDataFrame(rows, "id long, y int")
    got = {r["id"] for r in split.add_validation_split(df, "id", "y").where("validation_set = 1").collect()}
    assert got == expected_validation([r for r in rows if r[1] is not None])


def test_split_is_stable_under_repartition(spark):
    df = spark.range(500).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    a = split.fit_split(df, "id", "y")
    b = split.fit_split(df.repartition(7).orderBy(F.desc("id")), "id", "y")
    assert a == b
    both = a.apply(df).groupBy("y", "validation_set").count().collect()
    assert {(r[0], r[1]): r[2] for r in both} == {(1, 0): 134, (1, 1): 33, (0, 0): 267, (0, 1): 66}


def test_split_finds_the_cut_inside_a_crowded_prefix(spark, monkeypatch):
    monkeypatch.setattr(split, "_PREFIX_DIGITS", 0)
    rows = [(i, i % 2) for i in range(101)]
    df = spark.createDataFrame(rows, "id long, y int")
    got = {r["id"] for r in split.add_validation_split(df, "id", "y").where("validation_set = 1").collect()}
    assert got == expected_validation(rows)


def test_string_keys(spark):
    rows = [(f"POS{i}", 1) for i in range(30)] + [(f"NEG{i}", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, y int")
    got = {r["id"] for r in split.add_validation_split(df, "id", "y").where("validation_set = 1").collect()}
    assert got == expected_validation(rows) and len(got) == 12


# ---- vocabulary and features -----------------------------------------------------------------


def brute_tf(text, high=3, low=1):
    t = re.findall(r"\b\w\w+\b", (text or "").lower())
    return Counter(" ".join(t[i:i + n]) for n in range(low, high + 1) for i in range(len(t) - n + 1))


def brute_vocabulary(texts, k, min_df, max_df, high=3, low=1):
    df, cf = Counter(), Counter()
    for text in texts:
        tf = brute_tf(text, high, low)
        cf.update(tf)
        df.update(tf.keys())
    kept = [t for t in cf if min_df <= df[t] <= max_df * len(texts)]
    kept = sorted(sorted(kept, key=lambda t: (-cf[t], t))[:k])
    return kept, [df[t] for t in kept], [cf[t] for t in kept]


def random_texts(n, seed, words=12, longest=40):
    rng = random.Random(seed)
    alphabet = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "ii", "x", "jj", "éé"][:words]
    weights = [2 ** -(i / 2) for i in range(len(alphabet))]
    return [" ".join(rng.choices(alphabet, weights, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("k,min_df,max_df,high,low", [
    (5, 2, 0.95, 3, 1), (30, 2, 0.95, 3, 1), (7500, 2, 0.95, 3, 1), (20, 3, 0.5, 3, 1), (12, 1, 0.3, 3, 2), (12, 1, 1.0, 2, 2), (9, 2, 0.9, 1, 1),
])
def test_vocabulary_equals_brute_force(spark, k, min_df, max_df, high, low):
    texts = random_texts(40, k) + ["", "lone word here", "aa aa aa aa aa aa"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = fit_vocabulary(df, "text", max_features=k, min_df=min_df, max_df=max_df, ngram_range=(low, high))
    assert (got.terms, got.df, got.cf) == brute_vocabulary(texts, k, min_df, max_df, high, low)
    assert got.n_docs == len(texts)


@pytest.mark.parametrize("k", range(1, 12))
def test_ties_at_the_last_place(spark, k):
    texts = ["aa bb aa cc", "aa bb cc", "bb aa cc", "cc aa bb", "aa bb aa cc dd"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = fit_vocabulary(df, "text", max_features=k, min_df=2, max_df=0.9)
    assert (got.terms, got.df, got.cf) == brute_vocabulary(texts, k, 2, 0.9, 3, 1)


@pytest.mark.parametrize("cells", [256, 4096, 1 << 20])
def test_vocabulary_is_exact_however_full_the_cells(spark, monkeypatch, cells):
    """Many n-grams of one document only, more frequent than the terms that may be kept, so the sketch is asked again."""
    from corpusloom.operators import vocabulary

    monkeypatch.setattr(vocabulary, "CELLS", cells)
    asked, count = [], vocabulary._fullest_cells
    monkeypatch.setattr(vocabulary, "_fullest_cells", lambda *a: asked.append(count(*a)) or asked[-1])
    texts = random_texts(60, 3, longest=60) + [" ".join(f"rare{i % 600}" for i in range(24_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = fit_vocabulary(df, "text", max_features=40)
    assert (got.terms, got.df, got.cf) == brute_vocabulary(texts, 40, 2, 0.95)
    assert len(asked) == {256: 1, 4096: 2, 1 << 20: 2}[cells], [least for _, least in asked]


def test_document_frequency_edges(spark):
    # df of exactly 0.95 * N stays, one more goes; df 2 stays, 1 goes; ties at the cap by name.
    texts = [f"often{'' if i else ' never1'} {'most' if i < 19 else 'rest'} w{i // 2:02d}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocab = fit_vocabulary(df, "text", ngram_range=(1, 1), max_features=4)
    assert vocab.terms == ["most", "w00", "w01", "w02"]
    assert "often" not in vocab.terms and "never1" not in vocab.terms


def test_vocabulary_ignores_validation_rows(spark):
    rows = [(i, f"alpha beta gamma{i % 3}", 0) for i in range(12)] + [(99, "unseen unseen words", 1), (98, "unseen words", 1)]
    df = spark.createDataFrame(rows, "id int, text string, validation_set int")
    with_val = fit_vocabulary(split.train_rows(df), "text")
    assert with_val == fit_vocabulary(df.where("id < 90"), "text")
    assert not any("unseen" in t for t in with_val.terms)


def test_statistics_of_empty_documents(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "id int, text string")
    assert term_statistics(df, "text").count() == 0
    vocab = fit_vocabulary(df, "text")
    assert len(vocab) == 0
    assert [list(r["bow"]["indices"]) for r in vectorize.bow_features(df, "text", vocab).collect()] == [[], []]
    with pytest.raises(ValueError):
        vocab.require_features()


def test_no_training_rows(spark):
    with pytest.raises(ValueError):
        fit_vocabulary(spark.createDataFrame([], "id int, text string"), "text")


@pytest.fixture(scope="module")
def corpus(spark):
    texts = random_texts(60, 3)
    rows = [(i, t, i % 2, int(i % 5 == 0)) for i, t in enumerate(texts)] + [(100, "zz yy", 1, 1), (101, None, 0, 0)]
    df = spark.createDataFrame(rows, "id long, text string, pos int, validation_set int").cache()
    vocab = fit_vocabulary(split.train_rows(df), "text", max_features=80)
    return rows, df, vocab


def test_bow_and_long_form(spark, corpus):
    rows, df, vocab = corpus
    docs = vectorize.bow_features(df, "text", vocab)
    long = vectorize.with_terms(vectorize.long_features(docs, "bow", ["id"], "tf"), vocab).collect()
    got = {(r["id"], r["term"]): r["tf"] for r in long}
    known = set(vocab.terms)
    want = {(i, t): n for i, text, _, _ in rows for t, n in brute_tf(text).items() if t in known}
    assert got == want


def test_tokens_and_text_give_the_same_features(spark, corpus):
    from corpusloom.functions.tokens import feature_tokens

    _, df, vocab = corpus
    tokens = df.withColumn("t", feature_tokens(F.col("text")))
    assert fit_vocabulary(split.train_rows(tokens), "t", max_features=80) == vocab
    a = vectorize.bow_features(df, "text", vocab).select("id", "bow").collect()
    b = vectorize.bow_features(tokens, "t", vocab).select("id", "bow").collect()
    assert sorted(a) == sorted(b)


def test_term_counts(spark, corpus):
    rows, df, _ = corpus
    got = {(r["id"], r["term"]): r["tf"] for r in vectorize.term_counts(df, "text", "id").collect()}
    assert got == {(i, t): n for i, text, _, _ in rows for t, n in brute_tf(text).items()}


def test_tfidf_has_length_one_and_survives_unknown_documents(spark, corpus):
    rows, df, vocab = corpus
    docs = vectorize.tfidf_features(vectorize.bow_features(df, "text", vocab), "bow", vocab).collect()
    n_train = sum(1 for r in rows if r[3] == 0)
    for r in docs:
        tf = brute_tf(r["text"])
        raw = {t: (1 + math.log(tf[t])) * (math.log((1 + n_train) / (1 + d)) + 1) for t, d in zip(vocab.terms, vocab.df) if t in tf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        got = {vocab.terms[i]: v for i, v in zip(r["tfidf"]["indices"], r["tfidf"]["values"])}
        assert got.keys() == raw.keys()
        assert all(abs(got[t] - raw[t] / norm) < 1e-12 for t in raw)
    assert next(r for r in docs if r["id"] == 100)["tfidf"]["values"] == []


def test_wide_export(spark):
    vocab = Vocabulary(["café", "cafè", "good film"], [2, 2, 2], [3, 3, 3], 5)
    df = spark.createDataFrame([(1, "café good film good film"), (2, "")], "id int, text string")
    wide = vectorize.wide_features(vectorize.bow_features(df, "text", vocab), "bow", vocab)
    assert wide.columns == ["id", "text", "bow_caf", "bow_caf_1", "bow_good_film"]
    rows = {r["id"]: tuple(r)[2:] for r in wide.collect()}
    assert rows == {1: (1, 0, 2), 2: (0, 0, 0)}
    assert vectorize.feature_names(wide.columns) == ["bow_caf", "bow_caf_1", "bow_good_film"]
    with pytest.raises(ValueError):
        vectorize.feature_names(["id"])


def test_wide_export_places_values_without_text_and_reads_filled_cells_back(spark, tmp_path):
    size = 300
    vocab = Vocabulary([f"t{i:03d}" for i in range(size)], [2] * size, [3] * size, 5)
    sparse = {1: {0: 2, 1: 1, 299: 4}, 2: {}, 3: {150: 1}, 4: {i: i + 1 for i in range(size)}, None: {298: 7}}
    rows = [(k, (sorted(v), [float(v[i]) for i in sorted(v)])) for k, v in sparse.items()] + [(6, None)]
    df = spark.createDataFrame(rows, "id int, bow struct<indices array<int>, values array<double>>")
    wide = vectorize.wide_features(df, "bow", vocab)
    names = vectorize.feature_names(wide.columns)
    got = {r["id"]: tuple(r)[1:] for r in wide.collect()}
    assert got == {k: tuple(sparse.get(k, {}).get(i, 0) for i in range(size)) for k in [*sparse, 6]}
    assert {f.dataType.simpleString() for f in wide.schema.fields[1:]} == {"bigint"}
    assert "from_csv" not in wide._jdf.queryExecution().optimizedPlan().toString()
    stored = materialise(wide, "wide", str(tmp_path / "wide"), form="orc")
    cells = sorted(((r["id"] or 0, r["ngram_column"], r["tf"]) for r in vectorize.filled_cells(stored, "id", names).collect()))
    assert cells == sorted((k or 0, names[i], n) for k, v in sparse.items() for i, n in v.items())
    odd = spark.createDataFrame([(1, None, -1, 3)], "id int, bow_a long, bow_b long, bow_c long")
    assert [tuple(r) for r in vectorize.filled_cells(odd, "id", ["bow_a", "bow_b", "bow_c"]).collect()] == [(1, "bow_c", 3)]


def test_vocabulary_round_trip(spark, corpus, tmp_path):
    _, _, vocab = corpus
    vocab.save(spark, str(tmp_path / "v"))
    assert Vocabulary.load(spark, str(tmp_path / "v")) == vocab


def test_too_many_features_are_refused_before_any_work(spark):
    with pytest.raises(ValueError):
        fit_vocabulary(spark.range(1).select(F.raise_error(F.lit("read"))), "text", max_features=10**7)


# ---- Naive Bayes -----------------------------------------------------------------------------


def test_naive_bayes_closed_form_and_mllib_agree(spark, corpus):
    from pyspark.ml.classification import NaiveBayes as SparkNaiveBayes

    rows, df, vocab = corpus
    docs = vectorize.bow_features(df, "text", vocab)
    train = split.train_rows(docs)
    model = classify.fit_naive_bayes(train, "bow", "pos", len(vocab))
    counts = np.zeros((2, len(vocab)))
    for _, text, y, val in rows:
        if not val:
            tf = brute_tf(text)
            counts[y] += [tf.get(t, 0) for t in vocab.terms]
    want = np.log(counts + 1) - np.log((counts + 1).sum(axis=1, keepdims=True))
    assert np.allclose(model.log_prob, want)
    sizes = Counter(y for _, _, y, val in rows if not val)
    assert np.allclose(model.log_prior, [math.log(sizes[c] / sum(sizes.values())) for c in (0, 1)])

    vectors = vectorize.as_vectors(docs, "bow", len(vocab), ["id", "pos", "validation_set"])
    ml = SparkNaiveBayes(labelCol="pos", smoothing=1.0).fit(vectors.where("validation_set = 0"))
    theirs = {r["id"]: int(r["prediction"]) for r in ml.transform(vectors).collect()}
    ours = {r["id"]: r["prediction"] for r in model.predict(docs, "bow").collect()}
    assert sum(ours[i] == theirs[i] for i in ours) >= len(ours) - 2


def test_naive_bayes_edges(spark, tmp_path):
    rows = [(0, "aa aa", 0), (1, "bb bb", 1), (2, "bb", 1)]
    df = spark.createDataFrame(rows, "id int, text string, pos int")
    vocab = Vocabulary(["aa", "bb"], [1, 2], [2, 3], 3)
    docs = vectorize.bow_features(df, "text", vocab)
    model = classify.fit_naive_bayes(docs, "bow", "pos", 2)
    new = vectorize.bow_features(spark.createDataFrame([(9, "zz"), (8, "aa"), (7, None)], "id int, text string"), "text", vocab)
    assert {r["id"]: r["prediction"] for r in model.predict(new, "bow").collect()} == {9: 1, 8: 0, 7: 1}
    even = classify.NaiveBayes([0, 1], [math.log(0.5)] * 2, [[0.0, 0.0]] * 2)
    assert {r["prediction"] for r in even.predict(new, "bow").collect()} == {0}
    model.save(spark, str(tmp_path / "m"))
    assert classify.NaiveBayes.load(spark, str(tmp_path / "m")) == model


# ---- linear models ---------------------------------------------------------------------------


def test_vector_head(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(2 if i % 2 else -2, 1.0), rng.gauss(0, 1)], i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, v array<float>, y int")
    model = head.fit_vector_head(df, "v", "y")
    right = model.predict(df, "v").where("prediction = y").count()
    assert right >= 95


# ---- metrics ---------------------------------------------------------------------------------


@pytest.mark.parametrize("pairs,want", [
    ([(1, 1), (0, 1), (0, 0), (1, 0), (1, 1)], (2, 1, 1, 1, 0.6, 2 / 3, 2 / 3, 2 / 3)),
    ([(1, 0), (0, 0)], (0, 0, 1, 1, 0.5, 0.0, 0.0, 0.0)),
    ([(0, 1), (0, 0)], (0, 1, 1, 0, 0.5, 0.0, 0.0, 0.0)),
    ([(1, 1)], (1, 0, 0, 0, 1.0, 1.0, 1.0, 1.0)),
])
def test_metrics(spark, pairs, want):
    df = spark.createDataFrame(pairs, "pos int, prediction int")
    row = metrics.evaluate(df, "m")
    assert row.columns == metrics.TEST_COLUMNS
    assert tuple(row.first())[2:] == pytest.approx(want)
    assert metrics.evaluate(df, "m", training_seconds=1.5).columns == metrics.VALIDATION_COLUMNS


def test_published_measures_follow_from_their_counts(spark):
    counts = spark.createDataFrame([(2119, 360, 2140, 381), (11174, 1581, 10919, 1326)], "TP long, FP long, TN long, FN long")
    got = sorted(tuple(r)[4:] for r in metrics.with_quality(counts).collect())
    assert got[0] == pytest.approx((0.8518, 0.854780153287616, 0.8476, 0.8511749347258486))
    assert got[1] == pytest.approx((0.88372, 0.8760486083888671, 0.89392, 0.8848940803801227))


def test_best_run(spark):
    runs = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, `f-score` double")
    assert metrics.best_run(runs).collect() == [("a", 0.9)]


def test_compare_predictions_equals_single_evaluations(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 1, 0), (1, 0, 1)], "y int, a int, b int")
    both = {r["model"]: tuple(r)[1:5] for r in metrics.compare_predictions(df, "y", {"A": "a", "B": "b"}).collect()}
    assert both == {"A": (1, 1, 0, 1), "B": (1, 0, 1, 1)}


# ---- rankings --------------------------------------------------------------------------------


def test_rankings_count_zero_rows_and_break_ties_by_name(spark):
    rows = [(1, "aa bb", 1, 0), (2, "aa cc", 1, 0), (3, "", 1, 0), (4, "dd dd", 0, 0), (5, "aa", 0, 1)]
    df = spark.createDataFrame(rows, "id int, text string, pos int, validation_set int")
    vocab = Vocabulary(["aa", "bb", "cc", "dd"], [2, 1, 1, 1], [2, 1, 1, 2], 4)
    docs = vectorize.bow_features(df, "text", vocab)
    total = [tuple(r) for r in ranking.top_bow_total(docs, "bow", "pos", vocab, 3).orderBy("class", "rank").collect()]
    assert total == [
        ("NEG", 1, "bow_dd", "dd", 2), ("NEG", 2, "bow_aa", "aa", 1), ("NEG", 3, "bow_bb", "bb", 0),
        ("POS", 1, "bow_aa", "aa", 2), ("POS", 2, "bow_bb", "bb", 1), ("POS", 3, "bow_cc", "cc", 1),
    ]
    train_only = ranking.top_bow_total(docs, "bow", "pos", vocab, 2, rows="train").where("class = 'NEG'").collect()
    assert {r["ngram"]: r["bow_total_count"] for r in train_only} == {"dd": 2, "aa": 0}
    first = ranking.top_bow_distinctive(docs, "bow", "pos", vocab, 1).where("class = 'POS'").first()
    # bb and cc lead: 1/3 against 0; aa scores 2/3 - 1/2.
    assert (first["ngram"], first["mean_bow_pos"], first["mean_bow_neg"]) == ("bb", pytest.approx(1 / 3), 0.0)
    with pytest.raises(ValueError):
        ranking.top_bow_total(docs, "bow", "pos", vocab, 3, rows="val")


def test_tfidf_rankings_use_training_rows(spark, corpus):
    _, df, vocab = corpus
    docs = vectorize.tfidf_features(vectorize.bow_features(df, "text", vocab), "bow", vocab)
    top = ranking.top_tfidf(docs, "tfidf", "pos", vocab, 10).collect()
    want = Counter()
    sizes = Counter()
    for r in split.train_rows(docs).collect():
        sizes[r["pos"]] += 1
        for i, v in zip(r["tfidf"]["indices"], r["tfidf"]["values"]):
            want[(r["pos"], vocab.terms[i])] += v
    for r in top:
        c = int(r["class"] == "POS")
        assert r["mean_tfidf"] == pytest.approx(want[(c, r["ngram"])] / sizes[c])
    assert sum(r["class"] == "POS" for r in top) == 10


# ---- external model --------------------------------------------------------------------------


def test_external_model_gets_batches_and_is_loaded_per_task(spark):
    def load():
        def model(texts):
            assert 0 < len(texts) <= 4
            return np.array([[t.count("a"), t.count("b")] for t in texts])
        return model

    rows = [(i, "a" * (i % 3) + "b" * (i % 2)) for i in range(50)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    got = {r["id"]: r["prediction"] for r in scoring.score_batches(df, "text", load, batch_size=4).collect()}
    assert got == {i: int((t or "").count("b") > (t or "").count("a")) for i, t in rows}
