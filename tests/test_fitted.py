"""Saved pipelines, the vector head and batches by length against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from corpusloom.operators import batches, head, stages, vectorize
from corpusloom.operators.classify import fit_naive_bayes
from corpusloom.operators.vocabulary import fit_vocabulary

TEXTS = [(i, f"{'good' if i % 2 else 'bad'} film number{i % 5} and more film", i % 2) for i in range(30)] + [(40, None, 1), (41, "", 0)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, text string, pos int")


def test_a_saved_pipeline_equals_its_parts(spark, texts, tmp_path):
    pipeline = Pipeline(stages=[
        stages.NgramVocabulary(maxFeatures=20, lengths=[1, 2], maxDF=1.0), stages.TfIdf(size=20, sublinear=False),
        stages.MultinomialNB(size=20, alpha=0.5, outputCol="nb"), stages.SquaredHingeSVM(size=20, c=1.0, balanced=True, outputCol="svm"),
    ])
    fitted = pipeline.fit(texts)
    fitted.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    new = spark.createDataFrame([(1, "good film"), (2, "bad film film"), (3, "unknown"), (4, None)], "id int, text string")
    columns = ["id", "bow", "tfidf", "nb", "svm", "margin"]
    want = sorted(map(str, fitted.transform(new).select(*columns).collect()))
    assert sorted(map(str, loaded.transform(new).select(*columns).collect())) == want
    vocab = fit_vocabulary(texts, "text", max_features=20, ngram_range=(1, 2), max_df=1.0)
    assert loaded.stages[0].fitted == vocab and loaded.stages[0].uid == fitted.stages[0].uid
    bow = vectorize.bow_features(texts, "text", vocab)
    assert loaded.stages[2].fitted == fit_naive_bayes(bow, "bow", "pos", len(vocab) if len(vocab) == 20 else 20, 0.5)
    parts = vectorize.tfidf_features(vectorize.bow_features(new, "text", vocab), "bow", vocab, sublinear=False)
    assert sorted(map(str, parts.select("id", "tfidf").collect())) == sorted(map(str, loaded.transform(new).select("id", "tfidf").collect()))


def test_an_unfitted_pipeline_is_saved_with_its_settings(spark, texts, tmp_path):
    Pipeline(stages=[stages.NgramVocabulary(maxFeatures=7, minDF=3)]).save(str(tmp_path / "p"))
    stage = Pipeline.load(str(tmp_path / "p")).getStages()[0]
    assert stage.getOrDefault("maxFeatures") == 7 and len(stage.fit(texts).fitted) == 7


def test_head_is_the_minimum(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=70).round(3).tolist(), int(rng.random() < 0.4)) for i in range(150)]
    odd = [(900, None, 1), (901, [1.0], 0), (902, [math.nan] * 70, 1), (903, [0.5] * 70, None), (904, [None] * 70, 1)]
    df = spark.createDataFrame(rows + odd, "id int, v array<double>, y int").repartition(3)
    model = head.fit_vector_head(df, "v", "y", weight_decay=0.05)
    x, y = np.hstack([np.array([r[1] for r in rows]), np.ones((150, 1))]), np.array([r[2] for r in rows])
    w = np.array(model.weights + [model.intercept])
    decay = np.append(np.full(70, 0.05), 0)
    gradient = x.T @ (1 / (1 + np.exp(-(x @ w))) - y) / 150 + decay * w
    assert np.abs(gradient).max() < 1e-9 and model.steps < 15
    got = {r.id: (r.probability, r.prediction) for r in model.predict(df, "v").collect()}
    assert got[900] == got[901] == (None, None)
    assert all(abs(got[i][0] - 1 / (1 + math.exp(-(x[i] @ w)))) < 1e-9 for i in range(150))
    model.save(spark, str(tmp_path / "h"))
    assert head.VectorHead.load(spark, str(tmp_path / "h")) == model


def test_head_of_one_class_and_of_nothing(spark):
    schema = "v array<float>, y int"
    assert head.fit_vector_head(spark.createDataFrame([], schema), "v", "y").weights == []
    one = head.fit_vector_head(spark.createDataFrame([([1.0, 2.0], 1)] * 5, schema), "v", "y")
    assert one.intercept > 0 and all(map(math.isfinite, one.weights))


def test_batches_equal_a_plain_ranking(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([3, 3, 3, 3, 0, 7, rng.randint(0, 40)])) for i in range(500)] + [(None, 4), (7, None), (8, None), (9, 3), (9, 3)]
    df = spark.createDataFrame(rows, "id int, n int").repartition(4)
    got = batches.batch_by_length(df, "n", "id", 8).collect()
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), r[0] or -1))
    want = []
    for at, (i, n) in enumerate(order):
        batch = [m or 0 for _, m in order[at // 8 * 8 : at // 8 * 8 + 8]]
        want.append((i, n, at // 8, max(batch)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert batches.batch_by_length(df.limit(0), "n", "id", 8).count() == 0
    cost = batches.padding(batches.batch_by_length(df, "n", "id", 8), "n", "batch").first()
    assert cost.batches == 64 and cost.tokens == sum(n or 0 for _, n in rows) and 0 < cost.waste < 0.1
