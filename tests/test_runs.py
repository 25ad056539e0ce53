from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import classify, metrics, split, vectorize
from corpusloom.operators.vocabulary import Vocabulary, fit_vocabulary
from corpusloom.operators.quality import QualityError
from corpusloom.plans import runner
from corpusloom.session import clean_up, fresh_path, materialise
from corpusloom.sources import tables
from corpusloom.streaming.apply import predict_stream

GOOD = ["great", "wonderful", "moving", "superb"]
BAD = ["awful", "boring", "terrible", "weak"]
PLAIN = ["story", "actor", "scene", "plot", "music", "camera"]


def review(rng, label):
    return " ".join(rng.choice(PLAIN) + "<br />" + rng.choice(GOOD if label else BAD) for _ in range(8)) + "."


def load_standin():
    return lambda texts: np.array([[sum(t.count(w) for w in BAD), sum(t.count(w) for w in GOOD)] for t in texts])


@pytest.fixture()
def tree(tmp_path):
    rng = random.Random(5)
    for part in ("train", "test"):
        for folder, label in (("pos", 1), ("neg", 0)):
            path = tmp_path / "corpus" / part / folder
            path.mkdir(parents=True)
            for i in range(20):
                (path / f"{i}_{8 if label else 2}.txt").write_text(review(rng, label))
    return tmp_path


def test_run_on_files(spark, tree):
    settings = runner.Settings(
        expected_files=20, expected_rows=40, expected_per_class=20, max_features=200, top_k=5,
        external_model=load_standin, tfidf=runner.TfIdfSettings(max_features=150, ngram_range=(1, 2), sublinear=False),
    )
    out = str(tree / "out")
    results = runner.run_on_files(spark, str(tree / "corpus"), out, settings=settings)
    assert tuple(results["hash_counts_train"].first()) == (40, 0)
    assert all(r["ok"] for r in results["split_report"].collect())
    test = {r["model"]: r for r in results["test_metrics"].collect()}
    assert set(test) == {"MNB_BOW", "SVM_TFIDF", "EXTERNAL"}
    assert all(r["TP"] + r["FP"] + r["TN"] + r["FN"] == 40 and r["accuracy"] >= 0.95 for r in test.values())
    schema = ", ".join(f"`{c}` string" for c in metrics.VALIDATION_COLUMNS)
    validation = tables.read_runs(spark, f"{out}/validation_metrics", schema).collect()
    assert len(validation) == 3 and all(r["training_time_seconds"] and r["run"] == "run" for r in validation)
    top = {r["ngram"] for r in results["top_bow_distinctive"].where("class = 'POS'").collect()}
    assert top & set(GOOD) and not top & set(BAD)
    assert tables.read_csv_text(spark, f"{out}/top_tfidf.csv").count() == 10
    assert tables.read_csv_text(spark, f"{out}/train.csv").count() == 40

    vocab = Vocabulary.load(spark, f"{out}/vocabulary")
    model = classify.NaiveBayes.load(spark, f"{out}/mnb_model")
    stored = spark.read.parquet(f"{out}/test_clean")
    scored = model.predict(vectorize.bow_features(stored, "tokens", vocab), "bow")
    assert scored.where("prediction = POS").count() == round(test["MNB_BOW"]["accuracy"] * 40)


def test_external_models_get_cut_texts_and_tfidf_its_own_terms(spark):
    rows = [(f"POS{i}", 1, "good " * 9 + "bad") for i in range(10)] + [(f"NEG{i}", 0, "bad bad good") for i in range(10)]
    df = spark.createDataFrame(rows, "Unique_ID string, POS int, Review string")

    def load():
        return lambda texts: [[0.0, 1.0] if len(t.split()) == 4 else [1.0, 0.0] for t in texts]

    settings = runner.Settings(external_model=load, external_max_words=4, tfidf=runner.TfIdfSettings(max_features=1, max_df=1.0), max_df=1.0)
    run = runner.ModelRun(df, None, "Unique_ID", settings)
    run.run(["split", "clean", "clean_light", "bow", "tfidf", "score_external"])
    scored = run.models["EXTERNAL"]("train").select("POS", "prediction").distinct().collect()
    assert sorted(map(tuple, scored)) == [(0, 0), (1, 1)]
    assert len(run.vocab) > 1 and run.tfidf_vocab.terms == ["good"]
    assert run.weights["train"].columns == ["Unique_ID", "POS", "validation_set", "tfidf"]


def test_steps_are_switchable_and_checked(spark, tree):
    root, out = str(tree / "corpus"), str(tree / "out")
    assert set(runner.run_on_files(spark, root, out, ["convert"])) == set()
    results = runner.run_on_files(spark, root, out, ["split", "clean", "bow", "top_bow"], runner.Settings(top_k=3))
    assert set(results) == {"split_report", "top_bow_total", "top_bow_distinctive"}
    with pytest.raises(ValueError, match="unknown"):
        runner.run_on_files(spark, root, out, ["fly"])
    with pytest.raises(QualityError, match="file_count"):
        runner.run_on_files(spark, root, out, ["check_files"])


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, review(rng, i % 2), i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, text string, pos int")
    vocab = fit_vocabulary(df, "text")
    model = classify.fit_naive_bayes(vectorize.bow_features(df, "text", vocab), "bow", "pos", len(vocab))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = predict_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "text", vocab, model)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    key = lambda df: sorted(map(tuple, df.select("id", "prediction").collect()))
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(predict_stream(df, "text", vocab, model))


def test_split_rule_applies_to_a_stream(spark, tmp_path):
    df = spark.range(60).withColumn("y", (F.col("id") % 2).cast("int"))
    rule = split.fit_split(df, "id", "y")
    df.write.parquet(str(tmp_path / "in"))
    stream = rule.apply(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("split_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("split_rows").where("validation_set = 1").count() == 12


def test_materialised_tables_go_to_the_shared_folder(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    path = fresh_path(spark, "x")
    assert path.startswith(shared) and path != fresh_path(spark, "x")
    kept = materialise(spark.range(3), "kept", str(tmp_path / "kept"))
    temporary = materialise(spark.range(3), "temporary")
    assert kept.count() == temporary.count() == 3
    clean_up(spark)
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(temporary.inputFiles()[0]).count()


def test_texts_are_cleaned_once_for_both_forms(spark, monkeypatch):
    from corpusloom.functions import text

    texts = ["The &amp;lt;b&amp;gt; Cats\u00a0RAN <br/> fast", "\ufb01ne &amp; GOOD, isn't it?", None, "  ", "\u0130stanbul <i>ROCKS</i>"]
    rows = spark.createDataFrame([(i % 2, f"POS{i}", t) for i, t in enumerate(texts)], "POS int, Unique_ID string, Review string")
    alone = runner.ModelRun(rows, rows, "Unique_ID", runner.Settings())
    alone.run(["clean"])
    calls, heavy = [], text.heavy_clean
    monkeypatch.setattr(text, "heavy_clean", lambda *a, **k: calls.append(a) or heavy(*a, **k))
    both = runner.ModelRun(rows, rows, "Unique_ID", runner.Settings())
    both.run(["clean", "clean_light"])
    assert len(calls) == 2  # one a table
    for name in ("train", "test"):
        ordered = lambda run: run.cleaned[name].orderBy("Unique_ID").collect()
        assert ordered(both) == ordered(alone) and both.light[name].count() == len(texts)
