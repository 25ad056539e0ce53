"""The whole run in order: check, convert, split, clean, vectorize, train, explain, test."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import light_clean
from corpusloom.functions.tokens import feature_tokens, preprocess_text, truncate_tokens
from corpusloom.operators import classify, integrity, metrics, quality, ranking, scoring, split, svm, vectorize
from corpusloom.operators.vocabulary import Vocabulary, fit_vocabulary
from corpusloom.plans import inputs
from corpusloom.session import materialise
from corpusloom.sources import labelled_files, tables

#: What a step needs from earlier ones of the same run.
NEEDS = {
    "bow": ("clean",), "tfidf": ("bow",), "train_mnb": ("split", "bow"), "train_svm": ("split", "tfidf"),
    "score_external": ("clean_light",), "top_bow": ("bow",), "top_tfidf": ("split", "tfidf"),
}

#: ``clean`` goes on from the texts of ``clean_light`` where both run.
STEPS = (
    "check_files", "convert", "check_table", "check_hashes", "split", "clean_light", "clean",
    "bow", "tfidf", "train_mnb", "train_svm", "score_external", "top_bow", "top_tfidf", "test",
)


@dataclass(frozen=True)
class TfIdfSettings:
    """Vocabulary and weighting of the TF-IDF features; the defaults are the fixed values of the published run."""

    max_features: int = 7500
    min_df: int = 2
    max_df: float = 0.95
    ngram_range: tuple[int, int] = (1, 3)
    sublinear: bool = True


@dataclass(frozen=True)
class Settings:
    """Parameters of a run; the defaults are the fixed values of the published one."""

    expected_files: int = quality.FILES_PER_SUBSET
    expected_rows: int = quality.EXPECTED_ROWS
    expected_per_class: int = quality.EXPECTED_PER_CLASS
    seed: int = split.SEED
    fraction: float = split.VALIDATION_FRACTION
    max_features: int = 7500
    min_df: int = 2
    max_df: float = 0.95
    ngram_range: tuple[int, int] = (1, 3)
    tfidf: TfIdfSettings = TfIdfSettings()
    alpha: float = classify.ALPHA
    svm_c: float = svm.SVM_C
    svm_tolerance: float = svm.TOLERANCE
    top_k: int = ranking.TOP_K
    run: str = "run"
    external_model: Callable[[], scoring.Model] | None = None
    external_max_words: int = 500


class ModelRun:
    """Training and testing on two tables with the columns key, ``POS`` and ``Review``.

    ``tables`` hold the texts. Each step stores the key, label and split beside what it makes, and nothing else:
    ``cleaned`` and ``light`` the cleaned texts, ``features`` the counts, ``weights`` the TF-IDF rows.
    """

    def __init__(self, train: DataFrame, test: DataFrame | None, key: str, settings: Settings, out: str | None = None):
        self.spark: SparkSession = train.sparkSession
        self.tables = {"train": train} | ({"test": test} if test is not None else {})
        self.key, self.settings, self.out = key, settings, out
        self.cleaned: dict[str, DataFrame] = {}
        self.light: dict[str, DataFrame] = {}
        self.features: dict[str, DataFrame] = {}
        self.weights: dict[str, DataFrame] = {}
        self.results: dict[str, DataFrame] = {}
        self.vocab: Vocabulary | None = None
        self.tfidf_vocab: Vocabulary | None = None
        self.models: dict[str, Callable[[str], DataFrame]] = {}

    def _store(self, df: DataFrame, name: str, *made: Column | str) -> DataFrame:
        """Key, label, split and the columns ``made`` of ``df``, written once."""
        kept = [c for c in (self.key, "POS", "validation_set") if c in df.columns]
        return materialise(df.select(*kept, *made), name, f"{self.out}/{name}" if self.out else None)

    def split(self) -> None:
        s = self.settings
        rows = split.add_validation_split(self.tables["train"], self.key, "POS", fraction=s.fraction, seed=s.seed)
        self.tables["train"] = rows
        self.results["split_report"] = quality.split_report(rows, fraction=s.fraction, label="POS")

    def clean(self) -> None:
        for name, df in self.tables.items():
            if name in self.light:
                text = self.light[name].withColumn("Review_preprocessed", preprocess_text(F.col("Review_preprocessed_BERT"), lightly_cleaned=True))
            else:
                text = df.withColumn("Review_preprocessed", preprocess_text(F.col("Review")))
            self.cleaned[name] = self._store(text, f"{name}_clean", "Review_preprocessed", feature_tokens(F.col("Review_preprocessed")).alias("tokens"))

    def clean_light(self) -> None:
        for name, df in self.tables.items():
            self.light[name] = self._store(df, f"{name}_clean_light", light_clean(F.col("Review")).alias("Review_preprocessed_BERT"))

    def _vocabulary(self, name: str, s: Settings | TfIdfSettings) -> Vocabulary:
        vocab = fit_vocabulary(
            split.train_rows(self.cleaned["train"]), "tokens", max_features=s.max_features,
            min_df=s.min_df, max_df=s.max_df, ngram_range=s.ngram_range,
        ).require_features()
        if self.out:
            vocab.save(self.spark, f"{self.out}/{name}")
        return vocab

    def bow(self) -> None:
        self.vocab = self._vocabulary("vocabulary", self.settings)
        for name, df in self.cleaned.items():
            self.features[name] = self._store(vectorize.bow_features(df, "tokens", self.vocab), f"{name}_bow", "bow")

    def tfidf(self) -> None:
        """Weights from the counts at hand where both vocabularies have the same settings, else from counts of their own."""
        s, own = self.settings, self.settings.tfidf
        bounds = lambda x: (x.max_features, x.min_df, x.max_df, x.ngram_range)
        same = bounds(s) == bounds(own)
        self.tfidf_vocab = self.vocab if same else self._vocabulary("tfidf_vocabulary", own)
        for name, df in self.cleaned.items():
            counted = self.features[name] if same else vectorize.bow_features(df, "tokens", self.tfidf_vocab)
            weighted = vectorize.tfidf_features(counted, "bow", self.tfidf_vocab, sublinear=own.sublinear)
            self.weights[name] = self._store(weighted, f"{name}_tfidf", "tfidf")

    def _validate(
        self, name: str, predict: Callable[[DataFrame], DataFrame], seconds: float, inputs: dict[str, DataFrame]
    ) -> None:
        self.models[name] = lambda part: predict(inputs[part])
        scored = predict(split.validation_rows(inputs["train"]))
        self.results[f"validation_{name}"] = metrics.evaluate(scored, name, "POS", training_seconds=seconds)

    def train_mnb(self) -> None:
        train = split.train_rows(self.features["train"])
        model, seconds = classify.timed(
            classify.fit_naive_bayes, train, "bow", "POS", len(self.vocab), self.settings.alpha
        )
        if self.out:
            model.save(self.spark, f"{self.out}/mnb_model")
        self._validate("MNB_BOW", lambda df: model.predict(df, "bow"), seconds, self.features)

    def train_svm(self) -> None:
        s = self.settings
        train = split.train_rows(self.weights["train"])
        if self.out:
            vectorize.as_vectors(train, "tfidf", len(self.tfidf_vocab), [self.key, "POS"], f"{self.out}/tfidf_vectors")
        model, seconds = classify.timed(
            svm.fit_squared_hinge, train, "POS", "tfidf", len(self.tfidf_vocab), s.svm_c, tolerance=s.svm_tolerance
        )
        if self.out:
            model.save(self.spark, f"{self.out}/svm_model")
        self._validate("SVM_TFIDF", lambda df: model.predict(df, "tfidf"), seconds, self.weights)

    def score_external(self) -> None:
        """The model gets the first ``external_max_words`` words of each text."""
        load, most = self.settings.external_model, self.settings.external_max_words
        if load is None:
            return
        words = truncate_tokens(F.split("Review_preprocessed_BERT", " "), most)
        cut = {name: df.withColumn("Review_preprocessed_BERT", F.array_join(words, " ")) for name, df in self.light.items()}
        self._validate("EXTERNAL", lambda df: scoring.score_batches(df, "Review_preprocessed_BERT", load), 0.0, cut)

    def top_bow(self) -> None:
        rows, k = self.features["train"], self.settings.top_k
        self.results["top_bow_total"] = ranking.top_bow_total(rows, "bow", "POS", self.vocab, k)
        self.results["top_bow_distinctive"] = ranking.top_bow_distinctive(rows, "bow", "POS", self.vocab, k)

    def top_tfidf(self) -> None:
        rows, k = self.weights["train"], self.settings.top_k
        self.results["top_tfidf"] = ranking.top_tfidf(rows, "tfidf", "POS", self.tfidf_vocab, k)
        self.results["top_tfidf_distinctive"] = ranking.top_tfidf_distinctive(rows, "tfidf", "POS", self.tfidf_vocab, k)

    def test(self) -> None:
        rows = [metrics.evaluate(predict("test"), name, "POS") for name, predict in self.models.items()]
        self.results["test_metrics"] = metrics.compare(rows)

    def run(self, steps: Iterable[str]) -> dict[str, DataFrame]:
        """Run the named steps in their fixed order; the results are lazy tables."""
        wanted = set(steps)
        for step in sorted(wanted & set(NEEDS)):
            if missing := set(NEEDS[step]) - wanted:
                raise ValueError(f"step {step} needs {sorted(missing)}")
        for step in STEPS[STEPS.index("split"):]:
            if step in wanted:
                getattr(self, step)()
        rows = [df for name, df in self.results.items() if name.startswith("validation_")]
        if rows:
            self.results["validation_metrics"] = metrics.compare(rows)
        return self.results


def run_on_files(
    spark: SparkSession, root: str, out: str, steps: Iterable[str] = STEPS, settings: Settings = Settings()
) -> dict[str, DataFrame]:
    """The run on text folders below ``root``; tables, models and results go below ``out``."""
    wanted = list(steps)
    unknown = set(wanted) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}")
    s = settings
    results: dict[str, DataFrame] = {}
    if "check_files" in wanted:
        report = quality.file_report(labelled_files.list_files(spark, root), s.expected_files)
        results["file_report"] = quality.require(report)
    if "convert" in wanted:
        labelled_files.read_labelled_text(spark, root).write.partitionBy("split").parquet(f"{out}/reviews")
    reviews = spark.read.schema(
        "POS int, Unique_ID string, Score int, Review string, split string"
    ).parquet(f"{out}/reviews")
    parts = {name: reviews.where(F.col("split") == name).drop("split") for name in ("train", "test")}
    for name, df in parts.items():
        if "convert" in wanted:
            tables.write_csv(labelled_files.sort_by_id(df), f"{out}/{name}.csv", quote_all=True)
        if "check_table" in wanted:
            report = quality.table_report(
                df, name, expected_rows=s.expected_rows, expected_pos=s.expected_per_class,
                expected_neg=s.expected_per_class,
            )
            results[f"table_report_{name}"] = quality.require(report)
        if "check_hashes" in wanted:
            files = labelled_files.read_text_files(spark, root).where(F.col("split") == name)
            checked = integrity.hash_check(df, files, split=name, strict=True)
            tables.write_csv(checked, f"{out}/{name}_hash_check.csv", quote_all=True)
            results[f"hash_counts_{name}"] = integrity.match_counts(checked)
    results |= ModelRun(parts["train"], parts["test"], "Unique_ID", s, out).run(wanted)
    for name in ("top_bow_total", "top_bow_distinctive", "top_tfidf", "top_tfidf_distinctive", "test_metrics"):
        if name in results:
            tables.write_csv(results[name].coalesce(1), f"{out}/{name}.csv")
    if "validation_metrics" in results:
        tables.append_run(results["validation_metrics"].coalesce(1), f"{out}/validation_metrics", s.run)
    return results


# Fixed value: a seed of its own for the rows held out for the test.
TEST_SEED = 20260228


def run_on_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The run on the labelled documents of a data folder, a fifth of them held out for the test.

    One row of counts for each step from ``convert`` to ``test``. Checks of files have their own
    reports, and ``score_external`` needs a model of the caller's.
    """
    rows = materialise(inputs.raw_reviews(spark, folder), "reviews")
    held_out = split.add_validation_split(rows, "Unique_ID", "POS", seed=TEST_SEED).withColumnRenamed("validation_set", "held_out")
    train, test = (held_out.where(F.col("held_out") == v).drop("held_out") for v in (0, 1))
    run = ModelRun(train, test, "Unique_ID", Settings(svm_c=10.0, svm_tolerance=1e-8))
    results = run.run(["split", "clean", "clean_light", "bow", "tfidf", "train_mnb", "train_svm", "top_bow", "top_tfidf", "test"])
    count = F.count(F.lit(1)).alias("rows")
    both = lambda stored, name: stored["train"].select(name).union(stored["test"].select(name))
    size = F.size("bow.indices")
    confusion = lambda name, model: results[name].where(F.col("model") == model).select(*metrics.COUNTS)
    return {
        "convert": rows.agg(count),
        "split": run.tables["train"].agg(F.count_if(F.col("validation_set") == 0).alias("train"), F.count_if(F.col("validation_set") == 1).alias("validation")),
        "clean": both(run.cleaned, "Review_preprocessed").agg(count, F.count_if(F.col("Review_preprocessed") == "").alias("empty")),
        "clean_light": both(run.light, "Review_preprocessed_BERT").agg(F.count("Review_preprocessed_BERT").alias("rows")),
        "bow": both(run.features, "bow").agg(F.lit(len(run.vocab)).alias("terms"), F.sum(size).alias("cells")),
        "tfidf": both(run.weights, "tfidf").agg(F.count_if(F.aggregate("tfidf.values", F.lit(0.0), lambda acc, v: acc + v * v) > 0.999).alias("unit_rows")),
        "train_mnb": confusion("validation_MNB_BOW", "MNB_BOW"),
        "train_svm": confusion("validation_SVM_TFIDF", "SVM_TFIDF"),
        "top_bow": results["top_bow_total"].agg(count, F.sum("bow_total_count").alias("total")),
        "top_tfidf": results["top_tfidf"].agg(count),
        "test": confusion("test_metrics", "MNB_BOW"),
        "test_svm": confusion("test_metrics", "SVM_TFIDF"),
    }
