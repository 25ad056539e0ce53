"""Vocabulary, TF-IDF, Naive Bayes and SVM as stages of a ``pyspark.ml`` pipeline that is saved and loaded as one.

Fit ``Pipeline(stages=[NgramVocabulary(...), TfIdf(...), SquaredHingeSVM(...)])`` on training rows, save the model,
and apply a loaded one to new texts: it carries its vocabulary, settings and weights.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.classify import ALPHA, NaiveBayes, fit_naive_bayes
from corpusloom.operators.svm import SVM_C, TOLERANCE, LinearSVM, fit_squared_hinge
from corpusloom.operators.vectorize import bow_features, tfidf_features
from corpusloom.operators.vocabulary import MAX_DF, MAX_FEATURES, MIN_DF, Vocabulary, fit_vocabulary


class _Columns(Params):
    inputCol = Param(Params._dummy(), "inputCol", "column that is read", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column that is added", TypeConverters.toString)

    def _given(self, values: dict) -> None:
        self._set(**{k: v for k, v in values.items() if v is not None})


class _Writer(MLWriter):
    def __init__(self, instance: _Fitted):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.fitted.save(self.sparkSession, f"{path}/fitted")


class _Reader(MLReader):
    def __init__(self, kind: type[_Fitted]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _Fitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.kind.holds.load(self.sparkSession, f"{path}/fitted"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _Fitted(Model, _Columns, MLWritable, MLReadable):
    """A stage around a fitted object that can save itself; ``holds`` is its class."""

    holds: type

    def __init__(self, fitted=None):
        super().__init__()
        self.fitted = fitted

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Fits(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    def _model(self, kind: type[_Fitted], fitted) -> _Fitted:
        return self._copyValues(kind(fitted))


class _Bounds(_Columns):
    maxFeatures = Param(Params._dummy(), "maxFeatures", "terms that are kept", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "least documents of a term", TypeConverters.toInt)
    maxDF = Param(Params._dummy(), "maxDF", "largest share of documents of a term", TypeConverters.toFloat)
    lengths = Param(Params._dummy(), "lengths", "fewest and most tokens of an n-gram", TypeConverters.toListInt)


class NgramVocabularyModel(_Fitted, _Bounds):
    """Adds the counts of the vocabulary's terms in a text, or an array of tokens, as a sparse row."""

    holds = Vocabulary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return bow_features(dataset, self.getOrDefault("inputCol"), self.fitted, self.getOrDefault("outputCol"))


class NgramVocabulary(_Fits, _Bounds):
    """Learns the terms of ``inputCol``; see ``vocabulary.fit_vocabulary``."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, maxFeatures=None, minDF=None, maxDF=None, lengths=None):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="bow", maxFeatures=MAX_FEATURES, minDF=MIN_DF, maxDF=MAX_DF, lengths=[1, 3])
        self._given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NgramVocabularyModel:
        get = self.getOrDefault
        vocab = fit_vocabulary(
            dataset, get("inputCol"), max_features=get("maxFeatures"), min_df=get("minDF"), max_df=get("maxDF"), ngram_range=tuple(get("lengths")),
        )
        return self._model(NgramVocabularyModel, vocab)


class TfIdfModel(_Fitted):
    """Adds TF-IDF weights of length one, made from a row of counts."""

    holds = Vocabulary
    sublinear = Param(Params._dummy(), "sublinear", "whether counts enter as 1 + log", TypeConverters.toBoolean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return tfidf_features(dataset, get("inputCol"), self.fitted, get("outputCol"), get("sublinear"))


class TfIdf(_Fits):
    """Learns document frequencies from rows of counts, in one aggregation by feature."""

    sublinear = TfIdfModel.sublinear
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, sublinear=None, size=None):
        super().__init__()
        self._setDefault(inputCol="bow", outputCol="tfidf", sublinear=True, size=MAX_FEATURES)
        self._given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TfIdfModel:
        indices = F.col(f"{self.getOrDefault('inputCol')}.indices")
        # Index -1 counts the rows.
        counted = dataset.select(F.explode(F.concat(F.array(F.lit(-1)), F.coalesce(indices, F.array().cast("array<int>")))).alias("i"))
        found = {r["i"]: r["count"] for r in counted.groupBy("i").count().collect()}
        rows, size = found.pop(-1, 0), self.getOrDefault("size")
        df = [found.get(i, 0) for i in range(size)]
        return self._model(TfIdfModel, Vocabulary([f"{i}" for i in range(size)], df, df, rows))


class _Labelled(_Columns):
    labelCol = Param(Params._dummy(), "labelCol", "class of a row, 0 or 1", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)


class MultinomialNBModel(_Fitted):
    """Adds the more likely class; see ``classify.NaiveBayes``."""

    holds = NaiveBayes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.predict(dataset, self.getOrDefault("inputCol"), self.getOrDefault("outputCol")).drop("scores")


class MultinomialNB(_Fits, _Labelled):
    """Learns class and term probabilities from rows of counts."""

    alpha = Param(Params._dummy(), "alpha", "count added to every term", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol=None, size=None, alpha=None):
        super().__init__()
        self._setDefault(inputCol="bow", outputCol="prediction", labelCol="pos", size=MAX_FEATURES, alpha=ALPHA)
        self._given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MultinomialNBModel:
        get = self.getOrDefault
        return self._model(MultinomialNBModel, fit_naive_bayes(dataset, get("inputCol"), get("labelCol"), get("size"), get("alpha")))


class SquaredHingeSVMModel(_Fitted):
    """Adds class 1 where the margin is positive."""

    holds = LinearSVM

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.predict(dataset, self.getOrDefault("inputCol"), self.getOrDefault("outputCol"))


class SquaredHingeSVM(_Fits, _Labelled):
    """Learns linear weights from sparse rows; see ``svm.fit_squared_hinge``."""

    c = Param(Params._dummy(), "c", "inverse regularization", TypeConverters.toFloat)
    balanced = Param(Params._dummy(), "balanced", "whether both classes weigh the same", TypeConverters.toBoolean)
    tolerance = Param(Params._dummy(), "tolerance", "largest norm of the gradient at the end", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol=None, size=None, c=None, balanced=None, tolerance=None):
        super().__init__()
        self._setDefault(inputCol="tfidf", outputCol="prediction", labelCol="pos", size=MAX_FEATURES, c=SVM_C, balanced=False, tolerance=TOLERANCE)
        self._given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SquaredHingeSVMModel:
        get = self.getOrDefault
        weight = "balanced" if get("balanced") else None
        return self._model(SquaredHingeSVMModel, fit_squared_hinge(dataset, get("labelCol"), get("inputCol"), get("size"), get("c"), weight, get("tolerance")))
