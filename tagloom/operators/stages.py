"""The vectoriser and the per-label classifier as Spark ML stages: fit, transform, put into a Pipeline, save, load.

A saved stage is a folder with Spark's metadata (class, params and ``format``, a number that load() checks) and plain tables: terms with
index, idf and scale; coefficients by label; or MLlib's own folders for the models that MLlib fitted.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import features, forest, models
from tagloom.operators.linear import LinearModel
from tagloom.session import written

FORMAT = 1


def param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class TextParams(Params):
    identifier = param("identifier", "column of the record's id", TypeConverters.toString)
    inputCol = param("inputCol", "column of the text", TypeConverters.toString)
    outputCol = param("outputCol", "column of the features", TypeConverters.toString)
    vectorizer = param("vectorizer", "count or tf-idf", TypeConverters.toString)
    sublinear = param("sublinear", "1 + ln of the counts", TypeConverters.toBoolean)
    stopWords = param("stopWords", "name of a stop word list, or empty", TypeConverters.toString)
    ngram = param("ngram", "shortest and longest n-gram", TypeConverters.toListInt)
    scaled = param("scaled", "divide by the largest value of a term", TypeConverters.toBoolean)

    def counts(self, df: DataFrame) -> DataFrame:
        return features.count_vectorize(df, tuple(self.getOrDefault("ngram")), self.getOrDefault("stopWords") or None,
                                        self.getOrDefault("identifier"), self.getOrDefault("inputCol"))

    def weights(self, tf: DataFrame, idf: DataFrame) -> DataFrame:
        """(id, term, weight) before scaling."""
        if self.getOrDefault("vectorizer") == "count":
            return tf.join(idf.select("term"), "term").select("id", "term", F.col("tf").cast("double").alias("weight"))
        return features.weigh(tf, idf.select("term", "idf"), self.getOrDefault("sublinear"))


class TermVectorizer(Estimator, TextParams, DefaultParamsReadable, DefaultParamsWritable):
    """Counts or TF-IDF of the terms of a text as sparse vectors, scaled by the largest value of each term."""

    @keyword_only
    def __init__(self, *, identifier="id", inputCol="description", outputCol="features", vectorizer="tf-idf", sublinear=False,
                 stopWords="", ngram=(1, 1), scaled=True):
        super().__init__()
        self._setDefault(identifier="id", inputCol="description", outputCol="features", vectorizer="tf-idf", sublinear=False,
                         stopWords="", ngram=[1, 1], scaled=True)
        self._set(**{k: list(v) if k == "ngram" else v for k, v in self._input_kwargs.items()})
        if self.getOrDefault("vectorizer") not in features.VECTORIZERS:
            raise ValueError(f"unknown vectorizer {self.getOrDefault('vectorizer')!r}; known: {features.VECTORIZERS}")

    def _fit(self, df: DataFrame) -> TermVectorizerModel:
        tf = written(self.counts(df), "counts")
        known = features.vocabulary(tf).join(features.inverse_frequency(tf, df), "term")
        if self.getOrDefault("scaled"):
            known = known.join(features.max_abs_fit(self.weights(tf, features.inverse_frequency(tf, df))), "term", "left")
        else:
            known = known.withColumn("scale", F.lit(1.0))
        terms = known.select("term", F.col("index").cast("int").alias("index"), "idf", F.coalesce(F.nullif("scale", F.lit(0.0)), F.lit(1.0)).alias("scale"))
        return self._copyValues(TermVectorizerModel(written(terms, "terms")))


class TermVectorizerModel(Model, TextParams, MLReadable, MLWritable):
    """terms: (term, index, idf, scale)."""

    def __init__(self, terms: DataFrame | None = None):
        super().__init__()
        self.terms = terms
        self.size = terms.count() if terms is not None else 0

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its vectors; terms that were not fitted are left out. Ids that repeat share one vector of all their terms."""
        id, out = self.getOrDefault("identifier"), self.getOrDefault("outputCol")
        weights = self.weights(self.counts(df), self.terms).join(self.terms.select("term", "scale"), "term") \
            .select("id", "term", (F.col("weight") / F.col("scale")).alias("weight"))
        rows = features.sparse_rows(weights, self.terms.select("term", "index"), self.size, df.select(F.col(id).alias("id")).distinct())
        return df.join(rows.select(F.col("id").alias("_id"), F.col("features").alias(out)), F.col(id).eqNullSafe(F.col("_id"))).drop("_id")

    def write(self) -> MLWriter:
        return StageWriter(self, {}, lambda path: self.terms.write.parquet(f"{path}/terms"))

    @classmethod
    def read(cls) -> MLReader:
        return StageReader(cls, lambda spark, path, extra: cls(spark.read.parquet(f"{path}/terms")))


class LabelParams(Params):
    labelsCol = param("labelsCol", "column of the label arrays", TypeConverters.toString)
    featuresCol = param("featuresCol", "column of the vectors", TypeConverters.toString)
    outputCol = param("outputCol", "column of the probabilities", TypeConverters.toString)
    estimator = param("estimator", "name of the estimator", TypeConverters.toString)
    vocabulary = param("vocabulary", "the labels, in the order of the probabilities", TypeConverters.toListString)
    classWeight = param("classWeight", "balanced, or empty", TypeConverters.toString)


class PerLabelClassifier(Estimator, LabelParams, DefaultParamsReadable, DefaultParamsWritable):
    """One binary model per label of the vocabulary, see models.fit_multilabel."""

    @keyword_only
    def __init__(self, *, vocabulary=(), estimator="lreg", classWeight="", labelsCol="labels", featuresCol="features", outputCol="proba"):
        super().__init__()
        self._setDefault(vocabulary=[], estimator="lreg", classWeight="", labelsCol="labels", featuresCol="features", outputCol="proba")
        self._set(**{k: list(v) if k == "vocabulary" else v for k, v in self._input_kwargs.items()})
        if self.getOrDefault("estimator") not in models.ESTIMATORS:
            raise ValueError(f"unknown estimator {self.getOrDefault('estimator')!r}; known: {', '.join(models.ESTIMATORS)}")

    def _fit(self, df: DataFrame) -> PerLabelModel:
        rows = df.select(F.monotonically_increasing_id().alias("id") if "id" not in df.columns else "id",
                         F.col(self.getOrDefault("featuresCol")).alias("features"), F.col(self.getOrDefault("labelsCol")).alias("labels"))
        fitted = models.fit_multilabel(rows, self.getOrDefault("vocabulary"), self.getOrDefault("estimator"), self.getOrDefault("classWeight") or None)
        return self._copyValues(PerLabelModel(fitted))


class PerLabelModel(Model, LabelParams, MLReadable, MLWritable):
    def __init__(self, fitted: models.MultiLabelModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        source, out = self.getOrDefault("featuresCol"), self.getOrDefault("outputCol")
        if source == "features":
            return self.fitted.predict_proba(df, out)
        kept = [c for c in df.columns if c != "features"]
        return self.fitted.predict_proba(df.select(*kept, F.col(source).alias("features")), out).drop("features")

    def write(self) -> MLWriter:
        m = self.fitted
        extra = {"name": m.name, "odds": m.odds, "models": {v: len(m.models[v]) for v in m.vocabulary},
                 "forests": any(isinstance(model, forest.Forest) for v in m.vocabulary for model in m.models[v])}
        return StageWriter(self, extra, lambda path: save_models(m, path))

    @classmethod
    def read(cls) -> MLReader:
        return StageReader(cls, lambda spark, path, extra: cls(load_models(spark, path, extra)))


def save_models(m: models.MultiLabelModel, path: str) -> None:
    if m.name == "lreg":
        rows = [(i, model.intercept, model.coefficients.toArray().tolist()) for i, v in enumerate(m.vocabulary) for model in m.models[v]]
        spark = SparkSession.active()
        spark.createDataFrame(rows, "place int, intercept double, coefficients array<double>").write.parquet(f"{path}/coefficients")
        return
    for i, v in enumerate(m.vocabulary):
        for j, model in enumerate(m.models[v]):
            model.save(f"{path}/models/{i}/{j}")


def load_models(spark: SparkSession, path: str, extra: dict) -> models.MultiLabelModel:
    names = list(extra["models"])
    if extra["name"] == "lreg":
        found = sorted(spark.read.parquet(f"{path}/coefficients").collect())  # a row per label
        loaded = {names[r["place"]]: [LinearModel(DenseVector(np.array(r["coefficients"])), r["intercept"])] for r in found}
    elif extra.get("forests"):
        loaded = {v: [forest.load(spark, f"{path}/models/{i}/0")] for i, v in enumerate(names)}
    else:
        loaded = {v: [DefaultParamsReader.loadParamsInstance(f"{path}/models/{i}/{j}", spark) for j in range(extra["models"][v])]
                  for i, v in enumerate(names)}
    return models.MultiLabelModel(extra["name"], names, loaded, extra["odds"])


class StageWriter(MLWriter):
    def __init__(self, stage, extra: dict, tables):
        super().__init__()
        self.stage, self.extra, self.tables = stage, extra, tables

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, {"format": FORMAT, "extra": self.extra})
        self.tables(path)


class StageReader(MLReader):
    def __init__(self, cls, build):
        super().__init__()
        self.cls, self.build = cls, build

    def load(self, path: str):
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession, f"{self.cls.__module__}.{self.cls.__name__}")
        if found.get("format") != FORMAT:
            raise ValueError(f"{path}: format {found.get('format')!r} of this stage is not known, only {FORMAT}")
        stage = self.build(self.sparkSession, path, found["extra"])
        stage._resetUid(found["uid"])
        DefaultParamsReader.getAndSetParams(stage, found)
        return stage
