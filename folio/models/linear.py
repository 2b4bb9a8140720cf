"""Linear classifiers on text or dense features, and fitted text pipelines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from threading import Lock

import numpy as np
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.config import LR_C, SVC_C
from folio.models.vectorize import DropColumns, TextCleaner, TextVectorizer, TfidfScaler
from folio.operators.encode import class_list
from folio.operators.terms import count_rows, fit_vocabulary
from folio.session import stage

def logistic_regression(n_rows: int, c: float = LR_C, max_iter: int = 1000, tol: float = 1e-2) -> LogisticRegression:
    """Multinomial logistic regression with an L2 penalty of strength 1/C.

    ``tol`` bounds MLlib's relative improvement of the loss, not a gradient: on TF-IDF weights 1e-2 takes 46 steps
    where 1e-4 takes 210, and both predict the same class for every row.
    """
    return LogisticRegression(
        family="multinomial", regParam=1.0 / (c * n_rows), elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, tol=tol, labelCol="label_idx", featuresCol="features",
    )


def linear_svc(n_rows: int, c: float = SVC_C, max_iter: int = 100, tol: float = 1e-4) -> LinearSVC:
    """Binary linear SVM (hinge loss) with penalty 1/C."""
    return LinearSVC(
        regParam=1.0 / (c * n_rows), standardization=False, maxIter=max_iter, tol=tol,
        labelCol="label_idx", featuresCol="features",
    )


def one_vs_rest(classifier: Estimator, parallelism: int = 4) -> OneVsRest:
    """One binary model per class."""
    return OneVsRest(
        classifier=classifier, parallelism=parallelism, labelCol="label_idx", featuresCol="features"
    )


def label_position(label: Column, classes: Sequence[str]) -> Column:
    """Index of a label in the class list, as MLlib wants it."""
    return (F.array_position(F.lit(list(classes)), label) - 1).cast("double")


@dataclass(frozen=True)
class TextModelSpec:
    """A text classifier: vectoriser settings and learner ("lr" or "svc")."""

    name: str
    tfidf: bool
    max_n: int
    learner: str
    c: float

    def vectorizer(self) -> TextVectorizer:
        return TextVectorizer(maxN=self.max_n, tfidf=self.tfidf)

    def classifier(self, n_rows: int) -> Estimator:
        if self.learner == "lr":
            return logistic_regression(n_rows, self.c)
        return one_vs_rest(linear_svc(n_rows, self.c))


BOW_LR = TextModelSpec("bow_lr", tfidf=False, max_n=2, learner="lr", c=LR_C)
TFIDF_LR = TextModelSpec("tfidf_lr", tfidf=True, max_n=2, learner="lr", c=LR_C)
TFIDF_SVC = TextModelSpec("tfidf_svc", tfidf=True, max_n=2, learner="svc", c=SVC_C)
SPECS = {spec.name: spec for spec in (BOW_LR, TFIDF_LR, TFIDF_SVC)}


@dataclass(frozen=True)
class FittedModel:
    """A fitted pipeline with the class names of its label indices."""

    name: str
    classes: tuple[str, ...]
    pipeline: Transformer

    def _apply(self, df: DataFrame) -> DataFrame:
        """The pipeline on ``text``, or from ``terms`` on where the rows were cleaned already."""
        if "terms" in df.columns:
            return PipelineModel(self.pipeline.stages[1:]).transform(df)
        return self.pipeline.transform(df)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds the predicted class ``p``; ``terms`` are dropped."""
        names = F.lit(list(self.classes))
        predicted = self._apply(df).withColumn("p", F.get(names, F.col("prediction").cast("int")))
        return predicted.select(*[c for c in df.columns if c != "terms"], "p")

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Adds ``scores``: the class probabilities in class order, 0 for a class the training rows lacked."""
        found = vector_to_array("probability")
        scores = F.array(*[F.coalesce(F.get(found, F.lit(i)), F.lit(0.0)) for i in range(len(self.classes))])
        return self._apply(df).withColumn("scores", scores).select(*[c for c in df.columns if c != "terms"], "scores")


def with_terms(df: DataFrame, max_n: int = 2) -> DataFrame:
    """``text`` cleaned to ``terms``, written once; rows that have ``terms`` stay as they are."""
    if "terms" in df.columns:
        return df
    return stage(TextCleaner(maxN=max_n).transform(df).drop("text"), "terms")


class TrainingSet:
    """The rows of one fit with their vocabulary and features, which all models fitted on them share.

    Texts are cleaned once, the vocabulary is counted once, and the count matrix is written once; TF-IDF weights are derived
    from that matrix. Rows without a known term keep an empty vector.
    """

    def __init__(self, train: DataFrame, classes: Sequence[str] | None = None, max_n: int = 2):
        self.rows = with_terms(train, max_n)
        self.classes = tuple(classes or class_list(self.rows))
        self.max_n = max_n
        kept = fit_vocabulary(self.rows.select("terms"), count_rows(self.rows)).select("term", "idf").collect()
        if not kept:
            raise ValueError("no term survives the document frequency limits")
        kept.sort()
        self.terms, self.idf = [r["term"] for r in kept], [r["idf"] for r in kept]
        labelled = self.rows.select("terms", label_position(F.col("label"), self.classes).alias("label_idx"))
        self._features = {False: stage(self._counter().transform(labelled).drop("terms"), "counts")}
        self.n_rows = self._features[False].count()
        self._lock = Lock()

    def _counter(self, output: str = "features") -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(self.terms, inputCol="terms", outputCol=output)

    def features(self, tfidf: bool) -> DataFrame:
        """``label_idx, features``: counts, or the weights made of them."""
        with self._lock:
            if tfidf not in self._features:
                counts = self._features[False].withColumnRenamed("features", "counts")
                self._features[tfidf] = stage(TfidfScaler(idf=self.idf).transform(counts), "weights")
        return self._features[tfidf]

    def stages(self, tfidf: bool) -> list[Transformer]:
        """From text to features."""
        cleaner, drop = TextCleaner(maxN=self.max_n), DropColumns(columns=["terms"])
        if tfidf:
            return [cleaner, self._counter("counts"), drop, TfidfScaler(idf=self.idf)]
        return [cleaner, self._counter(), drop]


def fit_text_model(spec: TextModelSpec, train: DataFrame | TrainingSet, classes: Sequence[str] | None = None) -> FittedModel:
    """Clean, vectorise and classify ``text`` (or ``terms``) with ``label`` as one fitted pipeline."""
    data = train if isinstance(train, TrainingSet) else TrainingSet(train, classes, spec.max_n)
    classifier = spec.classifier(data.n_rows).fit(data.features(spec.tfidf))
    return FittedModel(spec.name, data.classes, PipelineModel([*data.stages(spec.tfidf), classifier]))


def logistic_fit(train: DataFrame, spec: TextModelSpec = TFIDF_LR) -> FittedModel:
    return fit_text_model(spec, train)


def linear_svc_fit(train: DataFrame, spec: TextModelSpec = TFIDF_SVC) -> FittedModel:
    return fit_text_model(spec, train)


def dense_features(df: DataFrame, vector: str) -> DataFrame:
    """Adds MLlib ``features`` from an array column."""
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def embedding_classifier(
    train: DataFrame, vector: str = "embedding", c: float = LR_C, classes: Sequence[str] | None = None
) -> FittedModel:
    """Logistic regression on dense vectors; ``predict`` wants ``features`` too."""
    classes = tuple(classes or class_list(train))
    rows = dense_features(train, vector).withColumn("label_idx", label_position(F.col("label"), classes))
    model = logistic_regression(rows.count(), c).fit(rows)
    return FittedModel("emb_lr", classes, model)


def sparse_rows(docs: DataFrame, postings: DataFrame, columns: DataFrame, size: int) -> DataFrame:
    """``docs`` with MLlib ``features`` from their postings and a ``(term, term_idx)`` table of ``size`` selected terms.

    A document collects at most ``size`` entries; one without a selected term has an empty vector. Staged, because
    optimisers read it many times.
    """
    joined = postings.join(columns.select("term", "term_idx"), "term")
    entries = joined.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("term_idx").cast("int").alias("i"), F.col("n").cast("double").alias("x")))).alias("__entries")
    )
    rows = docs.join(entries, "id", "left").withColumn("__entries", F.coalesce("__entries", F.array().cast("array<struct<i:int,x:double>>")))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.transform("__entries", lambda e: e["i"]).alias("indices"),
        F.transform("__entries", lambda e: e["x"]).alias("values"),
    )
    schema = T.StructType([*docs.schema.fields, T.StructField("features", VectorUDT())])
    # the written struct is the storage form of a vector, so it is read back as one
    return stage(rows.select(*docs.columns, vector.alias("features")), "sparse-rows", schema)


def coefficient_weights(spark: SparkSession, model: FittedModel) -> DataFrame:
    """``label, term, weight`` of a fitted linear text pipeline, for ``top_features_per_class``.

    One row per term goes out with its coefficients as an array; the classes are unfolded by Spark.
    """
    terms = next(s.vocabulary for s in model.pipeline.stages if isinstance(s, CountVectorizerModel))
    fitted = model.pipeline.stages[-1]
    if isinstance(fitted, OneVsRestModel):
        columns = np.stack([m.coefficients.toArray() for m in fitted.models], 1)
    else:
        columns = fitted.coefficientMatrix.toArray().T
    rows = spark.createDataFrame(list(zip(terms, columns.tolist())), "term string, weights array<double>")
    names = F.lit(list(model.classes))
    return rows.select("term", F.posexplode("weights").alias("c", "weight")).select(F.get(names, F.col("c")).alias("label"), "term", "weight")


def stored_entries(df: DataFrame, key: str = "id", vector: str = "features") -> DataFrame:
    """``key, term_idx, weight``: a row per stored entry of sparse vectors.

    Written as vectors and read back in their storage form, so nothing turns dense.
    """
    storage = T.StructType([df.schema[key], T.StructField(vector, VectorUDT.sqlType())])
    stored = stage(df.select(key, vector), "entries", storage)
    pairs = F.arrays_zip(F.col(f"{vector}.indices").alias("i"), F.col(f"{vector}.values").alias("v"))
    return stored.select(key, F.explode(pairs).alias("e")).select(
        key, F.col("e.i").alias("term_idx"), F.col("e.v").alias("weight")
    )
