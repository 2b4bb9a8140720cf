"""Soft voting and stacking."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.config import CV_FOLDS, LR_C, META_C, SEED, STACKING_FOLDS, SVC_C
from folio.models import batched
from folio.functions.text import clean_tokens, vectorizer_terms
from folio.models.linear import (
    BOW_LR,
    TFIDF_LR,
    FittedModel,
    TrainingSet,
    fit_text_model,
    label_position,
    logistic_regression,
    with_terms,
)
from folio.models.naive_bayes import (
    NaiveBayesModel,
    naive_bayes_fit,
    naive_bayes_predict,
    predicted_class,
    softmax,
)
from folio.operators.ranking import hash_rank, seeded_digest
from folio.operators.splits import stratified_kfold
from folio.operators.terms import term_counts
from folio.session import stage


def predict_class(probabilities: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Adds the class ``p`` of the largest of ``scores``; ties go to the lowest index."""
    return probabilities.withColumn("p", predicted_class(F.col("scores"), classes))


def soft_voting(probabilities: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Mean of the models' class probabilities per document, and its argmax.

    Input ``model, id, scores`` with scores in class order.
    """
    means = probabilities.groupBy("id").agg(
        F.array(*[F.avg(F.get("scores", F.lit(i))) for i in range(len(classes))]).alias("scores")
    )
    return predict_class(means, classes)


@dataclass(frozen=True)
class FittedNaiveBayes:
    """Naive Bayes over raw text, with the interface of the linear models."""

    model: NaiveBayesModel
    name: str = "bow_nb"

    def predict_proba(self, df: DataFrame) -> DataFrame:
        scored = naive_bayes_predict(self.model, _postings(df, ("id",)), df)
        kept = [c for c in df.columns if c != "terms"]
        return scored.withColumn("scores", softmax(F.col("scores"))).select(*kept, "scores")


def _postings(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Counts of single words, of texts or of rows that have one- and two-word terms."""
    if "terms" in df.columns:
        return term_counts(df, F.filter("terms", lambda t: ~F.contains(t, F.lit(" "))), keep)
    return term_counts(df, vectorizer_terms(clean_tokens(F.col("text"))), keep)


def fit_naive_bayes(train: DataFrame, classes: Sequence[str]) -> FittedNaiveBayes:
    return FittedNaiveBayes(naive_bayes_fit(_postings(train, ("id", "label")), train, classes))


@dataclass(frozen=True)
class VotingModel:
    members: tuple[FittedModel, ...]
    classes: tuple[str, ...]

    def predict(self, df: DataFrame) -> DataFrame:
        """``id, scores, p`` of every document."""
        rows = with_terms(df)
        parts = [m.predict_proba(rows).select("id", "scores") for m in self.members]
        return soft_voting(reduce(DataFrame.unionByName, parts), self.classes)


def fit_together(spark: SparkSession, fits: Sequence[Callable], parallelism: int = 4) -> list:
    """Run independent fits at the same time: each leaves the cluster idle between iterations."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda fit: inheritable_thread_target(spark)(fit)(), fits))


def fit_voting(train: DataFrame | TrainingSet, classes: Sequence[str]) -> VotingModel:
    """The TF-IDF and the bag-of-words logistic regressions, on one vocabulary and one count matrix."""
    data = train if isinstance(train, TrainingSet) else TrainingSet(train, classes)
    fits = [lambda s=spec: fit_text_model(s, data) for spec in (TFIDF_LR, BOW_LR)]
    return VotingModel(tuple(fit_together(data.rows.sparkSession, fits)), tuple(classes))


def _base_fits(data: TrainingSet) -> list[Callable]:
    return [
        lambda: fit_text_model(TFIDF_LR, data),
        lambda: fit_text_model(BOW_LR, data),
        lambda: fit_naive_bayes(data.rows, data.classes),
    ]


def _meta_features(bases: Sequence, df: DataFrame) -> DataFrame:
    """``df`` without its terms, plus ``features``: the base probabilities one after the other."""
    rows, names = df.drop("terms"), []
    for i, base in enumerate(bases):
        found = base.predict_proba(df.select("id", "terms")).withColumnRenamed("scores", f"__p{i}")
        rows = rows.join(found, "id")
        names.append(f"__p{i}")
    return rows.withColumn("features", array_to_vector(F.concat(*names))).drop(*names)


@dataclass(frozen=True)
class StackingModel:
    bases: tuple
    meta: FittedModel

    def predict(self, df: DataFrame) -> DataFrame:
        """``id, p`` of every document."""
        return self.meta.predict(_meta_features(self.bases, with_terms(df).select("id", "terms"))).select("id", "p")


def fit_stacking(
    train: DataFrame, classes: Sequence[str], k: int = STACKING_FOLDS, c: float = META_C
) -> StackingModel:
    """Logistic regression on out-of-fold probabilities of three base models.

    Every inner fold fits the bases, vocabularies included, on the other folds; the
    bases are then refitted on all rows. ``train`` has ``id, label`` and ``text`` or ``terms``. Terms are cleaned
    once for all folds, and each training set has one count matrix.
    """
    rows = with_terms(train)
    folds = stratified_kfold(rows.select("id", "label"), k)
    folded = stage(rows.join(folds.select("id", "fold"), "id"), "stacking-folds")
    trains = [folded.filter(F.col("fold") != fold).drop("fold") for fold in range(k)]
    sets = fit_together(
        train.sparkSession, [lambda t=part: TrainingSet(t, classes) for part in [*trains, folded.drop("fold")]]
    )
    fitted = fit_together(train.sparkSession, [fit for data in sets for fit in _base_fits(data)])
    size = len(fitted) // (k + 1)
    groups = [fitted[i : i + size] for i in range(0, len(fitted), size)]
    held_out = []
    for fold in range(k):
        part = folded.filter(F.col("fold") == fold).drop("fold")
        held_out.append(_meta_features(groups[fold], part).select("id", "label", "features"))
    meta_rows = stage(
        reduce(DataFrame.unionByName, held_out).withColumn(
            "label_idx", label_position(F.col("label"), classes)
        ),
        "stacking-meta",
    )
    meta = logistic_regression(meta_rows.count(), c, max_iter=500).fit(meta_rows)
    return StackingModel(tuple(groups[k]), FittedModel("ensemble_stacking", tuple(classes), meta))


# the three base learners of the stack and its meta learner, as in the reference's ensemble
STACK_BASES = (
    batched.Learner("tfidf_lr", "logistic", "tfidf", c=LR_C, max_n=2),
    batched.Learner("bow_lr", "logistic", "counts", c=LR_C, max_n=2),
    batched.Learner("bow_nb", "naive_bayes", "counts", max_n=1),
)
STACK_META = batched.Learner("ensemble_stacking", "logistic", "raw", c=META_C, max_n=1, max_iter=500)


def stacking_out_of_fold(
    rows: DataFrame, classes: Sequence[str], outer_k: int = CV_FOLDS, inner_k: int = STACKING_FOLDS, seed: int = SEED
) -> DataFrame:
    """``fold, id, y, p``: out-of-fold classes of the stacked ensemble, every outer fold fitted in the same passes.

    ``rows`` has ``id, label`` and ``words`` or ``terms``. For outer fold o, the bases are fitted on the other outer folds without
    inner fold i (training set ``o * (inner_k + 1) + i``) to give the meta rows of inner fold i their
    probabilities, and on all other outer folds (set ``o * (inner_k + 1) + inner_k``) to score fold o. All
    ``outer_k * (inner_k + 1) * 3`` base models share one count matrix and one pass per step; the ``outer_k``
    meta regressions on the stacked probabilities too.
    """
    k = len(classes)
    per = inner_k + 1
    outer = stratified_kfold(rows.select("id", "label"), outer_k, seed=seed).withColumnRenamed("fold", "outer")
    # inner folds of every outer training set, in one ranking: (id, o) for every o but the row's own
    pairs = outer.select("id", "label", "outer", F.explode(F.filter(F.sequence(F.lit(0), F.lit(outer_k - 1)), lambda o: o != F.col("outer"))).alias("o"))
    inner = hash_rank(pairs, ["o", "label"], seeded_digest(F.col("id"), seed), "__r").withColumn(
        "inner", ((F.col("__r") - 1) % inner_k).cast("int")
    )
    own = F.concat(F.filter(F.sequence(F.lit(0), F.lit(inner_k - 1)), lambda i: i != F.col("inner")), F.array(F.lit(inner_k)))
    memberships = inner.groupBy("id").agg(
        F.flatten(F.collect_list(F.transform(own, lambda i: F.col("o") * per + i))).alias("sets"),
        F.collect_list(F.col("o") * per + F.col("inner")).alias("held"),
    )
    labelled = rows.join(outer.select("id", "outer"), "id").join(memberships, "id", "left")
    ready = labelled.select(
        "id",
        label_position(F.col("label"), classes).cast("int").alias("label_idx"),
        F.coalesce("sets", F.array().cast("array<int>")).alias("sets"),
        F.concat(F.coalesce("held", F.array().cast("array<int>")), F.array(F.col("outer") * per + inner_k)).alias("scored"),
        *[c for c in ("words", "terms") if c in rows.columns],
        "outer",
    )
    matrix = batched.build_matrix(ready.drop("outer"), STACK_BASES, k)
    bases = batched.fit(matrix, STACK_BASES)
    scores = stage(batched.predict(bases), "stacking-base-scores")
    # meta rows: per (document, outer fold o) the base probabilities of the set that held the row out
    meta = scores.groupBy("id", (F.col("set") / per).cast("int").alias("o")).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("learner", "scores"))), lambda x: x["scores"])).alias("x")
    )
    meta = meta.join(ready.select("id", "label_idx", "outer"), "id").select(
        "id",
        "label_idx",
        F.when(F.col("o") != F.col("outer"), F.array("o")).otherwise(F.array().cast("array<int>")).alias("sets"),
        F.when(F.col("o") == F.col("outer"), F.array("o")).otherwise(F.array().cast("array<int>")).alias("scored"),
        "x",
    )
    stacked = batched.fit(batched.dense_matrix(meta, len(STACK_BASES) * k, k), [STACK_META])
    final = batched.predict(stacked)
    return final.join(labelled.select("id", "label", "outer"), "id").select(
        F.col("outer").alias("fold"), "id", F.col("label").alias("y"), predicted_class(F.col("scores"), classes).alias("p")
    )


# the reference's single text classifiers, for the batched solver
TFIDF_LR_LEARNER = batched.Learner("tfidf_lr", "logistic", "tfidf", c=LR_C, max_n=2)
BOW_LR_LEARNER = batched.Learner("bow_lr", "logistic", "counts", c=LR_C, max_n=2)
TFIDF_SVC_LEARNER = batched.Learner("tfidf_svc", "squared_hinge", "tfidf", c=SVC_C, max_n=2)


def batched_out_of_fold(
    rows: DataFrame, classes: Sequence[str], learners: Sequence[batched.Learner], k: int = CV_FOLDS, seed: int = SEED
) -> DataFrame:
    """``fold, id, y, learner, scores``: every learner fitted on every fold's training rows in shared passes.

    ``rows`` has ``id, label`` and ``words`` or ``terms``, which may be lazy: they are read once; fold f's models are fitted on the other folds and score fold f.
    """
    folds = stratified_kfold(rows.select("id", "label"), k, seed=seed)
    ready = rows.join(folds.select("id", "fold"), "id").select(
        "id",
        label_position(F.col("label"), classes).cast("int").alias("label_idx"),
        F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col("fold")).alias("sets"),
        F.array("fold").alias("scored"),
        *[c for c in ("words", "terms") if c in rows.columns],
    )
    fitted = batched.fit(batched.build_matrix(ready, learners, len(classes)), learners)
    names = F.lit([learner.name for learner in learners])
    return batched.predict(fitted).join(rows.select("id", "label"), "id").select(
        F.col("set").alias("fold"), "id", F.col("label").alias("y"), F.get(names, F.col("learner")).alias("learner"), "scores"
    )


def batched_predictions(rows: DataFrame, classes: Sequence[str], learners: Sequence[batched.Learner]) -> DataFrame:
    """``fold, id, y, p``: the class of the mean of the learners' scores (one learner: its own class)."""
    scored = batched_out_of_fold(rows, classes, learners)
    mean = scored.groupBy("fold", "id", "y").agg(
        F.array(*[F.avg(F.get("scores", F.lit(i))) for i in range(len(classes))]).alias("scores")
    )
    return mean.select("fold", "id", "y", predicted_class(F.col("scores"), classes).alias("p"))
