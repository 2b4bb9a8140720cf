"""Multinomial naive Bayes as aggregates over postings.

Closed form, so it is fitted with one aggregation by term and scored with one join and
one aggregation by document; both combine map-side. The class
prior is not smoothed (MLlib's is).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.config import MAX_DF, MAX_FEATURES, MIN_DF, NB_ALPHA
from folio.operators.terms import prune_by_df, top_vocabulary
from folio.session import stage


@dataclass(frozen=True)
class NaiveBayesModel:
    """``weights``: term, w (log theta per class); ``prior``: one row of log priors."""

    classes: tuple[str, ...]
    weights: DataFrame
    prior: DataFrame


def _class_array(classes: Sequence[str], cell) -> Column:
    return F.array(*[cell(c) for c in classes])


def class_documents(labels: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row: ``docs`` per class (array)."""
    return labels.agg(_class_array(classes, lambda c: F.count_if(F.col("label") == c)).alias("docs"))


def term_class_stats(postings: DataFrame, classes: Sequence[str]) -> DataFrame:
    """``term, df, total, counts`` with counts per class, in one shuffle by term."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("n").alias("total"),
        _class_array(
            classes, lambda c: F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0))
        ).alias("counts"),
    )


def _sum_array(column: Column) -> Column:
    return F.aggregate(column, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def log_prior(docs: DataFrame) -> DataFrame:
    """Unsmoothed log priors of one row of class document counts."""
    total = _sum_array(F.col("docs"))
    return docs.select(F.transform("docs", lambda d: F.when(d > 0, F.log(d / total)).otherwise(float("-inf"))).alias("prior"))


def log_theta(
    vocabulary: DataFrame, classes: Sequence[str], alpha: float = NB_ALPHA, by: Sequence[str] = ()
) -> DataFrame:
    """``by, term, w``: smoothed log probabilities per class over the kept vocabulary.

    ``by`` keeps the vocabularies of several runs apart (one row of totals per run).
    """
    k = range(len(classes))
    totals = F.struct(
        F.count(F.lit(1)).alias("size"),
        F.array(*[F.sum(F.get("counts", F.lit(i))) for i in k]).alias("sums"),
    ).alias("__t")
    if by:
        rows = vocabulary.join(vocabulary.groupBy(*by).agg(totals), list(by))
        total = F.col("__t")
    else:
        rows, total = vocabulary, vocabulary.agg(totals).scalar()
    smooth = F.lit(alpha)
    weights = [
        F.log(
            (F.get("counts", F.lit(i)) + smooth)
            / (F.get(total["sums"], F.lit(i)) + smooth * total["size"])
        )
        for i in k
    ]
    return rows.select(*by, "term", F.array(*weights).alias("w"))


def naive_bayes_fit(
    postings: DataFrame, labels: DataFrame, classes: Sequence[str], *, alpha: float = NB_ALPHA,
    min_df: int = MIN_DF, max_df: float = MAX_DF, max_features: int | None = MAX_FEATURES,
) -> NaiveBayesModel:
    """Fit on postings ``(id, label, term, n)`` and ``labels`` (a row per document).

    The kept vocabulary is staged: class totals and weights read it again.
    """
    docs = class_documents(labels, classes)
    n_docs = docs.select(_sum_array(F.col("docs")).alias("n")).scalar()
    stats = stage(prune_by_df(term_class_stats(postings, classes), n_docs, min_df, max_df), "nb-vocabulary")
    vocabulary = top_vocabulary(stats, max_features)
    return NaiveBayesModel(tuple(classes), log_theta(vocabulary, classes, alpha), log_prior(docs))


def joint_log_likelihood(
    postings: DataFrame, docs: DataFrame, weights: DataFrame, prior: Column, k: int, *,
    on: Sequence[str] = ("term",),
) -> DataFrame:
    """``docs`` columns plus ``scores`` (array per class) of every document.

    A document's postings sit in one task, so the partial sums leave one row per
    document for the shuffle. Documents without known terms keep their priors.
    """
    keys = list(on)
    joined = postings.join(weights, keys)
    sums = joined.groupBy("id").agg(
        *[F.sum(F.col("n") * F.get("w", F.lit(i))).alias(f"__s{i}") for i in range(k)]
    )
    scores = F.array(
        *[F.coalesce(f"__s{i}", F.lit(0.0)) + F.get(prior, F.lit(i)) for i in range(k)]
    )
    return (
        docs.join(sums, "id", "left")
        .withColumn("scores", scores)
        .drop(*[f"__s{i}" for i in range(k)])
    )


def predicted_class(scores: Column, classes: Sequence[str]) -> Column:
    """Class of the largest score; ties go to the lowest index."""
    return F.get(F.lit(list(classes)), F.array_position(scores, F.array_max(scores)).cast("int") - 1)


def softmax(scores: Column) -> Column:
    """Class probabilities of joint log likelihoods."""
    shifted = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    return F.transform(
        shifted, lambda e: e / F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    )


def naive_bayes_predict(model: NaiveBayesModel, postings: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` plus ``scores`` and the predicted class ``p``."""
    scored = joint_log_likelihood(
        postings.select("id", "term", "n"),
        docs,
        model.weights,
        model.prior.scalar(),
        len(model.classes),
    )
    return scored.withColumn("p", predicted_class(F.col("scores"), model.classes))


def naive_bayes_cross_predict(
    postings: DataFrame, docs: DataFrame, classes: Sequence[str], k: int, *, alpha: float = NB_ALPHA,
    min_df: int = MIN_DF, max_df: float = MAX_DF, max_features: int = MAX_FEATURES,
) -> DataFrame:
    """Out-of-fold predictions ``id, label, fold, scores, p`` of all k folds from one pass.

    Counts per (term, class, fold) are aggregated once; a fold's training counts are
    the totals minus its own, for document frequencies and class sizes alike. The
    vocabulary limits are applied per fold to those differences, so nothing leaks from
    a test fold. ``postings`` and ``docs`` carry ``label`` and ``fold``.
    """
    folds, indices = range(k), range(len(classes))
    numbered = postings.select(
        "term", "n", "fold", (F.array_position(F.lit(list(classes)), F.col("label")) - 1).alias("c")
    )
    cell = ", ".join(
        "array(" + ", ".join(f"sum(if(fold = {f} AND c = {i}, n, 0))" for i in indices) + ")" for f in folds
    )
    stats = stage(
        numbered.groupBy("term").agg(
            F.count(F.lit(1)).alias("df"),
            F.expr("array(" + ", ".join(f"count_if(fold = {f})" for f in folds) + ")").alias("dfs"),
            F.expr("array(" + ", ".join(f"sum(if(c = {i}, n, 0))" for i in indices) + ")").alias("counts"),
            F.expr(f"array({cell})").alias("cells"),
        ),
        "nb-fold-stats",
    )
    sizes = docs.groupBy("fold").agg(
        _class_array(classes, lambda c: F.count_if(F.col("label") == c)).alias("docs")
    )
    sizes = {row["fold"]: row["docs"] for row in sizes.collect()}  # k rows
    weights, priors = [], []
    for f in folds:
        train_docs = [sum(sizes[g][i] for g in sizes if g != f) for i in indices]
        train = stats.select(
            "term",
            (F.col("df") - F.get("dfs", F.lit(f))).alias("df"),
            F.zip_with("counts", F.get("cells", F.lit(f)), lambda total, held: total - held).alias("counts"),
        ).withColumn("total", _sum_array(F.col("counts")))
        kept = top_vocabulary(
            prune_by_df(train, F.lit(sum(train_docs)), min_df, max_df), max_features
        )
        weights.append(kept.withColumn("fold", F.lit(f)))
        priors.append((f, [math.log(n / sum(train_docs)) if n else -math.inf for n in train_docs]))
    vocabulary = stage(_union(weights), "nb-fold-vocabulary")
    theta = log_theta(vocabulary, classes, alpha, by=("fold",))
    prior_rows = F.create_map(*[F.lit(part) for pair in priors for part in pair])
    scored = joint_log_likelihood(
        postings.select("id", "fold", "term", "n"),
        docs,
        theta,
        F.try_element_at(prior_rows, F.col("fold")),
        len(classes),
        on=("fold", "term"),
    )
    return scored.withColumn("p", predicted_class(F.col("scores"), classes))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
