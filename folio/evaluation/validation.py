"""Temporal validation and cross-validation runs."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import CUTOFF_MONTHS, CV_FOLDS, MIN_TEST_ROWS
from folio.evaluation.metrics import class_report, cv_summary, summary_scores
from folio.models.ensembles import fit_together
from folio.operators.dedupe import require_min_rows
from folio.operators.splits import stratified_kfold, temporal_split
from folio.session import stage

FitPredict = Callable[[DataFrame, DataFrame], DataFrame]
"""(train, test) -> test rows with the predicted class ``p``; both have id, label, text."""


def temporal_validation(
    df: DataFrame, fit_predict: FitPredict, *, model: str, months: int = CUTOFF_MONTHS, digits: int = 4
) -> DataFrame:
    """Train up to the cutoff, test after it: one row per class with the run's scores.

    ``df`` has ``id, label, text, date``.
    """
    split = temporal_split(df, months=months)
    train = split.filter(F.col("split") == "train").drop("split", "date")
    test = split.filter(F.col("split") == "test").drop("split", "date")
    require_min_rows(test.select("id"), MIN_TEST_ROWS)
    scored = fit_predict(train, test).select(F.col("label").alias("y"), "p")
    predictions = stage(scored, "temporal-predictions")
    report = class_report(predictions).select("class", "precision", "recall", "f1")
    scores = summary_scores(predictions).withColumn(
        "train_size", train.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    run = scores.select(F.struct("*").alias("run")).scalar()
    return report.select(
        F.lit(model).alias("model"),
        run["train_size"].alias("train_size"),
        run["size"].alias("test_size"),
        *[F.round(run[c], digits).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")],
        "class",
        *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")],
    )


def cross_predict(df: DataFrame, fit_predict: FitPredict, k: int = CV_FOLDS) -> DataFrame:
    """Out-of-fold predictions ``fold, id, y, p`` by fitting once per fold, several folds at a time.

    The training rows come in one partition per core: every pass of an optimiser sends a result per partition to the
    driver, so their number must not grow with the rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    folds = stratified_kfold(df.select("id", "label"), k).select("id", "fold")
    folded = stage(df.join(folds, "id"), "cv-folds")

    def run(fold: int) -> DataFrame:
        train = folded.filter(F.col("fold") != fold).drop("fold").coalesce(cores)
        test = folded.filter(F.col("fold") == fold).drop("fold")
        return fit_predict(train, test).select(F.lit(fold).alias("fold"), "id", F.col("label").alias("y"), "p")

    parts = fit_together(df.sparkSession, [lambda f=fold: run(f) for fold in range(k)])
    return reduce(DataFrame.unionByName, parts)


def cross_validate(
    predictions: Callable[[], DataFrame], model: str
) -> DataFrame:
    """Fold means and deviations of out-of-fold predictions, with the seconds they took."""
    start = time.monotonic()
    scored = stage(predictions(), f"cv-{model}")
    elapsed = round(time.monotonic() - start, 1)
    named = scored.withColumn("model", F.lit(model))
    return cv_summary(named).withColumn("train_time_s", F.lit(elapsed))
