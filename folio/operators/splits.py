"""Folds, temporal and random splits, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.config import BATCH_SIZE, CUTOFF_MONTHS, CV_FOLDS, SEED
from folio.operators.ranking import hash_rank, seeded_digest, staged_rank


def stratified_kfold(
    df: DataFrame, k: int = CV_FOLDS, *, key: str = "id", label: str = "label", seed: int = SEED
) -> DataFrame:
    """Adds ``fold`` (0..k-1); the fold sizes of each class differ by at most one."""
    ranked = hash_rank(df, [label], seeded_digest(F.col(key), seed), "__rank")
    return ranked.withColumn("fold", ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def temporal_cutoff(df: DataFrame, date: str = "date", months: int = CUTOFF_MONTHS) -> Column:
    """Latest date minus calendar months, clamped to the month's end, as a scalar subquery."""
    latest = df.agg(F.max(date).alias("latest"))
    return latest.select(F.expr(f"latest - make_ym_interval(0, {int(months)})").alias("cutoff")).scalar()


def temporal_split(df: DataFrame, date: str = "date", months: int = CUTOFF_MONTHS) -> DataFrame:
    """Dated rows with ``split``: test after the cutoff, train up to it."""
    cutoff = temporal_cutoff(df, date, months)
    dated = df.dropna(subset=[date])
    return dated.withColumn(
        "split", F.when(F.col(date) > cutoff, F.lit("test")).otherwise(F.lit("train"))
    )


def random_split(df: DataFrame, share: float = 0.5, *, key: str = "id", seed: int = SEED) -> DataFrame:
    """Adds ``split``: exactly floor(share * n) train rows, the rest valid."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = hash_rank(df, [], seeded_digest(F.col(key), seed), "__rank")
    train = F.col("__rank") <= F.floor(F.lit(share) * total)
    return ranked.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("valid"))).drop("__rank")


def assign_batches(df: DataFrame, by: Sequence[str], order: Sequence[str], size: int = BATCH_SIZE) -> DataFrame:
    """Adds ``batch`` (from 0): consecutive runs of ``size`` rows per group, the last one short."""
    ranked = staged_rank(df, by, order, "__rank")
    return ranked.withColumn("batch", F.floor((F.col("__rank") - 1) / size)).drop("__rank")
