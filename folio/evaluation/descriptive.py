"""Descriptive aggregates of the corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preprocess(df: DataFrame, text: str = "body", **flags) -> DataFrame:
    """Adds ``text_clean``, ``n_tokens`` and ``n_chars``; a null text counts as empty."""
    from folio.functions.text import clean_tokens

    tokens = clean_tokens(F.coalesce(F.col(text), F.lit("")), **flags)
    # the token array is a column of its own so that it is built once per row
    return (
        df.withColumn("__tokens", tokens)
        .withColumns({"text_clean": F.array_join("__tokens", " "), "n_tokens": F.size("__tokens")})
        .withColumn("n_chars", F.length("text_clean"))
        .drop("__tokens")
    )


def class_counts(df: DataFrame, label: str = "category") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)


def date_range(df: DataFrame, label: str = "category", date: str = "date") -> DataFrame:
    """First and last day per class and over all (class ``*``); ``?`` without any date."""

    def day(column):
        return F.coalesce(F.date_format(column, "yyyy-MM-dd"), F.lit("?"))

    return (
        df.rollup(label)
        .agg(
            F.grouping(label).alias("__all"),
            day(F.min(date)).alias("first_day"),
            day(F.max(date)).alias("last_day"),
        )
        .select(F.when(F.col("__all") == 1, F.lit("*")).otherwise(F.col(label)).alias(label), "first_day", "last_day")
    )


def monthly_counts(df: DataFrame, classes: Sequence[str], label: str = "category", date: str = "date") -> DataFrame:
    """Rows per month and class, absent cells 0; undated rows are dropped."""
    month = F.date_format(F.date_trunc("month", date), "yyyy-MM")
    return (
        df.dropna(subset=[date])
        .groupBy(month.alias("month"))
        .agg(*[F.count_if(F.col(label) == c).alias(f"n_{c}") for c in classes])
    )


def token_histogram(df: DataFrame, label: str = "category") -> DataFrame:
    """Documents per class and token count; its size is bounded by the longest text."""
    return df.groupBy(label, "n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def token_stats(df: DataFrame, label: str = "category") -> DataFrame:
    """Mean, median, minimum and maximum tokens per class, to one decimal."""
    n, docs = F.col("n_tokens"), F.col("docs")
    return (
        token_histogram(df, label)
        .groupBy(label)
        .agg(
            F.round(F.sum(n * docs) / F.sum(docs), 1).alias("mean"),
            F.round(F.percentile(n, 0.5, docs), 1).alias("median"),
            F.min(n).alias("min"),
            F.max(n).alias("max"),
        )
    )


def token_overview(df: DataFrame) -> DataFrame:
    """Median token count and number of empty documents."""
    return (
        df.groupBy("n_tokens")
        .agg(F.count(F.lit(1)).alias("docs"))
        .agg(
            F.percentile("n_tokens", 0.5, F.col("docs")).alias("median_tokens"),
            F.coalesce(F.sum(F.when(F.col("n_tokens") == 0, F.col("docs"))), F.lit(0)).alias("empty_docs"),
        )
    )


def token_density(df: DataFrame, label: str = "category", points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density of token counts per class on a grid: ``label, idx, x, density``.

    Scott's bandwidth, a grid from min - cut*bw to max + cut*bw. Works on the token
    histogram: every histogram row adds its weight to each of the ``points`` grid
    positions, summed map-side. A class needs two different token counts.
    """
    hist = token_histogram(df, label)
    n, docs = F.col("n_tokens").cast("double"), F.col("docs")
    total, mean = F.sum(docs), F.sum(n * docs) / F.sum(docs)
    stats = (
        hist.groupBy(label)
        .agg(
            total.alias("__n"),
            mean.alias("__mean"),
            F.sum(n * n * docs).alias("__sq"),
            F.min(n).alias("__lo"),
            F.max(n).alias("__hi"),
        )
        .withColumn(
            "__bw",
            F.sqrt(F.try_divide(F.col("__sq") - F.col("__n") * F.col("__mean") ** 2, F.col("__n") - 1))
            * F.pow(F.col("__n").cast("double"), F.lit(-0.2)),
        )
        .filter("__bw > 0")
    )
    # one row per class
    joined = hist.join(F.broadcast(stats), label)
    low = F.col("__lo") - F.lit(cut) * F.col("__bw")
    high = F.col("__hi") + F.lit(cut) * F.col("__bw")
    x = low + F.col("idx") * (high - low) / F.lit(points - 1)
    z = (F.col("x") - n) / F.col("__bw")
    kernel = docs * F.exp(-0.5 * z * z) / (F.col("__n") * F.col("__bw") * F.lit((2 * 3.141592653589793) ** 0.5))
    return (
        joined.withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .groupBy(label, "idx")
        .agg(F.min("x").alias("x"), F.sum(kernel).alias("density"))
    )
