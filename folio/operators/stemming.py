"""Stemming as a vocabulary job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.stem import stem_es


def stem_vocabulary(postings: DataFrame) -> DataFrame:
    """``term, stem`` with every distinct term stemmed once."""
    return postings.select("term").distinct().withColumn("stem", stem_es(F.col("term")))


def stem_postings(postings: DataFrame) -> DataFrame:
    """Postings with terms replaced by stems and their counts added up."""
    others = [c for c in postings.columns if c not in ("term", "n")]
    return (
        postings.join(stem_vocabulary(postings), "term")
        .groupBy(*others, F.col("stem").alias("term"))
        .agg(F.sum("n").alias("n"))
    )
