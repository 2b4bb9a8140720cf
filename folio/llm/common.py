"""What the operators of this subpackage share: the word pattern, inputs and small native helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def search(key: Column, splitters: Sequence[int] | Column, length: int | Column | None = None) -> Column:
    """How many of the sorted ``splitters`` are at most ``key``: a binary search in one expression."""
    if isinstance(splitters, Column):
        values, count, top = splitters, F.size(splitters) if length is None else length, 1 << 20
    else:
        values, count, top = F.lit(list(splitters) or [0]), F.lit(len(splitters)), max(len(splitters), 1)
    steps = [1 << b for b in reversed(range(top.bit_length()))]

    def step(at: Column, width: Column) -> Column:
        there = at + width
        return F.when((there <= count) & (F.get(values, there - 1) <= key), there).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), step)
