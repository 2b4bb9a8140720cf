"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from folio.schemas import ARTICLES


def read_table(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Parquet table, as its files are split.

    A file of one row group is one task. Who keeps a table in few such files can set
    ``folio.input.partitions``: then tables read with a ``key`` are dealt out by it first.
    """
    df = spark.read.parquet(path)
    wanted = spark.conf.get("folio.input.partitions", None)
    return df.repartition(int(wanted), key) if key and wanted else df


def read_articles(spark: SparkSession, path: str, schema: T.StructType = ARTICLES) -> DataFrame:
    """Article or dataset Parquet under an explicit schema."""
    return spark.read.schema(schema).parquet(path)


def write_articles(df: DataFrame, path: str) -> None:
    """Overwrite the Parquet table at ``path``, creating its parent folders."""
    df.write.mode("overwrite").parquet(path)
