"""Metric documents, term matrices, cached tables and fitted models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from folio.schemas import CV_RESULTS


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its own file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType = CV_RESULTS) -> DataFrame:
    """Stored metric documents; a missing path gives an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def write_term_matrix(postings: DataFrame, labels: DataFrame, vocabulary: DataFrame, path: str) -> None:
    """Postings, targets and feature names as three tables for a later job."""
    for name, table in (("postings", postings), ("labels", labels), ("vocabulary", vocabulary)):
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def read_term_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    postings, labels, vocabulary = (
        spark.read.parquet(f"{path}/{name}") for name in ("postings", "labels", "vocabulary")
    )
    return postings, labels, vocabulary


def materialise_once(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Load the table at ``path``, computing and writing it first when it is absent.

    A finished write leaves ``_SUCCESS``; a table without it is computed again.
    """
    if not path_exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_model(model: PipelineModel, labels: DataFrame, path: str) -> None:
    """Persist a fitted pipeline with its label index."""
    model.write().overwrite().save(f"{path}/model")
    labels.write.mode("overwrite").parquet(f"{path}/labels")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/labels")
