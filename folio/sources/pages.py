"""Raw pages and stored API responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.schemas import CMS_PAGE


def read_labelled_html_dirs(
    spark: SparkSession,
    root: str,
    classes: Sequence[str] | None = None,
    *,
    pattern: str = "*.html",
    directory_prefix: str = "",
) -> DataFrame:
    """One directory per class: ``(category, source, html)``.

    The class is the directory name (less ``directory_prefix``, for Hive-style
    names). Undecodable bytes become U+FFFD. A class without a directory gives no rows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    directory = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    category = F.regexp_replace(directory, f"^{directory_prefix}", "") if directory_prefix else directory
    pages = files.select(
        category.alias("category"),
        F.col("_metadata.file_path").alias("source"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("html"),
    )
    return pages.filter(F.col("category").isin(*classes)) if classes else pages


def write_html_dirs(df: DataFrame, root: str) -> None:
    """Write ``(category, html)`` as one file per page under ``category=<class>/``."""
    (
        df.select("category", F.col("html").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .partitionBy("category")
        .text(root)
    )


def read_cms_pages(spark: SparkSession, path: str, *, multiline: bool = True) -> DataFrame:
    """Stored API responses: one row ``(total, article)`` per article element.

    ``multiline=False`` reads JSON Lines, which a cluster can split within files.
    """
    pages = spark.read.schema(CMS_PAGE).json(path, multiLine=multiline)
    return pages.select(
        F.col("count").alias("total"), F.explode("content_elements").alias("article")
    )


def add_provenance(df: DataFrame, category: str, source: str, method: str) -> DataFrame:
    """Constant class, source path and extraction method columns."""
    return df.withColumns(
        {"category": F.lit(category), "source": F.lit(source), "method": F.lit(method)}
    )
