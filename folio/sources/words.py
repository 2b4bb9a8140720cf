"""Word lists and word vectors in text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.text import trim_spaces


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed, lower-cased lines without blanks or a byte-order mark."""
    line = F.regexp_replace(F.col("value"), "^\ufeff", "")
    return (
        spark.read.text(path)
        .select(F.lower(trim_spaces(line)).alias("word"))
        .filter(F.col("word") != "")
        .distinct()
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Textual word vectors ``(word, vec)``; the two-field header line is dropped."""
    parts = F.split(trim_spaces(F.col("value")), " +")
    return (
        spark.read.text(path)
        .select(parts.alias("parts"))
        .filter(F.size("parts") > 2)
        .select(
            F.get("parts", F.lit(0)).alias("word"),
            F.transform(F.slice("parts", 2, F.size("parts") - 1), lambda x: x.cast("float")).alias("vec"),
        )
    )


def write_word_vectors(df: DataFrame, path: str) -> None:
    """Write ``(word, vec)`` in the textual form; the files carry no header line."""
    df.select(
        F.concat_ws(" ", "word", F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")).alias(
            "value"
        )
    ).write.text(path)
