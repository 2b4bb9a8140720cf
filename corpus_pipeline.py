"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix and encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm import decontamination, mixing, quality, simhash, token_planes
from folio.llm.common import table
from folio.llm.queries import tokenizer_path
from folio.session import stage


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest id."""
    return simhash.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_rows(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids of all rows as bit planes; a row per document as read back: its place and length among the ids."""
    return token_planes.encode_and_read(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", filter_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("token output", encode_tokens),
]

# Fingerprints, tilts and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").replace("/", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
