"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import chat, decontamination, html_text, merkle, mixing, periodic, passages, quality, recurrent_lm, secret_scan, sharding, simhash, token_planes
from folio.llm.common import table
from folio.session import stage


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def tokenizer_path() -> str:
    """The public vocabulary file of the token output; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_planes.encode_and_read(table(spark, sf_dir, "documents"), tokenizer_path())
    return read.withColumnRenamed("id", "doc_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("item").alias("item_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        "agreement",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.cascade(table(spark, sf_dir, "documents"), measures=True)
    failed = (F.col("n_words") < quality.MIN_WORDS) | (
        100 * F.col("n_repeat_words") > quality.MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return judged.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "kept",
    )


OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS r
  FROM documents),
grams AS (
  SELECT r, i, md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 5)) AS j) GROUP BY r),
tops AS (
  SELECT r, max(n) AS top FROM (SELECT r, x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM t) GROUP BY r, x) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, coalesce(top, 0) AS top
  FROM t LEFT JOIN covered USING (r) LEFT JOIN tops USING (r)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 10 * n_echoes > 3 * n_words
            OR 10 * n_upper > 3 * word_chars OR word_chars < 2 * n_words OR word_chars > 14 * n_words
            OR (n_words >= 50 AND 4 * top > n_words)) AS kept
FROM j
"""


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op7_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return shards.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.shared_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        F.col("other").alias("source_doc_id"),
        F.col("other_start").alias("source_start"),
        F.col("other_end").alias("source_end"),
        "identity",
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op11_tamper(docs: DataFrame) -> F.Column:
    """The text as tampered for the check: A-Z lower-cased where 3 divides crc32 of the decimal doc_id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(chosen, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, op11_tamper(docs)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


# fixed values of the check: the conversation appended to the table and its text
PROBE_CONV = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    probe = spark.createDataFrame(
        [(PROBE_CONV, 0, "user", PROBE_TEXT), (PROBE_CONV, 1, "assistant", PROBE_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    turns = chat.fold(chat.events_from_turns(rows.unionByName(probe)))
    written = stage(chat.render(turns), "chat-formatted")
    return chat.digests(chat.read_back(written))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_token_planes": op2_token_planes,
    "op3_simhash": op3_simhash,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_html_text": op6_html_text,
    "op7_recurrent_lm": op7_recurrent_lm,
    "op8_sharding": op8_sharding,
    "op9_passages": op9_passages,
    "op10_secret_scan": op10_secret_scan,
    "op11_merkle": op11_merkle,
    "op12_periodic": op12_periodic,
    "op13_chat": op13_chat,
}
ORACLES = {"op5_quality": OP5_SQL}
