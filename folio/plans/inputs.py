"""Pipeline inputs derived from the given tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.config import LEGACY_MAX_DF
from folio.functions.stem import stem_tokens
from folio.functions.stopwords import STOPWORDS_ES, STOPWORDS_ES_PLAIN
from folio.functions.text import (
    LEGACY_TOKEN,
    clean_tokens,
    drop_stopwords,
    remove_accents,
    tokenize_regex,
    vectorizer_terms,
)
from folio.operators.terms import bag_tallies, count_rows, prune_by_df, term_bags, term_counts
from folio.session import stage
from folio.sources.tables import read_table

CLASSES = ("de", "en", "es", "fr")
CLASS_ORDER = ("es", "en", "fr", "de")
# Accuracy here is a check of the plumbing; labels.quality is the harder target.
START_DAY = "2022-09-30"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", "doc_id")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/pages.parquet", "page_id")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    text, doc = F.col("text"), F.col("doc_id")
    newline = F.lit("\n")
    day = F.make_dt_interval((doc * 37 % 1317).cast("int"))
    return documents(spark, sf).select(
        doc.alias("id"),
        F.split_part(text, newline, F.lit(1)).alias("title"),
        F.split_part(text, newline, F.lit(2)).alias("subtitle"),
        text.alias("body"),
        F.when(doc % 50 != 7, F.lit(START_DAY).cast("timestamp_ntz") + day).alias("date"),
        F.when(doc % 97 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("https://news.example.org/"), F.col("lang"), F.lit("/"), F.md5(text)))
        .alias("url"),
        F.col("source").alias("author"),
        F.col("lang").alias("category"),
    )


ARTICLES_SQL = f"""articles AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, split_part(text, chr(10), 2) AS subtitle,
         text AS body,
         CASE WHEN doc_id % 50 = 7 THEN NULL
              ELSE TIMESTAMP '{START_DAY}' + to_days(CAST(doc_id * 37 % 1317 AS INTEGER)) END AS date,
         CASE WHEN doc_id % 97 = 0 THEN ''
              ELSE 'https://news.example.org/' || lang || '/' || md5(text) END AS url,
         source AS author, lang AS category
  FROM documents)"""


def clean_terms(text: str = "text") -> Column:
    """Vectoriser terms of a text column under the default cleaning."""
    return vectorizer_terms(clean_tokens(F.col(text)))


def postings(spark: SparkSession, sf: str, ngram_range=(1, 1)) -> DataFrame:
    """``id, label, term, n`` of the documents; the label is the language."""
    docs = documents(spark, sf).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")
    return term_counts(docs, clean_terms(), ("id", "label"), ngram_range=ngram_range)


def staged_postings(spark: SparkSession, sf: str, ngram_range=(1, 1)) -> DataFrame:
    """Postings written once, for queries that pass over them again: cleaning costs more than storing."""
    return stage(postings(spark, sf, ngram_range), "postings")


def _bags(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")
    return term_bags(docs, clean_terms(), ("id", "label"))


def staged_bags(spark: SparkSession, sf: str) -> DataFrame:
    """``id, label, bag`` of the documents, written once."""
    return stage(_bags(spark, sf), "bags")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """``id, label`` per document."""
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("label")
    )


def folded_bags(spark: SparkSession, sf: str, folds: DataFrame) -> DataFrame:
    """Staged ``id, label, bag, fold``: counted terms meet the folds, texts are not shuffled."""
    return stage(_bags(spark, sf).join(folds.select("id", "fold"), "id"), "fold-bags")


def folded_postings(spark: SparkSession, sf: str, folds: DataFrame) -> DataFrame:
    """``id, label, fold, term, n``."""
    return folded_bags(spark, sf, folds).select("id", "label", "fold", F.inline("bag"))


def legacy_bags(spark: SparkSession, sf: str, stem: bool = False) -> DataFrame:
    """Staged ``id, label, bag`` of the older vectoriser: accents off, its own token pattern, accent-free stopwords, one- and two-word terms."""
    tokens = tokenize_regex(remove_accents(F.lower(F.col("text"))))
    if stem:
        tokens = stem_tokens(tokens)
    tokens = drop_stopwords(tokens, STOPWORDS_ES_PLAIN)
    docs = documents(spark, sf).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")
    return stage(term_bags(docs, tokens, ("id", "label"), ngram_range=(1, 2)), "legacy-bags")


def legacy_terms(bags: DataFrame) -> DataFrame:
    """The terms of the older vectoriser's vocabulary, staged: document frequency limits and no cap."""
    stats = bag_tallies(bags)
    return stage(prune_by_df(stats, count_rows(bags), max_df=LEGACY_MAX_DF), "legacy-terms")


STOPWORD_SQL = ", ".join("'" + word + "'" for word in STOPWORDS_ES)
CLEAN_SQL = (
    "regexp_replace(lower(regexp_replace(text, '<[^>]+>', ' ', 'g')), "
    "'[^a-záéíóúüñ\\s]', ' ', 'g')"
)
SPLIT_SQL = f"list_filter(string_split_regex({CLEAN_SQL}, '\\s+'), lambda x: x <> '')"
TOKENS_SQL = f"""tokens AS MATERIALIZED (
  SELECT doc_id AS id, lang AS label, text,
         list_filter({SPLIT_SQL}, lambda x: x NOT IN ({STOPWORD_SQL})) AS toks
  FROM documents)"""
POSTINGS_SQL = f"""{TOKENS_SQL},
postings AS MATERIALIZED (
  SELECT id, label, term, count(*) AS n
  FROM (SELECT id, label, unnest(toks) AS term FROM tokens)
  WHERE length(term) >= 2 GROUP BY id, label, term),
n_docs AS (SELECT count(*) AS n_docs FROM documents)"""
BIGRAM_POSTINGS_SQL = f"""{TOKENS_SQL},
terms2 AS (SELECT id, label, list_filter(toks, lambda x: length(x) >= 2) AS t FROM tokens),
grams AS (
  SELECT id, label, unnest(t) AS term FROM terms2
  UNION ALL
  SELECT id, label, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
  FROM terms2 WHERE len(t) >= 2),
postings AS MATERIALIZED (SELECT id, label, term, count(*) AS n FROM grams GROUP BY id, label, term),
n_docs AS (SELECT count(*) AS n_docs FROM documents)"""
_PLAIN_STOPWORD_SQL = ", ".join("'" + word + "'" for word in STOPWORDS_ES_PLAIN)
LEGACY_SQL = f"""legacy AS MATERIALIZED (
  SELECT doc_id AS id, lang AS label,
         list_filter(regexp_extract_all(strip_accents(lower(text)), '{LEGACY_TOKEN}'),
                     lambda x: x NOT IN ({_PLAIN_STOPWORD_SQL})) AS t
  FROM documents),
legacy_grams AS (
  SELECT id, label, unnest(t) AS term FROM legacy
  UNION ALL
  SELECT id, label, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
  FROM legacy WHERE len(t) >= 2),
legacy_postings AS MATERIALIZED (SELECT id, label, term, count(*) AS n FROM legacy_grams GROUP BY id, label, term),
legacy_terms AS (
  SELECT term FROM legacy_postings GROUP BY term
  HAVING count(*) >= 3 AND count(*) <= {LEGACY_MAX_DF}::DOUBLE * (SELECT count(*) FROM documents))"""
DF_SQL = """stats AS (
  SELECT term, count(*) AS df, CAST(sum(n) AS BIGINT) AS total FROM postings GROUP BY term)"""
VOCABULARY_SQL = f"""{DF_SQL},
vocabulary AS MATERIALIZED (
  SELECT term, df, total, ln((1.0 + n_docs) / (1.0 + df)) + 1 AS idf
  FROM stats, n_docs WHERE df >= 3 AND df <= 0.9::DOUBLE * n_docs
  ORDER BY total DESC, term LIMIT 50000)"""
TFIDF_SQL = f"""{POSTINGS_SQL},
{VOCABULARY_SQL},
weighted AS (SELECT id, label, term, n, (1 + ln(n)) * idf AS w FROM postings JOIN vocabulary USING (term)),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY id),
tfidf AS (SELECT id, label, term, w / norm AS tfidf FROM weighted JOIN norms USING (id))"""
