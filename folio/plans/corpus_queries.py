"""Deduplication, samples, splits and descriptive aggregates."""

from pyspark.sql import functions as F

from folio.evaluation import descriptive
from folio.functions.text import clean_tokens
from folio.functions.urls import build_url, url_slug
from folio.operators import dedupe, splits
from folio.plans.inputs import (
    ARTICLES_SQL,
    CLASS_ORDER,
    CLASSES,
    SPLIT_SQL,
    STOPWORD_SQL,
    articles,
    labels,
)
from folio.plans.registry import query
from folio.plans.text_queries import SLUG_SQL

_RANK_SQL = "CASE category " + " ".join(
    f"WHEN '{c}' THEN {i}" for i, c in enumerate(CLASS_ORDER, 1)
) + f" ELSE {len(CLASS_ORDER) + 1} END"
_KEY_SQL = "CASE WHEN url = '' THEN '#' || id::VARCHAR ELSE url END"


@query(
    "build_url",
    f"""WITH {ARTICLES_SQL}
SELECT id, 'https://news.example.org' || coalesce(CASE WHEN url <> '' THEN '/' || category || '/' || id END, '') AS value
FROM articles""",
)
def url_query(spark, sf):
    path = F.when(F.col("url") != "", F.concat_ws("/", F.lit(""), "category", F.col("id").cast("string")))
    return articles(spark, sf).select("id", build_url("https://news.example.org", path).alias("value"))


@query("min_body_filter", f"WITH {ARTICLES_SQL} SELECT id, category FROM articles WHERE length(body) >= 150")
def min_body(spark, sf):
    return dedupe.min_body_filter(articles(spark, sf)).select("id", "category")


@query(
    "dedupe_url_accepted",
    f"""WITH {ARTICLES_SQL}
SELECT id, url, category FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL} ORDER BY {_RANK_SQL}, id) AS rn
  FROM articles WHERE length(body) >= 150) WHERE rn = 1""",
)
def url_accepted(spark, sf):
    rows = dedupe.min_body_filter(articles(spark, sf)).select("id", "url", "category")
    return dedupe.dedupe_url_accepted(rows, CLASS_ORDER)


@query(
    "dedupe_url_claimed",
    f"""WITH {ARTICLES_SQL}
SELECT id, url, category FROM (
  SELECT *, row_number() OVER (PARTITION BY category, url ORDER BY id) AS rn FROM articles)
WHERE rn = 1 AND length(body) >= 150""",
)
def url_claimed(spark, sf):
    return dedupe.dedupe_url_claimed(articles(spark, sf)).select("id", "url", "category")


@query(
    "drop_duplicate_urls",
    f"""WITH {ARTICLES_SQL}
SELECT id, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS rn FROM articles) WHERE rn = 1""",
)
def duplicate_urls(spark, sf):
    return dedupe.drop_duplicate_urls(articles(spark, sf).select("id", "url"))


@query(
    "dedupe_slug_last",
    f"""WITH slugs AS (
  SELECT page_id, regexp_extract(url, '^\\w+://[^/]+/([^/?#]*)', 1) AS category,
         regexp_replace(CASE WHEN {SLUG_SQL} LIKE '%.html' THEN {SLUG_SQL} ELSE {SLUG_SQL} || '.html' END,
                        '\\d+', '') AS slug
  FROM pages)
SELECT page_id, category, slug FROM (
  SELECT *, row_number() OVER (PARTITION BY category, slug ORDER BY page_id DESC) AS rn FROM slugs) WHERE rn = 1""",
)
def slug_last(spark, sf):
    slug = F.regexp_replace(url_slug(F.col("url")), r"^(.*?)\d+", "$1")
    rows = spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id", F.regexp_extract("url", r"^\w+://[^/]+/([^/?#]*)", 1).alias("category"), slug.alias("slug")
    )
    return dedupe.dedupe_slug_last(rows, ["category", "slug"], "page_id")


@query(
    "cap_per_class",
    f"""WITH {ARTICLES_SQL}
SELECT id, category, title FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS rn FROM articles) WHERE rn <= 100""",
)
def capped(spark, sf):
    return dedupe.cap_per_class(articles(spark, sf), 100).select("id", "category", "title")


_PAGED_SQL = """SELECT event_id, event_type, ts,
  count(*) OVER (PARTITION BY event_type) AS total,
  (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 15 + 1 AS page FROM events"""


def _events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


@query(
    "systematic_page_sample",
    f"""WITH paged AS ({_PAGED_SQL}),
plan AS (SELECT *, greatest(1, total // 15) AS max_p, least(greatest(1, (500 + 14) // 15), greatest(1, total // 15)) AS needed
  FROM paged)
SELECT event_id, event_type, page FROM plan
WHERE (page - 1) % (max_p // needed) = 0 AND (page - 1) // (max_p // needed) < needed""",
)
def page_sample(spark, sf):
    rows = _events(spark, sf).select("event_id", "event_type", "ts")
    return dedupe.systematic_page_sample(rows, ["event_type"], ["ts", "event_id"], 500).select(
        "event_id", "event_type", "page"
    )


@query(
    "block_skip_sample",
    f"""WITH paged AS ({_PAGED_SQL})
SELECT event_id, event_type, page FROM paged WHERE (page - 1) % 25 < 5 AND page <= 17 * 25""",
)
def block_sample(spark, sf):
    rows = _events(spark, sf).select("event_id", "event_type", "ts")
    return dedupe.block_skip_sample(rows, ["event_type"], ["ts", "event_id"]).select(
        "event_id", "event_type", "page"
    )


@query("drop_null_rows", f"WITH {ARTICLES_SQL} SELECT id, date FROM articles WHERE date IS NOT NULL")
def null_rows(spark, sf):
    return dedupe.drop_null_rows(articles(spark, sf).select("id", "date"), ["date"])


@query("require_min_rows", "SELECT doc_id AS id, lang AS label FROM documents")
def min_rows(spark, sf):
    return dedupe.require_min_rows(labels(spark, sf), 50)


@query(
    "extraction_audit",
    f"""WITH {ARTICLES_SQL},
status AS (
  SELECT category, length(body) < 150 AS is_short,
         row_number() OVER (PARTITION BY length(body) < 150, {_KEY_SQL} ORDER BY {_RANK_SQL}, id) AS rn
  FROM articles)
SELECT category, count(*) FILTER (NOT is_short AND rn = 1) AS accepted,
       count(*) FILTER (is_short) AS short, count(*) FILTER (NOT is_short AND rn > 1) AS duplicate
FROM status GROUP BY category""",
)
def audit(spark, sf):
    return dedupe.extraction_audit(articles(spark, sf), CLASS_ORDER)


@query(
    "stratified_kfold",
    """SELECT doc_id AS id, lang AS label,
  CAST((row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || ':42')) - 1) % 5 AS INTEGER) AS fold
FROM documents""",
)
def kfold(spark, sf):
    return splits.stratified_kfold(labels(spark, sf)).select("id", "label", "fold")


@query(
    "temporal_split",
    """SELECT o_orderkey, o_orderdate,
  CASE WHEN o_orderdate > (SELECT max(o_orderdate) - INTERVAL 3 MONTH FROM orders) THEN 'test' ELSE 'train' END AS split
FROM orders WHERE o_orderdate IS NOT NULL""",
)
def temporal(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderdate")
    return splits.temporal_split(rows, "o_orderdate")


@query(
    "random_split",
    """SELECT doc_id AS id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':42'))
  <= floor(0.5 * (SELECT count(*) FROM documents)) THEN 'train' ELSE 'valid' END AS split FROM documents""",
)
def random_halves(spark, sf):
    return splits.random_split(labels(spark, sf).select("id"))


@query(
    "assign_batches",
    """SELECT doc_id, toxic, (row_number() OVER (PARTITION BY toxic ORDER BY doc_id) - 1) // 32 AS batch FROM labels""",
)
def batches(spark, sf):
    rows = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    return splits.assign_batches(rows, ["toxic"], ["doc_id"])


@query("class_counts", f"WITH {ARTICLES_SQL} SELECT category, count(*) AS n FROM articles GROUP BY category")
def class_counts(spark, sf):
    return descriptive.class_counts(articles(spark, sf))


@query(
    "date_range",
    f"""WITH {ARTICLES_SQL}
SELECT coalesce(category, '*') AS category, coalesce(strftime(min(date), '%Y-%m-%d'), '?') AS first_day,
       coalesce(strftime(max(date), '%Y-%m-%d'), '?') AS last_day
FROM articles GROUP BY ROLLUP (category)""",
)
def date_range(spark, sf):
    return descriptive.date_range(articles(spark, sf))


@query(
    "monthly_counts",
    f"""WITH {ARTICLES_SQL}
SELECT strftime(date_trunc('month', date), '%Y-%m') AS month, """
    + ", ".join(f"count(*) FILTER (category = '{c}') AS n_{c}" for c in CLASSES)
    + " FROM articles WHERE date IS NOT NULL GROUP BY 1",
)
def monthly_counts(spark, sf):
    return descriptive.monthly_counts(articles(spark, sf), CLASSES)


_N_TOKENS_SQL = f"""WITH tokens AS (
  SELECT lang AS category,
         CAST(len(list_filter({SPLIT_SQL}, lambda x: x NOT IN ({STOPWORD_SQL}))) AS BIGINT) AS n_tokens
  FROM documents)"""


def _n_tokens(spark, sf):
    rows = articles(spark, sf)
    return rows.select("category", F.size(clean_tokens(F.col("body"))).cast("bigint").alias("n_tokens"))


@query(
    "token_stats",
    f"""{_N_TOKENS_SQL}
SELECT category, round(avg(n_tokens), 1) AS mean, round(quantile_cont(n_tokens, 0.5), 1) AS median,
       min(n_tokens) AS min, max(n_tokens) AS max FROM tokens GROUP BY category""",
)
def token_stats(spark, sf):
    return descriptive.token_stats(_n_tokens(spark, sf))


@query(
    "token_overview",
    f"""{_N_TOKENS_SQL}
SELECT quantile_cont(n_tokens, 0.5)::DOUBLE AS median_tokens, count(*) FILTER (n_tokens = 0) AS empty_docs FROM tokens""",
)
def token_overview(spark, sf):
    return descriptive.token_overview(_n_tokens(spark, sf))


@query(
    "token_density",
    f"""{_N_TOKENS_SQL},
stats AS (
  SELECT category, count(*) AS n, stddev_samp(n_tokens) * pow(count(*), -0.2) AS bw,
         min(n_tokens) AS lo, max(n_tokens) AS hi FROM tokens GROUP BY category),
grid AS (
  SELECT category, idx, lo - 3 * bw + idx * (hi - lo + 6 * bw) / 199 AS x, n, bw
  FROM stats, (SELECT unnest(range(200))::INTEGER AS idx) WHERE bw > 0),
hist AS (SELECT category, n_tokens, count(*) AS docs FROM tokens GROUP BY category, n_tokens)
SELECT category, idx, round(x, 5) AS x,
       round(sum(docs * exp(-0.5 * pow((x - n_tokens) / bw, 2))) / (n * bw * sqrt(2 * pi())), 8) AS density
FROM grid JOIN hist USING (category) GROUP BY category, idx, x, n, bw""",
)
def token_density(spark, sf):
    done = descriptive.token_density(_n_tokens(spark, sf))
    return done.select("category", "idx", F.round("x", 5).alias("x"), F.round("density", 8).alias("density"))
