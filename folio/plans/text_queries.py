"""Text normalisation queries."""

from pyspark.sql import functions as F

from folio.evaluation.descriptive import preprocess
from folio.functions import text as tx
from folio.functions.html import (
    extract_between_markers,
    extract_links,
)
from folio.functions.stopwords import STOPWORDS_ES
from folio.functions.urls import is_article_url, map_section, resolve_url, url_slug
from folio.operators.extract import html_fallback_parse, with_text_nodes
from folio.operators.stemming import stem_vocabulary
from folio.plans.inputs import (
    ARTICLES_SQL,
    SPLIT_SQL,
    STOPWORD_SQL,
    articles,
    documents,
    pages,
    postings,
)
from folio.plans.registry import query


def _documents_query(name, sql_value, column):
    """A query ``doc_id, value`` over every document."""

    @query(name, f"SELECT doc_id, {sql_value} AS value FROM documents")
    def run(spark, sf):
        return documents(spark, sf).select("doc_id", column().alias("value"))

    return run


_joined = f"array_to_string({SPLIT_SQL}, ' ')"

_documents_query("normalize_nfc", "nfc_normalize(text)", lambda: tx.normalize_nfc(F.col("text")))
_documents_query("lowercase", "lower(text)", lambda: tx.lowercase(F.col("text")))
_documents_query("remove_accents", "strip_accents(text)", lambda: tx.remove_accents(F.col("text")))
_documents_query(
    "keep_letters",
    "regexp_replace(lower(text), '[^a-záéíóúüñ\\s]', ' ', 'g')",
    lambda: tx.keep_letters(F.lower(F.col("text"))),
)
_documents_query(
    "tokenize_ws",
    "array_to_string(list_filter(string_split_regex(text, '[\\s\\x0B]+'), lambda x: x <> ''), '|')",
    lambda: F.array_join(tx.tokenize_ws(F.col("text")), "|"),
)
_documents_query(
    "drop_stopwords",
    "array_to_string(list_filter(string_split_regex(lower(text), '[\\s\\x0B]+'), "
    f"lambda x: x <> '' AND x NOT IN ({STOPWORD_SQL})), '|')",
    lambda: F.array_join(tx.drop_stopwords(tx.tokenize_ws(F.lower(F.col("text"))), STOPWORDS_ES), "|"),
)
_documents_query(
    "clean_text",
    f"array_to_string(list_filter({SPLIT_SQL}, lambda x: x NOT IN ({STOPWORD_SQL})), ' ')",
    lambda: tx.clean_text(F.col("text")),
)
_documents_query(
    "tokenize_regex",
    f"array_to_string(regexp_extract_all(text, '{tx.LEGACY_TOKEN}'), '|')",
    lambda: F.array_join(tx.tokenize_regex(F.col("text")), "|"),
)
_documents_query(
    "tokenize_min2",
    f"array_to_string(list_filter({SPLIT_SQL}, lambda x: length(x) >= 2), '|')",
    lambda: F.array_join(tx.tokenize_min2(tx.clean_text(F.col("text"), stopwords=None)), "|"),
)


@query(
    "preprocess",
    f"""WITH cleaned AS (
  SELECT doc_id, list_filter({SPLIT_SQL}, lambda x: x NOT IN ({STOPWORD_SQL})) AS toks FROM documents)
SELECT doc_id, array_to_string(toks, ' ') AS text_clean, CAST(len(toks) AS BIGINT) AS n_tokens,
       length(array_to_string(toks, ' ')) AS n_chars
FROM cleaned""",
)
def preprocess_query(spark, sf):
    done = preprocess(documents(spark, sf).select("doc_id", "text"), "text")
    return done.select(
        "doc_id", "text_clean", F.col("n_tokens").cast("bigint"), F.col("n_chars").cast("bigint")
    )


@query("stem_tokens")
def stem_tokens(spark, sf):
    """Every distinct Spanish term with its stem."""
    spanish = postings(spark, sf).filter(F.col("label") == "es")
    return stem_vocabulary(spanish)


@query("strip_html_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS value FROM pages")
def strip_html_tags(spark, sf):
    return pages(spark, sf).select("page_id", tx.strip_html_tags(F.col("html")).alias("value"))


@query(
    "first_non_blank",
    f"""WITH {ARTICLES_SQL}
SELECT id, coalesce(nullif(subtitle, ''), nullif(url, ''), nullif(title, ''), '') AS value FROM articles""",
)
def first_non_blank(spark, sf):
    value = tx.first_non_blank(F.col("subtitle"), F.col("url"), F.col("title"))
    return articles(spark, sf).select("id", value.alias("value"))


@query(
    "embed_text",
    f"""WITH {ARTICLES_SQL}
SELECT id, trim(coalesce(title, '') || '. ' || coalesce(subtitle, '') || '. ' || left(coalesce(body, ''), 200),
            ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS value
FROM articles""",
)
def embed_text(spark, sf):
    value = tx.embed_text(F.col("title"), F.col("subtitle"), F.col("body"))
    return articles(spark, sf).select("id", value.alias("value"))


_ENTITIES_SQL = (
    "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
    "'&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
)
_VISIBLE_SQL = (
    "regexp_replace(regexp_replace(regexp_replace({0}, '<!--.*?-->', chr(1), 'gs'), "
    "'<script\\b.*?</script\\s*>', chr(1), 'gis'), '<style\\b.*?</style\\s*>', chr(1), 'gis')"
)
_SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def _nodes_sql(html: str) -> str:
    marked = f"regexp_replace({_VISIBLE_SQL.format(html)}, '<[^>]*>', chr(1), 'g')"
    pieces = f"string_split({_ENTITIES_SQL.format(marked)}, chr(1))"
    return f"list_filter(list_transform({pieces}, lambda x: trim(x, {_SPACE_SQL})), lambda x: x <> '')"


@query("html_to_text", f"SELECT page_id, array_to_string({_nodes_sql('html')}, ' ') AS value FROM pages")
def html_to_text_query(spark, sf):
    rows = with_text_nodes(pages(spark, sf).select("page_id", "html"))
    return rows.select("page_id", F.array_join("nodes", " ").alias("value"))


_H1_SQL = "regexp_extract(html, '<h1\\b[^>]*>(.*?)</h1\\s*>', 1, 'is')"


@query(
    "html_fallback_parse",
    f"""SELECT page_id, array_to_string({_nodes_sql(_H1_SQL)}, '') AS title,
       array_to_string(list_slice(list_filter({_nodes_sql('html')}, lambda x: length(x) > 60), 1, 50), ' ') AS body
FROM pages""",
)
def fallback_parse(spark, sf):
    rows = pages(spark, sf).select("page_id", "html", F.lit("noticias").alias("category"))
    return html_fallback_parse(rows).select("page_id", "article.title", "article.body")


@query(
    "extract_between_markers",
    """SELECT page_id, nullif(regexp_extract(replace(html, chr(10), ''), '<article>(.+)<footer>', 1), '') AS value
FROM pages""",
)
def between_markers(spark, sf):
    value = extract_between_markers(F.col("html"), "<article>", "<footer>")
    return pages(spark, sf).select("page_id", value.alias("value"))


@query(
    "extract_links",
    """WITH hrefs AS (
  SELECT page_id, url, regexp_extract(url, '^(\\w+://[^/?#]+)', 1) AS origin,
         unnest(regexp_extract_all(html, '<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1, 'is')) AS href
  FROM pages)
SELECT page_id, href,
       CASE WHEN href = '' THEN url
            WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href
            WHEN starts_with(href, '//') THEN regexp_extract(url, '^(\\w+:)', 1) || href
            WHEN starts_with(href, '/') THEN origin || href
            WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href
            WHEN starts_with(href, '?') THEN regexp_replace(url, '[?#].*$', '') || href
            ELSE origin || '/' || regexp_extract(regexp_replace(url, '[?#].*$', ''), '^\\w+://[^/]+/(.*/)', 1) || href
       END AS link
FROM hrefs""",
)
def links(spark, sf):
    hrefs = pages(spark, sf).select("page_id", "url", F.explode(extract_links(F.col("html"))).alias("href"))
    return hrefs.select("page_id", "href", resolve_url(F.col("url"), F.col("href")).alias("link"))




@query(
    "filter_article_urls",
    """SELECT page_id, dated FROM (
  SELECT page_id, regexp_extract(url, '^(\\w+://[^/?#]+)', 1)
         || CASE WHEN page_id % 3 = 0 THEN '/seccion/' ELSE '/2024/05/08/' END
         || regexp_extract(url, '^\\w+://[^/?#]+/(.*)$', 1) AS dated
  FROM pages)
WHERE regexp_matches(dated, '^https?://[^/]+/20\\d\\d/\\d{2}/\\d{2}/.+')""",
)
def article_urls(spark, sf):
    url = F.col("url")
    folder = F.when(F.col("page_id") % 3 == 0, F.lit("/seccion/")).otherwise(F.lit("/2024/05/08/"))
    dated = F.concat(
        F.regexp_extract(url, r"^(\w+://[^/?#]+)", 1), folder, F.regexp_extract(url, r"^\w+://[^/?#]+/(.*)$", 1)
    )
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", dated.alias("dated"))
    return rows.filter(is_article_url(F.col("dated"), "https?://[^/]+"))


SLUG_SQL = "string_split(rtrim(url, '/'), '/')[-1]"


@query(
    "url_slug",
    f"""SELECT page_id, CASE WHEN {SLUG_SQL} LIKE '%.html' THEN {SLUG_SQL} ELSE {SLUG_SQL} || '.html' END AS slug
FROM pages""",
)
def slug(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", url_slug(F.col("url")).alias("slug"))


_SECTIONS = {"en": "english", "fr": "francais", "es": "espanol"}


@query(
    "map_section",
    """SELECT page_id, segment, CASE segment WHEN 'en' THEN 'english' WHEN 'fr' THEN 'francais'
       WHEN 'es' THEN 'espanol' END AS category
FROM (SELECT page_id, regexp_extract(url, '^\\w+://[^/]+/([^/?#]*)', 1) AS segment FROM pages)
WHERE segment IN ('en', 'fr', 'es')""",
)
def section_labels(spark, sf):
    segment = F.regexp_extract("url", r"^\w+://[^/]+/([^/?#]*)", 1)
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", segment.alias("segment"))
    mapped = rows.withColumn("category", map_section(F.col("segment"), _SECTIONS))
    return mapped.filter(F.col("category").isNotNull())
