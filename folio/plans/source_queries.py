"""Readers, writers and CMS articles; every round trip runs on derived copies of the tables."""

from pyspark.sql import functions as F

from folio.evaluation import metrics
from folio.functions import cms
from folio.functions.arrays import normalize_vector
from folio.operators import terms
from folio.operators.extract import parse_with_fallback
from folio.plans.inputs import (
    ARTICLES_SQL,
    POSTINGS_SQL,
    SPLIT_SQL,
    VOCABULARY_SQL,
    articles,
    documents,
    labels,
    pages,
    postings,
    staged_postings,
)
from folio.plans.registry import query
from folio.plans.score_queries import CV_SUMMARY_SQL, predictions
from folio.plans.text_queries import _nodes_sql
from folio.session import scratch_path
from folio.sources import artifacts, words
from folio.sources import pages as page_source
from folio.sources.tables import read_articles, write_articles


@query("read_articles", f"WITH {ARTICLES_SQL} SELECT id, title, date, url, author, category FROM articles")
def read_articles_query(spark, sf):
    path = scratch_path(spark, "articles")
    write_articles(articles(spark, sf), path)
    return read_articles(spark, path).select("id", "title", "date", "url", "author", "category")


@query("write_articles", f"WITH {ARTICLES_SQL} SELECT id, md5(body) AS body_md5, category FROM articles")
def write_articles_query(spark, sf):
    """Written twice to the same path: the second write replaces the first."""
    path = scratch_path(spark, "articles") + "/interim/articles"
    rows = articles(spark, sf)
    write_articles(rows.select("id"), path)
    write_articles(rows, path)
    return read_articles(spark, path).select("id", F.md5("body").alias("body_md5"), "category")


_PAGE_CLASS_SQL = "regexp_extract(url, '^\\w+://[^/]+/([^/?#]*)', 1)"
_PAGE_CLASSES = ("en", "fr", "es", "missing")


@query(
    "read_labelled_html_dirs",
    f"""SELECT {_PAGE_CLASS_SQL} AS category, md5(html) AS html_md5, count(*) AS n
FROM pages WHERE {_PAGE_CLASS_SQL} IN ('en', 'fr', 'es') GROUP BY 1, 2""",
)
def html_dirs(spark, sf):
    """Pages written one file each into class directories; one configured class has none."""
    root = scratch_path(spark, "html")
    category = F.regexp_extract("url", r"^\w+://[^/]+/([^/?#]*)", 1)
    page_source.write_html_dirs(pages(spark, sf).select(category.alias("category"), "html"), root)
    read = page_source.read_labelled_html_dirs(
        spark, root, _PAGE_CLASSES, pattern="*.txt", directory_prefix="category="
    )
    # the text writer ends each file with a newline
    html = F.regexp_replace("html", r"\n\z", "")
    return read.groupBy("category", F.md5(html).alias("html_md5")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "add_provenance",
    """SELECT page_id, 'noticias' AS category, 'pages/' AS source, 'bs4_fallback' AS method FROM pages""",
)
def provenance(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id")
    return page_source.add_provenance(rows, "noticias", "pages/", cms.METHOD_MARKUP)


# CMS articles made of documents: every line is an element, its type by position.
def cms_articles(spark, sf):
    """``doc_id, title, article``."""
    doc = F.col("doc_id")
    none = F.lit(None).cast("string")

    def element(line, i):
        kind = i % 4
        text = F.when(kind == 0, F.concat(F.lit("<b>"), line, F.lit("</b>"))).otherwise(F.lit(""))
        item = F.struct(line.alias("content"), none.alias("text"))
        numbered = F.struct(none.alias("content"), F.concat(F.lit("item <i>"), i.cast("string"), F.lit("</i>")).alias("text"))
        return F.struct(
            F.when(kind == 0, F.lit("text")).when(kind == 1, F.lit("header")).when(kind == 2, F.lit("list"))
            .otherwise(F.lit("image")).alias("type"),
            text.alias("content"),
            F.when(kind != 2, line).alias("text"),
            F.when(kind == 2, F.array(item, numbered)).alias("items"),
        )

    def basic(value):
        return F.struct(value.alias("basic"))

    stamp = F.concat(
        F.lit("2024-0"), (doc % 9 + 1).cast("string"), F.lit("-1"), (doc % 10).cast("string"), F.lit("T22:30:0"),
        (doc % 6).cast("string"),
    )
    dated = (
        F.when(doc % 7 == 1, F.lit("bad"))
        .when(doc % 4 == 0, F.concat(stamp, F.lit("Z")))
        .when(doc % 4 == 1, F.concat(stamp, F.lit(".250-03:00")))
        .otherwise(stamp)
    )
    newline = F.lit("\n")
    return documents(spark, sf).select(
        "doc_id",
        "text",
        F.struct(
            basic(F.concat(F.lit(" "), F.split_part("text", newline, F.lit(1)))).alias("headlines"),
            basic(F.when(doc % 3 != 0, F.split_part("text", newline, F.lit(2))).otherwise(F.lit(""))).alias("subheadlines"),
            basic(F.concat(F.lit("desc "), F.col("source"))).alias("description"),
            F.transform(F.split("text", "\n"), element).alias("content_elements"),
            F.when(doc % 5 != 0, dated).alias("display_date"),
            F.when(doc % 10 != 0, F.concat(stamp, F.lit("+0100"))).alias("first_publish_date"),
            F.when(doc % 97 != 0, F.concat(F.lit("/"), F.col("lang"), F.lit("/"), doc.cast("string"))).alias("website_url"),
            F.struct(
                F.when(doc % 11 == 0, F.array().cast("array<struct<name:string>>"))
                .otherwise(F.array(F.struct(F.col("source").alias("name"))))
                .alias("by")
            ).alias("credits"),
        ).alias("article"),
    )


_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"
_STAMP_SQL = (
    "'2024-0' || (doc_id % 9 + 1) || '-1' || (doc_id % 10) || ' 22:30:0' || (doc_id % 6)"
)
CMS_SQL = f"""elements AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
pieces AS (
  SELECT doc_id, i, 0 AS j, {_TRIM.format("regexp_replace(line, '<[^>]+>', ' ', 'g')")} AS piece FROM elements
  WHERE i % 4 <> 3
  UNION ALL SELECT doc_id, i, 1, 'item  ' || i FROM elements WHERE i % 4 = 2),
bodies AS (SELECT doc_id, string_agg(piece, ' ' ORDER BY i, j) AS body FROM pieces WHERE piece <> '' GROUP BY doc_id),
parsed AS MATERIALIZED (
  SELECT d.doc_id, text,
         {_TRIM.format("split_part(text, chr(10), 1)")} AS title,
         {_TRIM.format("CASE WHEN doc_id % 3 <> 0 THEN split_part(text, chr(10), 2) ELSE '' END")} AS subtitle,
         CASE WHEN doc_id % 3 <> 0 AND split_part(text, chr(10), 2) <> ''
              THEN {_TRIM.format("split_part(text, chr(10), 2)")} ELSE 'desc ' || source END AS api_subtitle,
         coalesce(body, '') AS body,
         CASE WHEN doc_id % 5 <> 0 THEN
                CASE WHEN doc_id % 7 = 1 THEN NULL
                     WHEN doc_id % 4 = 1 THEN CAST({_STAMP_SQL} || '.250' AS TIMESTAMP) + INTERVAL 3 HOUR
                     ELSE CAST({_STAMP_SQL} AS TIMESTAMP) END
              WHEN doc_id % 10 <> 0 THEN CAST({_STAMP_SQL} AS TIMESTAMP) - INTERVAL 1 HOUR END AS date,
         'https://news.example.org' || CASE WHEN doc_id % 97 <> 0 THEN '/' || lang || '/' || doc_id ELSE '' END AS url,
         CASE WHEN doc_id % 11 = 0 THEN '' ELSE source END AS author
  FROM documents d LEFT JOIN bodies USING (doc_id))"""


@query("read_cms_pages", f"WITH {CMS_SQL} SELECT 15 AS total, url AS url, md5(body) AS body_md5 FROM parsed")
def cms_pages(spark, sf):
    """Articles stored as API responses of up to 15 articles and read back."""
    path = scratch_path(spark, "responses")
    (
        cms_articles(spark, sf)
        .groupBy(F.floor(F.col("doc_id") / 15).alias("page"))
        .agg(F.collect_list("article").alias("content_elements"))
        .select(F.lit(15).cast("bigint").alias("count"), "content_elements")
        .write.json(path)
    )
    read = page_source.read_cms_pages(spark, path, multiline=False)
    article = F.col("article")
    return read.select(
        F.col("total").cast("int").alias("total"),
        cms.build_url(cms.SITE, article["website_url"]).alias("url"),
        F.md5(cms.extract_body_blocks(article["content_elements"])).alias("body_md5"),
    )


@query(
    "parse_cms_article",
    f"WITH {CMS_SQL} SELECT doc_id, title, api_subtitle AS subtitle, body, date, url, author, 'noticias' AS category FROM parsed",
)
def parse_cms(spark, sf):
    parsed = cms.parse_cms_article(F.col("article"), F.lit("noticias"), description_as_subtitle=True)
    return cms_articles(spark, sf).select("doc_id", parsed.alias("a")).select("doc_id", "a.*")


@query("extract_body_blocks", f"WITH {CMS_SQL} SELECT doc_id, body FROM parsed")
def body_blocks(spark, sf):
    body = cms.extract_body_blocks(F.col("article.content_elements"))
    return cms_articles(spark, sf).select("doc_id", body.alias("body"))


@query("first_author", f"WITH {CMS_SQL} SELECT doc_id, author FROM parsed")
def first_author(spark, sf):
    return cms_articles(spark, sf).select("doc_id", cms.first_author(F.col("article")).alias("author"))


@query(
    "parse_iso_utc",
    """SELECT event_id, CASE event_id % 6
    WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 150 MINUTE WHEN 2 THEN ts + INTERVAL 5 HOUR
    WHEN 3 THEN ts WHEN 4 THEN date_trunc('day', ts) END AS value FROM events""",
)
def iso_dates(spark, sf):
    """Event times as ISO text with several offsets, without one, as a date, and malformed."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.concat(stamp, F.lit("Z")))
        .when(kind == 1, F.concat(stamp, F.lit("+02:30")))
        .when(kind == 2, F.concat(stamp, F.lit("-0500")))
        .when(kind == 3, stamp)
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("on "), stamp))
    )
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", text.alias("text"))
    return rows.select("event_id", cms.parse_iso_utc(F.col("text")).alias("value"))


# Pages around the CMS articles: none, an empty object, or the article as embedded JSON.
def cms_html(spark, sf):
    doc = F.col("doc_id")
    payload = (
        F.when(doc % 4 == 0, F.lit("track();"))
        .when(doc % 4 == 1, F.lit("Fusion.globalContent = { };"))
        .otherwise(
            F.concat(F.lit('Fusion.site="x";Fusion.globalContent = '), F.to_json("article"), F.lit(";Fusion.y=1;"))
        )
    )
    html = F.concat(
        F.lit("<html><head><script>"), payload, F.lit("</script></head><body><h1>Nota "), doc.cast("string"),
        F.lit('</h1><time datetime="2024-05-08T10:00:00-03:00">hoy</time><p>'), F.col("text"), F.lit("</p></body></html>"),
    )
    return cms_articles(spark, sf).select("doc_id", html.alias("html"))


_EMBEDDED_SQL = "doc_id % 4 >= 2 AND NOT contains(text, '};')"
_FALLBACK_HTML = (
    "'<body><h1>Nota ' || doc_id || '</h1><time datetime=\"\">hoy</time><p>' || text || '</p></body></html>'"
)


@query(
    "extract_embedded_json",
    f"""WITH {CMS_SQL}
SELECT doc_id, NOT (doc_id % 4 = 0 OR (doc_id % 4 >= 2 AND contains(text, '}};'))) AS found,
       CASE WHEN {_EMBEDDED_SQL} THEN ' ' || split_part(text, chr(10), 1) END AS headline FROM parsed""",
)
def embedded(spark, sf):
    article = cms.extract_embedded_json(F.col("html"))
    rows = cms_html(spark, sf).select("doc_id", article.alias("article"))
    return rows.select("doc_id", F.col("article").isNotNull().alias("found"), F.col("article.headlines.basic").alias("headline"))


@query(
    "parse_with_fallback",
    f"""WITH {CMS_SQL}
SELECT doc_id, CASE WHEN {_EMBEDDED_SQL} THEN 'fusion' ELSE 'bs4_fallback' END AS method,
       CASE WHEN {_EMBEDDED_SQL} THEN title ELSE 'Nota ' || doc_id END AS title,
       CASE WHEN {_EMBEDDED_SQL} THEN body ELSE array_to_string(list_slice(list_filter(
         {_nodes_sql(_FALLBACK_HTML)}, lambda x: length(x) > 60), 1, 50), ' ') END AS body,
       CASE WHEN {_EMBEDDED_SQL} THEN date ELSE TIMESTAMP '2024-05-08 13:00:00' END AS date,
       CASE WHEN {_EMBEDDED_SQL} THEN url ELSE '' END AS url
FROM parsed""",
)
def with_fallback(spark, sf):
    rows = cms_html(spark, sf).withColumn("category", F.lit("noticias"))
    return parse_with_fallback(rows).select("doc_id", "method", "title", "body", "date", "url")


@query(
    "read_stopwords",
    f"""SELECT DISTINCT unnest({SPLIT_SQL}) AS word FROM documents""",
)
def stopword_file(spark, sf):
    """A word file made of every token of the documents, with blanks and capitals."""
    from folio.functions.text import clean_tokens

    path = scratch_path(spark, "words")
    token = F.explode(clean_tokens(F.col("text"), stopwords=None))
    line = F.concat(F.lit("  "), F.initcap("token"), F.lit("\t"))
    rows = documents(spark, sf).select(token.alias("token")).distinct()
    rows.select(line.alias("value")).unionByName(rows.limit(1).select(F.lit("  ").alias("value"))).write.text(path)
    return words.read_stopwords(spark, path)


WORD_DIM = 8
WORD_VECTORS_SQL = f"""word_vectors AS (
  SELECT term AS word, i, ('0x' || left(md5(term || ':' || i), 4))::INTEGER / 65535.0::DOUBLE - 0.5 AS x
  FROM vocabulary, (SELECT unnest(range({WORD_DIM})) AS i))"""


def word_vectors(spark, sf, rows=None):
    """``word, vec``: eight hash digits per vocabulary term."""
    rows = postings(spark, sf) if rows is None else rows
    vocabulary = terms.fit_vocabulary(rows, terms.count_rows(labels(spark, sf)))

    def value(i):
        digest = F.md5(F.concat("term", F.lit(f":{i}")))
        return F.conv(F.left(digest, F.lit(4)), 16, 10).cast("double") / 65535.0 - 0.5

    return vocabulary.select(F.col("term").alias("word"), F.array(*[value(i) for i in range(WORD_DIM)]).alias("vec"))


@query(
    "read_word_vectors",
    f"""WITH {POSTINGS_SQL}, {VOCABULARY_SQL}, {WORD_VECTORS_SQL}
SELECT word, CAST(i AS INTEGER) AS dim, round(x::FLOAT::DOUBLE, 5) AS value FROM word_vectors""",
)
def word_vector_file(spark, sf):
    path = scratch_path(spark, "vectors")
    words.write_word_vectors(word_vectors(spark, sf), path)
    read = words.read_word_vectors(spark, path)
    return read.select("word", F.posexplode("vec").alias("dim", "x")).select(
        "word", "dim", F.round(F.col("x").cast("double"), 5).alias("value")
    )


@query("metrics_json_io", f"WITH {CV_SUMMARY_SQL} SELECT *, 0.0::DOUBLE AS train_time_s FROM summary")
def metrics_json(spark, sf):
    path = scratch_path(spark, "metrics")
    summary = metrics.cv_summary(predictions(spark, sf)).withColumn("train_time_s", F.lit(0.0))
    missing = artifacts.read_metrics(spark, path)
    artifacts.write_metrics(summary, path)
    return missing.unionByName(artifacts.read_metrics(spark, path))


@query(
    "write_term_matrix",
    f"""WITH {POSTINGS_SQL}, {VOCABULARY_SQL},
idx AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_idx FROM vocabulary)
SELECT id, label, term_idx, n FROM postings JOIN idx USING (term)""",
)
def term_matrix(spark, sf):
    """Three tables written for a later job and joined again from what was stored."""
    path = scratch_path(spark, "matrix")
    rows = staged_postings(spark, sf)
    vocabulary = terms.fit_vocabulary(rows, terms.count_rows(labels(spark, sf)))
    artifacts.write_term_matrix(
        rows.select("id", "term", "n"),
        labels(spark, sf),
        terms.vocabulary_index(vocabulary).select("term", "term_idx"),
        path,
    )
    stored, targets, names = artifacts.read_term_matrix(spark, path)
    return (
        stored.join(names, "term")
        .join(targets, "id")
        .select("id", "label", F.col("term_idx").cast("bigint").alias("term_idx"), "n")
    )


_NORMAL_SQL = """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS dim, round(value / norm, 6) AS value FROM (
  SELECT vec_id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS pos,
         sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm
  FROM embeddings)"""


def _normalised(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return rows.select("vec_id", normalize_vector(F.col("embedding")).alias("vec"))


def _by_dimension(df, key):
    return df.select(key, F.posexplode("vec").alias("dim", "x")).select(
        key, "dim", F.round("x", 6).alias("value")
    )


@query("normalize_vector", _NORMAL_SQL)
def normalised(spark, sf):
    return _by_dimension(_normalised(spark, sf), "vec_id")


@query("materialise_once", _NORMAL_SQL)
def materialised(spark, sf):
    """Computed and stored on the first call, loaded on the second."""
    path = scratch_path(spark, "embeddings")
    artifacts.materialise_once(spark, path, lambda: _normalised(spark, sf))

    def never():
        raise RuntimeError("the stored table was not used")

    return _by_dimension(artifacts.materialise_once(spark, path, never), "vec_id")
