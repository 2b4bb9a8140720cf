"""Pages to article rows.

Each costly value (decoded markup, embedded JSON) is a column of its own before it is
used twice, so a row computes it once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.cms import (
    METHOD_EMBEDDED,
    METHOD_MARKUP,
    SITE,
    embedded_json,
    html_fallback_article,
    parse_cms_article,
    parse_json,
)
from folio.functions.html import (
    decode_entities,
    first_heading,
    long_nodes,
    mark_tags,
    split_marked,
    time_attribute,
)

_ARTICLE_FIELDS = ("title", "subtitle", "body", "date", "url", "author", "category")


def with_text_nodes(df: DataFrame, html: str = "html", nodes: str = "nodes") -> DataFrame:
    """Adds the array of text nodes of a page."""
    return (
        df.withColumn("__marked", mark_tags(F.col(html)))
        .withColumn("__decoded", decode_entities(F.col("__marked")))
        .withColumn(nodes, split_marked(F.col("__decoded")))
        .drop("__marked", "__decoded")
    )


def html_fallback_parse(df: DataFrame, html: str = "html", category: str = "category") -> DataFrame:
    """Adds ``article``: heading, long text nodes and date of the page's own markup."""
    article = html_fallback_article(
        first_heading(F.col(html)),
        long_nodes(F.col("__nodes")),
        time_attribute(F.col(html)),
        F.col(category),
    )
    return with_text_nodes(df, html, "__nodes").withColumn("article", article).drop("__nodes")


def parse_with_fallback(
    df: DataFrame, html: str = "html", category: str = "category", site: str = SITE
) -> DataFrame:
    """Article fields and ``method``: embedded JSON if usable, else the page's own text.

    A valid object with a short body does not fall back; an empty one does.
    """
    others = [c for c in df.columns if c not in (html, category)]
    tried = (
        df.withColumn("__json", embedded_json(F.col(html)))
        .withColumn("__json", F.when(~F.col("__json").rlike(r"^\{\s*\}$"), F.col("__json")))
        .withColumn("__cms", parse_json(F.col("__json")))
        # markup that will not be used is not decoded
        .withColumn("__html", F.when(F.col("__json").isNull(), F.col(html)))
    )
    usable = F.col("__json").isNotNull()
    both = html_fallback_parse(tried, "__html", category).withColumn(
        "__article",
        F.when(usable, parse_cms_article(F.col("__cms"), F.col(category), site=site)).otherwise(
            F.col("article")
        ),
    )
    method = F.when(usable, F.lit(METHOD_EMBEDDED)).otherwise(F.lit(METHOD_MARKUP))
    return both.select(
        *others, *[F.col(f"__article.{name}").alias(name) for name in _ARTICLE_FIELDS], method.alias("method")
    )
