"""Articles embedded in pages or API responses as CMS JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.arrays import let
from folio.functions.text import first_non_blank, strip_html_tags, trim_spaces
from folio.functions.urls import build_url
from folio.schemas import CMS_ARTICLE

# The assignment that carries the article, and the names of both methods.
EMBEDDED_PATTERN = r"(?s)Fusion\.globalContent\s*=\s*(\{.+?\});"
METHOD_EMBEDDED = "fusion"
METHOD_MARKUP = "bs4_fallback"

SITE = "https://news.example.org"


def embedded_json(html: Column) -> Column:
    """Text of the embedded article object; null when absent or not valid JSON.

    The capture ends at the first ``};``, so such a pair inside a string spoils the
    object and the page is parsed as plain markup.
    """
    return let(
        F.regexp_extract(html, EMBEDDED_PATTERN, 1),
        lambda text: F.when((text != "") & F.try_parse_json(text).isNotNull(), text),
    )


def extract_embedded_json(html: Column) -> Column:
    """The embedded article as a struct; null when absent or not valid JSON."""
    return let(embedded_json(html), parse_json)


def parse_json(text: Column) -> Column:
    return F.when(text.isNotNull(), F.from_json(text, CMS_ARTICLE))


# date, hour, minute, second, fraction; sign, hours, minutes and seconds of the offset; with or without separators
_ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?(?:Z|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2}))?)?)?)?$"
)


def parse_iso_utc(text: Column) -> Column:
    """ISO-8601 text to a naive UTC timestamp; blank or malformed text gives null.

    Values without an offset count as UTC, whatever the session zone is.
    """
    part = lambda i: F.regexp_extract(text, _ISO, i)
    number = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
    clock = lambda i: F.lpad(number(i).cast("string"), 2, "0")
    day = F.concat_ws("-", part(1), part(3), part(4))
    time = F.concat(clock(5), F.lit(":"), clock(6), F.lit(":"), clock(7), F.lit("."), F.rpad(part(8), 6, "0"))
    offset = (number(10) * 3600 + number(11) * 60 + number(12)) * F.when(part(9) == "-", -1).otherwise(1)
    local = F.unix_micros(F.try_to_timestamp(F.concat(day, F.lit("T"), time, F.lit("Z"))))
    return F.when(text.rlike(_ISO), micros_to_ntz(local - offset.cast("long") * 1_000_000))


def micros_to_ntz(micros: Column) -> Column:
    """Naive UTC timestamp of a microsecond count, independent of the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000).cast("decimal(20,6)")).cast("decimal(18,6)")
    )


def extract_body_blocks(elements: Column) -> Column:
    """Body text: text and header elements and list items, tags stripped, in order."""

    def pieces(element: Column) -> Column:
        own = F.array(first_non_blank(element["content"], element["text"]))
        items = F.transform(
            F.coalesce(element["items"], F.array()),
            lambda item: first_non_blank(item["content"], item["text"]),
        )
        nothing = F.array().cast("array<string>")
        return (
            F.when(element["type"].isin("text", "header"), own)
            .when(element["type"] == "list", items)
            .otherwise(nothing)
        )

    raw = F.flatten(F.transform(F.coalesce(elements, F.array()), pieces))
    stripped = F.transform(raw, lambda piece: trim_spaces(strip_html_tags(piece)))
    return F.array_join(F.filter(stripped, lambda piece: piece != ""), " ")


def first_author(article: Column) -> Column:
    return F.coalesce(F.get(article["credits"]["by"], F.lit(0))["name"], F.lit(""))


def parse_cms_article(
    article: Column, category: Column, *, site: str = SITE, description_as_subtitle: bool = False
) -> Column:
    """A CMS article struct as a flat article struct.

    ``description_as_subtitle`` is the API variant: a blank subtitle falls back to
    the description.
    """
    subtitles = [article["subheadlines"]["basic"]]
    if description_as_subtitle:
        subtitles.append(article["description"]["basic"])
    return F.struct(
        trim_spaces(first_non_blank(article["headlines"]["basic"])).alias("title"),
        trim_spaces(first_non_blank(*subtitles)).alias("subtitle"),
        extract_body_blocks(article["content_elements"]).alias("body"),
        parse_iso_utc(first_non_blank(article["display_date"], article["first_publish_date"])).alias(
            "date"
        ),
        build_url(site, article["website_url"]).alias("url"),
        first_author(article).alias("author"),
        category.alias("category"),
    )


def html_fallback_article(title: Column, body: Column, stamp: Column, category: Column) -> Column:
    """Article struct of a page without usable embedded JSON."""
    blank = F.lit("")
    return F.struct(
        title.alias("title"),
        blank.alias("subtitle"),
        body.alias("body"),
        parse_iso_utc(stamp).alias("date"),
        blank.alias("url"),
        blank.alias("author"),
        category.alias("category"),
    )
