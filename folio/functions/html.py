"""Markup to text, and the legacy marker extraction."""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.text import trim_spaces

# The rest of a tag after its "<": a quoted attribute value may hold ">".
_TAG_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>"""
# Parts of a page that are not text; one that is never closed reaches to the page's end.
_INVISIBLE = rf"(?is)<!--.*?(?:-->|\z)|<(script|style|template)(?=[\s/>]){_TAG_REST}.*?(?:</\1\s*>|\z)"
_BREAK = "\u0001"

# Entities decoded without leaving the JVM; &amp; must come last.
NAMED_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&hellip;", "…"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&aacute;", "á"),
    ("&eacute;", "é"),
    ("&iacute;", "í"),
    ("&oacute;", "ó"),
    ("&uacute;", "ú"),
    ("&uuml;", "ü"),
    ("&ntilde;", "ñ"),
    ("&amp;", "&"),
)
_OTHER_ENTITY = (
    "&(?!(?:" + "|".join(name[1:-1] for name, _ in NAMED_ENTITIES) + ");)[#A-Za-z]"
)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(_html.unescape, na_action="ignore")


def decode_entities(text: Column) -> Column:
    """Entities to characters; only texts with unlisted entities go through Python."""
    named = text
    for name, char in NAMED_ENTITIES:
        named = F.replace(named, F.lit(name), F.lit(char))
    return F.coalesce(_unescape(F.when(text.rlike(_OTHER_ENTITY), text)), named)


def mark_tags(html: Column) -> Column:
    """Markup with every tag and every invisible part replaced by a break character."""
    return F.regexp_replace(F.regexp_replace(html, _INVISIBLE, _BREAK), f"<{_TAG_REST}|<[^>]*>", _BREAK)


def split_marked(decoded: Column) -> Column:
    """The stripped, non-empty pieces between break characters."""
    return F.filter(
        F.transform(F.split(decoded, _BREAK), trim_spaces), lambda piece: piece != ""
    )


def text_nodes(html: Column) -> Column:
    """The stripped, non-empty text nodes in page order."""
    return split_marked(decode_entities(mark_tags(html)))


def html_to_text(html: Column) -> Column:
    """Markup to text: nodes joined by one blank; null stays null."""
    return F.when(html.isNotNull(), F.array_join(text_nodes(html), " "))


def first_heading(html: Column) -> Column:
    """Text of the first <h1>, its nodes stripped and run together; '' without one."""
    inner = F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1)
    return F.array_join(text_nodes(inner), "")


def time_attribute(html: Column) -> Column:
    """The datetime attribute of the first <time>; '' without one."""
    tag = F.regexp_extract(html, r"(?is)<time\b([^>]*)>", 1)
    return F.regexp_extract(tag, r"""(?is)\bdatetime\s*=\s*["']([^"']*)["']""", 1)


def long_nodes(nodes: Column, min_chars: int = 60, max_nodes: int = 50) -> Column:
    """The first ``max_nodes`` text nodes longer than ``min_chars``, joined by blanks."""
    return F.array_join(
        F.slice(F.filter(nodes, lambda n: F.length(n) > min_chars), 1, max_nodes), " "
    )


def extract_between_markers(text: Column, start: str, end: str) -> Column:
    r"""Greedy capture between two literal markers after dropping newlines; null without one."""
    joined = F.replace(text, F.lit("\n"), F.lit(""))
    return F.nullif(F.regexp_extract(joined, rf"(?s)\Q{start}\E(.+)\Q{end}\E", 1), F.lit(""))


# An anchor up to the value of its first href attribute; "data-href" and text inside other values do not count.
_HREF = (
    r"""(?is)<a(?=\s)(?:[^>=\s]++|\s(?!href\s*=)|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
    r"""\shref\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
)


def extract_links(html: Column) -> Column:
    """The href values of all anchors, in page order, quoted or not, with entities decoded."""
    raw = F.regexp_extract_all(html, F.lit(_HREF), F.lit(1))
    bare = F.transform(raw, lambda v: F.regexp_replace(v, r"""^(["'])(.*)\1$""", "$2"))
    # the decoder works on texts, so the values of a page go through it as one
    decoded = F.split(decode_entities(F.array_join(bare, _BREAK)), _BREAK)
    return F.when(F.size(raw) > 0, decoded).otherwise(F.when(raw.isNotNull(), F.array().cast("array<string>")))
