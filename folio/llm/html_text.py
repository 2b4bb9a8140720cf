"""Main text of web pages: structure first, then differencing against the page of nearest URL."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.ranking import staged_rank
from folio.session import stage

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - frozenset("td th tr tbody thead tfoot caption option optgroup legend head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# What never belongs to the main text: by element, by role, and by a word of class or id.
DROPPED = frozenset("nav footer aside form fieldset button select menu dialog head canvas object audio video".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs masthead topbar footer comment comments commentlist disqus replies reply respond "
    "discussion share sharing social related recommended recommendations widget toolbar pagination pager skip search".split()
)
CONTENT_WORDS = frozenset(("articlebody", "article-body", "article-content", "entry-content", "post-content", "main-content"))

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'=/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s"'=/]+)""")
URL = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^?#]*)")

MAIN, OPEN = 1, 2  # zones of a block: inside the article, undecided; dropped blocks are not kept at all


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value, bare in ATTRIBUTE.findall(text):
        found[(name or bare).lower()] = html.unescape(value.strip("\"'")).lower() if value else ""
    return found


def _marks(tag: str, text: str, in_main: bool) -> int:
    """-1: dropped with all it holds; 1: the article; 0: neither."""
    if tag in DROPPED or (tag == "header" and not in_main):
        return -1
    attributes = _attributes(text) if text.strip(" /") else {}
    if attributes:
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
            return -1
        role, named = attributes.get("role", ""), f"{attributes.get('class', '')} {attributes.get('id', '')}"
        if role in DROPPED_ROLES or (not in_main and {"header"} & set(re.split(r"[\s_-]+", named))):
            return -1
        if tag not in ("html", "body", "article", "main") and DROPPED_WORDS & set(re.split(r"[\s_-]+", named)):
            return -1
        if role in ("main", "article") or attributes.get("itemprop") == "articlebody" or CONTENT_WORDS & set(named.split()):
            return 1
    return 1 if tag in ("article", "main") else 0


def blocks(page: str) -> tuple[list[str], list[int]]:
    """Text and zone of each block outside dropped elements, in page order.

    Reads tag soup: a closing tag closes all that is open inside its element, one without an open element is ignored, a block
    closes an open paragraph, and an element that holds code or is never closed reaches to its end tag or the page's end.
    """
    texts: list[str] = []
    zones: list[int] = []
    stack: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    dropped = main = heads = 0  # open elements that drop, that are the article, that are headers of an article
    pieces: list[str] = []

    def flush() -> None:
        line = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if line:
            texts.append(line)
            zones.append(MAIN if main else OPEN)

    def close_to(tag: str) -> None:
        nonlocal dropped, main, heads
        while stack:
            name, mark = stack.pop()
            count[name] -= 1
            dropped -= mark == -1
            main -= mark == 1
            heads -= mark == 2
            if name == tag:
                return

    def text(start: int, end: int) -> None:
        if start < end and not dropped and (not heads or any(count[h] for h in HEADINGS)):
            pieces.append(page[start:end])

    at = 0
    while (found := TAG.search(page, at)) is not None:
        text(at, found.start())
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                text(found.start() + 9, at - 3 if found[0].endswith("]]>") else at)
            continue
        tag = found[2].lower()
        if tag in BLOCK:
            flush()
        if tag == "br":
            pieces.append(" ")
        if found[1]:
            if count[tag]:
                close_to(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        if count["p"] and tag in ENDS_PARAGRAPH:
            close_to("p")
        if tag in ("li", "dt", "dd", "option", "td", "th", "tr") and stack and stack[-1][0] == tag:
            close_to(tag)
        if found[3].endswith("/") and tag not in BLOCK:
            continue
        mark = _marks(tag, found[3], bool(main))
        if tag == "header" and mark == 0:
            mark = 2
        stack.append((tag, mark))
        count[tag] += 1
        dropped += mark == -1
        main += mark == 1
        heads += mark == 2
    text(at, len(page))
    flush()
    return texts, zones


def shared_lines(ours: list[int], theirs: list[int]) -> set[int]:
    """Positions of ours on a longest common subsequence with theirs.

    A common subsequence is an increasing run through the pairs of equal lines, so the longest one is found by
    keeping the smallest end of each length, over pairs only and not over all lines against all.
    """
    places = defaultdict(list)
    for j, key in enumerate(theirs):
        places[key].append(j)
    ends: list[int] = []
    tops: list[tuple] = []
    for i, key in enumerate(ours):
        for j in reversed(places.get(key, ())):
            k = bisect_left(ends, j)
            link = (i, tops[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                tops.append(link)
            else:
                ends[k], tops[k] = j, link
    found, link = set(), tops[-1] if tops else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def main_lines(texts: list[str], zones: list[int]) -> list[str]:
    """The article's blocks where the page marks one, else all undecided blocks."""
    return [t for t, z in zip(texts, zones) if z == MAIN] if MAIN in zones else texts


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text`` per page: its main blocks, one a line.

    Each page is parsed once into blocks. Pages with blocks are ordered by host and URL path; a page's partner is the neighbour
    in that order, of the same host, whose path shares the longer prefix (of equals the earlier one), and the two pages'
    lines are aligned by longest common subsequence. Shared lines go, but for those in an element marked as the
    article: what two articles share is content. Where a page marks an article, its text is that article, unless the lines
    outside it that are the page's own (not shared) are longer: then the mark is a teaser's, and they are text too. Only keys
    are ordered, by a range sort, so a host with a third of the pages spreads over tasks; a page looks at the lines of one
    partner; texts stay where they were written.

    Null or empty html gives an empty text. Pages without a URL or host are paired among themselves; a page alone on its host
    has no partner and keeps its undecided blocks. Repeated rows each give a row; an empty table gives none.
    """
    id_type = pages.schema[id_col].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts, marked, keys, hosts, paths = [], [], [], [], []
                for url, page in zip(part.column(1), part.column(2)):
                    lines, zones = blocks(page.as_py())
                    marked.append([z == MAIN for z in zones])
                    texts.append(lines)
                    keys.append([xxhash.xxh64_intdigest(t) - (1 << 63) for t in lines])
                    place = URL.match(url.as_py() or "")
                    hosts.append(place[1].lower() if place else "")
                    paths.append(place[2] if place else url.as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(hosts, pa.string()),
                        pa.array(paths, pa.string()),
                        pa.array(texts, pa.list_(pa.string())),
                        pa.array(marked, pa.list_(pa.bool_())),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["id", "url", "host", "path", "texts", "marked", "keys"],
                )

    schema = f"id {id_type}, url string, host string, path string, texts array<string>, marked array<boolean>, keys array<long>"
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")))
    parsed = stage(rows.mapInArrow(parse, schema).withColumn("row", F.monotonically_increasing_id()), "page-blocks")

    places = parsed.where(F.size("keys") > 0).select("row", "host", "path")
    ranked = stage(staged_rank(places, [], ["host", "path", "row"], "place"), "page-places")

    def neighbour(name: str, step: int) -> DataFrame:
        return ranked.select(
            (F.col("place") + step).alias("place"), *[F.col(c).alias(f"{name}_{c}") for c in ("row", "host", "path")]
        )

    def prefix(name: str):
        # the common prefix grows while characters agree; -1 for a neighbour of another host
        shorter = F.least(F.length("path"), F.length(f"{name}_path"))
        same = lambda i: F.substring("path", i, F.lit(1)) == F.substring(f"{name}_path", i, F.lit(1))
        length = F.aggregate(
            F.sequence(F.lit(1), shorter), F.lit(0), lambda n, i: F.when((n == i - 1) & same(i), i).otherwise(n)
        )
        return F.when(F.col(f"{name}_host") == F.col("host"), F.when(shorter > 0, length).otherwise(0)).otherwise(-1)

    both = ranked.join(neighbour("before", 1), "place", "left").join(neighbour("after", -1), "place", "left")
    partners = both.select(
        "row",
        F.when(F.greatest(prefix("before"), prefix("after")) < 0, None)
        .when(prefix("before") >= prefix("after"), F.col("before_row"))
        .otherwise(F.col("after_row"))
        .alias("partner"),
    )
    lines = parsed.select("row", "keys")
    paired = partners.join(lines, "row").join(lines.select(F.col("row").alias("partner"), F.col("keys").alias("theirs")), "partner")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shared = [], []
            for row, *sides in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = shared_lines(*sides)
                if found and len(found) < len(sides[0]):
                    rows.append(row)
                    shared.append(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(shared, pa.list_(pa.int32()))], names=["row", "shared"])

    template = stage(paired.select("row", "keys", "theirs").mapInArrow(align, "row long, shared array<int>"), "page-template")
    shared = lambda i: F.coalesce(F.array_contains("shared", i), F.lit(False))
    own = F.filter("texts", lambda _, i: ~F.get("marked", i) & ~shared(i))
    size = lambda lines: F.length(F.array_join(lines, ""))
    in_article = F.filter("texts", lambda _, i: F.get("marked", i))
    # what the two pages do not share outweighs the mark: the mark is a teaser's
    is_article = (F.size(in_article) > 0) & (size(in_article) >= size(own))
    kept = F.when(is_article, in_article).otherwise(F.filter("texts", lambda _, i: F.get("marked", i) | ~shared(i)))
    return parsed.join(template, "row", "left").select("id", "url", F.array_join(kept, "\n").alias("text"))
