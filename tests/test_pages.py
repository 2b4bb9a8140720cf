import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from folio.functions import cms, html, urls
from folio.operators.extract import parse_with_fallback, with_text_nodes
from folio.schemas import CMS_ARTICLE
from folio.sources.pages import read_cms_pages, read_labelled_html_dirs
from folio.sources.words import read_stopwords, read_word_vectors

LONG = "palabra " * 20


def parse(spark, article, **flags):
    df = spark.createDataFrame([(json.dumps(article),)], "j string").select(F.from_json("j", CMS_ARTICLE).alias("a"))
    return df.select(cms.parse_cms_article(F.col("a"), F.lit("c"), **flags).alias("r")).select("r.*").first()


def test_article_defaults(spark):
    row = parse(spark, {"content_elements": []})
    assert (row.title, row.subtitle, row.body, row.date, row.author) == ("", "", "", None, "")
    assert row.url == cms.SITE


def test_body_blocks(spark):
    elements = [
        {"type": "text", "content": "<p>uno</p>"},
        {"type": "header", "content": "", "text": "dos"},
        {"type": "list", "items": [{"content": "tres"}, {"text": " <i>cuatro</i> "}, {}]},
        {"type": "image", "content": "no"},
        {"type": "text", "content": "<br>"},
        {},
    ]
    assert parse(spark, {"content_elements": elements}).body == "uno dos tres cuatro"


def test_subtitle_and_dates(spark):
    article = {
        "headlines": {"basic": " T "}, "subheadlines": {"basic": ""}, "description": {"basic": " D "},
        "display_date": "", "first_publish_date": "2024-05-08T22:30:00.5-03:00", "credits": {"by": [{"name": "Ana"}]},
    }
    row = parse(spark, article, description_as_subtitle=True)
    assert (row.title, row.subtitle, row.author) == ("T", "D", "Ana")
    assert row.date == dt.datetime(2024, 5, 9, 1, 30, 0, 500000)
    assert parse(spark, article).subtitle == ""
    assert parse(spark, {**article, "display_date": "mañana"}).date is None


def test_iso_dates_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Argentina/Buenos_Aires")
    try:
        values = ["2024-01-31T10:00:00Z", "2024-01-31T10:00:00", "2024-01-31", "2024-01-31 10:00+0530", "2024-13-01", ""]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
        got = [r[0] for r in df.orderBy("i").select(cms.parse_iso_utc(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    ten = dt.datetime(2024, 1, 31, 10)
    assert got == [ten, ten, dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 4, 30), None, None]


def page(payload, body=LONG):
    return (
        f"<html><script>x=1;Fusion.globalContent = {payload};</script><h1> Un <b>t&iacute;tulo</b></h1>"
        f'<time datetime="2024-01-01">x</time><p>{body} a &amp; b &frac12;</p><p>corto</p></html>'
    )


def test_fallback_choice(spark):
    good = json.dumps({"headlines": {"basic": "H"}, "content_elements": [{"type": "text", "content": "breve"}]})
    spoiled = json.dumps({"headlines": {"basic": "a };"}})
    rows = [(1, page(good)), (2, page("{ }")), (3, page("{bad}")), (4, page(spoiled)), (5, "<p>nada</p>")]
    df = spark.createDataFrame(rows, "id int, html string").withColumn("category", F.lit("c"))
    got = {r.id: r for r in parse_with_fallback(df).collect()}
    # valid JSON with a short body does not fall back
    assert (got[1].method, got[1].title, got[1].body) == ("fusion", "H", "breve")
    for i in (2, 3, 4):
        assert got[i].method == "bs4_fallback"
        assert got[i].title == "Untítulo"
        assert got[i].body == f"{LONG} a & b ½"
        assert got[i].date == dt.datetime(2024, 1, 1) and got[i].url == ""
    assert got[5].body == "" and got[5].date is None


def test_text_nodes_skip_invisible_parts(spark):
    raw = "<!-- no --><style>p{}</style><p>a</p> <script>if (a<b) c</script><p> b &lt;i&gt; </p>"
    df = spark.createDataFrame([(raw,)], "html string")
    assert with_text_nodes(df).first().nodes == ["a", "b <i>"]
    assert df.select(html.html_to_text(F.col("html"))).first()[0] == "a b <i>"


def test_markers_and_links(spark):
    df = spark.createDataFrame([("x<p class=\"c\">uno\ndos<div>mas<div>fin",)], "t string")
    got = df.select(html.extract_between_markers(F.col("t"), '<p class="c">', "<div>")).first()[0]
    assert got == "unodos<div>mas"
    assert df.select(html.extract_between_markers(F.col("t"), "[", "]")).first()[0] is None


def test_resolved_links_match_urljoin(spark):
    from urllib.parse import urljoin

    base = "https://h.org/a/b/c.html?q=1#f"
    hrefs = ["x", "/x/y", "//o.org/z", "?p=2", "#top", "../up", "../../../over", "./same/", "http://e.org/", "", "mailto:a@b", ".."]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hrefs)], "i int, h string")
    got = [r[0] for r in df.orderBy("i").select(urls.resolve_url(F.lit(base), F.col("h"))).collect()]
    assert got == [urljoin(base, h) for h in hrefs]


def test_url_rules(spark):
    df = spark.createDataFrame([("https://h.org/2024/05/08/nota/",), ("https://h.org/2024/5/08/nota.html",)], "u string")
    rows = df.select(urls.is_article_url(F.col("u"), r"https://h\.org"), urls.url_slug(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [(True, "nota.html"), (False, "nota.html")]
    sections = spark.createDataFrame([("el-pais",), ("deportes",)], "s string")
    assert [r[0] for r in sections.select(urls.map_section(F.col("s"))).collect()] == ["elpais", None]


def test_html_directories(spark, tmp_path):
    for name, content in [("economia", b"<p>uno \xff</p>"), ("deportes", b"x")]:
        (tmp_path / name).mkdir()
        (tmp_path / name / "nota.html").write_bytes(content)
        (tmp_path / name / "nota.txt").write_bytes(b"no")
    rows = read_labelled_html_dirs(spark, str(tmp_path), ["economia", "falta"]).collect()
    assert [(r.category, r.html) for r in rows] == [("economia", "<p>uno �</p>")]
    assert rows[0].source.endswith("economia/nota.html")


def test_multiline_responses(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps({"count": 2, "content_elements": [{"website_url": "/a"}, {}]}, indent=1))
    got = read_cms_pages(spark, str(tmp_path)).select("total", "article.website_url").collect()
    assert sorted(map(tuple, got), key=str) == [(2, "/a"), (2, None)]


def test_word_files(spark, fixtures):
    assert {r.word for r in read_stopwords(spark, str(fixtures / "stopwords.txt")).collect()} == {
        "algún", "de", "la", "por qué",
    }
    vectors = {r.word: r.vec for r in read_word_vectors(spark, str(fixtures / "words.vec")).collect()}
    assert len(vectors) == 5 and vectors["mar"] == [0.5, -0.5, 0.25]


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "page, links",
    [
        ('<a data-href="x" href="y">', ["y"]),
        ("<a href=plain/path>t</a><a class=c href=b >", ["plain/path", "b"]),
        ('<a href="/s?a=1&amp;b=2">', ["/s?a=1&b=2"]),
        ("<A HREF='up'>", ["up"]),
        ('<a title="a > href=no" href="z">', ["z"]),
        ("<abbr href='no'><a>none</a>", []),
        ('<a href="">', [""]),
        ("<a name=n href = '1' href='2'>", ["1"]),
        ("", []),
    ],
)
def test_links_of_odd_anchors(spark, page, links):
    assert one(spark, page, html.extract_links) == links


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p title="a>b">hola</p>', "hola"),
        ("<p>x</p><script>if (a<b) leak()", "x"),
        ("<p>x</p><!-- never closed <p>y</p>", "x"),
        ("<p title=it's>uno</p><p>d'os</p>", "uno d'os"),
        ("<script src='a>b'>c</script>dos", "dos"),
    ],
)
def test_odd_markup(spark, page, text):
    assert one(spark, page, html.html_to_text) == text


def test_markers_span_all_line_ends(spark):
    assert one(spark, "x<a>uno\r\ndos tres\x85<b>y", lambda c: html.extract_between_markers(c, "<a>", "<b>")) == "uno\rdos tres\x85"


@pytest.mark.parametrize(
    "text, iso",
    [
        ("20240508", "2024-05-08 00:00:00"),
        ("2024-05-08T10", "2024-05-08 10:00:00"),
        ("20240508T101530", "2024-05-08 10:15:30"),
        ("2024-05-08 10:15:30.5+02:00:30", "2024-05-08 08:15:00.500000"),
        ("2024-05-08T10:15-03", "2024-05-08 13:15:00"),
        ("2024-05-08T10:15:30Z", "2024-05-08 10:15:30"),
        ("2024-05-0810", None),
        ("2024-0508", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_forms(spark, text, iso):
    got = one(spark, text, cms.parse_iso_utc)
    assert (None if got is None else str(got)) == iso
