import pytest

from folio.llm import html_text

NAV = '<nav><a href="/">Home</a></nav><div class="ad">Buy</div>'
CASES = {
    "plain": ("<p>One</p><p>Two</p>", "One\nTwo"),
    "article only": (f"<html><head><title>T</title></head><body>{NAV}<article><h1>Head</h1><p>Text</p></article><footer>F</footer>", "Head\nText"),
    "white space and references": ("<article><p> a\n\t&amp;&nbsp;b &lt;i&gt; &#233;&#x41; </p></article>", "a & b <i> éA"),
    "inline markup": ("<article><p>a<b>b</b> <i>c</i><br>d</p></article>", "ab c d"),
    "unclosed": ("<article><p><b>One<br><p>Two</article><p>out", "One\nTwo"),
    "script and style": ("<article><script>if (a<b) '</p>'</script><style>p{}</style><p>x</p><script>never", "x"),
    "comments": ("<article><!-- <p>no</p> --><p>yes</p><!-- open <p>no</p>", "yes"),
    "attributes": ('<article><p title="a>b" data-x=\'<p>\'>hola</p></article>', "hola"),
    "form and aside": ("<article><p>x</p><form><input><label>Mail</label></form><aside>more</aside></article>", "x"),
    "reader comments": ('<article><p>x</p><section id="comments"><p>first!</p></section></article>', "x"),
    "notice and sidebar": ('<main><div class="cookie-notice">ok?</div><div class="sidebar">s</div><div>y</div></main>', "y"),
    "hidden": ('<article><p hidden>no</p><div style="display: none">no</div><p>yes</p></article>', "yes"),
    "roles": ('<div role="navigation">n</div><div role="main"><p>m</p></div>', "m"),
    "site header": ("<header>Site</header><article><header><h1>Title</h1><p>By me</p></header><p>x</p></article>", "Title\nx"),
    "list": ("<article><ul><li>a<li>b</ul></article>", "a\nb"),
    "not a tag": ("<article><p>1 < 2 and 3>2</p></article>", "1 < 2 and 3>2"),
    "upper case": ("<ARTICLE><P>a</P><SCRIPT>b</SCRIPT></ARTICLE>", "a"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_structure(name):
    page, want = CASES[name]
    texts, zones = html_text.blocks(page)
    assert "\n".join(html_text.main_lines(texts, zones)) == want


@pytest.mark.parametrize("ours, theirs, want", [("abcd", "xbyd", {1, 3}), ("aab", "ba", {0}), ("", "a", set()), ("abab", "abab", {0, 1, 2, 3})])
def test_shared_lines_are_a_longest_common_subsequence(ours, theirs, want):
    found = html_text.shared_lines([ord(c) for c in ours], [ord(c) for c in theirs])
    assert len(found) == len(want) and (found == want or ours == "aab")


def test_template_lines_go_by_the_nearest_page(spark):
    frame = "<div>Welcome to us</div><div>{}</div><div>Call 555</div>"
    rows = [(i, f"http://h.example/news/{i:03d}", frame.format(f"Story number {i}")) for i in range(40)]
    rows += [(100, "http://alone.example/x", frame.format("Alone")), (101, "http://copy.example/a", "<p>same</p>"), (102, "http://copy.example/b", "<p>same</p>")]
    rows += [(103, "http://h.example/news/000", None)]
    got = {r["id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # the empty page of equal path is no partner
    assert all(got[i] == f"Story number {i}" for i in range(40))
    assert got[100] == "Welcome to us\nAlone\nCall 555" and got[101] == got[102] == "same" and got[103] == ""


def test_every_page_is_aligned_and_its_own_lines_outweigh_a_teaser(spark):
    page = "<div>Welcome to us all</div><article><h2>Teaser {0}</h2></article><div>{1}</div><div>Call 555 or write to us</div>"
    rows = [(i, f"http://h.example/{i}", page.format(i, f"Own long text number {i}")) for i in range(6)]
    # an article with a shared line in it and little outside: the mark holds, and the shared line of the article stays
    marked = "<div>Welcome to us all</div><article><p>Same words in all articles</p><p>Body {0}</p></article><div>by {0}</div>"
    rows += [(10 + i, f"http://m.example/{i}", marked.format(i)) for i in range(4)]
    got = {r["id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Teaser {i}\nOwn long text number {i}" for i in range(6))
    assert all(got[10 + i] == f"Same words in all articles\nBody {i}" for i in range(4))
