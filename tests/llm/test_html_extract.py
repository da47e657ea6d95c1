import pytest

from tidewatch.llm import html_extract as h

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use</div>
<main><article><header><h1>Tit&eacute;l</h1><div class=byline>By me</div></header><p>One &amp;&nbsp;two<br>three <b>bold</b>er
 text<p>Second <a href=x>link</a><div class="ad">Buy</div><blockquote>Quote</blockquote><ul><li>a<li>b</ul><form><p>mail</p></form>
<section id="comments"><article class="comment"><p>nice</p></article></section></article></main><aside>Side</aside><footer>&copy; x</footer></body></html>"""


def text_of(html, *others, n=1):
    wrapper = h.wrapper_of(h.parse(html))
    for other in others:
        wrapper = h.align(wrapper, h.wrapper_of(h.parse(other)))
    plan = h.slots(wrapper, 1 + len(others))
    return h.main_text(h.parse(html), tuple(plan["roots"]), frozenset(map(tuple, plan["literals"])))


def test_article_without_its_surroundings():
    assert text_of(ARTICLE) == "Titél\n\nOne & two three bolder text\n\nSecond link\n\nQuote\n\na\n\nb"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("plain &lt;b&gt;", "plain <b>"), ("<p>unclosed <b>bold <i>x</p><p>y", "unclosed bold x\n\ny"),
        ("<table><tr><td>1<td>2<tr><td>3</table> z", "1\n\n2\n\n3\n\nz"), ("<p>a<!-- x -->b<script>1<2</script>c</p>", "abc"),
        ("<p>a</p></div></p><p>b</p>", "a\n\nb"), ("a < b", "a < b"), ("<p>x<p>&#8364;&hellip;", "x\n\n€…"), ("<div hidden>a</div><p style='display: none'>b</p>c", "c"),
        ("<script>never closed <p>x</p>", ""), ("<p title=\"a>b\">x</p>", "x"), ("<p title=don't>x</p>", "x"), ("<article><p>a</article><article><p>b</article>", "a\n\nb"),
        ("<div id=main-menu>m</div><div class='post-content with-sidebar'>c</div>", "c"), ("<!-- open", ""), ("<p>a<hr>b", "a\n\nb"),
        ("<head><title>x</title><meta a><p>in head", "in head"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\n\nb\n\nc"),
    ],
)
def test_markup(html, text):
    assert text_of(html) == text


def test_wrappers_are_union_free_expressions():
    def one(html):
        return h.as_expression(h.wrapper_of(h.parse(html)))

    assert one("<ul><li>a<li>b</ul>") == "<ul>(<li>#PCDATA</li>)+</ul>"
    assert one("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "<dl>(<dt>#PCDATA</dt><dd>#PCDATA</dd>)+</dl>"
    pages = ["<div><h2>Same</h2><p>one</p></div>", "<div><h2>Same</h2><p>two</p><p>three</p><ol><li>x</ol></div>", "<div><h2>Same</h2></div>"]
    wrapper = None
    for p in pages:
        own = h.wrapper_of(h.parse(p))
        wrapper = own if wrapper is None else h.align(wrapper, own)
    assert h.as_expression(wrapper) == "<div><h2>#TEXT</h2>(<p>#PCDATA</p>)*(<ol><li>#PCDATA</li></ol>)?</div>"


def test_template_text_goes_where_there_is_no_article():
    pages = [f"<div><p>Welcome to our site</p><p>Story {i} of the day</p><p><a href=/>All the stories</a></p></div>" for i in range(4)]
    assert text_of(*pages) == "Story 0 of the day"
    assert text_of(pages[0]) == "Welcome to our site\n\nStory 0 of the day"
    same = [pages[0]] * 4
    assert text_of(*same).startswith("Welcome")


def test_tables(spark):
    rows = [
        (1, "http://a.org/1", ARTICLE), (2, "http://a.org/2", ARTICLE.replace("Second", "Other")), (3, None, "<p>x"), (4, "::bad::", None), (1, "http://a.org/1", ARTICLE),
        (5, "http://A.org/3", "<p>no article here"), (6, "http://b.org", "<div>" * 3000 + "deep"), (7, "http://b.org", "<p>" + "long " * 300000),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string").repartition(3)
    found = h.extract(pages).collect()
    texts = {r.page_id: r._text for r in found}
    assert len(found) == 8 and {r.host for r in found} == {"clash"}
    assert texts[1] == text_of(ARTICLE) and "Other link" in texts[2] and texts[3] == "x" and texts[4] == "" and texts[5] == "no article here"
    assert texts[6] == "deep" and len(texts[7]) == 5 * 300000 - 1
    wrappers = {r.host: r.n for r in h.infer_wrappers(pages).collect()}
    assert wrappers == {"a.org": 4, "b.org": 2, "": 2}
    assert h.extract(pages.limit(0)).collect() == []
