"""The page parser: no text stops it, its time is linear, and it reads plain pages as the standard library does."""
import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.functions.htmltree import Page, attributes, hrefs, tokens
from jobsift.plans import pages

PIECES = ["<", ">", "</", "<!", "<![", "<![foo[", "<![CDATA[", "]]>", "<!--", "-->", "--!>", "<?", "?>", "<p>", "</p>", "<li>", "<ul>", "</ul>", "<a href=",
          "'", '"', "=", "/x", " ", "<script>", "</script>", "<style", "text", "&amp;", "&#0;", "&#x110000;", "é", "\x00", "<img alt='location'>", "<td>", "<div>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=5)), max_size=40))
def test_no_text_stops_the_parser(parts):
    html = "".join(parts)
    page = Page(html)
    page.blocks(), page.beside_image("location"), page.links("/")
    assert [h for h in hrefs(html) if "/" in h] == [h for _, h in page.links("/")]
    assert all(-1 <= p < len(page.tags) for _, p in page.texts)


@pytest.mark.parametrize("piece", ["<p><div>", "<b><p>", "<!--", "<", "<a x='", "<a x='>", "<![if ", "<b></i>", "<b><li>", "<![CDATA[", "<?", "</a ", "=\"",
                                   "<p><table><td><b>", "<script>", "<li><ul>"])
def test_time_is_linear(piece):
    def seconds(n):
        html = "<a " * (piece == "=\"") + piece * n
        t0 = time.perf_counter()
        Page(html), hrefs(html)
        return time.perf_counter() - t0
    small = min(seconds(10_000) for _ in range(3))
    assert seconds(80_000) < 40 * small + 0.2


class Standard(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.seen, self.silent = [], False
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.seen.append(("start", tag, {k: v or "" for k, v in reversed(attrs)}))
        self.silent = tag in ("script", "style")

    def handle_endtag(self, tag):
        self.seen.append(("end", tag, None))
        self.silent = False

    def handle_data(self, data):
        if not self.silent and data.strip():
            self.seen.append(("text", data, None))


plain = st.recursive(
    st.one_of(st.sampled_from(["some text", "a &amp; b", "&eacute;t&#233;", "<br>", "<img src=x alt='the place'>", "<!-- <p> no -->", "<script>if (a < b) '<p>'</script>"])),
    lambda inner: st.builds(lambda tag, attr, kids: f"<{tag}{attr}>{''.join(kids)}</{tag}>", st.sampled_from(["div", "P", "ul", "li", "a", "span"]),
                            st.sampled_from(["", " class=x", ' href="/a?b=1&amp;c=2"', " HREF='it&quot;s' id=\"a>b\"", " checked data-x = 5"]), st.lists(inner, max_size=4)),
    max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(plain)
def test_plain_pages_read_as_in_the_standard_library(html):
    mine = [(k, t if k != "text" else a, attributes(a) if k == "start" else None) for k, t, a in tokens(html) if k != "text" or a.strip()]
    assert mine == Standard(html).seen


def test_odd_marks(spark):
    odd = ["<p>x</p><![foo[bar]]><a href='/fr/job/1'>one</a>", "<p>a long enough paragraph that stays in the description.<!-- open", "<a href='/fr/job/2>two</a><p>three</p>",
           "<!x><?php echo ?></><p>&#xD800; &#99999999;", None, "", "<" * 50, "<a href=/fr/job/3 href=/fr/job/4>x</a>", "<a title=it's href=/fr/job/5>"]
    df = spark.createDataFrame([(i, "https://h.org/x", h) for i, h in enumerate(odd)], "page_id long, url string, html string")
    links = {(r["page_id"], r["link"]) for r in pages.extract_links(df).collect()}
    assert links == {(0, "https://h.org/fr/job/1"), (7, "https://h.org/fr/job/3"), (8, "https://h.org/fr/job/5"), (2, "https://h.org'/fr/job/2")}
    fields = {r["page_id"]: r for r in pages.extract_page_fields(df).collect()}
    assert len(fields) == len(odd) and fields[1]["description"] == "a long enough paragraph that stays in the description."
    assert pages.extract_body_text(df).count() == len(odd)
