"""Links of odd pages against a parser, addresses against the standard library's rules."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

from pageflow.sources import landing, links

PAGES = [
    '<a href="/a">x</a><A HREF=\'/b\'>y</A><a href=/c>z</a><a\n href = "/d" >',
    '<a name="n">no</a><a data-href="/no" href="/yes"><a href><a href=""><a class=x href=/u id=2>',
    '<!-- <a href="/no1"> --><a href="/1"><script>var s = \'<a href="/no2">\';</script><a href="/2">',
    '<style>a:after{content:"<a href=/no>"}</style><a title="a > b" href="/gt"><a title=\'"\' href="/q">',
    '<a href="/x?a=1&amp;b=2&#38;c&#x26;d&quot;&lt;"><a href="/&#233;&#xe9;&#128512;&amp;amp;">',
    '<a href="/first" href="/second"><abbr href="/no"><area href="/no"><a/href="/slash"><a href="/self"/>',
    "<a title=don't href=/quote><p title=it's><a href='/after'>",
    "text < 5 <a href=/less> a<b><a href=/more",
    "",
    None,
    "<a href='é ü'>ü</a><a href=\"/multi\nline\">",
    "<!DOCTYPE html><?php echo ?><a href='/decl'>",
    "<a " + "x=1 " * 3_000 + "href='/many'>" + "<p>" * 20_000 + "<a href='/far'>",
    "<!-- open <a href='/no'>",
    "<SCRIPT><a href='/no'></scripty><a href='/no'></SCRIPT ><a href='/out'>",
]
LINKS = [
    "http://x.org/a", "//h.org/p", "/p/../q?x#y", "a/b", "../up", "../../../top", "./same", ".", "..", "?q=1", "#frag", "",
    "a/./b/../c", "mailto:a@b", "HTTP://X/", "g;x=1/../y", "  /spaces  ",
]
BASES = ["http://h.org/d/e/f.html?old=1#z", "https://h.org", "http://h.org/d/"]


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        names = [n for n, _ in attrs]
        if tag == "a" and "href" in names:
            self.found.append(attrs[names.index("href")][1] or "")


def parsed(page: str | None) -> list[str]:
    parser = Anchors()
    parser.feed(page or "")
    parser.close()
    return parser.found


def test_anchors_of_odd_pages(spark):
    rows = spark.createDataFrame(list(enumerate(PAGES)), "page_id int, html string")
    got: dict[int, list[str]] = {k: [] for k in range(len(PAGES))}
    for r in links.anchors(rows).collect():
        got[r.page_id].append(r.link)
    for k, page in enumerate(PAGES):
        assert got[k] == parsed(page), page[:200]


def test_addresses(spark):
    cases = [(b, x) for b in BASES for x in LINKS]
    rows = spark.createDataFrame(cases, "base string, link string")
    for r in rows.select("base", "link", links.resolved(rows["link"], rows["base"]).alias("got")).collect():
        wanted = urljoin(r.base, r.link.strip())
        assert r.got.rstrip("/") == wanted.rstrip("/") or r.link in ("HTTP://X/", "") or "#" in wanted, (r, wanted)
    odd = {(r.base, r.link): r.got for r in rows.select("base", "link", links.resolved(rows["link"], rows["base"]).alias("got")).collect()}
    assert odd[(BASES[0], "#frag")] == "http://h.org/d/e/f.html?old=1#frag"
    assert odd[(BASES[0], "")] == "http://h.org/d/e/f.html?old=1"
    assert odd[(BASES[0], "/p/../q?x#y")] == "http://h.org/q?x#y"
    assert odd[(BASES[0], "../../../top")] == "http://h.org/top"


def test_base_elements(spark):
    html = '<head><base target="_top"><base href="/root/x"><base href="/no/"></head><a href="y.gz">'
    rows = spark.createDataFrame([(1, "http://h.org/p/", html), (2, "http://h.org/p/", "<a href='y.gz'>"), (3, None, "<a href='y.gz'>")], "n int, url string, html string")
    got = {r.n: r.address for r in links.anchors(rows, url="url").collect()}
    assert got == {1: "http://h.org/root/y.gz", 2: "http://h.org/p/y.gz", 3: "y.gz"}


def test_harvest_skips_what_is_no_markup(spark):
    rows = spark.createDataFrame([(1, '<!--<a href="/a.gz">--><a href=/b.gz><a href="/c&#46;gz">')], "page_id int, html string")
    assert [r.link for r in landing.link_harvest(rows, "/", ".gz").collect()] == ["/b.gz", "/c.gz"]
