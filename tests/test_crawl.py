from urllib.parse import urljoin

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.functions.text import decode_entities, encode_entities, html_to_text
from tidepool.functions.urls import acceptable_path, hrefs, in_scope, query_map, resolve_url
from tidepool.operators import crawl

PAGES = [
    ("http://a.org/", '<a href="/b.html">b</a> <A HREF=\'c\'>c</A> <a href=x/../d.html>d</a>'
                      '<a name="q">no</a><a href="http://evil.com/?u=a.org">e</a>'),
    ("http://a.org/b.html", '<a href="/">home</a><a href="d.html">d</a><a href="/doc.pdf">p</a>'),
    ("http://a.org/c", '<a href="/d.html#top">frag</a><a href="/a.html?x=1">q</a>'),
    ("http://a.org/d.html", '<a href="../gone">gone</a><a href="//b.org/x">other</a>'),
    ("http://evil.com/?u=a.org", '<a href="http://a.org/late">late</a>'),
    ("http://a.org/island", '<a href="/d.html">d</a>'),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "url STRING, html STRING")


def test_bfs(spark, pages):
    seeds = crawl.seed_source(spark, ["http://a.org/", "http://a.org/"])
    got = {r["url"]: (r["depth"], r["status"])
           for r in crawl.crawl_bfs(pages, seeds, ["a.org"]).collect()}
    # The last dot behind the last slash is in "?u=a.org", so the out-of-scope page is not followed.
    assert got == {
        "http://a.org/": (0, "fetched"), "http://a.org/b.html": (1, "fetched"),
        "http://a.org/c": (1, "fetched"), "http://a.org/d.html": (1, "fetched"),
        "http://a.org/gone": (2, "missing")}


def test_bfs_scope_by_host_and_depth(spark, pages):
    seeds = crawl.seed_source(spark, ["http://a.org/"])
    one = crawl.crawl_bfs(pages, seeds, ["a.org"], max_depth=1, scope="host")
    assert {r["url"] for r in one.collect()} == {
        "http://a.org/", "http://a.org/b.html", "http://a.org/c", "http://a.org/d.html"}


def test_bfs_does_not_depend_on_partitions(spark, pages):
    seeds = crawl.seed_source(spark, ["http://a.org/"])
    a = rows(crawl.crawl_bfs(pages.repartition(1), seeds, ["a.org"]))
    b = rows(crawl.crawl_bfs(pages.repartition(5), seeds, ["a.org"]))
    assert a == b


REFS = ["", "#f", "?q=1", "?q=1#f", "x", "./x", "../x", "../../x", "../../../x", "/x", "/x/./y",
        "/x/../y", "//h.net/p", "//h.net", "http://z.com/a?b#c", "mailto:a@b.c", "x/y/../z", "x/.",
        "x/..", "..", ".", "/", "a;b=1", "x?y=/../z", "x#/../z", "HTTP://Z.com", "/a.b/c", "..x/y"]


@pytest.mark.parametrize("base", ["http://h.org/a/b/c.html?k=v#z", "https://h.org", "http://h.org/"])
def test_resolve_like_the_standard(spark, base):
    df = spark.createDataFrame([(base, r) for r in REFS], "base STRING, ref STRING")
    got = {r["ref"]: r["u"] for r in df.select("ref", resolve_url("base", "ref").alias("u")).collect()}
    for ref in REFS:
        want = urljoin(base, ref)
        if ref == "":
            want = base.split("#")[0]
        if ref == "HTTP://Z.com":
            want = ref
        assert got[ref].rstrip("/") == want.rstrip("/"), ref


def test_relative_base_is_dropped(spark):
    df = spark.createDataFrame([("/x", "y")], "base STRING, ref STRING")
    assert df.select(resolve_url("base", "ref")).first()[0] is None


def test_acceptable_path(spark):
    cases = {"http://h.com": False, "http://h.com/": True, "http://h.com/a.html": True,
             "http://h.com/a.html?x=1": False, "http://h.com/10?page=2": True,
             "http://h.com/a.HTML": False, "http://h.com/a.pdf": False, "http://h.com/x#y": False,
             "http://h.com/a.": True, "http://h.com/a.jsp": True, "http://h.com/a.b\\c": True}
    df = spark.createDataFrame([(u,) for u in cases], "u STRING")
    got = {r["u"]: r["ok"] for r in df.select("u", acceptable_path("u").alias("ok")).collect()}
    assert got == cases


def test_scope_modes(spark):
    df = spark.createDataFrame([("http://x.a.org/p",), ("http://evil.com/?u=a.org",),
                                ("http://nota.org/",), ("http://u@a.org:80/",)], "u STRING")
    assert [r[0] for r in df.select(in_scope("u", ["a.org"])).collect()] == [True] * 4
    assert [r[0] for r in df.select(in_scope("u", ["a.org"], "host")).collect()] == [
        True, False, False, True]


def test_not_visited_and_links(spark, pages):
    links = crawl.extract_links(pages)
    assert ("http://a.org/", "http://a.org/d.html") in rows(links)
    seen = spark.createDataFrame([("http://a.org/c",)], "url STRING")
    fresh = crawl.not_visited(links.select(F.col("dst").alias("url")), seen)
    got = [r[0] for r in fresh.collect()]
    assert len(got) == len(set(got)) and "http://a.org/c" not in got
    degree = {r["url"]: (r["out_degree"], r["in_degree"])
              for r in crawl.link_graph(links).collect()}
    assert degree["http://a.org/"] == (4, 1) and degree["http://a.org/d.html"] == (2, 3)


def test_preferred_merge(spark):
    a = spark.createDataFrame([("m",), ("b",)], "url STRING")
    b = spark.createDataFrame([("a",), ("b",)], "url STRING")
    merged = crawl.preferred_merge(a, b).orderBy("position")
    assert [tuple(r) for r in merged.collect()] == [("b", 0, 0), ("m", 0, 1), ("a", 1, 2), ("b", 1, 3)]


def test_links_that_are_not_followed(spark):
    html = ('<!-- <a href="/comment"> --><script>x = "<a href=\'/script\'>";</script>'
            '<style>/* <a href="/style"> */</style><a href="javascript:void(0)">j</a>'
            '<a href="mailto:a@b.c">m</a><a href="tel:1">t</a><a href="one.html">1</a>')
    based = '<head><base target="x" href="../sub/"></head>' + html
    pages = spark.createDataFrame([("http://h.org/d/p.html", html), ("http://h.org/e/p.html", based)],
                                  "url STRING, html STRING")
    assert rows(crawl.extract_links(pages)) == [
        ("http://h.org/d/p.html", "http://h.org/d/one.html"),
        ("http://h.org/e/p.html", "http://h.org/sub/one.html")]
    counted = {r["stage"]: r["processed"] for r in crawl.crawl_counters(pages).collect()}
    assert counted == {"pages": 2, "links": 2, "accepted": 2}


def test_visible_text_of_the_whole_standard(spark):
    texts = {"caf&eacute; &#8217;x&#8217; &mdash; one<hr>two<dl><dt>k</dt><dd>v": "café ’x’ — one two k v",
             "&euro;1 &Omega;&hellip; &rarr; &bull; &#x1F600; &#xD800; &#0; &nosuch; a&b": 
             "€1 Ω… → • 😀 &#xD800; &#0; &nosuch; a&b",
             "<form>a<fieldset>b</fieldset><select><option>c<option>d</select></form><address>e": "a b c d e",
             "<table><caption>t</caption><thead><tr><th>h<tbody><tr><td>x<i>y</i>": "t h xy"}
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = {r["t"]: r["v"] for r in df.select("t", html_to_text("t").alias("v")).collect()}
    assert got == texts
    names = {"€": "&euro;", "Ω": "&Omega;", "♦": "&diams;", "ƒ": "&fnof;", "日": "日", "😀": "😀"}
    df = spark.createDataFrame([(c,) for c in names], "c STRING")
    spelled = {r["c"]: r["e"] for r in df.select("c", encode_entities("c").alias("e")).collect()}
    assert spelled == names


def test_hrefs_and_query(spark):
    df = spark.createDataFrame([('<a class=x href="/a&amp;b"> <link href="no"> <a\nhref=q>'
                                 '<a data-href="no" HREF = \'it"s\'><area href=no><a href="" id=1>',
                                 "http://h/?a=1&b=%C3%A4+c&a=2&flag&=e")], "h STRING, u STRING")
    r = df.select(hrefs("h").alias("h"), query_map("u").alias("q")).first()
    assert r["h"] == ["/a&b", "q", 'it"s', ""]
    assert r["q"] == {"a": ["1", "2"], "b": ["ä c"], "flag": [""], "": ["e"]}


def test_text_and_entities(spark):
    html = ("<p>One<b>two</b> three<br>four<!-- <p>no --><script>var t='</p>';</script>"
            "<style>p{}</style>&nbsp;&lt;x&gt; &amp;amp; &copy;</p>\n\t end ")
    df = spark.createDataFrame([(html, 'ä & "é" <ñ>', "&auml;&amp;lt;&unknown;&& &yuml;")],
                               "h STRING, e STRING, d STRING")
    r = df.select(html_to_text("h"), encode_entities("e"), decode_entities("d")).first()
    assert r[0] == "Onetwo three four <x> &amp; © end"
    assert r[1] == "&auml; &amp; &quot;&eacute;&quot; &lt;&ntilde;&gt;"
    assert r[2] == "ä&lt;&unknown;&& ÿ"


def test_links_are_extracted_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def fetch(html):
        read.add(1)
        return html

    pages = spark.createDataFrame([(f"http://a.org/{i}", f'<a href="/{i + 1}">') for i in range(40)],
                                  "url STRING, html STRING")
    seeds = spark.createDataFrame([("http://a.org/37",)], "url STRING")
    got = crawl.crawl_bfs(pages.withColumn("html", fetch("html")), seeds, ["a.org"])
    assert rows(got) == [("http://a.org/37", 0, "fetched"), ("http://a.org/38", 1, "fetched"),
                         ("http://a.org/39", 2, "fetched"), ("http://a.org/40", 3, "missing")]
    assert read.value == 40
