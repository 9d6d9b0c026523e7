from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.urls import anchor_hrefs, resolve_url
from sedimenta.operators import links

HTML = {
    "plain": '<a href="/a.parquet">x</a><a class=b href=/b>y</a>',
    "quotes": "<A HREF='/c d' id=\"q\">z</A><a\n  title=\"x > y\" href = \" /e \">e</a>",
    "hidden": '<!-- <a href="/no"> --><script>var a = \'<a href="/no">\';</script><style>a{}</style><a href="/yes">',
    "entities": '<a href="/p?a=1&amp;b=2">1</a><a href="/x&#47;y&#x2F;z">2</a><a href="/q?u&v">3</a>',
    "decoys": '<link href="/no"><area href="/no"><a name="t">n</a><abbr href="/no"><a data-href="/no" href="/ok">',
    "tricky": "<a title='href=\"/no\"' href=\"/t\"><a title=\"a b href=/no\" href='/u'>",
    "slash": '<a href="/s"/><a href=/v/>w</a>',
    "repeat": '<a href="/r"></a><a href="/r"></a>',
    "none": "no tags at all",
}


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.found.append(dict(attrs)["href"].strip())


def by_parser(html):
    parser = Anchors()
    parser.feed(html)
    return parser.found


@pytest.mark.parametrize("name", HTML)
def test_anchor_hrefs_equal_an_html_parser(spark, name):
    df = spark.createDataFrame([(HTML[name],)], "html string")
    assert df.select(anchor_hrefs(F.col("html")).alias("h")).first().h == by_parser(HTML[name])


def test_long_attribute_does_not_overflow_the_matcher(spark):
    html = '<a title="' + "x 'y' " * 20_000 + '" ' + "data=1 " * 5_000 + 'href="/far">'
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(anchor_hrefs(F.col("html")).alias("h")).first().h == ["/far"]


BASES = [
    "http://h.example/a/b/c.html?x=1#f", "https://h.example", "https://h.example/", "http://h.example/d/", "HTTP://h.example/a//b/c",
    "http://u@h.example:8080/p;v/q",
]
HREFS = [
    "", "/", "/x", "//other.example/x", "//other.example", "x", "x/y", "./x", "../x", "../../x", "../../../../x", "/../x", "/./x/.", "/x/..",
    "?q=1", "?q=1#z", "#f", "x?q#f", "x#", "http://z.example/../a", "https://z.example?q", "mailto:a@b.example", "javascript:void(0)",
    "x//y", "/x//y", "x/", ".", "..", "./", "../", "x/./y/../z", "x:y", "a b", "file.parquet", "...", "/a/../../b", ";v", "x;v?q",
]


def test_resolve_url_equals_urljoin(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "base string, href string")
    got = {(r.base, r.href): r.u for r in df.select("base", "href", resolve_url("base", "href").alias("u")).collect()}
    wrong = {k: (v, urljoin(*k)) for k, v in got.items() if v != urljoin(*k)}
    assert not wrong


def pages(spark):
    html = "".join(
        f'<a href="{h}">x</a>'
        for h in (
            "/d/t_2023-00.parquet", "/d/t_2023-01.parquet", "t_2023-05.PARQUET", "/d/t_2023-06.parquet", "/d/t_2023-13.parquet",
            "/d/t.parquet", "/d/t_2023-02.csv", "https://cdn.example/t_2023-03.parquet", "/d/t_2023-01.parquet",
        )
    )
    return spark.createDataFrame([(1, "https://h.example/data/index.html", html)], "page_id long, url string, html string")


def test_data_links(spark):
    rows = links.data_links(pages(spark)).orderBy("pos").collect()
    assert [(r.pos, r.abs_url, r.period) for r in rows] == [
        (1, "https://h.example/d/t_2023-01.parquet", "2023-01"),
        (2, "https://h.example/data/t_2023-05.PARQUET", "2023-05"),
        (7, "https://cdn.example/t_2023-03.parquet", "2023-03"),
        (8, "https://h.example/d/t_2023-01.parquet", "2023-01"),
    ]


def test_suffix_and_bounds_are_parameters(spark):
    found = links.extract_links(pages(spark))
    assert links.with_suffix(found, ".csv").count() == 1
    assert [r.period for r in links.in_period(found, "2023-06", "2023-06").collect()] == ["2023-06"]
