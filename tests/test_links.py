"""Link harvest, filter, overlay and intake on hand-written pages."""

import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tripaudit.sources import (
    filter_links,
    harvest_links,
    load_pages,
    narrow_links,
    new_intake,
    new_links,
    overlaid_links,
    overlay_links,
)

PAGES = [
    (1, "u1", '<a href=" https://x/trip/yellow_tripdata_2024-01.parquet ">a</a>'
              '<A class="c" HREF="https://old/yellow_tripdata_2024-02.parquet">b</A>'
              '<a href="https://x/green_tripdata_2024-01.csv">c</a>'
              '<a href="https://x/fhv_tripdata_2024-01.parquet">d</a>'),
    (2, "u2", "<a title='t' href='https://new/yellow_tripdata_2024-02.parquet' id=z>e</a>"
              '<a href="https://x/green_tripdata_2023-12.parquet">f</a>'
              '<a href="https://x/green_tripdata_2023-11.parquet">g</a>'),
]


def _pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_harvest(spark):
    rows = harvest_links(_pages(spark)).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos) for r in rows] == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1), (2, 2)]
    assert rows[0].href == "https://x/trip/yellow_tripdata_2024-01.parquet"
    assert rows[0].filename == "yellow_tripdata_2024-01.parquet"


def test_filter_last_wins(spark):
    m = {r.filename: r.url for r in
         filter_links(harvest_links(_pages(spark)), [2024], ["yellow", "green"]).collect()}
    assert m == {
        "yellow_tripdata_2024-01.parquet": "https://x/trip/yellow_tripdata_2024-01.parquet",
        "yellow_tripdata_2024-02.parquet": "https://new/yellow_tripdata_2024-02.parquet",
    }


def test_overlay_and_intake(spark):
    links = harvest_links(_pages(spark))
    base = filter_links(links, [2024], ["yellow", "green"])
    upd = narrow_links(filter_links(links, [2023], ["yellow", "green"]), "_2023-12")
    both = overlay_links(base, upd)
    assert sorted(r.filename for r in both.collect()) == [
        "green_tripdata_2023-12.parquet", "yellow_tripdata_2024-01.parquet",
        "yellow_tripdata_2024-02.parquet"]
    # update wins on a shared name
    upd2 = spark.createDataFrame([("yellow_tripdata_2024-01.parquet", "https://mirror/y1")], "filename string, url string")
    got = {r.filename: r.url for r in overlay_links(base, upd2).collect()}
    assert got["yellow_tripdata_2024-01.parquet"] == "https://mirror/y1"
    have = spark.createDataFrame([("yellow_tripdata_2024-01.parquet",)], "filename string")
    assert sorted(r.filename for r in new_intake(both, have).collect()) == [
        "green_tripdata_2023-12.parquet", "yellow_tripdata_2024-02.parquet"]


def test_harvest_like_a_parser(spark):
    html = ('<!-- <a href="/commented.parquet">x</a> -->'
            '<script>var s = "<a href=\'/scripted.parquet\'>";</script>'
            '<style>a[href="/styled"]{}</style>'
            '<a title="x>y" data-href="/wrong" href="/right.parquet">r</a>'
            '<a href=/bare_2024.parquet>b</a>'
            '<a href=\'/say "hi".parquet\'>q</a>'
            '<a href="/q?a=1&amp;b=2">e</a>')
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [r.href for r in harvest_links(df).orderBy("pos").collect()]
    assert got == ["/right.parquet", "/bare_2024.parquet", '/say "hi".parquet', "/q?a=1&b=2"]


class _Hrefs(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.found.append((dict(attrs)["href"] or "").strip())

    handle_startendtag = handle_starttag


MARKUP = [
    '<a href="x&copy=1&amp;&copy;&eacute;&#47;&#x2F;">', "<a/href=u>", "<a href>", "<a title=it's href=v\"w>",
    "<a href='q' href=z>", '<a href="a>b" b=c/>', "<A HREF=foo/bar/>x", '<a href = "  s&nbsp;">', "<a href=a&b;c>",
    "<a\nhref=n/>", "<script><a href=3>", '<a data-href=x href=" y\u3000">',
    '<a href="&#128;&#0;&#xD800;&#99999999999999999999;&notit;&amp;lt;&#1;&#x1F600;">', '<abbr href=x><a href="1"/>',
    '<a href="&unknown; &am &AMP &#x;">', "<a b href=1 c>", "<a href=\"\"><a href=''>", "<style>a</style><a href=k>",
    '<a href="a&quot;b" >', "<a href=x'y>", "<a = href=z>", '<a href="l\nm">', "<!-- <a href=1> --><a href=2>",
]


def test_hrefs_as_a_parser_reports_them(spark):
    df = spark.createDataFrame(list(enumerate(MARKUP)), "page_id long, html string")
    got = {}
    for r in harvest_links(df).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append(r.href)
    for i, markup in enumerate(MARKUP):
        parser = _Hrefs()
        parser.feed(markup)
        parser.close()
        assert got.get(i, []) == parser.found, markup


LONG = [
    ("<a " + "x" * 1_000_000 + " href=1>", 1), ('<a href="' + "x" * 1_000_000 + '">', 1), ("<!-- " * 20_000, 0),
    ("<a " + "b=c " * 100_000 + "href=2>", 1), ('<a "' * 20_000, 0), ("<script>" * 20_000, 0),
    ('<a href="' * 20_000, 0), ("<a b='" * 20_000, 0), ("<a" * 100_000, 0), ("<a href=1><!-- <a href=2>", 1),
]


@pytest.mark.parametrize("case", range(len(LONG)))
def test_long_and_unclosed_markup_takes_linear_time(spark, case):
    html, links = LONG[case]
    began = time.time()
    assert harvest_links(spark.createDataFrame([(1, html)], "page_id long, html string")).count() == links
    assert time.time() - began < 15


def test_one_pass_overlay_and_intake_agree_with_the_steps(spark):
    links = harvest_links(_pages(spark))
    base = filter_links(links, [2024], ["yellow", "green"])
    upd = narrow_links(filter_links(links, [2023], ["yellow", "green"]), "_2023-12")
    one = overlaid_links(links, ([2024], ["yellow", "green"]), ([2023], ["yellow", "green"]), "_2023-12")
    assert sorted(one.collect()) == sorted(overlay_links(base, upd).collect())
    marked = links.withColumn("taken", F.col("page_id") == 1)
    got = new_links(marked, F.col("taken"), [2023, 2024], ["yellow", "green"])
    have = links.filter("page_id = 1")
    assert sorted(got.collect()) == sorted(
        new_intake(filter_links(links, [2023, 2024], ["yellow", "green"]), have).collect())
    for df in (one, got):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"(Merge|Hash|Loop)Join|[-+] Union\n", plan)


def test_landed_pages_need_no_numbering(spark, tmp_dir):
    for name, url in (("a.html", "/x_2024.parquet"), ("b.html", "/new/x_2024.parquet")):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(f'<a href="{url}">x</a>')
    pages = load_pages(spark, f"{tmp_dir}/*.html")
    assert "Window" not in pages._jdf.queryExecution().executedPlan().toString()
    assert [r.url for r in filter_links(harvest_links(pages), [2024], ["x"]).collect()] == ["/new/x_2024.parquet"]
