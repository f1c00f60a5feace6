import duckdb
import pytest
from pyspark.sql import functions as F

from coinweir.llm import url_filter
from coinweir.llm.queries import URL_RULES, op7_url_filter
from coinweir.llm.url_filter import ALLOW, BLOCK, Rule


def canonical(url):
    return f'<head><link href="{url}" rel="canonical"></head>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; URL={url}'>"


PAGES = [
    (1, "http://a.example.net/x", "x"),
    (2, "http://b.example.org/de/y", canonical("http://a.example.net/x")),
    (3, "http://c.test/z#f", refresh("http://B.example.org/de/y")),
    (4, "http://d.test/q", canonical("http://e.example.net/en/1")),
    (5, "http://f.net/", canonical("http://d.test/q")),
    (6, "http://c.test/z", "l"),
    (7, None, None),
    (8, "nourl", canonical("http://a.example.net/x")),
    (None, "http://C.TEST/z?#", None),
    (9, "http://g.test", canonical("/home")),
    (10, "http://g.test/home", refresh("//a.example.net/x")),
    (10, "http://g.test/home", refresh("//a.example.net/x")),
    (11, "http://net", None),
    (12, "http://xnet/", None),
    (13, "http://h.test/1", canonical("rel.html")),
    (14, "://", ""),
    (15, "x" * 100_000, "y" * 300_000),
]


def by_id(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: (str(row[0]), row[1:3]))


def test_verdicts_follow_aliases(spark):
    pages = spark.createDataFrame(PAGES, "page_id int, url string, html string").withColumn("verdict", F.lit(1)).withColumn("node", F.lit(1))
    rows = by_id(url_filter.judge(pages, URL_RULES).collect())
    verdict = {row[0]: row[4] for row in rows}
    assert verdict[1] == BLOCK  # by rule
    assert all(verdict[page] == BLOCK for page in (2, 3, 6, 9, 10))  # aliases
    assert verdict[4] == ALLOW and verdict[5] == BLOCK  # one name is allowed; a rule of its own still blocks
    assert all(verdict[page] == ALLOW for page in (7, 8, 11, 12, 13, 14, 15))
    database = duckdb.connect()
    database.execute("CREATE TABLE pages(page_id INT, url VARCHAR, html VARCHAR)")
    database.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    assert by_id(database.execute(url_filter.oracle(URL_RULES)).fetchall()) == rows
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_redirects_from_elsewhere(spark):
    pages = spark.createDataFrame(PAGES, "page_id int, url string, html string")
    redirects = spark.createDataFrame([("http://h.test/1", "http://far.net/"), (None, "http://far.net/")], "src string, dst string")
    verdict = {row.page_id: row.verdict for row in url_filter.judge(pages, URL_RULES, redirects=redirects).collect()}
    assert verdict[13] == BLOCK


def test_the_longest_rule_counts(spark):
    rules = [Rule(BLOCK, "net"), Rule(ALLOW, "a.net", "/x"), Rule(BLOCK, "a.net", "/x/y"), Rule(ALLOW, "b.a.net")]
    urls = ["http://a.net/x", "http://a.net/x/y?q", "http://b.a.net/x/y", "http://c.net", "http://net", "http://a.net/z"]
    pages = spark.createDataFrame([(at, url, None) for at, url in enumerate(urls)], "page_id int, url string, html string")
    rows = by_id(url_filter.judge(pages, rules).collect())
    assert [row[3] for row in rows] == ["a.net/x", "a.net/x/y", "a.net/x/y", "net", "net", "net"]
    with pytest.raises(ValueError):
        url_filter.judge(pages, [Rule("maybe", "net")])


def test_query_against_sql(spark, folder):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    expected = database.execute(url_filter.oracle(URL_RULES)).fetchall()
    assert by_id(op7_url_filter(spark, folder).collect()) == by_id(expected)


BAD = "http://a.net/d/e.html?x=1&y=2"
#: Links to BAD as pages write them, each from a page of its own, and whether they count.
WRITTEN = [
    ('<link rel="canonical" href="http://a.net/d/e.html?x=1&amp;y=2">', "http://p.test/", True),
    ("<LINK REL='nofollow canonical' HREF='http://A.net/d/e.html?x=1&#38;y=2' />", "http://p.test/", True),
    ('<link rel=canonical href=http://a.net/d/e.html?x=1&y=2>', "http://p.test/", True),
    ('<link rel="stylesheet" href="/s.css"><link rel="canonical" href=" http://a.net/d/e.html?x=1&amp;y=2#top ">', "http://p.test/", True),
    ('<link rel="canonical" href="http://q.test/1"><link href="http://a.net/d/e.html?x=1&amp;y=2" rel="canonical">', "http://p.test/", True),
    ("<meta content='3; URL=http://a.net/d/e.html?x=1&amp;y=2' http-equiv=Refresh>", "http://p.test/", True),
    ('<meta http-equiv="refresh" content="0"><meta http-equiv="refresh" content="0;url=http://a.net/d/e.html?x=1&y=2">', "http://p.test/", True),
    ('<link rel="canonical" href="//a.net/d/e.html?x=1&y=2">', "http://p.test/", True),
    ('<link rel="non-canonical" href="http://a.net/d/e.html?x=1&y=2">', "http://p.test/", False),
    ('<link data-rel="canonical" href="http://a.net/d/e.html?x=1&y=2">', "http://p.test/", False),
    ('<link rel="canonical" data-href="http://a.net/d/e.html?x=1&y=2">', "http://p.test/", False),
    ('<link rel="canonical" href="mailto:a@a.net"><link rel="canonical" href="#top"><link rel="canonical" href="">', "http://p.test/", False),
    ('<link <p rel="canonical" href="http://a.net/d/e.html?x=1&y=2">', "http://p.test/", False),
    ("<link rel=canonical href=" * 20_000, "http://p.test/", False),
]


def test_all_links_as_pages_write_them(spark):
    rows = [(at, f"{url}{at}", html) for at, (html, url, _) in enumerate(WRITTEN)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    rules = [Rule(BLOCK, "a.net", "/d/")]
    found = {row.page_id: row.verdict for row in url_filter.judge(pages, rules).collect()}
    assert found == {at: BLOCK if counts else ALLOW for at, (*_, counts) in enumerate(WRITTEN)}
    database = duckdb.connect()
    database.execute("CREATE TABLE pages(page_id INT, url VARCHAR, html VARCHAR)")
    database.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert by_id(database.execute(url_filter.oracle(rules)).fetchall()) == by_id(url_filter.judge(pages, rules).collect())


#: Targets below http://H.test/a/b/c?q (the examples of RFC 3986, section 5.4, and empty paths).
RELATIVE = [
    ("http://H.test/a/b/c?q", "g", "http://h.test/a/b/g"),
    ("http://H.test/a/b/c?q", "./g", "http://h.test/a/b/g"),
    ("http://H.test/a/b/c?q", "g/", "http://h.test/a/b/g/"),
    ("http://H.test/a/b/c?q", "/g", "http://h.test/g"),
    ("http://H.test/a/b/c?q", "?y", "http://h.test/a/b/c?y"),
    ("http://H.test/a/b/c?q", "g?y/../z", "http://h.test/a/b/g?y/../z"),
    ("http://H.test/a/b/c?q", ".", "http://h.test/a/b/"),
    ("http://H.test/a/b/c?q", "..", "http://h.test/a/"),
    ("http://H.test/a/b/c?q", "../g", "http://h.test/a/g"),
    ("http://H.test/a/b/c?q", "../../g", "http://h.test/g"),
    ("http://H.test/a/b/c?q", "../../../../g", "http://h.test/g"),
    ("http://H.test/a/b/c?q", "/./g/../x", "http://h.test/x"),
    ("http://H.test/a/b/c?q", "g..", "http://h.test/a/b/g.."),
    ("http://H.test/a/b/c?q", "..g/./h", "http://h.test/a/b/..g/h"),
    ("http://H.test", "g", "http://h.test/g"),
    ("http://H.test?q", "g", "http://h.test/g"),
]


def test_relative_targets(spark):
    rows = spark.createDataFrame(RELATIVE, "url string, target string, expected string")
    found = rows.select("expected", url_filter.absolute(F.col("target"), F.col("url")).alias("found")).collect()
    assert [row.found for row in found] == [row.expected for row in found]
    pages = [(at, url, f'<link rel="canonical" href="{target}">') for at, (url, target, _) in enumerate(RELATIVE)]
    links = url_filter.links_of(spark.createDataFrame(pages, "page_id int, url string, html string"), "url", "html")
    assert sorted(row.dst for row in links.collect()) == sorted(expected for *_, expected in RELATIVE)
