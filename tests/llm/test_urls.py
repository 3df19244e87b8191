"""Rules, propagation over redirects, and odd rows."""

from tagweave.llm import components, queries, urls

RULES = queries.URL_RULES


def test_components_against_union_find(spark):
    import random

    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 420)] + [(7, 7), (None, 3), (900, 900)]
    edges += [(1000, 1000 + i) for i in range(1, 50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, find(x)) for x in root} and len(got) == len(root)
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def page(i, url, html=""):
    return (i, url, html)


def test_verdicts(spark):
    canon = lambda u: f'<html><head><LINK href="{u}" rel="canonical"></head>'
    pages = [
        page(1, "http://a.example.net/x"),
        page(2, "http://a.example.net/en/x"),
        page(3, "http://EXAMPLE.com/de/x?q#f"),
        page(4, "https://x.example.org/fr/"),
        page(5, None),
        page(6, "no scheme"),
        page(7, "http://net"),
        page(8, "http://notexample.net.com/a", canon("http://bad.net/home")),
        page(9, "http://m.test/a/b", '<meta content="0; URL=../c" http-equiv=refresh>'),
        page(10, "http://m.test/one", canon("/two")),
        page(11, "http://m.test/two#x", canon("//z.net/three")),
        page(12, "http://m.test/four", canon("http://m.test/one")),
        page(13, "http://m.test/five", canon("http://good.org/fr/1") + '<meta http-equiv="refresh" content="0;url=http://q.net/1">'),
        page(14, "http://m.test/six", canon("http://m.test/five")),
        page(14, "http://m.test/six", None),
        page(None, "http://m.test/one", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(map(repr, [tuple(r) for r in urls.judge(df, "page_id", "url", RULES, html_col="html").collect()]))
    want = [
        (1, "a.example.net", "/x", "net/", "block"),
        (2, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (3, "example.com", "/de/x", "example.com/de/", "block"),
        (4, "x.example.org", "/fr/", "org/fr/", "allow"),
        (5, "", "", None, "allow"),
        (6, "", "", None, "allow"),
        (7, "net", "", None, "allow"),
        (8, "notexample.net.com", "/a", None, "block"),
        (9, "m.test", "/a/b", None, "allow"),
        (10, "m.test", "/one", None, "block"),
        (11, "m.test", "/two", None, "block"),
        (12, "m.test", "/four", None, "block"),
        (13, "m.test", "/five", None, "allow"),
        (14, "m.test", "/six", None, "allow"),
        (14, "m.test", "/six", None, "allow"),
        (None, "m.test", "/one", None, "block"),
    ]
    assert got == sorted(map(repr, want))


def test_edges_as_a_table_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://u.x/1"), (2, "http://u.x/2")], "page_id long, url string")
    edges = spark.createDataFrame([("http://u.x/1", "http://b.net/"), (None, "http://u.x/2")], "a string, b string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, "page_id", "url", RULES, edges).collect()} == {1: "block", 2: "allow"}
    assert urls.judge(pages.limit(0), "page_id", "url", RULES, edges).count() == 0
    assert [r.verdict for r in urls.judge(pages, "page_id", "url", RULES, default="block").collect()] == ["block"] * 2


def several(spark):
    two = canon("http://q.test/1") + canon("http://bad.net/2") + '<meta http-equiv=refresh content="0;url=/r?a&amp;b"><meta http-equiv=refresh content="1; url=http://good.org/fr/3">'
    pages = [
        page(1, "http://m.test/two", two.replace("http://good.org/fr/3", "http://q.test/3")), page(2, "http://m.test/r?a&b"), page(3, "http://q.test/1"),
        page(4, "http://n.test/both", two), page(5, "http://n.test/" + "x" * 50_000, canon("http://n.test/both")), page(6, "http://n.test/plain", "y" * 3_000_000 + canon("http://bad.net/")),
        page(7, None, canon("http://bad.net/")), page(7, None, canon("http://bad.net/")), page(8, "", two),
    ]
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def canon(u):
    return f'<link rel="canonical" href="{u}">'


def test_every_link_of_a_page_counts_as_in_the_sql(spark):
    import duckdb

    from tagweave.llm.oracle import SQL

    df = several(spark)
    got = urls.judge(df, "page_id", "url", RULES, html_col="html")
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    want = con.execute(SQL["op7_redirect_equivalence"]).fetchall()
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in got.collect())
    verdicts = {r.page_id: r.verdict for r in got.collect()}
    # All are of one group over q.test/1, and allow takes precedence there.
    assert verdicts[1] == verdicts[4] == verdicts[5] == "allow"


def test_two_canonical_links_pass_on_a_block(spark):
    df = spark.createDataFrame([page(1, "http://m.test/a", canon("http://q.test/1") + canon("http://bad.net/2"))], "page_id long, url string, html string")
    assert [r.verdict for r in urls.judge(df, "page_id", "url", RULES, html_col="html").collect()] == ["block"]


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    df = several(spark)
    odd = df.withColumns({c: F.lit(None).cast("string") for c in ("host", "path", "rule", "verdict", "_id", "_url", "node", "component", "a", "_hit", "_node", "_alias", "passed_on")})
    judged = lambda x: sorted(map(repr, (tuple(r) for r in urls.judge(x, "page_id", "url", RULES, html_col="html").collect())))
    assert judged(odd) == judged(df)
    assert urls.judge(odd.limit(0), "page_id", "url", RULES, html_col="html").count() == 0
