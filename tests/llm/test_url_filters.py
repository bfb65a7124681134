import pytest

from relevo.llm import url_filters
from relevo.llm.url_filters import filter_urls

duckdb = pytest.importorskip("duckdb")


def test_rules_links_and_odd_urls(spark):
    rows = [
        (1, "http://A.Example.com/en/1?x#y", None),
        (2, "https://www.example.com/en/", "<a href='http://linked.org/x'>"),
        (3, "http://x.net/fr/a", "<a href=\"HTTP://Other.org/\">"),
        (4, "http://linked.org/p", "plain"),
        (5, "http://other.org", '<a href="http://x.net/en">'),
        (6, "no scheme", "<p>"),
        (7, None, None),
        (8, "http://x.net/en/", ""),
        (9, "http://com", None),
        (9, "http://com", None),
        (10, "http://other.org?q=/fr/", None),
    ]
    pages = spark.createDataFrame([(*r, "extra", "other") for r in rows], "page_id long, url string, html string, host string, verdict string")
    out = {r.page_id: r for r in filter_urls(pages).collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].verdict) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert (out[2].rule, out[2].verdict) == ("www.example.com/en/", "allow")
    assert (out[3].rule, out[3].verdict) == ("net/fr/", "block")
    assert (out[4].rule, out[4].verdict) == (None, "allow") and int(out[4].trust) > 0
    # links to a blocked host: distrust flows back
    assert (out[5].host, out[5].path, out[5].rule, out[5].verdict) == ("other.org", "", None, "block")
    assert (out[6].host, out[6].path, out[6].verdict) == ("", "", "allow") == (out[7].host, out[7].path, out[7].verdict)
    assert out[8].verdict == "block" and out[8].rule is None
    assert out[9].rule is None and out[9].path == ""
    assert (out[10].path, out[10].verdict) == ("", "block")
    assert filter_urls(pages).count() == len(rows)
    assert filter_urls(pages.limit(0)).count() == 0


def test_small_masses_long_ways_and_links_without_a_scheme(spark):
    """By operator and SQL: hubs, a chain of 15 hosts, links without a scheme."""
    to = lambda host: f"<a href='http://{host}/'>"
    links = {f"h{i}.org": to("b.net") for i in range(30)} | {f"g{i}.org": to("h0.org") for i in range(30)}
    links |= {"c0.org": to("b.net")} | {f"c{i}.org": to(f"c{i - 1}.org") for i in range(1, 15)}
    links |= {"s.org": "<a href='//b.net/es/'>", "free.org": "<a href='/b.net/'>"}
    pages = [("http://b.net/es/", None), *((f"http://{h}/", html) for h, html in links.items())]
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert {r.host for r in filter_urls(table).collect() if r.verdict == "allow"} == {"free.org"}
    hub = "".join(to(f"spoke{i}.org") for i in range(200))
    more = [("http://hub.com/", hub), ("http://a.b.hub.com/", to("hub.com") + to("B.net")), ("http://spoke3.org/", to("b.net")), (None, None), ("http://spoke3.org/", "")]
    table = table.unionByName(spark.createDataFrame([(1000 + i, *p) for i, p in enumerate(more)], table.schema))
    con = duckdb.connect()
    con.register("pages", table.toArrow())
    names = ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    want = con.sql(f"SELECT {', '.join(names)} FROM ({url_filters.ORACLE_SQL})").fetchall()
    got = [tuple(r) for r in filter_urls(table).select(*names).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[4] for r in got if r[1] == "spoke7.org"} <= {"allow"} and any(int(r[5]) for r in got)
