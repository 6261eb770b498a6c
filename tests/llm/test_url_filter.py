import random

import duckdb
import pytest

from shelfwise.llm import url_filter
from shelfwise.llm.queries import ORACLES, QUERIES
from tests.llm.support import rows_of

PAGES = "page_id long, url string, html string, host string, verdict string"


def pages_of(spark, rows):
    return spark.createDataFrame([(k, url, html, "clash", "clash") for k, (url, html) in enumerate(rows)], PAGES)


@pytest.mark.parametrize("data", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    assert rows_of(QUERIES["op3_url_filter"](spark, data)) == sorted(con.sql(ORACLES["op3_url_filter"]).fetchall(), key=str)


def test_rules_and_parsing(spark):
    urls = ["http://A.Example.NET/en/1?x#y", "https://b.net/de", "https://notnet/x", "x://example.com/de/#a", "http://c.org?u=/fr/", "http://c.org/fr/a", "no scheme", None, "http://deep.sub.example.com/de/x", "http://b.net"]
    found = rows_of(url_filter.judge(pages_of(spark, [(u, None) for u in urls])))
    assert [r[1:] for r in found] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("b.net", "/de", "net/", "block"),
        ("notnet", "/x", None, "allow"),
        ("example.com", "/de/", "example.com/de/", "block"),
        ("c.org", "", None, "allow"),
        ("c.org", "/fr/a", "org/fr/", "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("deep.sub.example.com", "/de/x", "example.com/de/", "block"),
        ("b.net", "", None, "allow"),  # half of its host is blocked, which is not more than the threshold
    ]


def verdicts(frame):
    return {r[1]: r[4] for r in rows_of(url_filter.judge(frame))}


def sql_verdicts(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    for k, (url, html) in enumerate(rows):
        con.execute("INSERT INTO pages VALUES (?, ?, ?)", [k, url, html])
    return {r[1]: r[4] for r in con.execute(ORACLES["op3_url_filter"]).fetchall()}


def link(*hosts):
    return " ".join(f'<a href="http://{h}/">' for h in hosts)


def test_distrust_runs_against_links_and_trust_along_them(spark):
    rows = [("http://bad.net/", ""), ("http://linker.io/", link("bad.net")), ("http://far.io/", link("linker.io")), ("http://x.org/fr/", "<a HREF = '//friend.io/x'>"), ("http://friend.io/", link("bad.net")), ("http://other.io/", ""), ("http://fan.io/", link("x.org"))]
    expected = {"bad.net": "block", "linker.io": "block", "far.io": "allow", "x.org": "allow", "friend.io": "allow", "other.io": "allow", "fan.io": "allow"}
    assert verdicts(pages_of(spark, rows)) == expected == sql_verdicts(rows)


@pytest.mark.parametrize("linkers", [1, 2, 10, 100])
def test_linkers_of_a_blocked_host_are_blocked_however_many_there_are(spark, linkers):
    """At the production threshold; hosts that link to an allowed host, which itself links to a blocked one, are not."""
    rows = [("http://bad.net/", ""), ("http://good.org/fr/", link("bad.net"))]
    rows += [(f"http://linker{k}.io/", link("bad.net")) for k in range(linkers)]
    rows += [(f"http://fan{k}.io/", link("good.org")) for k in range(linkers)]
    expected = {"bad.net": "block", "good.org": "allow"} | {f"linker{k}.io": "block" for k in range(linkers)} | {f"fan{k}.io": "allow" for k in range(linkers)}
    assert verdicts(pages_of(spark, rows)) == expected == sql_verdicts(rows)


def test_a_linked_graph_equals_sql(spark):
    """Random links between and within domains, some hosts judged in part."""
    rng = random.Random(5)
    hosts = [f"h{k}.{d}" for k in range(12) for d in ("net", "io", "sub.io", "example.com")] + ["h1.org", "h2.org", "example.net", "example.com"]
    rows = [(f"http://{rng.choice(hosts)}/{rng.choice(['de/', 'fr/', 'en/', ''])}{k}", link(*rng.sample(hosts, rng.randrange(3)))) for k in range(150)]
    found = rows_of(url_filter.judge(pages_of(spark, rows)))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [[k, url, html] for k, (url, html) in enumerate(rows)])
    assert found == sorted(con.execute(ORACLES["op3_url_filter"]).fetchall(), key=str)
    unruled = [r[4] for r in found if r[3] is None]
    assert unruled.count("block") >= 3 and unruled.count("allow") > 5


def test_masses_equal_a_plain_loop(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c")]
    seeds = [("a", 1.0, 0.0), ("c", 0.25, 0.5)]
    found = {r.host: (r.trust, r.distrust, r.ahead, r.behind) for r in url_filter.propagate(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(seeds, "host string, trust double, distrust double")).collect()}
    forward, backward = edges, [(b, a) for a, b in edges]
    even = dict.fromkeys("abcd", 1.0)
    for place, ways, start in ((0, forward, {h: s[0] for h, *s in seeds}), (1, backward, {h: s[1] for h, *s in seeds}), (2, forward, even), (3, backward, even)):
        mass = dict(start)
        for _ in range(url_filter.ROUNDS):
            after = dict(start)
            for a, b in ways:
                after[b] = after.get(b, 0.0) + url_filter.DAMPING * mass.get(a, 0.0) / sum(x == a for x, _ in ways)
            mass = after
        for host in "abcd":
            assert abs(found[host][place] - mass.get(host, 0.0)) < 1e-9


def test_awkward_rows(spark):
    pages = pages_of(spark, [(None, None), ("", ""), ("http://x.net/", "<a href=" * 5000), ("http://x.net/", "<a href=" * 5000)])
    assert [r[4] for r in rows_of(url_filter.judge(pages))] == ["allow", "allow", "block", "block"]
    assert url_filter.judge(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(pages, tuple(url_filter.Rule("block", f"h{k}", "/") for k in range(1001)))
