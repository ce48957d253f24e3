"""URL rules, and trust and distrust against a plain computation."""

from __future__ import annotations

import random

import pytest

from sluice.llm import queries as llm
from sluice.llm import url_graph as G

PAGES = "page_id long, url string, html string, host string, verdict int"
RULES = llm.URL_RULES


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("http://A.Example.ORG/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1"),
        ("http://example.org/es/", "example.org", "/es/", "example.org/es/"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/"),
        ("http://x.org", "x.org", "", None),
        ("http://x.org?q=http://y.com/fr/", "x.org", "", None),
        ("ftp://x.com/fr/a#b?c", "x.com", "/fr/a", "com/fr/"),
        ("://x.com/de/", "x.com", "/de/", "com/de/"),
        ("x.com/de/", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
        ("http://É.com/fr/\n", "É.com", "/fr/\n", "com/fr/"),
        ("http:///p", "", "/p", None),
    ],
)
def test_location_and_rule(spark, url, host, path, rule):
    r = G.judged_by_rules(pages(spark, [(1, url, None)]), RULES).first()
    assert (r.host, r.path, r.rule) == (host, path, rule)
    assert r.verdict == ({None: None, "org/": "allow", "com/fr/": "allow"}.get(rule, "block"))


def test_links(spark):
    html = """<a href="http://B.com/x">1</a><A class='c' HREF='//c.net?q'>2</A><a href=https://d.org/>3</a><a href="/own">4</a>
        <a href="http://a.com/self">5</a><link href="http://no.com/"><a name=x>6<p href="http://no.com"><a href="mailto:x@y.z">7"""
    links = G.host_links(pages(spark, [(1, "http://a.com/", html), (2, "http://a.com/2", html), (3, None, html), (4, "http://b.com", None)]))
    assert sorted((r.src, r.dst) for r in links.collect()) == [("a.com", "b.com"), ("a.com", "c.net"), ("a.com", "d.org")]


def plain_ranks(edges, seeds, damping=G.DAMPING, rounds=300):
    out = {}
    for which, flows in (("trust", edges), ("distrust", [(b, a) for a, b in edges])):
        seed = {h: (1 - damping) * s[which] for h, s in seeds.items()}
        degree: dict = {}
        for a, _ in flows:
            degree[a] = degree.get(a, 0) + 1
        rank = dict(seed)
        for _ in range(rounds):
            after = dict(seed)
            for a, b in flows:
                after[b] = after.get(b, 0.0) + damping * rank.get(a, 0.0) / degree[a]
            rank = after
        for h, r in rank.items():
            out.setdefault(h, {})[which] = r
    return out


def web():
    rnd = random.Random(3)
    hosts = [f"h{i}.net" for i in range(25)] + [f"good{i}.org" for i in range(5)] + [f"bad{i}.com" for i in range(5)] + ["hub.net"]
    rows = []
    for i, host in enumerate(hosts):
        for j in range(3):
            target = rnd.sample(hosts, 3) if host != "hub.net" else hosts
            if host.startswith("h") and i < 6:
                target = ["bad0.com", "bad1.com"]
            links = "".join(f'<a href="http://{t}/">l</a>' for t in target)
            path = {"b": "/de/1", "g": "/en/2"}.get(host[0], f"/{j}")
            rows.append((3 * i + j, f"http://{host}{path}", links))
    return rows


def test_ranks_and_verdicts(spark):
    rows = web()
    judged = {r.page_id: r for r in G.judge(pages(spark, rows).repartition(4), RULES).collect()}
    edges = set()
    for _, url, html in rows:
        own = url.split("/")[2]
        edges |= {(own, t) for t in html.replace('<a href="http://', "").replace('/">l</a>', " ").split() if t != own}
    seeds = {h: {"trust": float(h.startswith("good")), "distrust": float(h.startswith("bad"))} for h in {u.split("/")[2] for _, u, _ in rows}}
    seeds = {h: s for h, s in seeds.items() if s["trust"] or s["distrust"]}
    ranks = plain_ranks(sorted(edges), seeds)
    verdicts = set()
    for page_id, url, _ in rows:
        host = url.split("/")[2]
        trust, distrust = (ranks.get(host, {}).get(k, 0.0) for k in ("trust", "distrust"))
        r = judged[page_id]
        assert (r.trust or 0.0) == pytest.approx(trust, rel=1e-5) and (r.distrust or 0.0) == pytest.approx(distrust, rel=1e-5)
        if r.rule is None:
            assert r.verdict == ("block" if distrust > 0.5 * (trust + distrust) else "allow")
            verdicts.add(r.verdict)
    assert verdicts == {"allow", "block"}


def test_sql_agrees_on_a_graph(spark, tmp_path):
    import duckdb

    spark.createDataFrame(web(), "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({llm.ORACLES['op1_link_graph_verdicts']})").fetchall())
    got = sorted(tuple(r) for r in llm.QUERIES["op1_link_graph_verdicts"](spark, str(tmp_path)).collect())
    assert got == want


def test_distrust_reaches_the_far_end_of_a_chain(spark):
    """Links lead from host to host and at last to a blocked page."""
    rows = [(i, f"http://c{i}.net/", f'<a href="http://c{i + 1}.net/">') for i in range(40)] + [(40, "http://c40.net/", '<a href="http://x.com/">'),
            (41, "http://x.com/de/1", None), (42, "http://far.net/", None)]
    got = {r.page_id: r for r in G.judge(pages(spark, rows), RULES).collect()}
    assert [i for i, r in got.items() if r.verdict != "block"] == [42]
    assert got[0].distrust == pytest.approx(0.15 * 0.85**41)
    with pytest.raises(G.NotConverged):
        G.judge(pages(spark, rows), RULES, rounds=20)


def test_mixed_seeds_and_odd_rows(spark):
    rows = [(1, "http://m.com/fr/1", None), (2, "http://m.com/de/1", None), (3, "http://m.com/de/2", None), (4, "http://m.com/en/", ""),
            (5, "http://x.net/", "<a href='http://x.net/y'>"), (5, "http://x.net/", "<a href='http://x.net/y'>"), (None, None, None)]
    got = {r.page_id: r.verdict for r in G.judge(pages(spark, rows), RULES).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow", None: "allow"}
    assert G.judge(pages(spark, []), RULES).collect() == []
