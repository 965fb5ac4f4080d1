"""Rules, host edges and the two walks against plain Python."""

import random
import re

import pytest

from trustfold.llm.queries import URL_RULES
from trustfold.llm.url_filter import Rule, host_edges, host_of, judge, path_of, propagate, ruled, rules_table

LIST = [Rule.of(*r) for r in URL_RULES]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    cut = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:cut]


URLS = ["http://A.example.com/en/1?x", "https://www.example.com/en/2#y", "http://x.net/es/", "http://x.net/es", "http://x.net", "ftp://com/", "http://com",
        "no scheme", None, "", "://", "http://ÄB.net/fr/a://b", "http://x.example.com?/en/", "http://notexample.com/en/", "http://net/fr/1", "a://b\n.net/fr/"]


def test_hosts_and_paths(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", host_of(spark_col("u")).alias("h"), path_of(spark_col("u")).alias("p"))
    assert [(r["h"], r["p"]) for r in df.collect()] == [split(u) for u in URLS]


def test_a_later_scheme_is_no_path(spark):
    urls = ["http://x.net?to=a://b/es/1", "http://x.net#a://b/es/1", "http://x.net/?to=a://b/es/1", "http://?a://b/es/1"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", host_of(spark_col("u")).alias("h"), path_of(spark_col("u")).alias("p"))
    assert [(r["h"], r["p"]) for r in df.collect()] == [split(u) for u in urls] == [("x.net", ""), ("x.net", ""), ("x.net", "/"), ("", "")]


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def best_rule(host, path):
    fits = [r for r in LIST if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None) if host else None


def test_longest_rule_wins(spark):
    pairs = [split(u) for u in URLS] + [("www.example.com", "/de/"), ("example.com", "/en"), ("", "/")]
    got = {(r["host"], r["path"]): (r["rule"], r["rule_verdict"]) for r in
           ruled(spark.createDataFrame(pairs + pairs, "host string, path string"), rules_table(spark, LIST)).collect()}
    want = {p: best_rule(*p) for p in pairs}
    assert got == {p: (r.host + r.path, r.verdict) for p, r in want.items() if r}


def test_edges_of_links_and_domains(spark):
    html = ["""<a href="http://B.org/x">1</a> <a HREF='//c.net'>2</a><a href=/rel>""", '<a href="https://b.org">', '<a href="http://a.b.org/self">', None]
    pages = spark.createDataFrame([("a.b.org", html[0]), ("a.b.org", html[1]), ("a.b.org", html[2]), ("", html[0]), ("c.net", html[3])], "host string, html string")
    got = {(r["src"], r["dst"]): r["weight"] for r in host_edges(pages, 0.5).collect()}
    assert got == {("a.b.org", "b.org"): 2.5, ("a.b.org", "c.net"): 1.0, ("b.org", "a.b.org"): 0.5}


def walk(edges, seeds, rounds, damping):
    home = {h: (1 - damping) * s for h, s in seeds.items()}
    rank = home
    for _ in range(rounds):
        new = dict(home)
        for h, r in rank.items():
            out = [(d, w) for (s, d), w in edges.items() if s == h]
            total = sum(w for _, w in out)
            for d, w in out:
                new[d] = new.get(d, 0) + damping * r * w / total
        rank = new
    return {h: r / sum(rank.values()) for h, r in rank.items()}


@pytest.mark.parametrize("rounds", [1, 7])
def test_ranks_match_plain_iteration(spark, rounds):
    rng = random.Random(rounds)
    edges = {(f"h{rng.randint(0, 9)}", f"h{rng.randint(0, 9)}"): float(rng.randint(1, 4)) for _ in range(25)}
    seeds = {"trust": {"h1": 0.25, "h2": 0.75}, "distrust": {"h3": 1.0}}
    got = propagate(spark.createDataFrame([(*k, w) for k, w in edges.items()], "src string, dst string, weight double"),
                    spark.createDataFrame([(w, h, x) for w, s in seeds.items() for h, x in s.items()], "walk string, host string, weight double"), rounds=rounds)
    got = {(r["walk"], r["host"]): r["rank"] for r in got.collect()}
    turned = {(b, a): w for (a, b), w in edges.items()}
    for name, graph in (("trust", edges), ("distrust", turned)):
        want = walk(graph, seeds[name], rounds, 0.85)
        assert {h for w, h in got if w == name} == set(want)
        assert all(abs(got[name, h] - r) < 1e-9 for h, r in want.items())


def test_neighbours_of_blocked_hosts_are_blocked(spark):
    page = lambda i, u, to="": (i, u, f'<a href="{to}">' if to else None)
    rows = [page(1, "http://bad.net/es/1"), page(2, "http://friend.org/a", "http://bad.net/"), page(3, "http://good.com/x", "http://fine.org/"),
            page(4, "http://fine.org/b"), page(5, "http://alone.org/c"), page(6, None), page(7, "http://bad.net/de/"), page(7, "http://bad.net/de/")]
    got = [(r["page_id"], r["rule"], r["verdict"]) for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules_table(spark, LIST)).collect()]
    assert sorted(got) == [(1, "net/es/", "block"), (2, None, "block"), (3, "com/", "allow"), (4, None, "allow"), (5, None, "allow"), (6, None, "allow"),
                           (7, None, "block"), (7, None, "block")]


def expected_verdicts(pages):
    """Verdict of each (id, url, html) by plain Python: rules, link graph, both walks, thresholds."""
    placed = {i: split(u) for i, u, _ in pages}
    links, hosts = {}, set()
    for i, _, html in pages:
        host = placed[i][0]
        hosts.add(host)
        for to in set(re.findall(r'href="http://([^/"]*)', html)):
            if to != host:
                links[host, to] = links.get((host, to), 0) + 1.0
                hosts.add(to)
    edges = dict(links)
    steps = set()
    for h in hosts:
        chain = [s for s in (h.split(".", i)[-1] for i in range(h.count(".") + 1)) if "." in s]
        steps |= set(zip(chain, chain[1:]))
    for a, b in steps:
        for e in ((a, b), (b, a)):
            edges[e] = edges.get(e, 0) + 0.5
    share = {}
    for host, path in placed.values():
        r = best_rule(host, path)
        n, allow, block = share.get(host, (0, 0, 0))
        share[host] = (n + 1, allow + (r is not None and r.verdict == "allow"), block + (r is not None and r.verdict == "block"))
    ranks = {}
    for name, at, graph in (("trust", 1, edges), ("distrust", 2, {(b, a): w for (a, b), w in edges.items()})):
        seeds = {h: v[at] / v[0] for h, v in share.items() if v[at]}
        total = sum(seeds.values())
        ranks[name] = walk(graph, {h: s / total for h, s in seeds.items()}, 20, 0.85)
    every = set(ranks["trust"]) | set(ranks["distrust"])
    out = {}
    for i, (host, path) in placed.items():
        r = best_rule(host, path)
        t, d = ranks["trust"].get(host, 0.0), ranks["distrust"].get(host, 0.0)
        out[i] = r.verdict if r else "block" if host in every and d >= t and d * len(every) >= 0.25 else "allow"
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_of_a_random_crawl(spark, seed):
    rng = random.Random(seed)
    names = [f"{a}{b}.{c}" for a in ("", "www.") for b in ("a", "b", "example", "d", "e") for c in ("com", "net", "org", "co.uk")]
    pages = [(i, f"http://{rng.choice(names)}/{rng.choice(['en', 'es', 'fr', 'x'])}/{i}",
              "".join(f'<a href="http://{rng.choice(names)}/p">' for _ in range(rng.randint(0, 3)))) for i in range(150)]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules_table(spark, LIST)).collect()}
    want = expected_verdicts(pages)
    by_walk = {i for i, u, _ in pages if best_rule(*split(u)) is None}
    assert got == want and {want[i] for i in by_walk} == {"allow", "block"}


def test_odd_tables(spark):
    rows = [(None, None, None, "h", 1.0), (1, "x", "<a href=", "h", 2.0), (2, "http://a.net/es/", "", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, trust double")
    got = judge(df, rules_table(spark, LIST))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"] and got.count() == 3
    assert judge(df.limit(0), rules_table(spark, LIST)).count() == 0
    assert {r["verdict"] for r in judge(df, rules_table(spark, [])).collect()} == {"allow"}
