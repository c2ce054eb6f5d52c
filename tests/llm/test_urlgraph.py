"""The URL filter against plain Python."""

import re
from collections import defaultdict

import pytest

from seriesloom.llm import urlgraph as U

ODD = [
    (1, None, None),
    (2, "no scheme", "<a href='http://x.org/'>"),
    (3, "http://A.Example.NET/en/x?q#f", '<a href="http://b.org/fr/1">b</a><a HREF=//c.com>c</a><a href="/own">'),
    (4, "http://example.net/EN/", ""),
    (5, "http://example.net", None),
    (6, "http://c.com#/de/", '<a href="https://Bad.net/1">'),
    (7, "http://b.org/fr/1", '<a href="http://d.com/">'),
    (7, "http://b.org/fr/1", '<a href="http://d.com/">'),
    (None, "x://www.example.com/de/?://y", ""),
    (9, "http://notexample.net/en/", ""),
    (10, "http://d.com/a\nb", ""),
    (11, "http://Éa.org/fr", ""),
]


def brute(pages):
    low = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s)

    def parts(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return (low(m[1]), m[2]) if m else ("", "")

    def rule(host, path):
        fit = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.name), default=None)

    links, hosts = set(), set()
    for _, url, html in pages:
        h = parts(url)[0]
        hosts |= {h} - {""}
        for to in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)""", html or ""):
            d = parts("http:" + to if to.startswith("//") else to)[0]
            if h and d and h != d:
                links.add((h, d))
                hosts.add(d)
    for h in list(hosts):
        while h.count(".") > 1:
            up = h.split(".", 1)[1]
            links |= {(h, up), (up, h)}
            h = up
    seeds = {"allow": defaultdict(float), "block": defaultdict(float)}
    for _, url, _ in pages:
        if r := rule(*parts(url)):
            seeds[r.verdict][parts(url)[0]] += 1
    rank = {}
    for kind, graph in (("allow", links), ("block", {(b, a) for a, b in links})):
        seed = {h: n / sum(seeds[kind].values()) for h, n in seeds[kind].items()}
        out = defaultdict(list)
        for a, b in graph:
            out[a].append(b)
        mass = dict(seed)
        for _ in range(U.ROUNDS):
            new = defaultdict(float)
            for h, n in seed.items():
                new[h] += (1 - U.DAMPING) * n
            for h, n in mass.items():
                for d in out[h] or [h]:
                    new[d] += U.DAMPING * n / len(out[h] or [h])
            mass = new
        rank[kind] = mass
    for i, url, _ in pages:
        h, p = parts(url)
        r = rule(h, p)
        t, d = rank["allow"].get(h, 0), rank["block"].get(h, 0)
        yield i, h, p, r and r.name, r.verdict if r else "block" if d > U.RATIO * t else "allow", pytest.approx(t), pytest.approx(d)


def by_page(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_odd_pages(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in ODD], "page_id long, url string, html string, host string, rule string")
    assert by_page(tuple(r) for r in U.judge(pages).collect()) == by_page(brute(ODD))
    assert U.judge(pages.limit(0)).collect() == []


def test_pages_of_the_test_tables(spark, sf):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = by_page(tuple(r) for r in U.op2_url_filter(spark, sf).collect())
    assert got == by_page(brute(pages)) and {r[4] for r in got} == {"allow", "block"}


def test_hosts_far_from_a_blocked_seed(spark):
    """A chain of 100 hosts that ends at a blocked one, longer than the rounds that the tolerance asks for."""
    pages = [(i, f"http://h{i}.io/", f'<a href="http://h{i + 1}.io/">') for i in range(99)]
    pages += [(99, "http://h99.io/", '<a href="http://bad.net/">'), (100, "http://bad.net/", ""), (101, "http://alone.io/", "")]
    got = {r.id: r for r in U.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert U.ROUNDS < 100 and all(got[i].verdict == "block" and got[i].distrust > 0 for i in range(101))
    assert got[101].verdict == "allow" and got[101].distrust == 0
