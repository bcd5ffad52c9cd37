from __future__ import annotations

import math

from ordermill.llm import hosts
from ordermill.llm.queries import URL_RULES


def test_rules_and_parts(spark):
    urls = [
        "http://A.Example.NET/en/x?q", "https://example.net/en", "http://x.example.com/de/", "http://b.org/fr/1", "http://notnet/",
        "http://net", "http://a.net?x://b.org/fr/", None, "no scheme", "http://h.org#/fr/", "HTTP://WWW.Example.com/DE/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'z' as host", "'y' as verdict")
    empty = spark.createDataFrame([], "url string, bad int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hosts.judge(pages, empty, URL_RULES).collect()}
    assert [found[i] for i in range(len(urls))] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "/en", "net/", "block"),
        ("x.example.com", "/de/", "example.com/de/", "block"), ("b.org", "/fr/1", "org/fr/", "allow"),
        ("notnet", "/", None, "allow"), ("net", "", None, "allow"), ("a.net", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("h.org", "", None, "allow"), ("www.example.com", "/DE/", None, "allow"),
    ]


def _strength(groups):
    excess = sum((b - n * p) ** 2 - n * p * (1 - p) for n, b, p in groups)
    pairs = sum(n * (n - 1) * p * (1 - p) for n, b, p in groups)
    r = excess / pairs if pairs > 0 else 0
    return min(max(1 / r - 1, hosts.WEAKEST), hosts.STRONGEST) if r > 0 else hosts.STRONGEST


def test_posteriors_by_hand(spark):
    seen = {"a.good.com": (40, 1), "b.good.com": (30, 2), "a.bad.com": (20, 19), "b.bad.com": (15, 15), "one.org": (1, 1), "x.co.uk": (10, 3)}
    rows = [(f"http://{h}/p", int(i < bad)) for h, (n, bad) in seen.items() for i in range(n)] + [(None, 1), ("http://a.good.com", None)]
    labelled = spark.createDataFrame(rows, "url string, bad int")
    domain = lambda h: h if h == "x.co.uk" else ".".join(h.split(".")[-2:])
    suffix = lambda h: "co.uk" if h == "x.co.uk" else h.rsplit(".", 1)[-1]

    def level(name, above, means):
        groups = {}
        for h, (n, b) in seen.items():
            g = groups.setdefault(name(h), [0, 0, means[above(h)]])
            g[0], g[1] = g[0] + n, g[1] + b
        k = _strength(list(groups.values()))
        return {g: (b + p * k) / (n + k) for g, (n, b, p) in groups.items()}

    n, b = (sum(v[i] for v in seen.values()) for i in (0, 1))
    s = level(suffix, lambda h: 0, {0: (b + 1) / (n + 2)})
    d = level(domain, suffix, s)
    expected = level(lambda h: h, domain, d)
    found = {r.host: r["mean"] for r in hosts.rated(labelled)[0].collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[h], expected[h], rel_tol=1e-9) for h in expected)
    # A host never seen takes its domain's posterior.
    pages = spark.createDataFrame([(1, "http://new.bad.com/"), (2, "http://new.good.com/"), (2, "http://new.good.com/")], "page_id long, url string")
    assert sorted((r.page_id, r.verdict) for r in hosts.judge(pages, labelled, {}).collect()) == [(1, "block"), (2, "allow"), (2, "allow")]


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert hosts.judge(pages, spark.createDataFrame([], "url string, bad int"), URL_RULES).collect() == []
