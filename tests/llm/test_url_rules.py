"""URL rules against trying every rule."""

import random
from bisect import bisect_right
from collections import Counter

from pyspark.sql import functions as F

from clickloom.llm import queries, url_rules


def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    m = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return host, path[:m]


def _brute(url, rules):
    host, path = _host_path(url)
    fitting = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=None)
    return (host, path, best and best[3], best[4] if best else "allow")


def test_random_rules(spark):
    pick = random.Random(4)
    labels = ["a", "b", "net", "x-y", "é", "a.b"]

    def host():
        return ".".join(pick.choice(labels) for _ in range(pick.randint(1, 4)))

    rules = [
        (host(), "/" + "".join(pick.choice("ab/") for _ in range(pick.randint(0, 3))), pick.choice(["allow", "block"]))
        for _ in range(120)
    ] + [(None, "/", "block"), ("a", None, "block")]
    urls = [
        f"{pick.choice(['http', 'HTTPS'])}://{host().upper() if n % 7 == 0 else host()}"
        + pick.choice(["", "/", "/a", "/ab/a", "/b/b?x=/a", "#/a", "?q"])
        for n in range(1500)
    ] + [None, "", "no url", "://", "http://", "a://b://c/d\n/e"]
    pages = spark.createDataFrame(
        [(n if n % 50 else None, url, "x") for n, url in enumerate(urls)], "page_id long, url string, verdict string"
    )
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    for ranges in (1, 7, 64):
        found = url_rules.judge(pages, table, ranges=ranges).collect()
        assert sorted(map(repr, (tuple(row)[1:] for row in found))) == sorted(
            repr(_brute(url, rules)) for url in urls
        )


def test_empty_sides(spark):
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_rules.judge(pages, rules, "block").collect()] == [(1, "a", "/b", None, "block")]
    assert url_rules.judge(pages.limit(0), rules).collect() == []


def test_sweep_leaves_closed_hosts():
    rules = [("net.", "net", "/", "block"), ("net.a.", "a.net", "/", "allow"), ("net.b.c.", "c.b.net", "/x", "allow")]
    urls = [("net.", "/"), ("net.a.", "/"), ("net.a.z.", "/"), ("net.b.", "/"), ("net.b.c.", "/x"), ("org.", "/")]
    assert [pair and pair[1] for pair in url_rules.sweep(urls, rules)] == [
        "block", "allow", "allow", "block", "allow", None,
    ]


def test_copies_of_one_page_are_spread(spark):
    rows = [(7, "http://example.net/en/a")] * 3000 + [(n, f"http://h{n % 9}.org/fr/{n}") for n in range(100, 350)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(5)
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    found = url_rules.judge(pages, rules, ranges=8)
    verdicts = Counter((r["page_id"] == 7, r["rule"], r["verdict"]) for r in found.collect())
    assert verdicts == {(True, "example.net/en/", "allow"): 3000, (False, "org/fr/", "allow"): 250}
    sort_keys = url_rules.keyed(pages)
    bounds = url_rules._bounds(sort_keys, 8)
    held = Counter(bisect_right(bounds, r["sort_key"]) for r in sort_keys.collect())
    assert len(held) == 8 and max(held.values()) < 1000
