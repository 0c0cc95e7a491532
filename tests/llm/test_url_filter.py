"""Judged addresses against a plain search through rules and lists."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import connect, rows_of, rows_of_sql

from shelfstream.llm import url_filter
from shelfstream.llm.url_filter import (
    OP11_SQL, RULES, build_filter, judge_urls, mirror_urls, op11_url_filter, passes, unwanted_urls,
)

PAGES = "page_id long, url string, verdict string, row int"


def _split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), path[:end]


def _slow(pages, rules, urls):
    listed = {(h, p.rstrip("/")) for h, p in map(_split, urls) if h}
    out = []
    for page_id, url in pages:
        host, path = _split(url)
        fits = [
            (len(h + p), len(h), h + p, v == "block") for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=None)
        on_list = host != "" and (host, path.rstrip("/")) in listed
        block = best[3] if best else on_list
        out.append((page_id, host, path, best and best[2], on_list, "block" if block else "allow"))
    return sorted(out, key=str)


def _judged(spark, pages, rules, urls):
    table = spark.createDataFrame([(i, u, "x", 1) for i, u in pages], PAGES).repartition(3)
    return judge_urls(
        table,
        spark.createDataFrame(rules, "host string, path string, verdict string"),
        spark.createDataFrame([(u,) for u in urls], "url string"),
    )


EDGES = [
    (1, None), (2, ""), (3, "example.org/en/1"), (4, "http://EXAMPLE.org/en/1?x#y"), (4, "http://EXAMPLE.org/en/1?x#y"),
    (5, "http://org"), (6, "http://org/"), (7, "http://notorg.org2/"), (8, "http://a.b.example.org/es/"),
    (9, "http://xexample.org/es/"), (10, "https://a.com/fr/?q=://b.com/de/"), (11, "x://y.com#/de/"),
    (12, "://z.com/de/"), (13, "http://Ä.COM/de/É"), (None, "http://listed.net/a//"), (14, "http:///de/"),
    (15, "ftp://LISTED.net/a?b"), (16, "http://listed.net/a/b"), (17, "http://.com/de/"),
    (18, "http://" + "a." * 40_000 + "com/de/" + "x" * 100_000), (19, "http://m.listed.net/a"),
]


def test_edges_equal_a_plain_search(spark):
    urls = ["http://listed.net/a", "http://listed.net/a/", None, "nothing", "http://org/q"]
    rules = [*RULES, ("org", "/", "allow"), ("Listed.net", "/a/b", "block"), (None, "/", "block"), ("", "/", "block")]
    got = _judged(spark, EDGES, rules, urls)
    assert got.columns == ["page_id", "host", "path", "rule", "listed", "verdict"]
    plain = [(_split("x://" + (h or ""))[0], p, v) for h, p, v in rules]
    assert sorted(map(tuple, got.collect()), key=str) == _slow(EDGES, plain, urls)


def test_random_addresses_and_rules(spark):
    rng = random.Random(3)
    labels = ["a", "bb", "c-c", "org", "com"]
    host = lambda: ".".join(rng.choices(labels, k=rng.randint(1, 4)))
    path = lambda: "".join(rng.choices(["/", "/x", "/yy", "/x/1"], k=rng.randint(0, 3)))
    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"s://{host()}{path()}" for _ in range(80)]
    pages = [(n, f"http://{host()}{path()}{rng.choice(['', '?a', '#b'])}") for n in range(600)]
    got = _judged(spark, pages, rules, urls)
    assert sorted(map(tuple, got.collect()), key=str) == _slow(pages, rules, urls)


def test_the_one_of_equal_rules_that_blocks(spark):
    got = _judged(spark, [(1, "http://a.org/x")], [("org", "/", "allow"), ("ORG", "/", "block")], [])
    assert [r.verdict for r in got.collect()] == ["block"]


def test_empty_tables(spark):
    assert _judged(spark, [], RULES, []).collect() == []
    got = _judged(spark, [(1, "http://a.org/x")], [], []).collect()
    assert [tuple(r) for r in got] == [(1, "a.org", "/x", None, False, "allow")]


def test_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    words = build_filter(keys, 20_000)
    own = np.array([r.h for r in keys.collect()])
    others = np.array([r.h for r in spark.range(10**6, 10**6 + 50_000).select(F.xxhash64("id").alias("h")).collect()])
    assert passes(words, own).all()
    assert passes(words, others).mean() < 0.005


@pytest.mark.parametrize("blocks", [1, 7])
def test_a_filter_too_small_changes_no_verdict(spark, monkeypatch, blocks):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", blocks)
    urls = [f"http://h{n}.net/p" for n in range(500)]
    pages = [(n, f"http://h{n}.net/p") for n in range(0, 1000, 3)]
    got = _judged(spark, pages, RULES, urls)
    assert sorted(map(tuple, got.collect()), key=str) == _slow(pages, RULES, urls)


def test_mirrors_and_unwanted_hosts(spark):
    rows = [
        (3, "http://B.net/x/", "<p>one"), (1, "http://a.net/x", "<p>one"), (2, "https://a.net/x/?q", "<p>one"),
        (4, "http://c.net/", "<p>two"), (None, "http://d.net/", "<p>one"), (5, None, "<p>one"), (6, "http://e.net/", ""),
        (7, "http://f.net/", ""), (8, "http://g.net/", None), (9, "http://my-ads.net/z", "<p>3"), (10, "http://myads.net/", "<p>4"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r.url for r in mirror_urls(pages).collect()] == ["http://b.net/x"]
    assert [r.url for r in unwanted_urls(pages, ["ads"]).collect()] == ["http://my-ads.net/z"]


def test_query_equals_sql(spark, sf_dir):
    assert rows_of(op11_url_filter(spark, sf_dir)) == rows_of_sql(connect(sf_dir), OP11_SQL)
