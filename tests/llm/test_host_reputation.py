"""URL filters: parts, rules, and posteriors against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wattlane.llm import host_reputation as reputation
from wattlane.llm.host_reputation import Rule
from wattlane.llm.queries import SITE_SUFFIXES, URL_RULES

SCHEMA = "page_id long, url string, html string, host string, suffix string, n string"


def pages_of(spark, urls, ids=None):
    ids = range(len(urls)) if ids is None else ids
    return spark.createDataFrame([(i, u, "x", "clash", "clash", "clash") for i, u in zip(ids, urls, strict=True)], SCHEMA)


def no_outcomes(spark):
    return spark.createDataFrame([], "page_id long, bad boolean")


def judged(spark, urls, outcomes=None, **options):
    found = reputation.filter_urls(
        pages_of(spark, urls), no_outcomes(spark) if outcomes is None else outcomes, URL_RULES, **options
    )
    return [tuple(r)[1:] for r in found.orderBy("page_id").collect()]


def test_parts_and_rules(spark):
    urls = {
        "https://A.Example.ORG/en/12": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/es/x?q=/fr/": ("example.org", "/es/x", "example.org/es/", "block"),
        "http://example.org/es": ("example.org", "/es", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "allow"),
        "http://example.org#/es/": ("example.org", "", None, "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://org/": ("org", "/", "org/", "allow"),
        "ftp://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "//x.com/de/": ("", "", None, "allow"),
        "http://x.com/FR/": ("x.com", "/FR/", None, "allow"),
        "http://x.com/fr/://y.org/": ("x.com", "/fr/://y.org/", "com/fr/", "allow"),
        "http://u@x.com:80/de/": ("u@x.com:80", "/de/", None, "allow"),
        "http://É.COM/de/é": ("É.com", "/de/é", "com/de/", "block"),
        "http://x.com/a\n/de/": ("x.com", "/a\n/de/", None, "allow"),
        "://?": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    assert judged(spark, list(urls)) == list(urls.values())


def test_longest_rule_and_its_ties(spark):
    rules = [Rule("allow", "a.b", "/c"), Rule("block", "b", "/c/d")]
    pages = pages_of(spark, ["http://a.b/c/d", "http://b/c/d"])
    found = reputation.filter_urls(pages, no_outcomes(spark), rules).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in found] == [("a.b/c", "allow"), ("b/c/d", "block")]


def test_levels(spark):
    hosts = {
        "a.b.c.co.uk": ("co.uk", "c.co.uk", "a.b.c.co.uk"),
        "c.co.uk": ("co.uk", "c.co.uk", "c.co.uk"),
        "co.uk": ("co.uk", "co.uk", "co.uk"),
        "uk": ("uk", "uk", "uk"),
        "": ("", "", ""),
        "u@h.net:8080": ("net", "h.net", "h.net"),
        "www.shop.example.com": ("example.com", "shop.example.com", "www.shop.example.com"),
    }
    rows = spark.createDataFrame([(h,) for h in hosts], "given string")
    levels = reputation.named_levels(F.col("given"), SITE_SUFFIXES)
    found = {r[0]: tuple(r)[1:] for r in rows.select("given", *(levels[k] for k in reputation.LEVELS)).collect()}
    assert found == hosts


def suffix_of(host):
    return host.rsplit(".", 1)[-1], ".".join(host.split(".")[-2:])


def made_up(seed=7):
    """One host with a third of all pages, bad domains, hosts without outcomes."""
    rng = random.Random(seed)
    pages = []
    for d in range(30):
        rate = 0.95 if d % 6 == 0 else 0.1
        for h in range(rng.randrange(1, 6)):
            host = f"h{h}.d{d}.{['com', 'net', 'org'][d % 3]}"
            known = rng.random() < 0.8
            pages += [(host, int(rng.random() < rate) if known else None) for _ in range(rng.randrange(1, 25))]
    return pages + [("big.site.com", int(rng.random() < 0.05)) for _ in range(len(pages) // 2)]


def test_posteriors_against_brute_force(spark):
    pages = made_up()
    frame = pages_of(spark, [f"http://{h}/x" for h, _ in pages])
    outcomes = spark.createDataFrame(
        [(i, None if b is None else bool(b)) for i, (_, b) in enumerate(pages)], "page_id long, bad boolean"
    )
    named = frame.select("page_id", *(c.alias(k) for k, c in reputation.named_levels(reputation.host_of(F.col("url")), ()).items()))
    counts = reputation.host_counts(named, outcomes).cache()
    found = {r.host: (r.a, r.b) for r in reputation.reputations(counts).collect()}
    expected = brute.reputations(pages, suffix_of)
    assert found.keys() == expected.keys()
    for host, (a, b) in expected.items():
        assert found[host] == pytest.approx((a, b), rel=1e-9)
    verdicts = {
        r.host: r.verdict for r in reputation.filter_urls(frame, outcomes, (), suffixes=()).collect()
    }
    blocked = {h for h, (a, b) in expected.items() if a / (a + b) - 1.645 * (a * b / (a + b + 1)) ** 0.5 / (a + b) > 0.5}
    assert {h for h, v in verdicts.items() if v == "block"} == blocked
    # Bad domains speak for their hosts without outcomes; good ones are left alone.
    assert len(blocked) >= 5 and all(int(h.split(".")[1][1:]) % 6 == 0 for h in blocked)
    bare = {h for h, b in pages if b is None}
    assert blocked & bare


def test_outcomes_of_odd_ids(spark):
    urls = ["http://a.net/x"] * 40 + ["http://b.net/x"]
    pages = pages_of(spark, urls, [None] * 20 + [7] * 20 + [8])
    outcomes = spark.createDataFrame(
        [(None, True), (7, True), (7, None), (7, False), (8, None)], "page_id long, bad boolean"
    )
    named = pages.select("page_id", *(c.alias(k) for k, c in reputation.named_levels(reputation.host_of(F.col("url")), ()).items()))
    counts = {r.host: (r.n, r.y) for r in reputation.host_counts(named, outcomes).collect()}
    assert counts == {"a.net": (20, 20), "b.net": (0, 0)}
    found = reputation.filter_urls(pages, outcomes, URL_RULES)
    assert found.count() == 41


def test_nothing(spark):
    found = reputation.filter_urls(pages_of(spark, []), no_outcomes(spark), URL_RULES)
    assert found.count() == 0 and found.columns == ["page_id", "host", "path", "rule", "verdict"]


def test_no_python_on_the_way(spark):
    found = reputation.filter_urls(pages_of(spark, ["http://a.com/"]), no_outcomes(spark), URL_RULES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
