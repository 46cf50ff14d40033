"""Operator 1 against a direct reading of the rules; exactness of cascades."""

import random

import numpy as np
from pyspark.sql import functions as F

from branchbook.llm import urlfilter as U


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in U.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    spam = any((host == h or host.endswith("." + h)) and path.startswith(p) for h, p in U.LISTED)
    return host, path, None, "block" if spam else "allow"


def urls():
    r = random.Random(2)
    hosts = ["net", "a.net", "example.net", "x.Example.NET", "notexample.net", "example.com", "b.example.com", "org",
             "m.org", "www.cheap-pills.example.com", "Éa.org", "..net", "net.", "", "u@h.net:80", "spam-farm.example.org"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/x", "/fr/", "/fr/é?x=/de/", "?q=1", "#top", "/de/#a", "\n/x"]
    out = [r.choice(["http", "", "HTTPS", "a://b"]) + "://" + r.choice(hosts) + r.choice(paths) for _ in range(400)]
    return out + [None, "", "no scheme", "://", "http:/a.net/"]


def test_rules(spark):
    rows = list(enumerate(urls()))
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df).collect()}
    assert got == {i: brute(u) for i, u in rows}


def test_long_lists_by_join_agree(spark, monkeypatch):
    rows = list(enumerate(urls()))
    df = spark.createDataFrame(rows, "page_id long, url string")
    monkeypatch.setattr(U, "MAX_WORDS", 1)
    many = [(f"h{i}.net", "/", "allow") for i in range(200)] + [(f"h{i}.net", "/x", "allow") for i in range(0)]
    pages = spark.createDataFrame([(i, f"http://h{i}.net/") for i in range(300)], "page_id long, url string")
    assert sum(r.verdict == "allow" for r in U.judge(pages, U.RULES + many, []).collect()) == 200
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df).collect()}
    assert got == {i: brute(u) for i, u in rows}


def test_cascade_is_exact_over_the_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 20000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    levels = U.build_cascade(listed, universe)
    assert len(levels) > 2
    h = universe.select("key", *(U._hash(F.col("key"), x.seed, w).alias(f"c{k}_{w}")
                                 for k, x in enumerate(levels) for w in (0, 1))).toPandas()
    a = np.array([h[f"c{k}_0"] for k in range(len(levels))])
    b = np.array([h[f"c{k}_1"] for k in range(len(levels))])
    want = h["key"].str[1:].astype(int) % 7 == 0
    assert (U._member(levels, a, b) == want.to_numpy()).all()


def test_empty_table(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string, host int")).collect() == []
