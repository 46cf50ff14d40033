"""Operator 1: URL filters by Bloom filter cascades.

A URL is looked up under its keys: every suffix of its host at a label
boundary, joined with every prefix of its path that has the length of some
listed path (so all subdomains and longer paths fit).  Each list of keys is
encoded by a cascade of Bloom filters over the complete universe of keys that
the corpus has: level 1 holds the listed keys, level 2 the universe's false
positives of level 1, level 3 the listed keys that level 2 wrongly reports, and
so on until a level has none.  The first level that lacks a key decides, so
membership is exact for every key of the corpus, in one pass over the pages
without a join.

Levels are built as distinct bit words on Spark; what the driver gathers is
bounded by ``MAX_WORDS`` words per cascade, which is checked against the exact
level size first.  A longer list is looked up by an equi-join of the keys.

Defined results: a null URL, or one without ``://``, has an empty host and path
and fits no rule; equal page ids are each reported; of two rules that fit, the
longer one wins (host and path together, then the longer host; a key both
allowed and blocked is blocked).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
#: The method's own list: sites whose pages are blocked where no rule fits.
LISTED = [("cheap-pills.example.com", "/"), ("spam-farm.example.org", "/"), ("free-bets.example.net", "/"),
          ("casino.example.com", "/")]
MAX_WORDS = 1 << 22
WORD = 62
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host and path."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    part = lambda g: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", g)
    return pages.select("page_id", F.translate(part(1), _UPPER, _LOWER).alias("host"), part(2).alias("path"))


def _keys(lengths: list[int]) -> Column:
    """The URL's keys, longest first: array<string>."""
    labels = F.split("host", "[.]")
    suffixes = F.filter(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")), lambda s: s != "")
    prefixes = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda n: F.struct(
        (-F.length(s) - n).alias("order"), (-F.length(s)).alias("then"),
        F.concat(s, F.substring(F.col("path"), F.lit(1), n)).alias("key")))))
    return F.transform(F.array_sort(keys), lambda k: k["key"])


@dataclass
class Level:
    words: np.ndarray       # WORD bits in each
    bits: int
    hashes: int
    seed: int

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        hit = np.ones(len(a), bool)
        for i in range(self.hashes):
            at = (a + i * b) % self.bits
            hit &= (self.words[at // WORD] >> (at % WORD)) & 1 == 1
        return hit


def _hash(key: Column, seed: int, which: int) -> Column:
    """31 bits of the key's hash."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(which)), 33)


def _build_level(keys: DataFrame, n: int, rate: float, seed: int) -> Level | None:
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, math.ceil(n * hashes / math.log(2)))
    if bits > MAX_WORDS * WORD:
        return None
    at = F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.pmod(
        _hash(F.col("key"), seed, 0) + i * _hash(F.col("key"), seed, 1), F.lit(bits)))
    rows = (keys.select(F.explode(at).alias("at"))
            .groupBy(F.expr(f"at div {WORD}").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(at % {WORD} as int))")).alias("set")).collect())
    words = np.zeros(bits // WORD + 1, np.int64)
    for r in rows:
        words[r["word"]] = r["set"]
    return Level(words, bits, hashes, seed)


def _member(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a``, ``b``: one row of hashes for each level."""
    out = np.zeros(a.shape[1], bool)
    open_ = np.arange(a.shape[1])
    for k, level in enumerate(levels):
        hit = level.has(a[k][open_], b[k][open_])
        out[open_[~hit]] = k % 2 == 1        # a key that level k lacks
        open_ = open_[hit]
    out[open_] = len(levels) % 2 == 1
    return out


def _probe(cascades: dict[str, list[Level]]):
    """Adds ``hits``: for each cascade the place of the first listed key, or null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, names = list(batch.columns[:4]), batch.schema.names[:4]
            for name, levels in cascades.items():
                keys = batch.column(batch.schema.get_field_index(f"h_{name}"))
                sizes = np.diff(keys.offsets.to_numpy())
                flat = keys.flatten().flatten().to_numpy().reshape(int(sizes.sum()), 2 * len(levels))
                member = _member(levels, flat[:, 0::2].T, flat[:, 1::2].T)
                row = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = np.full(len(sizes), -1, np.int32)
                at = np.flatnonzero(member)[::-1]
                first[row[at]] = place[at]
                cols.append(pa.array(first, mask=first < 0))
                names.append(name)
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level] | None:
    """The levels that tell ``listed`` (key) from the rest of ``universe``
    (key); None if a level would pass the bound.  Listed keys that the corpus
    lacks are left out: no page can ask for them."""
    inside = listed.distinct().join(universe, "key", "left_semi")
    outside = universe.join(listed.distinct(), "key", "left_anti")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    holds, other, n = inside, outside, n_in
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * n_in / max(1, n_out)))
    while n:
        level = _build_level(holds, n, rate, len(levels))
        if level is None:
            return None
        levels.append(level)
        wrong = other.where(_in_level(F.col("key"), level))
        holds, other, n, rate = wrong, holds, wrong.count(), 0.5
    return levels


def _in_level(key: Column, level: Level) -> Column:
    @F.pandas_udf("boolean")
    def has(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(level.has(a.to_numpy(), b.to_numpy()))
    return has(_hash(key, level.seed, 0), _hash(key, level.seed, 1))


def judge(pages: DataFrame, rules=RULES, listed=LISTED) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    spark: SparkSession = pages.sparkSession
    lengths = sorted({len(p) for _, p, _ in rules} | {len(p) for _, p in listed})
    blocked = {h + p for h, p, v in rules if v == "block"}
    lists = {"block": sorted(blocked), "allow": sorted({h + p for h, p, _ in rules} - blocked),
             "listed": sorted({h + p for h, p in listed})}
    urls = parsed(pages).withColumn("keys", _keys(lengths))
    universe = urls.select(F.explode("keys").alias("key")).distinct()
    frames = {n: spark.createDataFrame([(k,) for k in keys], "key string") for n, keys in lists.items()}
    cascades = {n: build_cascade(f, universe) for n, f in frames.items()}
    if any(c is None for c in cascades.values()):
        return _judge_by_join(urls, frames)
    cols = {f"h_{n}": F.transform("keys", _hasher(levels)) for n, levels in cascades.items()}
    schema = ("page_id long, host string, path string, keys array<string>, " + ", ".join(f"{n} int" for n in cascades))
    found = urls.withColumn("page_id", F.col("page_id").cast("long")).withColumns(cols).mapInArrow(_probe(cascades), schema)
    return _verdict(found)


def _hasher(levels: list[Level]):
    def hashes(k: Column) -> Column:
        return F.array(*(_hash(k, x.seed, w) for x in levels for w in (0, 1))).cast("array<long>")
    return hashes


def _verdict(found: DataFrame) -> DataFrame:
    """The longest rule (smallest place) decides, then the method's list."""
    place = F.least("block", "allow")
    rule = F.when(place.isNotNull(), F.element_at("keys", place + 1))
    by_rule = F.when(F.col("block") == place, "block").when(F.col("allow") == place, "allow")
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        by_rule, F.when(F.col("listed").isNotNull(), "block"), F.lit("allow")).alias("verdict"))


def _judge_by_join(urls: DataFrame, frames: dict[str, DataFrame]) -> DataFrame:
    """For lists whose filters would pass the bound: the keys' places by equi-joins."""
    urls = urls.withColumn("row", F.monotonically_increasing_id())
    places = urls.select("row", F.posexplode("keys").alias("place", "key"))
    for n, f in frames.items():
        first = places.join(f.distinct(), "key").groupBy("row").agg(F.min("place").alias(n))
        urls = urls.join(first, "row", "left")
    return _verdict(urls.withColumn("page_id", F.col("page_id").cast("long")))


_LISTED = ", ".join(f"('{h}', '{p}')" for h, p in LISTED)
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
SQL = f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                     '{_UPPER}', '{_LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT * FROM (VALUES {_RULES}) t(h, p, v)),
l AS (SELECT * FROM (VALUES {_LISTED}) t(h, p)),
fit AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
        FROM (SELECT DISTINCT host, path FROM u) d JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        GROUP BY ALL),
spam AS (SELECT DISTINCT host, path FROM (SELECT DISTINCT host, path FROM u) d
         JOIN l ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, u.host, u.path, fit.rule,
       coalesce(fit.v, CASE WHEN spam.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit ON u.host = fit.host AND u.path = fit.path
       LEFT JOIN spam ON u.host = spam.host AND u.path = spam.path
"""
