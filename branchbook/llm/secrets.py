"""Operator 7: secret scans, in DataFrame functions only.

Base spans come from three patterns.  The method adds ``markov`` spans: runs
of at least ``MIN_TOKEN`` token characters whose log-likelihood under a
first-order character Markov model of random strings exceeds that under a
model of ordinary identifiers by ``MIN_LLR`` nats.  Where a whole run does not,
its parts between separators (of ``PARTS``) of that length are judged alike, so
words in one run with a secret do not hide it.  A run or part that reaches out
of a base span is a span of its own, overlapping that one.  Both models are trained on
labelled samples: strings of the base matches (random) and words of texts
without any (ordinary), from a bounded sample of about ``SAMPLE_DOCS``
documents chosen by a hash of ``doc_id`` (all, if there are fewer).  The model
is one number for each pair of alphabet characters, whatever the corpus.

Positions count code points; a pattern's matches are found once, and the text
between them (``split`` by the same pattern) gives their places.

Defined results: null text is empty and has no spans (the digest is that of
the empty string); rows with equal or null ``doc_id`` are each reported; no
table, however empty, is an error (the models are then uniform).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind: (pattern, string that every match holds, shortest length of the checked group, the group)
#: ``{n,}`` finds what ``+`` with a later length check would, as the runs are of one class.
BASE = {
    "assign": (ASSIGN, None, 12, 2),
    "access": (r"AKIA[A-Z0-9]{14,}", "AKIA", 18, 0),
    "hex": (r"[0-9a-f]{16,}", None, 16, 0),
}
MIN_TOKEN, MIN_LLR = 20, 12.0
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN
#: Parts of a run: between ``/ =``, between ``- _``, and between any of them.
PARTS = tuple(r"[A-Za-z0-9%s]{%d,}" % (more, MIN_TOKEN) for more in ("+_-", "+/=", "+"))
SAMPLE_DOCS = 4000
BACKOFF = 8.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_V = len(ALPHABET) + 1                       # 0 stands for any other character
MASK = "[secret]"


def _places(text: str, pattern: str, need: Column | None, group: int, at_least: int) -> Column:
    """array<struct<start, end, value>> of the pattern's matches whose group
    has ``at_least`` characters; end exclusive, in code points."""
    t = F.col(text)
    p = F.lit(pattern)
    found = F.regexp_extract_all(t, p, F.lit(0))
    if need is not None:
        found = F.when(need, found).otherwise(F.array().cast("array<string>"))
    value = F.regexp_extract_all(t, p, F.lit(group)) if group else found
    each = F.arrays_zip(F.slice(F.split(t, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("hit"),
                        value.alias("val"))
    walk = F.aggregate(
        each, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.when(F.length(x["val"]) >= at_least, F.array_append(acc["out"], F.struct(
                (acc["at"] + F.length(x["gap"])).alias("start"),
                (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), x["val"].alias("value"))))
            .otherwise(acc["out"]).alias("out")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.size(found) > 0, walk["out"]).otherwise(empty)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """The documents (null text: empty) with a column of places for each base kind."""
    out = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    for kind, (pattern, must, least, group) in BASE.items():
        need = None if must is None else F.contains(F.col("text"), F.lit(must))
        out = out.withColumn(f"{kind}_at", _places("text", pattern, need, group, least))
    return out


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(value, random, n): strings of the base matches and ordinary words of a
    bounded sample of documents, with how often each was seen."""
    total = max(docs.count(), 1)
    cut = min(1.0, SAMPLE_DOCS / total)
    picked = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)) < int(cut * (1 << 30))
    d = with_base_spans(docs.select("doc_id", "text").where(picked))
    hits = F.concat(*(F.transform(f"{k}_at", lambda x: x["value"]) for k in BASE))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[A-Za-z_][A-Za-z0-9_]{3,}"), F.lit(0))
    both = d.select((F.size(hits) > 0).alias("random"), F.when(F.size(hits) > 0, hits).otherwise(words).alias("v"))
    return both.select("random", F.explode("v").alias("value")).groupBy("random", "value").agg(F.count("*").alias("n"))


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters (row-major over the
    alphabet): log P(next | this) among random strings less that among
    ordinary ones, each smoothed by ``BACKOFF`` counts of the next character's
    own frequency.  The driver gets at most two counts for each of the
    alphabet's pairs."""
    codes = samples.where(F.length("value") > 1).select("random", "n", _codes(F.col("value")).alias("c"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("c") - 1),
                        lambda i: F.element_at("c", i) * _V + F.element_at("c", i + 1))
    rows = (codes.select("random", "n", F.explode(pairs).alias("pair"))
            .groupBy("random", "pair").agg(F.sum("n").alias("n")).collect())
    models = {}
    for label in (True, False):
        pair = [0] * (_V * _V)
        for r in rows:
            if r["random"] == label:
                pair[r["pair"]] += r["n"]
        one = [1 + sum(pair[b::_V]) for b in range(_V)]
        total = sum(one)
        models[label] = [
            math.log((pair[a * _V + b] + BACKOFF * one[b] / total) / (sum(pair[a * _V:(a + 1) * _V]) + BACKOFF))
            for a in range(_V) for b in range(_V)]
    out = [x - y for x, y in zip(models[True], models[False])]
    return [round(x, 6) for x in out]


def score(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string under the two models."""
    table = F.split(F.lit(" ".join(map(repr, model))), " ").cast("array<double>")
    codes = _codes(value)
    return F.aggregate(
        codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("s")),
        lambda acc, c: F.struct(c.alias("last"), (acc["s"] + F.when(acc["last"] < 0, F.lit(0.0)).otherwise(
            F.element_at(table, acc["last"] * _V + c + 1))).alias("s")))["s"]


def _typed(places: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(places, lambda x: F.struct(x["start"].alias("start"), number.alias("kind"), x["end"].alias("end")))


def scan(docs: DataFrame) -> DataFrame:
    """The documents (null text: empty) with ``spans``, an array of
    (start, kind number, end) in order, and ``base``, the base ones of them."""
    model = train(labelled_samples(docs))
    d = with_base_spans(docs)
    d = d.withColumn("base", F.array_sort(F.concat(*(_typed(F.col(f"{k}_at"), k) for k in BASE))))
    d = d.withColumn("token_at", _places("text", TOKEN, None, 0, MIN_TOKEN))
    for k, pattern in enumerate(PARTS):
        d = d.withColumn(f"part_{k}", _places("text", pattern, F.size("token_at") > 0, 0, MIN_TOKEN))
    parts = [f"part_{k}" for k in range(len(PARTS))]
    d = d.withColumn("candidates", F.array_distinct(F.concat("token_at", *parts)))
    d = d.withColumn("likely", F.filter("candidates", lambda x: ~F.exists(
        F.col("base"), lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])) & (score(x["value"], model) >= MIN_LLR)))
    extra = F.filter("likely", lambda x: ~F.exists(F.col("likely"), lambda y: (y["start"] <= x["start"]) & (
        x["end"] <= y["end"]) & (y["end"] - y["start"] > x["end"] - x["start"])))
    return (d.withColumn("spans", F.array_sort(F.concat("base", _typed(extra, "markov"))))
            .withColumns({f"n_{k}": F.size(f"{k}_at").cast("long") for k in BASE})
            .drop("token_at", "candidates", "likely", *parts, *(f"{k}_at" for k in BASE)))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, the base spans' digest and all spans."""
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", *(f"n_{k}" for k in BASE), F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """The documents with each span (overlapping ones together) replaced by
    ``MASK``; columns of the input."""
    d = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns if c not in ("doc_id", "text")})
    d = scan(d)
    t = F.col("text")
    walk = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]),
                                                 F.lit(MASK))).otherwise(acc["out"]).alias("out")))
    text = F.when(F.size("spans") == 0, t).otherwise(
        F.concat(walk["out"], F.substring(t, walk["at"] + 1, F.length(t))))
    d = d.withColumn("masked_text", text)
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("masked_text").alias("text"))
        elif c == "n_chars":
            cols.append(F.when(F.size("spans") == 0, F.col("in_n_chars")).otherwise(F.length("masked_text"))
                        .cast(docs.schema[c].dataType).alias("n_chars"))
        else:
            cols.append(F.col(c if c == "doc_id" else f"in_{c}").alias(c))
    return d.select(cols)
