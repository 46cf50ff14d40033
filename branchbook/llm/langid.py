"""Operator 9: language identification of web pages by Bayesian evidence fusion.

For each page the posterior over the labelled languages combines

* the text's likelihood under byte-trigram models, tempered by ``TEMPER`` as
  trigrams overlap; they are trained on a bounded sample: of each language all
  labelled documents up to ``SAMPLE_DOCS``, of a larger one about as many,
  chosen by a hash of the document, so every labelled language has a model;
* the language declared in the markup, by the confusion table P(declared | language);
* the address suffix, by P(suffix | language);
* a prior of the host, smoothed towards its domain (last two labels) and that
  towards all pages, by ``SMOOTH`` pseudo-counts a level.

The tables are grouped sums of the text's own decisions over all pages; a
page's own vote is taken out of its host, domain and total counts, so its text
does not count twice.  Host and domain tables are equi-joined (salted, as one
host may hold a third of the pages); declared tags are two or three letters,
so their table is bounded and broadcast.

Defined results: null or empty html is a page without text evidence; a null
URL has the empty host, domain and suffix; absent or malformed declarations
carry no evidence; equal page ids are each reported; without any labelled
document the language is null.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import Workspace, batch_rows

SAMPLE_DOCS = 4000
BUCKETS = 1 << 14
TEMPER, SMOOTH, SALTS = 0.25, 5.0, 8

_MUL = np.uint32(2654435761)
_DROP = re.compile(r"<(script|style|nav)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_OTHER = re.compile(r"[\W\d_]+")
_LANG = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", re.I)


def grams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the letters (words parted by one blank)."""
    b = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(b) < 4:
        return np.empty(0, np.int64)
    return (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * _MUL) >> np.uint32(18)).astype(np.int64)


def visible(page: str) -> str:
    """The text outside tags.  Tags are looked for up to the last ``>`` only, so
    every ``<`` there ends at one, and a page of ``<`` alone costs nothing."""
    rest = _DROP.sub(" ", page)
    end = rest.rfind(">") + 1
    return html.unescape(_TAG.sub(" ", rest[:end]) + rest[end:])


def declared(page: str) -> str | None:
    m = _LANG.search(page)
    return m[1].lower() if m else None


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            total[lang] += np.bincount(grams(text), minlength=BUCKETS)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                          pa.array(n[at])], ["lang", "bucket", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and log P(trigram bucket | language); at most one number
    for each language and bucket comes to the driver."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    seen = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}   # one row per language
    cuts = [F.lit(x) for lang, n in seen.items() if n > SAMPLE_DOCS for x in (lang, int(SAMPLE_DOCS / n * (1 << 30)))]
    picked = labelled
    if cuts:
        cut = F.coalesce(F.element_at(F.create_map(*cuts), F.col("lang")), F.lit(1 << 30))
        picked = labelled.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(9)), F.lit(1 << 30)) < cut)
    rows = (picked.select("lang", "text").mapInArrow(_count_batches, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    langs = sorted(seen)
    count = np.full((len(langs), BUCKETS), 0.5)
    for r in rows:
        count[langs.index(r["lang"]), r["bucket"]] += r["n"]
    return langs, np.log(count / count.sum(axis=1, keepdims=True)) if langs else count


def log_likelihood(text: str, model: np.ndarray) -> np.ndarray:
    g = grams(text)
    return model[:, g].sum(axis=1)


def _evidence(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page_id, host, page in zip(*(c.to_pylist() for c in b.columns)):
                page = page or ""
                ll = log_likelihood(visible(page), model)
                vote = int(np.argmax(ll)) if np.any(ll) else None
                out.append((page_id, host, declared(page), ll.tolist(), vote))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string(),
                                                                pa.list_(pa.float64()), pa.int32()))],
                    ["page_id", "host", "declared", "ll", "vote"])
    return run


def _counts(votes: DataFrame, key: str, name: str, k: int) -> DataFrame:
    """``name``: array of the votes for each language, by ``key``."""
    return votes.groupBy(key).agg(F.array(*(
        F.sum(F.when(F.col("vote") == i, F.col("n")).otherwise(F.lit(0))).cast("double") for i in range(k))).alias(name))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def identify(pages: DataFrame, docs: DataFrame, ws: Workspace) -> DataFrame:
    """page_id, host, declared, text_lang, lang and its posterior probability."""
    langs, model = train(docs)
    k = len(langs)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
                         F.col("html").cast("string").alias("html"))
    if not k:
        return given.select("page_id", "host", *(F.lit(None).cast("string").alias(c) for c in (
            "declared", "text_lang", "lang")), F.lit(None).cast("double").alias("probability"))
    ev = given.mapInArrow(_evidence(model), "page_id long, host string, declared string, ll array<double>, vote int")
    ev = ws.write(ev, "evidence")

    labels = F.split("host", "[.]")
    votes = (ev.where(F.col("vote").isNotNull()).groupBy("host", "declared", "vote").agg(F.count("*").alias("n"))
             .withColumn("domain", F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."))
             .withColumn("suffix", F.element_at(labels, -1)))
    by_host = _counts(votes, "host", "n_host", k).join(
        votes.select("host", "domain", "suffix").distinct(), "host")
    hosts = (by_host.join(_counts(votes, "domain", "n_domain", k), "domain")
             .join(_counts(votes, "suffix", "n_suffix", k), "suffix"))
    hosts = ws.write(hosts.select("host", "n_host", "n_domain", "n_suffix"), "hosts")
    salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    tags = _counts(votes.where(F.col("declared").isNotNull()), "declared", "n_tag", k)   # at most 26**2 + 26**3 rows
    n_all, n_tags = [0.0] * k, [0.0] * k
    for r in votes.groupBy("vote").agg(F.sum("n").alias("n"), F.sum(F.when(
            F.col("declared").isNotNull(), F.col("n"))).alias("t")).collect():          # one row per language
        n_all[r["vote"]], n_tags[r["vote"]] = float(r["n"]), float(r["t"] or 0)

    joined = (ev.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
              .join(salted, ["host", "salt"], "left").join(F.broadcast(tags), "declared", "left"))
    every = F.array(*map(F.lit, n_all))
    none = F.array(*[F.lit(0.0)] * k)
    own = lambda i: F.when(F.col("vote") == i, 1.0).otherwise(0.0)
    anyone = F.when(F.col("vote").isNotNull(), 1.0).otherwise(0.0)
    at = lambda c, i: F.element_at(F.coalesce(F.col(c), none), i + 1)
    joined = joined.withColumns({f"s_{c}": _total(F.coalesce(F.col(c), none)) for c in ("n_host", "n_domain", "n_suffix", "n_tag")})

    def posterior(i: int) -> Column:
        total = (n_all[i] + 1.0 - own(i)) / (sum(n_all) + k - anyone)
        domain = (at("n_domain", i) - _if_any("s_n_domain", own(i)) + SMOOTH * total) / (
            F.col("s_n_domain") - _if_any("s_n_domain", anyone) + SMOOTH)
        prior = (at("n_host", i) - _if_any("s_n_host", own(i)) + SMOOTH * domain) / (
            F.col("s_n_host") - _if_any("s_n_host", anyone) + SMOOTH)
        suffix = (at("n_suffix", i) + SMOOTH * F.col("s_n_suffix") / (sum(n_all) + 1)) / (n_all[i] + SMOOTH)
        tag = (at("n_tag", i) + SMOOTH * F.greatest(F.col("s_n_tag"), F.lit(1.0)) / (sum(n_tags) + 1)) / (n_tags[i] + SMOOTH)
        return (F.log(prior) + TEMPER * F.element_at("ll", i + 1)
                + F.when(F.col("s_n_suffix") > 0, F.log(suffix)).otherwise(0.0)
                + F.when(F.col("declared").isNotNull(), F.log(tag)).otherwise(0.0))

    names = F.array(*map(F.lit, langs))
    scored = joined.withColumn("post", F.array(*(posterior(i) for i in range(k))))
    top = F.array_max("post")
    return scored.select(
        "page_id", "host", "declared", F.when(F.col("vote").isNotNull(), F.element_at(names, F.coalesce("vote", F.lit(0)) + 1)).alias("text_lang"),
        F.element_at(names, F.array_position("post", top).cast("int")).alias("lang"),
        (1.0 / F.aggregate("post", F.lit(0.0), lambda s, x: s + F.exp(x - top))).alias("probability"))


def _if_any(size: str, x: Column) -> Column:
    """A page's own vote is in a count only if the count is not empty."""
    return F.when(F.col(size) > 0, x).otherwise(0.0)
