"""Operator 12: how the sources of a language differ in their terms.

Terms are runs of letters (A-Z lower-cased) and non-ASCII characters.  They are
counted by sorting pointers, not by building a term object for each occurrence:

* a task lays a shard of documents (about ``SHARD_BYTES`` of text, ordered by
  language and source) into one buffer in which all other bytes are 0, and
  takes a pointer to every term's start;
* each language's slice of pointers is sorted by a multikey quicksort on 8-byte
  keys: by the first 8 bytes, then only runs whose terms go on are sorted by the
  next 8, and so on (a term's cost is linear in its length);
* equal runs, in which the pointers stand by document, yield a term's
  occurrences per source and its document frequency.

So a shard sends one row per term and source, which Spark adds up.  A language
keeps the V terms of at least ``KEPT_DOCS`` of its documents.  With ``count``
occurrences in a group and N over all kept terms, p = 1 + floor(10^9 * (count +
1) / (N + V)), and f = floor((p - q)^2 / q) compares a group's p with q.

* Part ``term``: the group's own terms with p > q (q: the language's), the 200
  largest f.
* Part ``pair``: the sum of f over all V terms for every other source of the
  language.  Most terms are absent from most sources, so the sum is put together
  from what is present: histograms of p for terms that only one of the two has,
  a product for terms that neither has, and corrections for the terms that both
  have, which are added up inside blocks of ``PAIRS`` source pairs.

All arithmetic is exact (64-bit integers; decimals where a product or a sum may
be longer).  A term's list of sources is no longer than the number of sources of
its language, whose square the result has in rows anyway.

Defined results: null text, language and source are ''; rows that share a
``doc_id`` are documents each; a language without kept terms has pairs of value
0 and no terms; a language with one source has no pairs; an empty table gives no
rows.  Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.llm.common import Workspace, batch_rows, chunks

KEPT_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
SHARD_BYTES, PAIRS = 16 << 20, 1 << 20

_TERM_BYTE = bytearray(256)
for _c in (*range(65, 91), *range(97, 123), *range(128, 256)):
    _TERM_BYTE[_c] = _c + 32 if _c < 91 else _c
_TERM_BYTE = bytes(_TERM_BYTE)

# -- pointers -----------------------------------------------------------------


def _keys(words: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next 8 bytes of terms that have ``left`` bytes left, 0 after their end."""
    k = words[start].astype(np.uint64)
    over = (8 * (8 - np.clip(left, 0, 8))).astype(np.uint64)
    k = np.where(left > 0, (k >> np.minimum(over, np.uint64(63))) << np.minimum(over, np.uint64(63)), np.uint64(0))
    return k


def sorted_runs(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pointers, sorted by term and then by place, and of each
    the number of its run of equal terms.  ``words``: the 8 bytes (big-endian)
    from every place of the buffer on."""
    n = len(start)
    key = _keys(words, start, size)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    depth = 8
    at = np.arange(n)                       # places of the sorted order whose keys were compared last
    while True:
        at = at[key & np.uint64(0xFF) != 0]                        # runs whose terms reach this depth
        run = np.cumsum(new[at]) - 1
        at = at[np.bincount(run)[run] > 1] if len(at) else at
        mine = order[at]
        if not (size[mine] > depth).any():
            break
        run = np.cumsum(new[at])
        key = _keys(words, start[mine] + depth, size[mine] - depth)
        sub = np.lexsort((key, run))
        order[at], key = mine[sub], key[sub]
        new[at[1:]] |= (key[1:] != key[:-1]) & (run[1:] == run[:-1])
        depth += 8
    run = np.cumsum(new) - 1
    both = np.sort((run << 32) | order)      # back to the order of places inside a run
    return both & 0xFFFFFFFF, both >> 32


def _strings(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at].tobytes()))


_COLUMNS = ["lang", "source", "term", "n", "docs"]
_ROW = "lang string, source string, term string, n long, docs long"


def _batch(lang: str, sources: list[str], which: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    names = pa.DictionaryArray.from_arrays(pa.array(which, pa.int32()), pa.array(sources, pa.string())).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), names, terms.cast(pa.string()), pa.array(n),
                                       pa.array(docs)], _COLUMNS)


def shard_counts(rows: list[tuple[str, str, bytes]]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences and documents of a shard (lang, source,
    text); a row with the empty term stands for each (lang, source)."""
    for lang, part in groupby(sorted(rows, key=lambda r: r[:2]), key=lambda r: r[0]):
        part = list(part)
        sources = sorted({r[1] for r in part})
        number = {s: k for k, s in enumerate(sources)}
        source_of = np.array([number[r[1]] for r in part])
        data = b"\0".join([r[2] for r in part]).translate(_TERM_BYTE) + bytes(16)
        b = np.frombuffer(data, np.uint8)
        words = np.ndarray(len(b) - 7, ">u8", data, strides=(1,))
        edge = np.diff(np.concatenate(([0], (b != 0).astype(np.int8))))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        doc_end = np.cumsum([len(r[2]) + 1 for r in part])
        doc = np.searchsorted(doc_end, start, "right")
        zero = np.zeros(len(sources), np.int64)
        yield _batch(lang, sources, np.arange(len(sources)), pa.array([""] * len(sources)), zero, zero)
        if not len(start):
            continue
        order, run = sorted_runs(words, start, end - start)
        doc = doc[order]
        source = source_of[doc]
        new_doc = np.ones(len(run), np.int64)
        new_doc[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
        new = np.flatnonzero(np.concatenate(([True], (run[1:] != run[:-1]) | (source[1:] != source[:-1]))))
        first = order[new]
        yield _batch(lang, sources, source[new], _strings(b, start[first], (end - start)[first]),
                     np.diff(np.append(new, len(run))), np.add.reduceat(new_doc, new))


def _shard_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = ((lang, source, t or b"") for lang, source, t in batch_rows(b, "lang", "source", "text"))
        for part in chunks(rows, 2, SHARD_BYTES):
            yield from shard_counts(part)


# -- divergence ---------------------------------------------------------------


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents); the empty term
    stands for every (lang, source) that occurs."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return (docs.select(text("lang"), text("source"), text("text")).mapInArrow(_shard_batches, _ROW)
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _p(n: str, total: str, kept: str) -> Column:
    return F.expr(f"1 + (cast({SCALE} AS decimal(10,0)) * cast({n} + 1 AS decimal(20,0))) div ({total} + {kept})")


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _f_array(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of terms that two sources of a language have: what their f's differ from
    the f's of absent terms, added up per pair of sources."""
    for b in batches:
        lists = b.column(b.schema.get_field_index("entries"))
        size = np.diff(lists.offsets.to_numpy())
        entry = lists.flatten()
        sid, p, p0 = (entry.field(k).to_numpy() for k in ("sid", "p", "p0"))
        langs = b.column(b.schema.get_field_index("lang")).dictionary_encode()
        lang = np.repeat(langs.indices.to_numpy(), size).astype(np.int64)
        n = np.repeat(size, size).astype(np.int64)                 # partners of each entry
        begin = np.repeat(np.cumsum(size) - size, size)
        ends = np.cumsum(n)
        at = 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
            m = n[at:to]
            u = np.repeat(np.arange(at, to), m)
            v = np.repeat(begin[at:to] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            apart = u != v
            u, v = u[apart], v[apart]
            at = to
            if not len(u):
                continue
            x = _f_array(p[u], p[v]) - _f_array(p[u], p0[v]) - _f_array(p0[u], p[v]) + _f_array(p0[u], p0[v])
            order = np.lexsort((sid[v], sid[u], lang[u]))
            key = np.column_stack([lang[u], sid[u], sid[v]])[order]
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            key = key[new]
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(key[:, 0])), pa.array(key[:, 1]), pa.array(key[:, 2]),
                 pa.array(np.add.reduceat(x[order], new))], ["lang", "g", "s", "x"])


def _pair_sums(cells: DataFrame, groups: DataFrame, ws: Workspace) -> DataFrame:
    """lang, g, s (source numbers) and value of every two sources of a language."""
    lists = cells.groupBy("lang", "term").agg(F.collect_list(F.struct("sid", "p", "p0")).alias("entries"))
    both = lists.where(F.size("entries") > 1).select("lang", "entries").mapInArrow(
        _pair_batches, "lang string, g long, s long, x long")
    hist = ws.write(cells.groupBy("lang", "sid", "p").agg(F.count("*").alias("n")), "histograms")
    other = groups.select("lang", F.col("sid").alias("o"), F.col("p0").alias("o0"))
    beside = hist.join(other, "lang").where("sid <> o")
    exact = lambda f: F.expr(f"cast({f} AS decimal(20,0)) * cast(n AS decimal(18,0))").cast("decimal(38,0)").alias("x")
    has = hist.groupBy("lang", "sid").agg(F.sum("n").alias("has"))
    mine = groups.join(has, ["lang", "sid"], "left").select("lang", "sid", "p0", "kept", F.coalesce("has", F.lit(0)).alias("has"))
    pairs = mine.join(mine.select("lang", F.col("sid").alias("o"), F.col("p0").alias("o0"), F.col("has").alias("o_has")), "lang")
    neither = (pairs.where("sid <> o").withColumn("n", F.expr("kept - has - o_has"))
               .select("lang", F.col("sid").alias("g"), F.col("o").alias("s"),
                       F.coalesce(exact(_f("p0", "o0")), F.lit(0)).alias("x")))
    every = (both.select("lang", "g", "s", F.col("x").cast("decimal(38,0)").alias("x"))
             .unionByName(beside.select("lang", F.col("sid").alias("g"), F.col("o").alias("s"), exact(_f("p", "o0"))))
             .unionByName(beside.select("lang", F.col("o").alias("g"), F.col("sid").alias("s"), exact(_f("o0", "p"))))
             .unionByName(neither))
    return every.groupBy("lang", "g", "s").agg(F.sum("x").cast("long").alias("value"))


def audit(docs: DataFrame, ws: Workspace) -> DataFrame:
    """lang, source, part, item, value and rank (see above)."""
    counts = ws.write(term_counts(docs), "counts")
    terms = (counts.where("term <> ''").groupBy("lang", "term")
             .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("entries"))
             .where(F.col("docs") >= KEPT_DOCS).select("lang", "term", "lang_n", F.explode("entries").alias("e"))
             .select("lang", "term", "lang_n", "e.source", "e.n"))
    terms = ws.write(terms, "terms")
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # a language's V and total, from one row per term (its first source)
    one = terms.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
    langs = one.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = (counts.where("term = ''").select("lang", "source")
              .withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
              .join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", "sid", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"), "lang_total"))
    groups = ws.write(groups.withColumn("p0", F.when(F.col("kept") > 0, F.expr(f"1 + {SCALE} div nullif(total + kept, 0)"))), "groups")
    cells = (terms.join(groups, ["lang", "source"])
             .select("lang", "source", "sid", "term", "p0", _p("n", "total", "kept").alias("p"), _p("lang_n", "lang_total", "kept").alias("q")))
    cells = ws.write(cells, "cells")

    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = (cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        F.expr(_f("p", "q")).alias("value"))
            .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= TOP))
    name = lambda k, c: groups.select("lang", F.col("sid").alias(k), F.col("source").alias(c))
    pair = (_pair_sums(cells, groups, ws).join(name("g", "source"), ["lang", "g"]).join(name("s", "item"), ["lang", "s"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
            .withColumn("rank", F.row_number().over(place)))
    return pair.unionByName(term)


#: DuckDB: every group meets every kept term of its language.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT row) >= {KEPT_DOCS}),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, count(w.row) AS n FROM g JOIN k ON g.lang = k.lang
      LEFT JOIN w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term GROUP BY ALL),
n AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (SELECT c.lang, c.source, c.term, c.n, 1 + {SCALE}::HUGEINT * (c.n + 1) // (n.total + v.v) AS p,
             1 + {SCALE}::HUGEINT * (k.n + 1) // (v.total + v.v) AS q
      FROM c JOIN n USING (lang, source) JOIN v USING (lang) JOIN k USING (lang, term)),
e AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(e.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM s WHERE part = 'pair' OR rank <= {TOP}
"""
