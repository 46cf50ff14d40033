"""Operator 11: how filters interact, by recursive enumeration of their orders.

Five filters judge every document; a bit of its *mask* says which of them it
fails.  All that an audit of any filter order needs is how many documents of a
part have which mask, so the table is read once and brought down to *cells*:
documents, good and toxic ones per (part, mask), 32 cells a part at most.

A recursive common table expression extends filter prefixes by an unused letter
until all are used.  A level's rows carry the bits applied so far; they meet the
cells of their part, and emit the metrics of the step just taken.  The letters
that may follow a set of bits are a table of its own, so each level is made of
equi-joins.  1 + 5 + 20 + 60 + 120 + 120 prefixes a part are enumerated, however
many documents there are; an order's steps are its prefixes.

* A  under ``MIN_WORDS`` words
* B  100 * distinct words < ``DISTINCT_PERCENT`` * words
* C  100 * [A-Z] characters > ``UPPER_PERCENT`` * code points
* D  holds any of ``MARKS``
* E  text identical to that of a smaller doc_id, anywhere in the table

A text's first document is found without gathering its copies: the least doc_id
of a digest (SHA-256) is a map-side minimum, and it meets the rows by (digest,
doc_id), a key that a hot text does not concentrate.

Defined results: null text is the empty text (of null and empty texts all but
the smallest id fail E); a null source is the part ''; rows that share a doc_id
are documents each, and none of them is the other's earlier copy; a null doc_id
never fails E, makes nobody fail it and has no label; of several labels of a
doc_id the largest counts; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import Workspace, batch_rows

LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, MARKS = 50, 65, 5, b"#$%&*|"
DUPLICATE = 1 << LETTERS.index("E")

_UPPER = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))        # bytes inside a code point


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    words = text.split()                 # ASCII white space, as the contract has it
    points = len(text.translate(None, _INNER))
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
             100 * upper > UPPER_PERCENT * points, len(text.translate(None, MARKS)) < len(text))
    return sum(1 << k for k, f in enumerate(fails) if f)


def _judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, parts, masks, digests = [], [], [], []
        for doc_id, part, text in batch_rows(b, "doc_id", "part", "text"):
            text = text or b""
            ids.append(doc_id)
            parts.append(part)
            masks.append(text_mask(text))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(parts, pa.string()), pa.array(masks, pa.int32()),
             pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (A to D) and digest of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _judge_batches, "doc_id long, part string, mask int, digest binary")


def mask_cells(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """part, mask (A to E), n, good and toxic documents."""
    rows = ws.write(judged(docs), "judged")
    # repeated rows become counts before anything meets by doc_id
    rows = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    named, nameless = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")
    first = (named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True)))
    late = F.when(F.col("is_first"), 0).otherwise(DUPLICATE)
    flag = lambda c: F.max((F.col(c) == 1).cast("int")).alias(c)
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("good"), "toxic")
             .groupBy("doc_id").agg(flag("good"), flag("toxic")))
    named = (named.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
             .select("part", F.col("mask").bitwiseOR(late).alias("mask"), "n",
                     F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    every = named.unionByName(nameless.select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    return every.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def _next_letters() -> str:
    """VALUES rows (applied bits, a letter not among them, its bit)."""
    sets = [c for n in range(len(LETTERS)) for c in combinations(LETTERS, n)]
    return ", ".join(f"({sum(map(_bit, s))}, '{x}', {_bit(x)})" for s in sets for x in LETTERS if x not in s)


def _over(field: str, test: str) -> str:
    """Sum of a field over the part's cells that pass a test of the mask ``x.mask``."""
    return f"aggregate(filter(c.cells, x -> {test}), 0L, (s, x) -> s + x.{field})"


_HERE = "(x.mask & r.applied) = 0 AND (x.mask & f.bit) <> 0"
RECURSION = f"""
WITH RECURSIVE
following(applied, letter, bit) AS (VALUES {_next_letters()}),
parts AS (SELECT part, collect_list(struct(mask, n, good, toxic)) AS cells FROM {{cells}} GROUP BY part),
steps(part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM parts
  UNION ALL
  SELECT r.part, concat(r.prefix, f.letter), r.applied | f.bit, r.step + 1,
         {_over("n", "(x.mask & (r.applied | f.bit)) = 0")},
         {_over("n", _HERE)},
         {_over("n", "(x.mask & r.applied) <> 0 AND (x.mask & f.bit) <> 0")},
         {_over("n", "x.mask = f.bit")},
         {_over("good", _HERE)},
         {_over("toxic", _HERE)}
  FROM steps r JOIN following f ON r.applied = f.applied JOIN parts c ON r.part = c.part
)
SELECT * FROM steps WHERE step > 0 LIMIT ALL
"""


def prefix_steps(cells: DataFrame) -> DataFrame:
    """The metrics of the last step of every filter prefix, for every part."""
    return cells.sparkSession.sql(RECURSION, cells=cells)


def audit(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """One row per part, filter order and step.  ``shapley``: what the step's
    filter removes, summed over all orders (a window of 120 rows)."""
    cells = ws.write(mask_cells(docs, labels, ws), "cells")
    steps = ws.write(prefix_steps(cells), "steps")
    orders = steps.where(F.col("step") == len(LETTERS)).select("part", F.col("prefix").alias("filter_order"))
    each = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))).withColumn(
        "prefix", F.expr("left(filter_order, step)"))
    return (each.join(steps.drop("step", "applied"), ["part", "prefix"])
            .withColumn("shapley", F.expr("sum(removed) OVER (PARTITION BY part, right(prefix, 1))"))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


def _sql() -> str:
    """DuckDB: the mask bit by bit, the orders by a five-fold self-join of the letters."""
    regex = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"
    pick = " || ".join(f"{x}.l" for x in "vwxyz")
    differ = " AND ".join(f"{a}.l <> {b}.l" for a, b in combinations("vwxyz", 2))
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, {regex} AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, len(words) < {MIN_WORDS} AS a,
             100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(text) AS c,
             regexp_matches(text, '[{MARKS.decode()}]') AS d, coalesce(doc_id > first, false) AS e,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails,
             count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
t AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (SELECT {pick} AS filter_order FROM t v, t w, t x, t y, t z WHERE {differ}),
s AS (SELECT filter_order, k::INT AS step, filter_order[k] AS f, filter_order[1:k - 1] AS before
      FROM o, unnest([1, 2, 3, 4, 5]) AS u(k)),
j AS (SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS fails_it, fails = f AS only_it,
             length(translate(fails, before, '')) < length(fails) AS gone FROM g, s),
r AS (SELECT part, filter_order, step, f,
       coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (NOT gone AND fails_it), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (gone AND fails_it), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (only_it), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (NOT gone AND fails_it), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (NOT gone AND fails_it), 0)::BIGINT AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""


SQL = _sql()
