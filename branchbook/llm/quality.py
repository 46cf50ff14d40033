"""Operator 4: quality rules with adaptive thresholds.

Each document gets five measures; per (language, source) a mergeable quantile
sketch of each measure gives robust fences that replace fixed cutoffs, and a
join of the documents with their group's fences decides.

The sketch is a histogram over buckets that keep the eight leading bits of an
integer (relative error below 1/128).  Sketches merge by adding counts, so the
result does not depend on row order, partitioning or retries.  A group with
fewer than ``MIN_GROUP`` documents uses its language's merged sketch, and a
language with fewer the merged sketch of all.

Defined results: null text counts as empty (0 words: base_failed); null
language or source is a group of its own; repeated ``doc_id`` rows are judged
each on its own; other columns of the input are ignored by ``measures`` and
kept by ``filter_documents``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import ROW, batch_rows, chunks, encode, keyed, Words, Workspace

BASE_MIN_WORDS, BASE_REPEAT_PERCENT = 50, 50
MIN_GROUP = 100
#: Fences lie ``SPREADS`` half-spreads beyond the quartile; the half-spread of a
#: measure (quartile to median) counts as ``floor`` at least.
SPREADS = 6
#: measure: (numerator, denominator, scale, half-spread floor, has a lower fence)
MEASURES = {
    "word_length": ("word_chars", "n_words", 100, 50, True),
    "symbols": ("n_symbols", "word_chars", 10000, 50, False),
    "dup_lines": ("n_dup_lines", "n_lines", 10000, 500, False),
    "repeats": ("n_repeat_words", "n_words", 10000, 500, False),
}
#: Copies of each group's fences, so that a hot group's join is spread out.
SALTS = 32

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False                       # UTF-8 continuation bytes
_LEAD[[9, 10, 11, 12, 13, 32]] = False


def _line_counts(text: bytes) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier line)."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _per_doc(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end] - total[start]


def count_measures(docs: list[bytes]) -> np.ndarray:
    """Rows of ``_COUNTS`` for a list of documents."""
    w = Words(docs)
    at, h3 = w.windows(3)
    covered = np.zeros(len(w.h) + 2, bool)
    if len(at):
        key = h3 + w.doc_of_word()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[n[inv] > 1]
        for k in range(3):
            covered[twice + k] = True
    lines = np.array([_line_counts(d) for d in docs], np.int64).reshape(len(docs), 2)
    return np.column_stack([
        w.n, _per_doc(_LEAD[w.bytes], w.doc_start, w.doc_end), _per_doc(_SYMBOL[w.bytes], w.doc_start, w.doc_end),
        lines[:, 1], _per_doc(covered, w.first, w.last), lines[:, 0]])


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = ((i, lang, src, encode(None) if t is None else t)
                for i, lang, src, t in batch_rows(b, "doc_id", "lang", "source", "text"))
        for part in chunks(rows, 3):
            ids, langs, srcs, texts = zip(*part)
            counts = count_measures(list(texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(srcs, pa.string()),
                 *(pa.array(counts[:, k]) for k in range(len(_COUNTS)))],
                ["doc_id", "lang", "source", *_COUNTS])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document."""
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_measure_batches, schema)
            .withColumn("base_failed", (F.col("n_words") < BASE_MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))))


def _value(m: str) -> Column:
    num, den, scale, _, _ = MEASURES[m]
    return F.expr(f"{scale} * {num} div greatest({den}, 1)")


def _bucket(v: str) -> Column:
    """The value with all but its eight leading bits cleared."""
    return F.expr(f"CASE WHEN {v} < 256 THEN {v} ELSE "
                  f"shiftleft(shiftright({v}, length(bin({v})) - 8), length(bin({v})) - 8) END")


def sketch(measured: DataFrame) -> DataFrame:
    """Bucket counts per (lang, source, measure) over documents that pass the
    base rules: one pass with map-side partial sums."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), _value(m).alias("v")) for m in MEASURES)))
    return (measured.where(~F.col("base_failed")).select("lang", "source", pairs.alias("p"))
            .select("lang", "source", "p.measure", _bucket("p.v").alias("bucket"))
            .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))


def fences(sk: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: documents and the low/high fence of each measure,
    from the sketches merged over everything but ``keys``."""
    merged = sk.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    names = ", ".join([*keys, "measure"])
    cum = merged.select("*", F.expr(f"sum(n) OVER (PARTITION BY {names} ORDER BY bucket)").alias("c"),
                        F.expr(f"sum(n) OVER (PARTITION BY {names})").alias("total"))
    quart = cum.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        *(F.min(F.when(100 * F.col("c") >= q * F.col("total"), F.col("bucket"))).alias(f"q{q}") for q in (25, 50, 75)))
    cols = [F.max("total").alias("total")]
    for m, (_, _, _, floor, lower) in MEASURES.items():
        mine = F.col("measure") == m
        high = F.col("q75") + SPREADS * F.greatest(F.col("q75") - F.col("q50"), F.lit(floor))
        cols.append(F.max(F.when(mine, high)).alias(f"{m}_high"))
        if lower:
            low = F.col("q25") - SPREADS * F.greatest(F.col("q50") - F.col("q25"), F.lit(floor))
            cols.append(F.max(F.when(mine, low)).alias(f"{m}_low"))
    return quart.groupBy(*keys).agg(*cols)


def _fence_columns() -> list[str]:
    return [f"{m}_{s}" for m, x in MEASURES.items() for s in (("high", "low") if x[4] else ("high",))]


def group_fences(sk: DataFrame) -> DataFrame:
    """The fences of every (lang, source): its own, its language's or all."""
    own, by_lang = fences(sk, ["lang", "source"]), fences(sk, ["lang"])
    cols = _fence_columns()
    # one row, taken in as a scalar subquery
    everything = fences(sk.withColumn("everything", F.lit(1)), ["everything"]).select(F.struct(*cols)).scalar()
    o, g = own.alias("o"), by_lang.alias("g")
    joined = o.join(g, F.col("o.lang").eqNullSafe(F.col("g.lang"))).withColumn("a", everything)
    pick = [F.when(F.col("o.total") >= MIN_GROUP, F.col(f"o.{c}"))
            .when(F.col("g.total") >= MIN_GROUP, F.col(f"g.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in cols]
    return joined.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), *pick)


def judge(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document.  The counts are
    written once (narrow rows); sketch, fences and verdict read them."""
    measured = ws.write(measures(docs), "measures")
    limits = (group_fences(sketch(measured)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
              .withColumnsRenamed({"lang": "f_lang", "source": "f_source"}))
    m = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = m.join(limits, (m.salt == limits.salt) & m.lang.eqNullSafe(limits.f_lang)
                    & m.source.eqNullSafe(limits.f_source), "left")
    inside = F.lit(True)
    for name, spec in MEASURES.items():
        inside = inside & (_value(name) <= F.col(f"{name}_high"))
        if spec[4]:
            inside = inside & (_value(name) >= F.col(f"{name}_low"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined.select("doc_id", *_COUNTS[:-1], "base_failed", kept.alias("kept"))


def filter_documents(docs: DataFrame, ws: Workspace) -> DataFrame:
    """The documents that the rules keep, with all columns of the input.  Each
    row has its own verdict, whatever its doc_id."""
    rows = keyed(docs, ws)
    verdict = judge(rows.select(F.col(ROW).alias("doc_id"), "lang", "source", "text"), ws)
    good = verdict.where(F.col("kept")).select(F.col("doc_id").alias(ROW))
    return rows.join(good, ROW, "left_semi").drop(ROW)
