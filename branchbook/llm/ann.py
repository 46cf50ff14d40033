"""Operator 3: approximate nearest neighbours by cross-polytope hashing.

Vectors are scaled to the unit sphere (one extra coordinate makes the largest
inner product the smallest angle), rotated by three rounds of random signs and
fast Hadamard transforms, and assigned to the nearest signed axis: one code per
table, ``TABLES`` tables.  A query probes its nearest ``PROBES`` axes in each
table (more where the table is small, so that about ``REACH`` rows are seen),
and all rows of those buckets are scored exactly.

* The lift keeps vectors apart only if their norms are alike.  So the index of
  each dimension is cut into ranges of norms within ``NORM_RATIO``, each lifted
  by its own largest norm, with its own tables and probes; ranges of at most
  ``BLOCK`` rows are searched whole.
* Queries that see fewer than ``K`` + 1 rows meet all rows, block by block.
* Of rows with the same vector only the ``K`` + 1 smallest ids can be among
  the nearest ``K`` (ties go to smaller ids), so only those are indexed; equal
  query vectors are searched once.
* The codes of a table are dealt to groups of about ``BLOCK`` rows.  A group
  with more rows or queries (a hot bucket) is cut into blocks, and rows and
  queries meet block by block; no task holds more than a block of each.
* Every block returns each query's best ``K`` + 1, and a window keeps the best.

Scores are inner products of the original vectors in double precision.
Defined results: a vector that is null, empty, zero or holds null or non-finite
components takes no part, as query or candidate, and neither does a row without
``vec_id``; vectors of each dimension are a table of their own; rows that
repeat a ``vec_id`` with one vector count once, with several vectors the id may
come with its best; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.llm.common import Workspace

K, QUERY_EVERY = 20, 20
TABLES, PROBES, REACH = 16, 8, 64
BLOCK, QUERY_BLOCK = 4096, 1024
NORM_RATIO = 1.25
SEED = 11


def axes(dim: int) -> int:
    """Rotated dimensions: the next power of two above ``dim``."""
    return 1 << int(dim).bit_length()


def probes(rows: int, dim: int) -> int:
    """Probes per table: ``PROBES``, or as many as see ``REACH`` rows."""
    buckets = 2 * axes(dim)
    return min(buckets, max(PROBES, -(-REACH * buckets // max(rows, 1))))


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    """Pseudo-random rotation of the rows of ``x`` (axes(dim) columns)."""
    n = x.shape[1]
    rng = np.random.Generator(np.random.PCG64([SEED, table]))
    for _ in range(3):
        x = x * rng.choice((-1.0, 1.0), n)
        h = 1
        while h < n:
            x = x.reshape(len(x), -1, 2, h)
            x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(-1, n)
            h *= 2
    return x


def codes(x: np.ndarray, table: int, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of each row, nearest first."""
    y = rotated(x, table)
    both = np.concatenate((y, -y), axis=1)
    if count == 1:
        return np.argmax(both, axis=1)[:, None]
    return np.argsort(-both, axis=1, kind="stable")[:, :count]


def lifted(x: np.ndarray, largest: float | None) -> np.ndarray:
    """Unit vectors with axes(dim) columns.  Rows of the index (``largest``
    norm given) get the coordinate that completes their norm; queries zero."""
    out = np.zeros((len(x), axes(x.shape[1])))
    top = np.abs(x).max(axis=1)
    norm = top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))
    if largest is None:
        out[:, :x.shape[1]] = x / norm[:, None]
    else:
        out[:, :x.shape[1]] = x / largest
        out[:, x.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (norm / largest) ** 2))
    return out


def _norm(v: str) -> Column:
    """Euclidean norm, scaled by the largest component (no overflow of squares)."""
    top = F.array_max(F.transform(v, F.abs))
    return top * F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / top) * (x / top)))


def valid_vectors(emb: DataFrame) -> DataFrame:
    """(vec_id, v, d): the vectors that take part and their dimension."""
    v = F.col("embedding").cast("array<double>")
    ok = (F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists(v, lambda x: x != 0))
    return emb.where(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("d"))


@dataclass(frozen=True)
class Range:
    """A part of the index: vectors of one dimension whose norms lie within
    ``NORM_RATIO``, or few vectors that are searched whole."""
    number: int
    largest: float
    whole: bool
    count: int
    groups: int


def ranges(bands: Iterable[tuple[int, int, int, float]]) -> dict[int, dict[int, Range]]:
    """The range of every band, by dimension, from the bands' (dimension, band,
    rows, largest norm).  Neighbouring bands are searched whole together while
    they hold at most ``BLOCK`` rows."""
    out: dict[int, dict[int, Range]] = {}
    number = 0
    for dim, own in groupby(sorted(bands), key=lambda x: x[0]):
        parts: list[list[tuple]] = []
        for x in own:
            if parts and sum(y[2] for y in parts[-1]) + x[2] <= BLOCK:
                parts[-1].append(x)
            else:
                parts.append([x])
        for part in parts:
            n = sum(x[2] for x in part)
            whole = n <= BLOCK
            r = Range(number, max(x[3] for x in part), whole, probes(n, dim),
                      1 if whole else min(2 * axes(dim), -(-n // BLOCK)))
            out.setdefault(dim, {}).update({x[1]: r for x in part})
            number += 1
    return out


_ROW = "id long, d int, r int, t int, g int, codes binary, vec binary"
_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
_ONE = np.zeros(1, np.int32).tobytes()


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[bytes]]]:
    """Of batches of (id, v, d, band): the vectors of each dimension and band as
    (dimension, band, ids, matrix, bytes of each vector)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            key = np.column_stack([part.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)])
            for dim, band in np.unique(key, axis=0).tolist():
                own = part.take(pa.array(np.flatnonzero((key == (dim, band)).all(axis=1))))
                x = own.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                raw = x.tobytes()
                yield dim, band, own.column(0).to_numpy(), x, [raw[i:i + 8 * dim] for i in range(0, len(raw), 8 * dim)]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _TYPES)],
                                      ["id", "d", "r", "t", "g", "codes", "vec"])


def _placed(ids: np.ndarray, vec: list[bytes], dim: int, r: Range, t: int, own: np.ndarray) -> pa.RecordBatch:
    """A row for each vector and group that its codes in table ``t`` lie in."""
    rows = []
    for i, code in enumerate(own):
        group = code % r.groups
        rows += [(int(ids[i]), dim, r.number, t, int(g), code[group == g].astype(np.int32).tobytes(), vec[i])
                 for g in np.unique(group)]
    return _record(rows)


def _whole(ids: np.ndarray, vec: list[bytes], dim: int, number: int) -> pa.RecordBatch:
    """The vectors under one code."""
    return _record([(int(i), dim, number, 0, 0, _ONE, v) for i, v in zip(ids, vec)])


def _indexed(plan: dict[int, dict[int, Range]]):
    """(id, v, d, band) of the index to rows of ``_ROW``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, band, ids, x, vec in _matrices(batches):
            r = plan[dim][band]
            if r.whole:
                yield _whole(ids, vec, dim, r.number)
                continue
            unit = lifted(x, r.largest)
            for t in range(TABLES):
                yield _placed(ids, vec, dim, r, t, codes(unit, t, 1))
    return run


def _asked(plan: dict[int, dict[int, Range]]):
    """(id, v, d, any) of the queries to rows of ``_ROW``, for all ranges of their dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, _, ids, x, vec in _matrices(batches):
            parts = sorted(set(plan[dim].values()), key=lambda r: r.number)
            for r in parts:
                if r.whole:
                    yield _whole(ids, vec, dim, r.number)
            hashed = [r for r in parts if not r.whole]
            if hashed:
                unit = lifted(x, None)
                for t in range(TABLES):
                    near = codes(unit, t, max(r.count for r in hashed))
                    for r in hashed:
                        yield _placed(ids, vec, dim, r, t, near[:, :r.count])
    return run


def _unplaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v, d, any) to rows of ``_ROW``, one range for each dimension."""
    for dim, _, ids, _, vec in _matrices(batches):
        yield _whole(ids, vec, dim, dim)


def _best(query: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and exact scores of its best K + 1 rows.  The
    fast product selects with a margin; the kept ones are scored row by row,
    so equal vectors get equal scores."""
    fast = query @ rows.T
    margin = 1e-9 * (1 + np.abs(fast).max(initial=0.0))
    out = []
    for q, f in zip(query, fast):
        at = np.arange(len(ids)) if len(ids) <= K + 1 else np.flatnonzero(
            f >= np.partition(f, len(f) - K - 1)[len(f) - K - 1] - margin)
        score = (rows[at] * q).sum(axis=1)
        at, score = (z[np.lexsort((ids[at], -score))[:K + 1]] for z in (at, score))
        out.append((ids[at], score))
    return out


def _searched(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    found = {"query_id": [], "d": [], "vec_id": [], "score": []}
    if rows.empty or queries.empty:
        return pd.DataFrame(found)
    dim = len(rows["vec"].iloc[0]) // 8
    x = np.frombuffer(b"".join(rows["vec"]), np.float64).reshape(-1, dim)
    code = np.frombuffer(b"".join(rows["codes"]), np.int32)
    ids = rows["id"].to_numpy()
    q = np.frombuffer(b"".join(queries["vec"]), np.float64).reshape(-1, dim)
    asked = [np.frombuffer(c, np.int32) for c in queries["codes"]]
    who, want = np.repeat(np.arange(len(q)), [len(a) for a in asked]), np.concatenate(asked)
    qid = queries["id"].to_numpy()
    for c in np.unique(code):
        mine, near = who[want == c], np.flatnonzero(code == c)
        if len(mine):
            for k, (i, s) in zip(mine, _best(q[mine], x[near], ids[near])):
                found["query_id"].append(np.full(len(i), qid[k]))
                found["d"].append(np.full(len(i), dim))
                found["vec_id"].append(i)
                found["score"].append(s)
    return pd.DataFrame({k: np.concatenate(v) if v else [] for k, v in found.items()})


def _dealt(rows: DataFrame, sizes: DataFrame, own: str, other: str) -> DataFrame:
    """Rows with their block of ``own`` and a copy for each block of ``other``."""
    blocks = rows.join(F.broadcast(sizes), ["r", "t", "g"])
    return (blocks.withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"n_{own}")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), (F.col(f"n_{other}") - 1).cast("int"))))
            .drop(f"n_{own}", f"n_{other}"))


def _met(index: DataFrame, query: DataFrame) -> DataFrame:
    """query_id, d, vec_id and score of the best rows of every block."""
    # one row for each (range, table, group), which holds about a block of rows or more than BLOCK / (2 * axes) of them
    size = lambda d, name, block: d.groupBy("r", "t", "g").agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))
    sizes = size(index, "n_block", BLOCK).join(size(query, "n_part", QUERY_BLOCK), ["r", "t", "g"])
    key = ["r", "t", "g", "block", "part"]
    left, right = _dealt(index, sizes, "block", "part"), _dealt(query, sizes, "part", "block")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _searched, "query_id long, d int, vec_id long, score double")


def _top(found: DataFrame) -> DataFrame:
    found = found.groupBy("query_id", "d", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "d").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= K + 1).drop("place")


def nearest(emb: DataFrame, ws: Workspace) -> DataFrame:
    """query_id, rank, vec_id and score: the K nearest found of every query."""
    rows = valid_vectors(emb).dropDuplicates(["vec_id", "v"])
    few = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("copy", F.row_number().over(few)).where(F.col("copy") <= K + 1)
    vectors = ws.write(kept.select("vec_id", "v", "d", _norm("v").alias("norm")), "vectors")
    # one number for each dimension, one row for each band (at most some thousand, as doubles end) of it
    largest = {r["d"]: r["s"] for r in vectors.groupBy("d").agg(F.max("norm").alias("s")).collect()}
    if not largest:
        return rows.selectExpr("vec_id query_id", "0 rank", "vec_id", "0D score").limit(0)
    top = F.element_at(F.create_map(*(F.lit(x) for p in largest.items() for x in p)), F.col("d"))
    banded = vectors.withColumn("band", F.floor(F.log(top / F.col("norm")) / F.lit(float(np.log(NORM_RATIO)))).cast("int"))
    plan = ranges(tuple(r) for r in banded.groupBy("d", "band").agg(F.count("*"), F.max("norm")).collect())
    asked = rows.where(F.col("vec_id") % QUERY_EVERY == 0)
    lead = asked.groupBy("v", "d").agg(F.min("vec_id").alias("lead_id"))
    index = ws.write(banded.select("vec_id", "v", "d", "band").mapInArrow(_indexed(plan), _ROW), "index")
    queries = lead.select("lead_id", "v", "d", F.lit(0).alias("band"))
    query = ws.write(queries.mapInArrow(_asked(plan), _ROW), "queries")
    best = ws.write(_top(_met(index, query)), "best")

    # queries that saw fewer rows than they need meet all rows of their dimension
    seen = best.groupBy(F.col("query_id").alias("lead_id"), "d").agg(F.count("*").alias("n_seen"))
    there = vectors.groupBy("d").agg(F.least(F.count("*"), F.lit(K + 1)).alias("n_there"))
    short = (queries.join(seen, ["lead_id", "d"], "left").join(F.broadcast(there), "d")
             .where(F.coalesce("n_seen", F.lit(0)) < F.col("n_there")))
    short = ws.write(short.select("lead_id", "v", "d", "band").mapInArrow(_unplaced, _ROW), "short")
    if not short.isEmpty():
        every = vectors.select("vec_id", "v", "d", F.lit(0).alias("band")).mapInArrow(_unplaced, _ROW)
        best = _top(best.unionByName(_met(every, short)))

    members = asked.join(lead, ["v", "d"]).select(F.col("vec_id").alias("own_id"), F.col("lead_id").alias("query_id"), "d")
    each = (members.join(best, ["query_id", "d"]).where(F.col("own_id") != F.col("vec_id"))
            .groupBy("own_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("own_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
            .select(F.col("own_id").alias("query_id"), "rank", "vec_id", "score"))
