"""Ranks without a single-partition sort.

``ROW_NUMBER() OVER (ORDER BY x)`` gathers its rows in one task, and so does a
window per month.  Here rows (or distinct keys) are range-partitioned on
(group, order keys), so partition i holds a contiguous slice of the order; the
slice is sorted and written once, with running sums; and slices get their
offsets from the running sum of one row per (partition, group).

``rank`` and ``dense_rank`` number the *distinct keys*: the keys' row counts
are partial aggregates, their prefix sums give both ranks, and the rows join
their key.  A hot key is one row of the key table, and the join back is an
equi-join that the optimizer broadcasts (few keys) or splits (skew).

``ranks_together`` computes any number of ranks over the same rows with one
range exchange: the rows (or distinct keys) of all measures are slices of one
order, that begins with the measure.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Store = Callable[[DataFrame, str], DataFrame]
#: Up to this many keys (or slices of groups) are broadcast to the rows (some MB).
SMALL_KEYS = 100_000


def _eq_null_safe(left: str, right: str, cols: list[str]) -> Column:
    """Columns equal (NULL with NULL) between two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in cols])


def _running_sums(parts: list[str]):
    """For ``mapInArrow`` over sorted slices: ``__in``, the sum of ``__w`` over the
    earlier rows of the slice that have the same ``parts``."""
    def same(a: pa.Array, b: pa.Array) -> np.ndarray:
        out = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(a.type):
            out = pc.or_(out, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        return out.to_numpy(zero_copy_only=False)

    def run(batches):
        last, carry = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = np.zeros(n, dtype=bool)
            for i, c in enumerate(parts):
                col = batch.column(c)
                starts[0] |= last is not None and not same(last[i], col.slice(0, 1))[0]
                starts[1:] |= ~same(col.slice(0, n - 1), col.slice(1))
            last = [batch.column(c).slice(n - 1, 1) for c in parts]
            w = batch.column("__w").to_numpy(zero_copy_only=False)
            earlier = np.cumsum(w) - w
            first = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            inside = earlier - np.where(first >= 0, earlier[first], -carry)
            carry = int(inside[-1] + w[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside, pa.int64())], names=[*batch.schema.names, "__in"])
    return run


def _slices(df: DataFrame, order: list[Column], parts: list[str], weight: Column | None, store: Store,
            num_partitions: int | None) -> DataFrame:
    """The rows with the number of the range partition that holds them (sorted)
    and the running sum of the weight in it.  One exchange: the sums are taken
    where the rows were sorted.  Without a weight each row counts once, and its
    place in the partition says all."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in parts] + list(order)
    if weight is None:
        rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        return store(rows.withColumns({"__pid": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "ranked")
    rows = df.withColumn("__w", F.coalesce(weight.cast("bigint"), F.lit(0).cast("bigint")))
    rows = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__pid", F.spark_partition_id())
    schema = T.StructType([*rows.schema.fields, T.StructField("__in", T.LongType())])
    return store(rows.mapInArrow(_running_sums(parts), schema), "ranked")


def _before(sliced: DataFrame, parts: list[str], name: str) -> DataFrame:
    """``name``: sum of the weight over the rows of the group that come earlier."""
    earlier = Window.partitionBy(*(parts or [F.lit(0)])).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    placed = "__at" in sliced.columns
    # of rows that count once: how many, and the place of the group's first
    sums = (F.count(F.lit(1)), F.min("__at")) if placed else (F.sum("__w"), F.lit(0))
    totals = sliced.groupBy("__pid", *parts).agg(sums[0].alias("__n"), sums[1].alias("__first"))
    offsets = totals.select("__pid", *parts, (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__off"))
    # a row per slice and group that it holds: few, unless the groups are many
    few = totals.count() <= SMALL_KEYS
    t, o = sliced.alias("t"), (F.broadcast(offsets) if few else offsets).alias("o")
    cond = F.col("t.__pid") == F.col("o.__pid")
    if parts:
        cond = cond & _eq_null_safe("t", "o", parts)
    cols = [F.col(f"t.`{c}`") for c in sliced.columns if c not in ("__pid", "__w", "__in", "__at")]
    return t.join(o, cond).select(*cols, (F.col("t.__at" if placed else "t.__in") + F.col("o.__off")).alias(name))


def prefix_sums(df: DataFrame, order: list[Column], partition_by: list[str] | None, weight: Column | None, store: Store,
                name: str, num_partitions: int | None = None) -> DataFrame:
    """``name``: sum of ``weight`` over the rows of the group that come earlier
    (None: their number)."""
    parts = list(partition_by or [])
    return _before(_slices(df, order, parts, weight, store, num_partitions), parts, name)


def row_number(df: DataFrame, order: list[Column], partition_by: list[str] | None, store: Store,
               name: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition_by ORDER BY order)``; give
    ``order`` tie-breaks, or the numbers among equal rows are arbitrary."""
    parts = list(partition_by or [])
    out = prefix_sums(df, order, parts, None, store, "__before", num_partitions)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + 1).cast("int").alias(name))


def _with_key(df: DataFrame, key_cols: list[str], order: list[Column], partition_by: list[str] | None, store: Store,
              weight: Column, name: str) -> DataFrame:
    parts = list(partition_by or [])
    keys = df.groupBy(*parts, *key_cols).agg(F.count(F.lit(1)).alias("__rows"))
    b = prefix_sums(keys, order, parts, weight, store, "__before").alias("b")
    a = df.alias("a")
    return a.join(b, _eq_null_safe("a", "b", parts + key_cols)).select(
        *[F.col(f"a.`{c}`") for c in df.columns], (F.col("b.__before") + 1).cast("int").alias(name))


def rank(df: DataFrame, key_cols: list[str], order: list[Column], partition_by: list[str] | None, store: Store,
         name: str = "rank") -> DataFrame:
    """``RANK()``: 1 + the rows of earlier keys."""
    return _with_key(df, key_cols, order, partition_by, store, F.col("__rows"), name)


def dense_rank(df: DataFrame, key_cols: list[str], order: list[Column], partition_by: list[str] | None, store: Store,
               name: str = "dense_rank") -> DataFrame:
    """``DENSE_RANK()``: 1 + the earlier keys."""
    return _with_key(df, key_cols, order, partition_by, store, F.lit(1), name)


@dataclass(frozen=True)
class RankSpec:
    """A rank column: ``name``, the function (``row_number``, ``rank`` or
    ``dense_rank``) and the value it orders by.  NULL is the largest value:
    first when descending, last when ascending."""
    name: str
    function: str
    value: str
    descending: bool = False


_EXACT = "decimal(38,10)"
_KEY = ["__k0", "__k1", "__k2"]


def _sort_key(df: DataFrame, spec: RankSpec, exact: str) -> list[Column]:
    """Three ascending columns that order like the spec: NULL flag, the value
    as a double, and as an exact number (a measure uses the one of its type)."""
    v = F.col(f"`{spec.value}`")
    real = dict(df.dtypes)[spec.value] in ("double", "float")
    nulls = v.isNotNull() if spec.descending else v.isNull()
    d = v.cast("double") if real else F.lit(None).cast("double")
    x = F.lit(None).cast(exact) if real else v.cast(exact)
    return [nulls.cast("tinyint").alias("__k0"), (-d if spec.descending else d).alias("__k1"),
            (-x if spec.descending else x).cast(exact).alias("__k2")]


def _exact_type(df: DataFrame, specs: list[RankSpec]) -> str:
    types = {dict(df.dtypes)[s.value] for s in specs}
    return "bigint" if types <= {"double", "float", "tinyint", "smallint", "int", "bigint"} else _EXACT


def numbered_rows(df: DataFrame, partition_by: str, tie_break: list[Column], store: Store,
                  num_partitions: int | None = None) -> DataFrame:
    """``df``, written once in the order of the group and the tie-break, with
    ``__row``: numbers that grow in that order, so that they stand for the
    tie-break (NULL last) wherever rows are ordered."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{partition_by}`").asc_nulls_first(), *[c.asc_nulls_last() for c in tie_break]]
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return store(rows.withColumn("__row", F.monotonically_increasing_id()), "rank_rows")


def rank_columns(base: DataFrame, specs: list[RankSpec], partition_by: str, store: Store, num_partitions: int | None = None,
                 copies: str | None = None, each: DataFrame | None = None, folded: bool = False) -> DataFrame:
    """``base`` (from ``numbered_rows``) with a rank column per spec.

    ``copies``: the column that says how many equal rows a row stands for; a
    ROW_NUMBER is then that of the first of them.  ``each``: the rows one by one
    (``__row``, ``__copy`` from 0, the group and the values), where the values
    of the ROW_NUMBERs differ between copies; the result has a row per copy, or,
    ``folded``, still one for all (see ``unfolded``).

    Every ROW_NUMBER contributes one narrow entry per row, every RANK and
    DENSE_RANK one per distinct key; the entries of all specs are
    range-partitioned and written **once** by (spec, group, key, row), and prefix
    sums over the slices give all numbers (with ``each``, the entries of the rows
    need no weights, and those of the keys go apart).  The ROW_NUMBERs of a row and its
    copies are gathered by the row and go back by one join on it; ranks by one on
    the key, which is broadcast if the keys are few.
    """
    part, ids = F.col(f"`{partition_by}`"), ["__row", *(["__copy"] if each is not None else [])]
    numbered = [(i, s) for i, s in enumerate(specs) if s.function == "row_number"]
    keyed = [(i, s) for i, s in enumerate(specs) if s.function != "row_number"]
    many = F.col(f"`{copies}`").cast("bigint") if copies else F.lit(1).cast("bigint")
    key_type = _exact_type(base, [s for _, s in keyed])
    exact = _EXACT if _EXACT in (key_type, _exact_type(each if each is not None else base, [s for _, s in numbered])) else "bigint"

    def long(df: DataFrame, chosen, weight: Column | None) -> DataFrame:
        entry = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("__m"), *_sort_key(df, s, exact)) for i, s in chosen])
        more = [] if weight is None else [weight.alias("__weight")]
        return df.select(part.alias("__part"), *ids, *more, F.explode(entry).alias("e")).select(
            "e.__m", "__part", *[f"e.{k}" for k in _KEY], *ids, *(["__weight"] if more else []))

    order = [F.col(c).asc_nulls_first() for c in (*_KEY, *ids)]
    number = (F.col("__before") + 1).cast("int")

    def placed(entries: DataFrame, weight: Column | None) -> DataFrame:
        return prefix_sums(entries, order, ["__m", "__part"], weight, store, "__before", num_partitions)

    entries = []
    if numbered:
        entries.append(long(base, numbered, many) if each is None else long(each, numbered, None))
    if keyed:
        counted = [i for i, s in keyed if s.function == "rank"]
        nothing = [F.lit(None).cast("bigint" if c == "__row" else "int").alias(c) for c in ids]
        keys = long(base.withColumns({c: x for c, x in zip(ids, nothing)}), keyed, many)
        keys = keys.groupBy("__m", "__part", *_KEY).agg(F.sum("__weight").alias("__rows"))
        weight = F.when(F.col("__m").isin(counted), F.col("__rows")).otherwise(1).cast("bigint")
        entries.append(keys.select("__m", "__part", *_KEY, *nothing, weight.alias("__weight")))
    if each is None:
        both = placed(reduce(DataFrame.unionByName, entries), F.col("__weight"))
        rows, k = both.where(F.col("__row").isNotNull()), both.where(F.col("__row").isNull())
    else:
        # one by one, each row counts once; the keys, far fewer, are apart
        rows, k = placed(entries[0], None) if numbered else None, placed(entries[-1], F.col("__weight")) if keyed else None
    out = base
    if numbered:
        # copy, spec and number in one value that orders like them: narrow rows move
        copy = F.col("__copy").cast("bigint") if each is not None else F.lit(0).cast("bigint")
        one = F.shiftleft(copy * len(specs) + F.col("__m"), 32) + number
        found = (rows.select("__row", one.alias("x")).repartition("__row")
                 .groupBy("__row").agg(F.array_sort(F.collect_list("x")).alias("x"))
                 # every copy has a number of each spec
                 .select("__row", F.transform(F.sequence(F.lit(0), F.size("x") - 1, F.lit(len(numbered))), lambda at: F.struct(
                     F.floor(F.shiftright(F.get("x", at), 32) / len(specs)).cast("int").alias("__copy"),
                     *[F.get("x", at + j).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias(s.name)
                       for j, (_, s) in enumerate(numbered)])).alias("__numbers")))
        # never broadcast: the file of a written, sorted base is far smaller than its rows
        out = out.join(found.hint("merge"), "__row")
    if keyed:
        few = k.count() <= SMALL_KEYS
        for i, s in keyed:
            one = k.where(F.col("__m") == i).select(F.col("__part"), *_KEY, number.alias(s.name))
            a, b = out.withColumns({c: x for c, x in zip(_KEY, _sort_key(out, s, exact))}).alias("a"), (F.broadcast(one) if few else one).alias("b")
            on = F.col(f"a.`{partition_by}`").eqNullSafe(F.col("b.__part")) & _eq_null_safe("a", "b", _KEY)
            out = a.join(b, on).select(*[F.col(f"a.`{c}`") for c in out.columns], F.col(f"b.{s.name}"))
    return unfolded(out, each is not None) if numbered and not folded else out


def value_ranks(df: DataFrame, specs: list[RankSpec], partition_by: str, store: Store, copies: str | None = None) -> DataFrame:
    """``df`` with its RANKs and DENSE_RANKs, taken over the distinct combinations
    of the group and all their values, and joined once (broadcast, if they are few)."""
    at = list(dict.fromkeys([partition_by, *[s.value for s in specs]]))
    many = F.sum(F.col(f"`{copies}`").cast("bigint")) if copies else F.count(F.lit(1))
    found = store(df.groupBy(*[f"`{c}`" for c in at]).agg(many.alias("__copies")), "values")
    ranks = store(rank_columns(found, specs, partition_by, store, copies="__copies"), "value_ranks")
    few = ranks.count() <= SMALL_KEYS
    a, b = df.alias("a"), (F.broadcast(ranks) if few else ranks).alias("b")
    return a.join(b, _eq_null_safe("a", "b", at)).select(*[F.col(f"a.`{c}`") for c in df.columns], *[F.col(f"b.`{s.name}`") for s in specs])


def unfolded(df: DataFrame, copies: bool = True) -> DataFrame:
    """Folded ``rank_columns``, a row per copy."""
    names = [f.name for f in df.schema["__numbers"].dataType.elementType.fields if copies or f.name != "__copy"]
    one = df.withColumn("__numbers", F.explode("__numbers") if copies else F.get("__numbers", F.lit(0)))
    return one.select(*[F.col(f"`{c}`") for c in df.columns if c != "__numbers"], *[F.col(f"__numbers.{n}").alias(n) for n in names])


def ranks_together(df: DataFrame, specs: list[RankSpec], partition_by: str, tie_break: list[Column], store: Store,
                   num_partitions: int | None = None) -> DataFrame:
    """``df`` with one rank column per spec, each per ``partition_by``.

    The rows are written once in the order of the tie-break, with a number of
    their own (``numbered_rows``); ``rank_columns`` does the rest.  ROW_NUMBER
    ties are broken by ``tie_break`` and then by the row, the same way for every
    spec.
    """
    base = numbered_rows(df, partition_by, tie_break, store, num_partitions)
    ranked = rank_columns(base, specs, partition_by, store, num_partitions)
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], *[s.name for s in specs])
