"""Data checks: declared constraints as queries, column profiling, reconciliation.

The original declares PRIMARY KEY / FOREIGN KEY / NOT NULL and enforces them
inside its storage engine; here they are Spark aggregates and anti-joins that
report violation counts, so a load can be checked before it is published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _one(check: str, table: str, n) -> DataFrame:
    return n.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                    F.col("n").cast("bigint").alias("n_violations"))


def pk_violations(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first for each duplicated key, plus NULL keys."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
           .agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("n")))
    nulls = df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).agg(F.count(F.lit(1)).alias("n"))
    return _one(f"pk:{','.join(keys)}", table, dup).unionByName(_one(f"pk_not_null:{','.join(keys)}", table, nulls))


def fk_violations(df: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-NULL child values with no parent row (a left anti-join; the
    parent's measured size decides how)."""
    p = parent.select(F.col(parent_col).alias(col)).distinct()
    miss = df.where(F.col(col).isNotNull()).join(p, col, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return _one(f"fk:{col}", table, miss)


def not_null_violations(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """One row per column: its NULL count — all columns in one aggregate."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(f"not_null:{c}").alias("check_name"), F.lit(table).alias("table_name"),
                 F.col(c).cast("bigint").alias("n_violations")) for c in cols])))


def duplicate_email_violations(fact_kpi_asm: DataFrame) -> DataFrame:
    """Emails under more than one (area_name, sale_name): the ASM join key is
    the email alone, so these fan out (rows beyond the first identity)."""
    ids = fact_kpi_asm.where(F.col("email").isNotNull()).select("email", "area_name", "sale_name").distinct()
    n = (ids.groupBy("email").agg(F.count(F.lit(1)).alias("c"))
         .agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("n")))
    return _one("unique:email", "fact_kpi_asm", n)


def head_area_twice(ratios: DataFrame, head_area: str) -> DataFrame:
    """(month, method) pairs where the head-office area has more than one ratio
    row (its zero row plus a data row): its head total is reported twice."""
    n = (ratios.where(F.col("area_code") == head_area).groupBy("rate_month", "method_code")
         .agg(F.count(F.lit(1)).alias("c"))
         .agg(F.count(F.when(F.col("c") > 1, 1)).alias("n")))
    return _one("head_area_once", "rate_allocation_area_month", n)


def check_constraints(*, regions: DataFrame, areas: DataFrame, provinces: DataFrame, tree: DataFrame,
                      ratios: DataFrame, fact_kpi_asm: DataFrame, finance: DataFrame, asm: DataFrame,
                      error_log: DataFrame, head_area: str = "A") -> DataFrame:
    """All declared constraints.  ``ratios`` are the unguarded ones (built
    without ``strict``), so that a violation shows here."""
    parts = [
        pk_violations(regions, "dim_region_table", ["region_id"]),
        pk_violations(areas, "dim_area_table", ["area_code"]),
        pk_violations(provinces, "dim_province_table", ["province_id"]),
        pk_violations(tree, "dim_pnl_structure", ["pnl_id"]),
        fk_violations(areas, "dim_area_table", "region_id", regions, "region_id"),
        fk_violations(provinces, "dim_province_table", "area_code", areas, "area_code"),
        fk_violations(ratios, "rate_allocation_area_month", "area_code", areas, "area_code"),
        not_null_violations(ratios, "rate_allocation_area_month",
                            ["rate_month", "method_code", "method_name", "area_code", "ratio"]),
        not_null_violations(regions, "dim_region_table", ["region_name"]),
        not_null_violations(tree, "dim_pnl_structure", ["pnl_code", "pnl_name", "pnl_parent_id", "pnl_level", "sortorder"]),
        not_null_violations(finance, "report_finance_table", ["month_key", "id"]),
        not_null_violations(asm, "report_asm_final_table", ["month_key"]),
        pk_violations(error_log, "error_log", ["log_id"]),
        not_null_violations(error_log, "error_log", ["proc_name", "run_month"]),
        not_null_violations(areas, "dim_area_table", ["area_name", "region_id"]),
        not_null_violations(provinces, "dim_province_table", ["province_name", "area_code"]),
        duplicate_email_violations(fact_kpi_asm),
        head_area_twice(ratios, head_area),
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_nulls(df: DataFrame, table: str) -> DataFrame:
    """Per column: row count and NULL count, in one aggregate over the table."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c)
                                                       for c in cols])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col("__rows").cast("bigint").alias("n_rows"), F.col(f"`{c}`").cast("bigint").alias("n_null"))
        for c in cols])))


def profile_outliers(df: DataFrame, table: str, columns: list[str], store, k: float = 1.5) -> DataFrame:
    """Tukey fences per numeric column from exact quartiles (the smallest value
    with at least a quarter, three quarters of the non-NULL rows at or below
    it), and the rows outside [Q1 - k*IQR, Q3 + k*IQR].

    One scan: rows become counts per (column, value), whose prefix sums over
    range partitions give the positions of the quartiles; the fences (a row
    per column) meet the same counts again.
    """
    from branchbook.operators.ranking import prefix_sums
    pairs = F.stack(F.lit(len(columns)), *[x for c in columns for x in (F.lit(c), F.col(f"`{c}`").cast("double"))])
    counts = (df.select(pairs.alias("column_name", "v")).where(F.col("v").isNotNull())
              .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n")))
    placed = store(prefix_sums(counts, [F.col("v").asc()], ["column_name"], F.col("n"), store, "before"), "values")
    total = placed.groupBy("column_name").agg(F.sum("n").alias("total"))
    reached = placed.join(total, "column_name").select(
        "column_name", "v", *((100 * (F.col("before") + F.col("n")) >= q * F.col("total")).alias(f"q{q}") for q in (25, 75)))
    fences = (reached.groupBy("column_name")
              .agg(*(F.min(F.when(F.col(f"q{q}"), F.col("v"))).alias(a) for q, a in ((25, "q1"), (75, "q3"))))
              .withColumns({"lower_fence": F.col("q1") - k * (F.col("q3") - F.col("q1")),
                            "upper_fence": F.col("q3") + k * (F.col("q3") - F.col("q1"))}))
    outside = (F.col("v") < F.col("lower_fence")) | (F.col("v") > F.col("upper_fence"))
    return (placed.join(fences, "column_name")
            .groupBy("column_name", "q1", "q3", "lower_fence", "upper_fence")
            .agg(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).cast("bigint").alias("n_outliers"))
            .select(F.lit(table).alias("table_name"), "column_name", "q1", "q3", "lower_fence", "upper_fence", "n_outliers"))


def reconcile(raw: DataFrame, staged: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Compare a raw table with its staged copy per key: row counts and sums
    on both sides and a status (match / missing / mismatch).  Both sides are
    aggregated before the full outer join, so only key-level rows move."""
    dec = T.DecimalType(38, 0)
    a = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("raw_rows"),
                               F.sum(F.col(measure).cast(dec)).alias("raw_amount"))
    b = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("staged_rows"),
                                  F.sum(F.col(measure).cast(dec)).alias("staged_amount"))
    j = a.join(b, [a[k].eqNullSafe(b[k]) for k in keys], "full_outer").select(
        *[F.coalesce(a[k], b[k]).alias(k) for k in keys],
        F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"), F.coalesce("staged_rows", F.lit(0)).alias("staged_rows"),
        "raw_amount", "staged_amount")
    status = (F.when(F.col("raw_rows") == 0, "missing_in_raw")
              .when(F.col("staged_rows") == 0, "missing_in_staged")
              .when((F.col("raw_rows") == F.col("staged_rows"))
                    & F.col("raw_amount").eqNullSafe(F.col("staged_amount")), "match")
              .otherwise("mismatch"))
    return j.withColumn("status", status)


def reconcile_rows(raw: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that one table has more often than the other, both ways:
    ``side`` (``raw_only`` or ``staged_only``), the columns of ``raw``, and
    ``n``, how many times more.  Two amounts swapped inside one key show here,
    while all counts and sums of ``reconcile`` agree.

    Every key gets an order-free fingerprint on both sides (rows and two sums of
    64-bit row hashes, partial aggregates); only rows of keys whose fingerprints
    differ are compared, by their signed multiplicities in one aggregate (NULLs
    are equal).  Where the tables agree, no row is shuffled.
    """
    cols = raw.columns
    staged = staged.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in raw.schema.fields])
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    every = [F.col(f"`{c}`") for c in cols]

    def prints(df: DataFrame, sign: int) -> DataFrame:
        return df.groupBy(*[f"`{k}`" for k in keys]).agg(
            (sign * F.count(F.lit(1))).alias("__n"), (sign * total(F.xxhash64(*every))).alias("__h"),
            (sign * total(F.xxhash64(F.lit(1), *every))).alias("__g"))

    both = prints(raw, 1).unionByName(prints(staged, -1))
    differ = both.groupBy(*[f"`{k}`" for k in keys]).agg(
        *[F.sum(c).alias(c) for c in ("__n", "__h", "__g")]).where("__n <> 0 OR __h <> 0 OR __g <> 0").select(*[f"`{k}`" for k in keys])

    def rows(df: DataFrame, sign: int) -> DataFrame:
        a, d = df.alias("a"), differ.alias("d")
        on = reduce(lambda x, y: x & y, [F.col(f"a.`{k}`").eqNullSafe(F.col(f"d.`{k}`")) for k in keys])
        return a.join(d, on, "left_semi").withColumn("__sign", F.lit(sign))

    left = (rows(raw, 1).unionByName(rows(staged, -1)).groupBy(*[f"`{c}`" for c in cols])
            .agg(F.sum("__sign").alias("__sign")).where("__sign <> 0"))
    return left.select(F.when(F.col("__sign") > 0, "raw_only").otherwise("staged_only").alias("side"), *every,
                       F.abs("__sign").alias("n"))
