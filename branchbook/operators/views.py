"""Reporting views over the two report tables (crosstab, heat map, month deltas)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.sources import seeds


def view_report_asm(report_asm: DataFrame) -> DataFrame:
    """Pass-through of the salesperson report (frozen column list)."""
    return report_asm.select(*report_asm.columns)


def area_names_in_order(areas: DataFrame) -> list[str]:
    """Area names ordered by area code: the crosstab's column list.

    The area dimension is bounded (8 seed rows; 6 in the test binding), so
    reading its names to name output columns is a lookup of a fixed-size
    dimension, not a pass of data through the driver.
    """
    return [r["area_name"] for r in areas.select("area_code", "area_name").orderBy("area_code").collect()]


def crosstab(source: DataFrame, categories: list | DataFrame, row_name: str | list[str], category: str, value: str,
             extra: list[str] = (), order: list = (), names: list[str] | None = None) -> DataFrame:
    """One row per ``row_name``, one column per category: the general form of a
    crosstab of (source, categories).

    ``order``: the source's order.  Where a (row, category) occurs several
    times, its last row gives the value (as that row has it, NULL too);
    ``extra`` columns come from a row's first source row.  Rows whose category
    is NULL or not listed still make their row but fill no column.
    ``categories``: the values in column order, as a list or a one-column frame
    (its rows become columns, so they are few); a repeated or NULL category is
    an error.  ``names``: the output columns' names (default: the categories).

    One aggregate with one conditional ``max_by`` per category: no pass to find
    the categories and no sort of the source.  Rows that are equal in ``order``
    are told apart by the value, the larger one last.
    """
    if isinstance(categories, DataFrame):
        categories = [r[0] for r in categories.collect()]
    if None in categories or len(set(categories)) < len(categories):
        raise ValueError(f"categories must be distinct and not NULL: {categories}")
    rows = [row_name] if isinstance(row_name, str) else list(row_name)
    names = names or [str(c) for c in categories]
    place = F.struct(*[F.expr(o) if isinstance(o, str) else o for o in order], F.col(f"`{value}`").alias("__value"))
    cells = [F.max_by(F.col(f"`{value}`"), F.when(F.col(f"`{category}`") == F.lit(c), place)).alias(n)
             for c, n in zip(categories, names)]
    firsts = [F.min_by(F.col(f"`{c}`"), place).alias(c) for c in extra]
    return source.groupBy(*[f"`{r}`" for r in rows]).agg(*firsts, *cells)


def report_finance_crosstab(report: DataFrame, areas: DataFrame, tree: DataFrame,
                            area_names: list[str] | None = None) -> DataFrame:
    """One row per (month, line), one amount column per area, in area order.

    Lines unknown to the tree are dropped; rows whose area is unknown or NULL
    still create their (month, line) row but fill no column; ``month_key``
    comes out as text.  A duplicated (month, line, area) keeps the larger
    amount (the original keeps whichever comes last in an order that does not
    decide between them).
    """
    names = area_names if area_names is not None else area_names_in_order(areas)
    rows = (report.join(areas.select("area_code", "area_name"), "area_code", "left")
            .join(F.broadcast(tree.select(F.col("pnl_id").alias("id"), "pnl_name", "sortorder")), "id"))
    pv = crosstab(rows, names, ["month_key", "pnl_name", "sortorder"], "area_name", "amount")
    return pv.select(F.col("month_key").cast("string").alias("month_key"), "pnl_name", "sortorder",
                     *[F.col(f"`{n}`") for n in names])


def _cutoffs(report: DataFrame, place, k: int, pieces: int = 64) -> DataFrame:
    """Per month bounds that its k smallest and k largest places keep: the k-th
    smallest of the minima (and k-th largest of the maxima) of any pieces of the
    month, since k rows reach it.  NULL (all rows stay) if fewer than k pieces
    have rows.  One narrow aggregate of months x pieces rows."""
    piece = F.pmod(F.xxhash64("email", "area_name", "rank_final"), F.lit(pieces))
    ends = report.groupBy(F.col("month_key").alias("__month"), piece.alias("p")).agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    kth = lambda c, up: F.get(F.sort_array(F.collect_list(c), up), F.lit(k - 1))
    return ends.groupBy("__month").agg(kth("lo", True).alias("__upto"), kth("hi", False).alias("__from"))


def heat_map(report_asm: DataFrame, k: int = 3, ordered: bool = False) -> DataFrame:
    """Top-k and bottom-k salespeople of each month by ``rank_final``, with 5
    KPIs unpivoted (CIR as its absolute value).

    Top and bottom are two separate per-month top-k windows, unioned; a row in
    both (months with fewer than 2k people) appears once.  Ties on rank_final are
    broken by (email, area_name).  The windows sort only the rows that can be
    among the k (``_cutoffs``): no task sorts the report.
    """
    base = report_asm.select("month_key", "email", "area_name", "rank_final", "ltn_avg", "psdn_avg",
                             "approval_rate_avg", "npl_truoc_wo_luy_ke", "cir")
    asc = Window.partitionBy("month_key").orderBy(F.col("rank_final").asc_nulls_last(),
                                                  F.col("email").asc_nulls_last(),
                                                  F.col("area_name").asc_nulls_last())
    desc = Window.partitionBy("month_key").orderBy(F.col("rank_final").desc_nulls_first(),
                                                   F.col("email").desc_nulls_first(),
                                                   F.col("area_name").desc_nulls_first())
    place = F.coalesce(F.col("rank_final").cast("bigint"), F.lit(2**63 - 1))     # NULL is the largest
    base = base.join(F.broadcast(_cutoffs(base, place, k)), F.col("month_key").eqNullSafe(F.col("__month")))
    low = base.where(F.col("__upto").isNull() | (place <= F.col("__upto"))).drop("__month", "__upto", "__from")
    high = base.where(F.col("__from").isNull() | (place >= F.col("__from"))).drop("__month", "__upto", "__from")
    top = low.withColumn("rn", F.row_number().over(asc)).where(F.col("rn") <= k).drop("rn")
    bottom = high.withColumn("rn", F.row_number().over(desc)).where(F.col("rn") <= k).drop("rn")
    picked = top.unionByName(bottom).distinct()
    kpis = seeds.heat_map_kpis()
    args = [F.lit(len(kpis))]
    for label, colname in kpis:
        v = F.col(colname).cast(T.DoubleType())
        args += [F.lit(label), F.abs(v) if colname == "cir" else v]
    out = picked.select("month_key", "email", F.col("rank_final").alias("rank_for_sort"),
                        F.stack(*args).alias("kpi", "value"))
    # the view's ORDER BY, applied only at the edge when a consumer needs it
    return out.orderBy("month_key", "rank_for_sort", "kpi") if ordered else out


def col_chart(report: DataFrame, areas: DataFrame, tree: DataFrame, ordered: bool = False) -> DataFrame:
    """Month-over-month amounts of lines 1, 20, 21, 26 for areas other than the
    head office: cumulative amount minus the previous *present* month's
    cumulative amount of the same line and area (0 before the first month).

    The filter runs before the LAG, as in the original's WHERE.  The window is
    partitioned by (line, area name): one small sorted run per line and area.
    """
    rows = (report.where(F.col("id").isin(seeds.COL_CHART_LINES) & (F.col("area_code") != seeds.HEAD_AREA))
            .join(F.broadcast(tree.select(F.col("pnl_id").alias("id"), "pnl_name")), "id", "left")
            .join(areas.select("area_code", "area_name"), "area_code", "left"))
    w = Window.partitionBy("id", "area_name").orderBy("month_key")
    amt = F.col("amount").cast(T.DecimalType(37, 10))
    prev = F.coalesce(F.lag(amt).over(w), F.lit(0).cast(T.DecimalType(37, 10)))
    out = rows.select("month_key", "id", "pnl_name", "area_name", (amt - prev).alias("monthly_amount"))
    if ordered:
        out = out.orderBy("month_key", "id", F.col("area_name").asc_nulls_last())
    return out.drop("id")
