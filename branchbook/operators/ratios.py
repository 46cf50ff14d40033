"""Head-office allocation ratios per area and month (7 methods).

The original computes each method with its own scan of the loan snapshot,
for one month per call.  Here the snapshot is read **once** for every method
and every report month:

1. ``snapshot_cells``: one grouped pass -> per (kpi_month, area) the
   conditional sums every method needs (partial aggregation map-side, so the
   shuffle carries at most months x areas rows per task);
2. ``cumulate_to_months``: each report month m takes the cells with
   kpi_month <= m (prefix sums over the small cell table);
3. each method is a share of its column within (month, method).

Ratios are ``decimal(18,10)``; NOT NULL on area and ratio is enforced lazily
(``strict=True``) exactly like the target table's constraint: one bad row
fails the month's whole insert.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.functions.columns import month_of_year, require_not_null
from branchbook.operators.geo import area_by_name, city_to_area
from branchbook.sources import seeds
from branchbook.sources.local import local_table
from branchbook.sources.schemas import RATIO_TYPE

SHARE_INPUT = T.DecimalType(20, 0)  # numerator/denominator width -> 18 quotient decimals


def month_frame(spark: SparkSession, months: Iterable[int], name: str = "report_month") -> DataFrame:
    """The report months as a one-column DataFrame (bounded by the calendar)."""
    return local_table(spark, [(int(m),) for m in sorted(set(months))], f"{name} int")


def month_values(months: DataFrame) -> list[int]:
    """The report months as a Python list (an inline table is read locally,
    without a job; any month list is bounded by the calendar)."""
    return sorted({int(r[0]) for r in months.collect() if r[0] is not None})


def cumulate_to_months(monthly: DataFrame, months: DataFrame, month_col: str, keys: list[str],
                       sums: dict[str, F.Column], year_to_date: bool = False) -> DataFrame:
    """For every report month m and key: the sums over the rows of ``monthly``
    with ``month_col <= m`` (``year_to_date``: and in m's year).

    Prefix sums: one running window per key over the (already aggregated)
    monthly rows, then an as-of step.  A month's running sums hold from that
    month until the key's next one (or the year's end), so each is handed to the
    report months of that interval only: the step makes months x keys rows, the
    size of the result, not a row for every pair of months.  As with SUM, a sum
    is NULL until a row has a value, and a key has no row before its first month.
    """
    rm = months.columns[0]
    at = F.col(month_col)
    sums = {n: e.alias(n) for n, e in sums.items()}
    # several rows of a month (keys coarser than the input) are one
    rows = monthly.where(at.isNotNull()).groupBy(month_col, *keys).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    part = [*keys, F.floor(at / 100)] if year_to_date else keys
    order = Window.partitionBy(*part).orderBy(month_col)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    end = F.floor(at / 100).cast("int") * 100 + 13 if year_to_date else F.lit(None).cast("int")
    rows = rows.select(month_col, *keys, *[F.sum(n).over(upto).alias(n) for n in sums],
                       F.coalesce(F.lead(month_col).over(order), end).alias("__next"))
    listed = F.array(*[F.lit(m) for m in month_values(months)])
    holds = F.filter(listed, lambda m: (m >= at) & (F.col("__next").isNull() | (m < F.col("__next"))))
    return rows.select(F.explode(holds).alias(rm), *keys, *sums)


def snapshot_cells(snapshot: DataFrame, provinces: DataFrame, last_month: int | None = None) -> DataFrame:
    """One pass over ``fact_kpi_month_raw_data`` -> per (kpi_month, area_code).

    ``last_month``: the last report month; later snapshots count for none, and
    the bound reaches the scan (and prunes the folders of a staged table).

    area_code comes from a LEFT lookup (unknown cities -> NULL area), as the
    ratio methods use; steps that need an inner lookup filter NULL areas.
    ``n_*`` count the rows passing each filter (so the existence of a group
    in the original's per-filter GROUP BY is known), ``s_*`` are the sums.
    """
    if last_month is not None:
        snapshot = snapshot.where(F.col("kpi_month") <= F.lit(int(last_month)))
    op = F.col("outstanding_principal").cast("decimal(19,0)")
    wo = F.col("write_off_balance_principal").cast("decimal(19,0)")
    b = F.col("max_bucket")
    wo_row = F.col("write_off_month") == F.col("kpi_month")
    gr1 = (b == 1) | b.isNull()
    gr2 = b == 2
    gr25 = b.isin(2, 3, 4, 5)
    npl = b.isin(3, 4, 5)

    def cnt(cond):
        return F.count(F.when(cond, 1))

    rows = city_to_area(snapshot.select(
        "kpi_month", "pos_city", "outstanding_principal", "write_off_month",
        "write_off_balance_principal", "max_bucket", "psdn"), provinces)
    return rows.groupBy("kpi_month", "area_code").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.sum(op).alias("s_all"),
        cnt(gr1).alias("n_gr1"), F.sum(F.when(gr1, op)).alias("s_gr1"),
        cnt(gr2).alias("n_gr2"), F.sum(F.when(gr2, op)).alias("s_gr2"),
        cnt(gr25).alias("n_gr25"), F.sum(F.when(gr25, op)).alias("s_gr25"),
        F.sum("psdn").alias("s_psdn"),
        cnt(wo_row).alias("n_wo"), F.sum(F.when(wo_row, wo)).alias("s_wo"),
        cnt(npl).alias("n_npl"), F.sum(F.when(npl, F.coalesce(op, F.lit(0).cast("decimal(19,0)")))).alias("s_npl"),
        F.sum(F.coalesce(op, F.lit(0).cast("decimal(19,0)"))).alias("s_tot"),
    )


def cumulative_writeoff(cells: DataFrame) -> DataFrame:
    """Running total of write-offs booked in their own month, per area.

    Only (month, area) pairs that have a write-off appear (areas from an
    inner city lookup).  The original writes this as a theta self-join
    (x.month <= y.month); over the existing rows it equals a running window
    sum, which is linear instead of quadratic.  The cell table is bounded by
    months x areas.
    """
    w = Window.partitionBy("area_code").orderBy("kpi_month").rowsBetween(Window.unboundedPreceding, 0)
    return (cells.where(F.col("area_code").isNotNull() & (F.col("n_wo") > 0))
            .select(F.col("kpi_month").alias("month_key"), "area_code",
                    F.sum("s_wo").over(w).alias("total_lk")))


def _share(df: DataFrame, part: str, by=("rate_month", "method_code"), nullif: bool = True) -> DataFrame:
    total = F.sum(part).over(Window.partitionBy(*by))
    num = F.col(part).cast(SHARE_INPUT)
    den = total.cast(SHARE_INPUT)
    if nullif:
        den = F.when(den != 0, den)
    return df.withColumn("ratio", num / den)


def balance_ratios(cells: DataFrame, months: DataFrame, year_to_date: bool = False) -> DataFrame:
    """AWO, AWO_GR1, AWO_GR2, AWO_GR2_5 and WO_PSDN for every report month;
    ``year_to_date``: from the snapshots of the month's year only."""
    dec = T.DecimalType(38, 0)
    cum = cumulate_to_months(cells, months, "kpi_month", ["area_code"], {
        **{n: F.col(n) for n in ("n_all", "n_gr1", "n_gr2", "n_gr25")},
        **{s: F.col(s).cast(dec) for s in ("s_all", "s_gr1", "s_gr2", "s_gr25", "s_psdn")}}, year_to_date)
    spec = [("AWO", "n_all", "s_all"), ("AWO_GR1", "n_gr1", "s_gr1"), ("AWO_GR2", "n_gr2", "s_gr2"),
            ("AWO_GR2_5", "n_gr25", "s_gr25"), ("WO_PSDN", "n_all", "s_psdn")]
    args = [F.lit(len(spec))]
    for code, n, s in spec:
        args += [F.lit(code), F.col(n), F.col(s)]
    long = cum.select(F.col(months.columns[0]).alias("rate_month"), "area_code",
                      F.stack(*args).alias("method_code", "n", "part"))
    return _share(long.where(F.col("n") > 0), "part").select("rate_month", "method_code", "area_code", "ratio")


def pre_writeoff_ratios(cells: DataFrame, months: DataFrame, strict: bool = True) -> DataFrame:
    """BWO_GR2_5: (bucket 2-5 balance + cumulative write-off) share per area.

    Reproduces the original's grouping by the *write-off* side's area: the
    bucket balance of a (month, area) with no write-off falls into a NULL
    area (whose ratio is NULL and fails the NOT NULL check).  No NULLIF: with
    ``strict`` a zero total raises division by zero, as the original does;
    without it that month's ratios are NULL, for ``ratio_violations`` to report,
    and other months are computed.
    """
    bal = (cells.where(F.col("n_gr25") > 0)
           .select("kpi_month", F.col("area_code").alias("a_area"), F.col("s_gr25").alias("amount")))
    wo = cumulative_writeoff(cells).select(
        F.col("month_key").alias("kpi_month"), F.col("area_code").alias("a_area"),
        F.col("area_code").alias("b_area"), "total_lk")
    joined = bal.join(wo, ["kpi_month", "a_area"], "left")  # NULL a_area never matches
    dec = T.DecimalType(38, 0)
    cum = cumulate_to_months(joined, months, "kpi_month", ["b_area"],
                             {"s_amount": F.col("amount").cast(dec), "s_lk": F.col("total_lk").cast(dec)})
    val = (F.col("s_amount") + F.col("s_lk")).cast(SHARE_INPUT)
    rows = cum.select(F.col(months.columns[0]).alias("rate_month"), F.lit("BWO_GR2_5").alias("method_code"),
                      F.col("b_area").alias("area_code"), val.alias("part"))
    return _share(rows, "part", nullif=not strict).select("rate_month", "method_code", "area_code", "ratio")


def headcount_cells(fact_kpi_asm: DataFrame, areas: DataFrame) -> DataFrame:
    """Distinct salespeople with a loan figure, per (month_col, area_code), plus
    the global distinct count per month_col (``is_total`` = true, area NULL).

    One grouping-sets aggregate: Spark expands each row to both levels and
    de-duplicates (level, month, area, sale_name) before counting, so a hot
    area does not concentrate the distinct set in one task.
    """
    rows = area_by_name(fact_kpi_asm.where(F.col("loan_to_new").isNotNull())
                        .select("month_col", "area_name", "sale_name"), areas)
    agg = rows.groupingSets([["month_col", "area_code"], ["month_col"]], "month_col", "area_code").agg(
        F.countDistinct("sale_name").alias("n_sales"),
        F.grouping("area_code").alias("g_area"))
    return agg.select("month_col", "area_code", "n_sales", (F.col("g_area") == 1).alias("is_total"))


def headcount_ratios(hc: DataFrame, months: DataFrame) -> DataFrame:
    """SM_COUNT: area's distinct salespeople / sum of the area counts.

    Salespeople are matched on month-of-year only (``p % 100 = month_col``),
    so years mix and months without sheet data give no area rows, as in the
    original.  The denominator is the sum of area counts (a salesperson in two
    areas counts twice), not the global distinct count.
    """
    rm = months.columns[0]
    areas_only = hc.where(~F.col("is_total"))
    j = areas_only.join(F.broadcast(months), F.col("month_col") == month_of_year(F.col(rm)))
    rows = j.select(F.col(rm).alias("rate_month"), F.lit("SM_COUNT").alias("method_code"),
                    "area_code", F.col("n_sales").alias("part"))
    return _share(rows, "part").select("rate_month", "method_code", "area_code", "ratio")


def head_zero_rows(months: DataFrame) -> DataFrame:
    """Ratio 0 for the head-office area under every method."""
    per_method = F.array(*[F.struct(F.lit(c).alias("method_code"), F.lit(n).alias("method_name"))
                           for c, n in seeds.HEAD_METHOD_NAMES])
    return (months.select(F.col(months.columns[0]).alias("rate_month"), F.inline(per_method))
            .select("rate_month", "method_code", "method_name",
                    F.lit(seeds.HEAD_AREA).alias("area_code"), F.lit(0).cast(RATIO_TYPE).alias("ratio")))


def allocation_ratios(snapshot: DataFrame, fact_kpi_asm: DataFrame, provinces: DataFrame,
                      areas: DataFrame, months: DataFrame, strict: bool = True,
                      cells: DataFrame | None = None, headcount: DataFrame | None = None) -> DataFrame:
    """``rate_allocation_area_month`` for all report months in one plan.

    ``strict=True``: NULL area or ratio aborts the job (the table's NOT NULL);
    ``strict=False``: rows are returned as computed, NULLs included, for
    inspection with ``ratio_violations``.
    """
    spark = months.sparkSession
    cells = cells if cells is not None else snapshot_cells(snapshot, provinces)
    hc = headcount if headcount is not None else headcount_cells(fact_kpi_asm, areas)
    names = local_table(spark, seeds.METHODS, "method_code string, method_name string")
    data = (balance_ratios(cells, months)
            .unionByName(pre_writeoff_ratios(cells, months, strict))
            .unionByName(headcount_ratios(hc, months))
            .join(F.broadcast(names), "method_code")
            .select("rate_month", "method_code", "method_name", "area_code",
                    F.col("ratio").cast(RATIO_TYPE).alias("ratio")))
    out = data.unionByName(head_zero_rows(months))
    if strict:
        out = out.select(
            "rate_month", "method_code", "method_name",
            require_not_null("area_code", "rate_allocation_area_month: NULL area_code").alias("area_code"),
            require_not_null("ratio", "rate_allocation_area_month: NULL ratio").alias("ratio"))
    return out


def ratio_violations(ratios: DataFrame) -> DataFrame:
    """Per month: rows breaking NOT NULL on area_code or ratio (0 = clean)."""
    return ratios.groupBy("rate_month").agg(
        F.count(F.when(F.col("area_code").isNull(), 1)).alias("null_area"),
        F.count(F.when(F.col("ratio").isNull(), 1)).alias("null_ratio"))
