"""Registered queries: one per operator of the build plan, bound to the test tables.

Every query reads the given test tables (through ``sources.bindings``) and runs
over all of their rows.  Report months are all months of the loan snapshot.
Ratios are built without ``strict``: months in which an area has a balance but
no write-off show the NULL rows that the target table would refuse
(``constraint_checks`` counts them; the ``run_month_*`` queries show what the
runner publishes instead).

Output conventions (so an SQL engine computing the same thing gives the same
values): money is rounded to 4 decimals *as a decimal* and then cast to
double; ratios (exact ``decimal(18,10)``) are cast to double; averages and
ratio lines computed in double are rounded to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.functions.columns import yyyymm
from branchbook.operators import asm as A
from branchbook.operators import allocation, checks, geo, pnl, views
from branchbook.plans.books import Books
from branchbook.plans.oracle import CROSSTAB_PRIORITIES, LATE_POSTINGS_FROM, OUTLIER_COLUMNS
from branchbook.plans.runner import (
    Tables, kept_headcount, read_error_log, read_output, refresh_headcount, run_changed, run_month)
from branchbook.session import configure
from branchbook.sources import bindings, io, seeds
from branchbook.sources import schemas as S
from branchbook.sources.publish import open_table
from branchbook.sources.scratch import RunFolder


class _Shared:
    """What the registered queries share for one (session, data dir): the books
    and one run of the monthly runner.  Another session or folder closes them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.key = (spark.sparkContext.applicationId, sf_dir)
        folder = RunFolder(spark)
        # derived from the largest test table and read by several steps
        self.wide = folder.write(bindings.kpi_asm_wide(spark, sf_dir), "kpi_asm_wide")
        self.books = Books.from_testdata(spark, sf_dir, materialize="table", strict=False, folder=folder, wide=self.wide)

    def _tables(self, name: str) -> Tables:
        """Outputs of their own over the staged facts and dimensions."""
        root = f"{self.books.folder.path}/{name}"
        s = self.staged
        return Tables(postings=f"{s}/postings", snapshot=f"{s}/snapshot", kpi_asm=f"{s}/kpi_asm", areas=f"{s}/areas",
                      provinces=f"{s}/provinces", rate_table=f"{root}/rate", finance_table=f"{root}/finance",
                      asm_table=f"{root}/asm", error_log=f"{root}/error_log")

    @cached_property
    def staged(self) -> str:
        """The test tables as loaded warehouse tables."""
        spark, d, root = self.spark, self.sf_dir, f"{self.books.folder.path}/staged"
        io.stage_postings(bindings.txn_raw(spark, d), f"{root}/postings")
        io.stage_snapshot(bindings.kpi_month_raw(spark, d), f"{root}/snapshot")
        io.stage_kpi_sheet(self.wide, f"{root}/kpi_asm")
        bindings.dim_area(spark, d).write.parquet(f"{root}/areas")
        bindings.dim_province(spark, d).write.parquet(f"{root}/provinces")
        return root

    # The runner's three steps over all months; each is run (and published) by
    # the first query that needs it.
    @cached_property
    def rates_run(self) -> Tables:
        t = self._tables("run")
        self.spark.createDataFrame([], S.ERROR_LOG).write.parquet(t.error_log)
        run_month(self.spark, t, self.books.month_list, steps=("ratios",))
        return t

    @cached_property
    def finance_run(self) -> Tables:
        run_month(self.spark, self.rates_run, self.books.month_list, steps=("finance",))
        return self.rates_run

    @cached_property
    def run(self) -> Tables:
        run_month(self.spark, self.finance_run, self.books.month_list, steps=("asm",))
        return self.rates_run

    @cached_property
    def changed_run(self) -> Tables:
        """All months run before the last postings arrived; these loaded, and
        the stale months run again."""
        spark, d = self.spark, self.sf_dir
        t = self._tables("changed")
        t = replace(t, postings=f"{self.books.folder.path}/changed/postings",
                    postings_by_month=f"{self.books.folder.path}/changed/kept_postings",
                    cells_by_month=f"{self.books.folder.path}/changed/kept_cells")
        raw = bindings.txn_raw(spark, d)
        late = F.col("transaction_date") >= F.lit(LATE_POSTINGS_FROM).cast("date")
        io.stage_postings(raw.where(~late), t.postings)
        run_changed(spark, t, self.books.month_list, steps=("ratios", "finance"))
        io.stage_postings(raw.where(late), t.postings, append=True)
        run_changed(spark, t, steps=("ratios", "finance"))
        return t

    @cached_property
    def sheet_loads(self) -> Tables:
        """The KPI sheet in two loads; the bitmaps of each are built from its own rows."""
        root = f"{self.books.folder.path}/sheet_loads"
        t = replace(self._tables("sheet_loads"), kpi_asm=f"{root}/kpi_asm", headcount_by_load=f"{root}/headcount")
        for early in (True, False):
            load = self.wide.where((F.col("month_key") < 199600) == early)
            keys = {r[0] for r in load.select("month_key").distinct().collect()}      # one per year
            io.stage_kpi_sheet(load, t.kpi_asm)
            refresh_headcount(self.spark, t, sorted(keys))
        return t

    @cached_property
    def two_loads(self) -> str:
        """Postings in two loads.  Both bring postings without a date (those of
        a 31st), and both bring December 1995."""
        path = f"{self.books.folder.path}/two_loads"
        raw = bindings.txn_raw(self.spark, self.sf_dir)
        day, month = F.dayofmonth("transaction_date"), F.date_trunc("month", "transaction_date").cast("date")
        loads = ((month <= F.lit("1995-12-01").cast("date"), F.col("d_c") == "F"),
                 (month >= F.lit("1995-12-01").cast("date"), F.col("d_c") != "F"))
        for dated, undated in loads:
            rows = raw.where(F.when(day == 31, undated).otherwise(dated))
            io.stage_postings(rows.withColumn("transaction_date", F.when(day != 31, F.col("transaction_date"))), path)
        return path


_SHARED: list[_Shared] = []


def shared(spark: SparkSession, sf_dir: str) -> _Shared:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if not _SHARED or _SHARED[0].key != key:
        while _SHARED:
            old = _SHARED.pop()
            if old.key[0] == key[0]:
                old.books.close()
        _SHARED.append(_Shared(spark, key[1]))
    return _SHARED[0]


def books(spark: SparkSession, sf_dir: str) -> Books:
    return shared(spark, sf_dir).books


def money(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 4).cast("double")


def dbl(c, scale: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), scale)


# -- ingest / reshape ---------------------------------------------------------

def q_kpi_unpivot(spark, d):
    return books(spark, d).kpi_asm


def q_analysis_code_decode(spark, d):
    return books(spark, d).txn


def q_geo_rollup(spark, d):
    b = books(spark, d)
    return geo.geo_rollup(b.snapshot, b.provinces, b.areas, b.regions).select(
        "kpi_month", "region_id", "region_name", "area_code", "area_name",
        F.col("outstanding").cast("bigint").alias("outstanding"), "n_loans")


# -- allocation ratios --------------------------------------------------------

def _ratio_rows(df: DataFrame) -> DataFrame:
    return df.select("rate_month", "method_code", "method_name", "area_code", F.col("ratio").cast("double").alias("ratio"))


def _ratio_method(code: str):
    def q(spark, d):
        return _ratio_rows(books(spark, d).ratios.where(F.col("method_code") == code))
    q.__name__ = f"q_ratio_{code.lower()}"
    return q


def q_allocation_ratios_all(spark, d):
    return _ratio_rows(books(spark, d).ratios)


def q_cumulative_writeoff(spark, d):
    b = books(spark, d)
    return b.writeoff_cumulative.select("month_key", "area_code", F.col("total_lk").cast("bigint").alias("total_lk"))


# -- finance ------------------------------------------------------------------

def _finance_rows(df: DataFrame) -> DataFrame:
    return df.select("month_key", "id", "area_code", money("amount").alias("amount"))


def q_head_total(spark, d):
    b = books(spark, d)
    return b.head_totals().select("month_key", "id", F.col("head_total").cast("double").alias("head_total"))


def q_allocate_line(spark, d):
    return _finance_rows(books(spark, d).leaves.where(F.col("id") == 3))


def q_allocate_placeholder(spark, d):
    return _finance_rows(books(spark, d).leaves.where(F.col("id") == 9))


def q_allocate_all_lines(spark, d):
    return _finance_rows(books(spark, d).leaves)


def q_headcount_line(spark, d):
    return _finance_rows(books(spark, d).headcount_line)


def q_pnl_rollup(spark, d):
    return _finance_rows(books(spark, d).rollups)


def q_pnl_ratios(spark, d):
    return _finance_rows(books(spark, d).ratio_lines)


def q_finance_report(spark, d):
    return _finance_rows(books(spark, d).finance)


# -- ASM ------------------------------------------------------------------------

def q_asm_averages(spark, d):
    a = A.measure_averages(books(spark, d).asm_averages)
    return a.withColumn("average", dbl("average", 6))


def q_npl_by_area(spark, d):
    return books(spark, d).npl_by_area.select("month_key", "area_code",
                                              dbl("npl_truoc_wo_luy_ke", 9).alias("npl_truoc_wo_luy_ke"))


def q_npl_by_asm(spark, d):
    b = books(spark, d)
    return b.npl_by_asm.select(
        "month_key", "area_name", "sale_name", "email", dbl("npl_truoc_wo_luy_ke", 9).alias("npl_truoc_wo_luy_ke"))


def q_asm_finance_lookup(spark, d):
    b = books(spark, d)
    return b.finance_lookup.select(
        "month_key", "area_name", "sale_name", "email", "id", money("amount").alias("amount"))


def _asm_out(df: DataFrame) -> DataFrame:
    cols = []
    for name, dtype in df.dtypes:
        if dtype == "double":
            scale = 9 if name in ("approval_rate_avg", "npl_truoc_wo_luy_ke") else 4 if name in (
                "cir", "margin", "hs_von", "hsbp_nhan_su") else 6
            cols.append(dbl(name, scale).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def q_asm_rank(spark, d):
    return _asm_out(books(spark, d).asm_ranked.select(
        "month_key", "email", "area_name", "sale_name", "ltn_avg", "psdn_avg", "approval_rate_avg",
        "npl_truoc_wo_luy_ke", *[F.col(n).cast("double").alias(n) for _, n in A.FINANCE_LOOKUPS],
        "rank_ltn", "rank_psdn", "rank_approval", "rank_npl", "rank_cir", "rank_margin", "rank_hs_von",
        "rank_hsbp"))


def q_rank_scalable(spark, d):
    """Three of the ASM ranks: row_number, rank and dense_rank."""
    return books(spark, d).asm_ranked.select("month_key", "email", "area_name", "sale_name", "rank_ltn", "rank_npl",
                                             "rank_cir")


def q_asm_score(spark, d):
    return books(spark, d).asm.select("month_key", "area_name", "email", "diem_quymo", "diem_fin", "tong_diem",
                                      "rank_ptkd", "rank_fin", "rank_final")


def q_asm_report(spark, d):
    return _asm_out(books(spark, d).asm)


# -- views ------------------------------------------------------------------------

def q_report_finance_crosstab(spark, d):
    b = books(spark, d)
    x = views.report_finance_crosstab(b.finance, b.areas, seeds.pnl_tree_df(spark))
    return x.select("month_key", "pnl_name", "sortorder",
                    *[money(f"`{c}`").alias(c) for c in x.columns[3:]])


def q_heat_map(spark, d):
    return views.heat_map(books(spark, d).asm).select(
        "month_key", "email", "rank_for_sort", "kpi", dbl("value", 4).alias("value"))


def q_col_chart(spark, d):
    b = books(spark, d)
    return views.col_chart(b.finance, b.areas, seeds.pnl_tree_df(spark)).select(
        "month_key", "pnl_name", "area_name", money("monthly_amount").alias("monthly_amount"))


def q_report_asm_view(spark, d):
    return _asm_out(views.view_report_asm(books(spark, d).asm))


# -- checks ------------------------------------------------------------------------

def q_constraint_checks(spark, d):
    b = books(spark, d)
    return checks.check_constraints(regions=b.regions, areas=b.areas, provinces=b.provinces,
                                    tree=seeds.pnl_tree_df(spark), ratios=b.ratios, fact_kpi_asm=b.kpi_asm,
                                    finance=b.finance, asm=b.asm,
                                    error_log=read_error_log(spark, shared(spark, d).run))


def _profiled(b: Books) -> dict[str, DataFrame]:
    return {"fact_txn_month_data": b.txn, "fact_kpi_asm": b.kpi_asm, "fact_kpi_month_raw_data": b.snapshot}


def q_profile_columns(spark, d):
    return reduce(DataFrame.unionByName, [checks.profile_nulls(df, t) for t, df in _profiled(books(spark, d)).items()])


def q_profile_outliers(spark, d):
    b = books(spark, d)
    tables = _profiled(b)
    return reduce(DataFrame.unionByName, [checks.profile_outliers(tables[t], t, cols, b.folder.write)
                                          for t, _, cols in OUTLIER_COLUMNS])


def q_reconcile(spark, d):
    """Raw postings vs the staged table read back, per account and area part:
    every row and every amount must survive staging; unknown area parts (which
    the allocation never picks up) show up as their own keys."""
    raw = bindings.txn_raw(spark, d).select(
        "account_code", F.split_part("analysis_code", F.lit("."), F.lit(3)).alias("area_code"), "amount")
    staged = open_table(spark, f"{shared(spark, d).staged}/postings", S.TXN).select("account_code", "area_code", "amount")
    r = checks.reconcile(raw, staged, ["account_code", "area_code"], "amount")
    return r.select("account_code", "area_code", "raw_rows", "staged_rows",
                    F.col("raw_amount").cast("bigint").alias("raw_amount"),
                    F.col("staged_amount").cast("bigint").alias("staged_amount"), "status")


# -- the monthly runner ------------------------------------------------------------

def q_run_month_rates(spark, d):
    return _ratio_rows(read_output(spark, shared(spark, d).rates_run, "rates"))


def q_run_month_finance(spark, d):
    return _finance_rows(read_output(spark, shared(spark, d).finance_run, "finance"))


def q_run_month_asm(spark, d):
    return _asm_out(read_output(spark, shared(spark, d).run, "asm"))


def q_run_changed_finance(spark, d):
    """The finance table after an incremental run: postings arrive late, and
    only the months that they make stale run again."""
    return _finance_rows(read_output(spark, shared(spark, d).changed_run, "finance"))


def q_two_loads(spark, d):
    """The posting table after two loads that overlap in a month and both bring
    postings without a date, per month and account."""
    schema = T.StructType([*S.TXN.fields, T.StructField("post_month", T.IntegerType())])
    return open_table(spark, shared(spark, d).two_loads, schema).groupBy("post_month", "account_code").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))


def q_headcount_kept(spark, d):
    """Distinct salespeople per month of the year and area, and over all areas,
    from the bitmaps kept of each sheet load."""
    return kept_headcount(spark, shared(spark, d).sheet_loads)


def q_postings_year_to_date(spark, d):
    """Line postings per area from the start of the report month's year."""
    b = books(spark, d)
    ytd = allocation.line_postings_cumulative(b.monthly_postings, b.months, year_to_date=True)
    return ytd.select(F.col("report_month").alias("month_key"), F.col("pnl_id").alias("id"), "area_code",
                      F.col("amount").cast("bigint").alias("amount"))


# -- general forms ------------------------------------------------------------------

def _company_tree(spark, d) -> DataFrame:
    """A line tree of other ids and depth than the P&L's: world, regions,
    nations, suppliers."""
    t = lambda name: bindings.table(spark, d, name)
    levels = [
        t("region").select((F.col("r_regionkey") + 10).alias("pnl_id"), F.lit(1).alias("pnl_parent_id")),
        t("nation").select((F.col("n_nationkey") + 100).alias("pnl_id"), (F.col("n_regionkey") + 10).alias("pnl_parent_id")),
        t("supplier").select((F.col("s_suppkey") + 1000).alias("pnl_id"), (F.col("s_nationkey") + 100).alias("pnl_parent_id"))]
    levels = [x.select(F.col("pnl_id").cast("long"), F.col("pnl_parent_id").cast("long")) for x in levels]
    return reduce(DataFrame.unionByName, levels)


def q_rollup_any_tree(spark, d):
    """Sales per month, flag and supplier, rolled up a four-level tree."""
    lines = bindings.table(spark, d, "lineitem").select(
        yyyymm("l_shipdate").alias("month_key"), (F.col("l_suppkey") + 1000).cast("long").alias("id"),
        F.col("l_returnflag").alias("area_code"), F.round(F.col("l_extendedprice") * 100, 0).cast("decimal(38,0)").alias("amount"))
    closure = pnl.tree_closure(_company_tree(spark, d))
    return pnl.rollup_tree(lines, closure, bounded=False).select("month_key", "id", "area_code", F.col("amount").cast("bigint").alias("amount"))


def q_tree_errors(spark, d):
    """A tree made of all orders (each under its customer's next order): the
    last order of every customer with an even key is given the first one as its
    parent, a cycle; that of the others is a root."""
    o = bindings.table(spark, d, "orders").select(F.col("o_orderkey").alias("pnl_id"), "o_custkey").where(F.col("o_custkey").isNotNull())
    w = Window.partitionBy("o_custkey").orderBy("pnl_id")
    last = F.lead(F.lit(1)).over(w).isNull() & (F.col("o_custkey") % 2 == 0)
    first = F.min("pnl_id").over(w.rowsBetween(Window.unboundedPreceding, 0))
    tree = o.select("pnl_id", F.when(last, first).otherwise(F.coalesce(F.lead("pnl_id").over(w), F.lit(-1))).alias("pnl_parent_id"))
    return pnl.tree_errors(tree, store=RunFolder(spark).write)


def q_crosstab_orders(spark, d):
    """The general crosstab over another table: a customer's last order value
    per priority (one priority is not listed), and the status of the first order."""
    o = bindings.table(spark, d, "orders")
    return views.crosstab(o, [c for c, _ in CROSSTAB_PRIORITIES], "o_custkey", "o_orderpriority", "o_totalprice",
                          extra=["o_orderstatus"], order=["o_orderdate", "o_orderkey"], names=[n for _, n in CROSSTAB_PRIORITIES])


def q_reconcile_rows(spark, d):
    """Postings against a copy in which some amounts moved within their account:
    the rows that differ, both ways."""
    raw = bindings.txn_raw(spark, d)
    moved = F.when(F.col("amount") % 97 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
    return checks.reconcile_rows(raw, raw.withColumn("amount", moved), ["account_code", "d_c"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "kpi_unpivot": q_kpi_unpivot,
    "analysis_code_decode": q_analysis_code_decode,
    "geo_rollup": q_geo_rollup,
    "ratio_awo": _ratio_method("AWO"),
    "ratio_awo_gr1": _ratio_method("AWO_GR1"),
    "ratio_awo_gr2": _ratio_method("AWO_GR2"),
    "ratio_awo_gr2_5": _ratio_method("AWO_GR2_5"),
    "ratio_wo_psdn": _ratio_method("WO_PSDN"),
    "ratio_sm_count": _ratio_method("SM_COUNT"),
    "ratio_bwo_gr2_5": _ratio_method("BWO_GR2_5"),
    "cumulative_writeoff": q_cumulative_writeoff,
    "allocation_ratios_all": q_allocation_ratios_all,
    "head_total": q_head_total,
    "allocate_line": q_allocate_line,
    "allocate_placeholder": q_allocate_placeholder,
    "allocate_all_lines": q_allocate_all_lines,
    "headcount_line": q_headcount_line,
    "pnl_rollup": q_pnl_rollup,
    "pnl_ratios": q_pnl_ratios,
    "finance_report": q_finance_report,
    "asm_averages": q_asm_averages,
    "npl_by_area": q_npl_by_area,
    "npl_by_asm": q_npl_by_asm,
    "asm_finance_lookup": q_asm_finance_lookup,
    "asm_rank": q_asm_rank,
    "asm_report": q_asm_report,
    "rank_scalable": q_rank_scalable,
    "report_finance_crosstab": q_report_finance_crosstab,
    "heat_map": q_heat_map,
    "col_chart": q_col_chart,
    "report_asm_view": q_report_asm_view,
    "constraint_checks": q_constraint_checks,
    "profile_columns": q_profile_columns,
    "profile_outliers": q_profile_outliers,
    "reconcile": q_reconcile,
    "asm_score": q_asm_score,
    "run_month_rates": q_run_month_rates,
    "run_month_finance": q_run_month_finance,
    "run_month_asm": q_run_month_asm,
    "run_changed_finance": q_run_changed_finance,
    "two_loads": q_two_loads,
    "headcount_kept": q_headcount_kept,
    "postings_year_to_date": q_postings_year_to_date,
    "rollup_any_tree": q_rollup_any_tree,
    "tree_errors": q_tree_errors,
    "crosstab_orders": q_crosstab_orders,
    "reconcile_rows": q_reconcile_rows,
}
