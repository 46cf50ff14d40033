"""Physical-plan properties the design relies on at scale."""

import re

from pyspark.sql import types as T

from branchbook.operators import allocation, ratios as R, reshape
from branchbook.sources import bindings, schemas as S, seeds
from branchbook.sources.publish import open_table

SF = "/root/testdata/sf0.01"


def _plan(df):
    # plans are inspected fresh: a frame cached by an earlier test would be
    # substituted into this plan by the cache manager
    df.sparkSession.catalog.clearCache()
    df.count()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def _selectors():
    return [(k, v) for _, (_, k, vals) in seeds.ALLOCATED_LINES.items() for v in vals]


def test_one_posting_scan_for_all_lines_and_months(spark):
    txn = reshape.decode_analysis_code(bindings.txn_raw(spark, SF))
    mp = allocation.line_postings_monthly(txn, seeds.line_selector_df(spark), seeds.prefix_lengths(), _selectors())
    plan = _plan(mp)
    assert plan.count("lineitem.parquet") == 1
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the only shuffle is the (line, area, month) aggregation
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_selector_filter_reaches_the_parquet_scan(spark, scratch):
    txn = reshape.decode_analysis_code(bindings.txn_raw(spark, SF))
    txn.write.parquet(f"{scratch}/postings")
    stored = spark.read.parquet(f"{scratch}/postings")
    mp = allocation.line_postings_monthly(stored, seeds.line_selector_df(spark), seeds.prefix_lengths(),
                                          _selectors())
    spark.catalog.clearCache()
    mp.count()
    plan = mp._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    # IN over the exact codes OR-ed with the three prefix StartsWith filters
    # (Spark elides the long literal list in the plan text)
    assert "Or(Or(Or(In(account_code" in pushed
    # column pruning: only the 4 columns used are read
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == \
        ["account_code", "amount", "area_code", "transaction_date"]


def test_one_snapshot_scan_for_every_method_and_month(spark):
    snap = bindings.kpi_month_raw(spark, SF)
    cells = R.snapshot_cells(snap, bindings.dim_province(spark, SF))
    plan = _plan(cells)
    assert plan.count("orders.parquet") == 1
    assert "SortMergeJoin" not in plan


def test_month_bounds_reach_the_fact_scans(spark, scratch):
    from branchbook.sources import io
    io.stage_postings(bindings.txn_raw(spark, SF), f"{scratch}/p")
    io.stage_snapshot(bindings.kpi_month_raw(spark, SF), f"{scratch}/s")
    txn = T.StructType([*S.TXN.fields, T.StructField("post_month", T.IntegerType())])
    postings, snapshot = open_table(spark, f"{scratch}/p", txn, 199701), open_table(spark, f"{scratch}/s", S.KPI_MONTH_RAW, 199701)
    for df in (postings, snapshot):
        slots = {int(re.search(r"slot=(\d+)", f).group(1)) for f in df.inputFiles()}
        assert max(slots) == 199701 and len(slots) > 12
    mp = allocation.line_postings_monthly(postings, seeds.line_selector_df(spark), seeds.prefix_lengths(), _selectors(),
                                          last_month=199701)
    assert "LessThanOrEqual(transaction_date" in _plan(mp)
    cells = R.snapshot_cells(snapshot, bindings.dim_province(spark, SF), 199701)
    assert "LessThanOrEqual(kpi_month,199701)" in _plan(cells)


def test_no_window_gathers_a_month(spark):
    from branchbook.plans.books import Books
    b = Books.from_testdata(spark, SF, months=[199704, 199705], materialize="table", strict=False)
    ranked = b.asm_ranked
    plan = _plan(ranked)
    # the only windows are over range slices (by __pid) and over their totals
    for w in re.findall(r"Window \[[^\n]*", plan):
        assert "__pid" in w or "__n" in w, w
    b.close()


def test_many_months_do_not_rescan_the_facts(spark, scratch):
    from branchbook.plans.books import Books
    b = Books.from_testdata(spark, SF, months=list(range(199501, 199513)) + list(range(199601, 199613)),
                            materialize="table", strict=False)
    plan = _plan(b.finance)
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan  # reads the written steps only
    assert b.finance.select("month_key").distinct().count() == 24
