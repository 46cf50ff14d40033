"""
T18 NULL-area headcount row; CSV staging; the functional finance API."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.operators import allocation, asm as A, pnl, ratios as R
from branchbook.sources import io, schemas as S, seeds
from branchbook.sources.publish import open_table

M = 202305


def test_shared_email_fans_out(spark):
    avg = spark.createDataFrame(
        [(M, "Bee", "x", "same@x", 1.0, 1, 2.0, 1, 0.5, 1), (M, "Cee", "y", "same@x", 3.0, 1, 4.0, 1, 0.7, 1)],
        "month_key int, area_name string, sale_name string, email string, ltn_avg double, n_ltn long, "
        "psdn_avg double, n_psdn long, approval_rate_avg double, n_ar long")
    empty_npl = spark.createDataFrame([], "month_key int, area_name string, sale_name string, email string, "
                                          "npl_truoc_wo_luy_ke double")
    empty_lookup = spark.createDataFrame([], "month_key int, area_name string, sale_name string, email string, "
                                             "id int, amount decimal(38,10)")
    j = A.asm_joined(avg, empty_npl, empty_lookup)
    # 2 loan rows x 2 psdn rows x 2 approval rows sharing the email
    assert j.count() == 8


def test_unknown_area_postings_are_not_allocated(spark):
    cum = spark.createDataFrame([(M, 3, "00", D(1000)), (M, 3, "B", D(300)), (M, 3, "Z", D(77))],
                                "report_month int, pnl_id int, area_code string, amount decimal(38,0)")
    rates = spark.createDataFrame([(M, "AWO_GR1", "A", D(0)), (M, "AWO_GR1", "B", D(1))],
                                  "rate_month int, method_code string, area_code string, ratio decimal(18,10)")
    cat = spark.createDataFrame([(3, "AWO_GR1")], "pnl_id int, method_code string")
    out = {r.area_code: r.amount for r in allocation.allocate_lines(cum, rates, cat).collect()}
    assert out == {"A": D(1000), "B": D(1300)}  # Z's 77 is nowhere


def test_headcount_line_keeps_null_area_row(spark):
    areas = seeds.areas_df(spark)
    k = spark.createDataFrame([(M, "Nowhere", "x", "x@x", 5, 1, 1, 1, 1, 0.5),
                               (M, seeds.AREAS[1][1], "y", "y@x", 5, 1, 1, 1, 1, 0.5)], S.FACT_KPI_ASM)
    months = R.month_frame(spark, [M])
    line = {r.area_code: r.amount for r in pnl.headcount_line(R.headcount_cells(k, areas), months).collect()}
    assert line == {None: D(1), "B": D(1), "A": D(2)}


def test_csv_staging_with_declared_schema(spark, scratch):
    rows = [(199705, "Bee", "s1", "e1") + tuple(range(1, 21)) + (0.5, None, 0.25, 1.0, 0.75)]
    wide = spark.createDataFrame(rows, S.KPI_ASM_WIDE)
    wide.write.option("header", True).csv(f"{scratch}/sheet_csv")
    back = io.read_csv(spark, f"{scratch}/sheet_csv", S.KPI_ASM_WIDE)
    assert back.drop(io.BAD_RECORD).schema == S.KPI_ASM_WIDE
    staged = io.stage_kpi_sheet(back, f"{scratch}/kpi_asm")
    got = sorted((r.month_col, r.loan_to_new, r.approval_rate) for r in staged.collect())
    assert got == [(1, 1, 0.5), (2, 2, None), (3, 3, 0.25), (4, 4, 1.0), (5, 5, 0.75)]


def test_postings_staging_is_partitioned_by_month_and_rerunnable(spark, scratch):
    raw = spark.createDataFrame([(dt.date(2023, 1, 3), "702000030002", "d", "N.01.B.02.POS_1", 5, "D"),
                                 (dt.date(2023, 2, 3), "702000030002", "d", "N.01.00.02", 7, "C")], S.TXN_RAW)
    io.stage_postings(raw, f"{scratch}/p")
    io.stage_postings(raw, f"{scratch}/p")   # replaces its months, adds nothing
    schema = T.StructType([*S.TXN.fields, T.StructField("post_month", T.IntegerType())])
    back = open_table(spark, f"{scratch}/p", schema)
    assert back.count() == 2
    assert sorted(r.post_month for r in back.select("post_month").collect()) == [202301, 202302]
    # a bound opens the folders of its months only
    assert all("slot=202301" in f for f in open_table(spark, f"{scratch}/p", schema, upto=202301).inputFiles())


def test_loads_accumulate_by_month(spark, scratch):
    def load(month, amount, **kw):
        raw = spark.createDataFrame([(dt.date(2023, month, 3), "702000030002", "d", "N.01.B.02.POS_1", amount, "D")], S.TXN_RAW)
        return io.stage_postings(raw, f"{scratch}/p", **kw)

    load(1, 5)
    load(2, 7)
    assert sorted((r.post_month, r.amount) for r in load(1, 6).collect()) == [(202301, 6), (202302, 7)]
    assert load(2, 1, append=True).count() == 3
    wide = spark.createDataFrame([(199705, "Bee", "s1", "e1") + (1,) * 20 + (0.5,) * 5], S.KPI_ASM_WIDE)
    io.stage_kpi_sheet(wide, f"{scratch}/k")
    k = io.stage_kpi_sheet(wide.withColumn("month_key", F.lit(199805).cast("long")), f"{scratch}/k")
    assert k.groupBy("month_key").count().count() == 2 and k.count() == 10
    snap = spark.createDataFrame([(202301, "b1", 0, 202301, 0, 2, 1)], S.KPI_MONTH_RAW)
    io.stage_snapshot(snap, f"{scratch}/s")
    assert io.stage_snapshot(snap.withColumn("kpi_month", F.lit(202302)), f"{scratch}/s").count() == 2


def test_csv_counts_malformed_rows(spark, scratch):
    spark.createDataFrame([("2023-01-03,7020,d,N.01.B.02,5,D",), ("2023-01-04,7020,d,N.01.B.02,five,D",)], "v string") \
        .coalesce(1).write.text(f"{scratch}/csv")
    df = io.read_csv(spark, f"{scratch}/csv", S.TXN_RAW, header=False).cache()
    assert tuple(io.bad_records(df).first()) == (2, 1)
    assert df.where(F.col(io.BAD_RECORD).isNotNull()).first()[io.BAD_RECORD].endswith("five,D")


def test_close_leaves_nothing_behind(spark):
    import os
    from branchbook.plans.books import Books
    b = Books.from_testdata(spark, "/root/testdata/sf0.01", months=[199705], materialize="table", strict=False)
    b.asm.count()
    path = b.folder.path.removeprefix("file:")
    assert os.listdir(path)
    b.close()
    assert not os.path.exists(path) and not b.cells.is_cached


def test_reconcile_reports_planted_faults(spark):
    from branchbook.operators import checks
    rows = [("a", "B", 5), ("a", "B", 6), ("b", "B", 7), ("c", "C", 8)]
    raw = spark.createDataFrame(rows, "account_code string, area_code string, amount long")
    bad = spark.createDataFrame([("a", "B", 5), ("b", "B", 9), ("c", "C", 8), ("d", "D", 1)],
                                "account_code string, area_code string, amount long")
    got = {r.account_code: r.status for r in checks.reconcile(raw, bad, ["account_code", "area_code"], "amount").collect()}
    assert got == {"a": "mismatch", "b": "mismatch", "c": "match", "d": "missing_in_raw"}


def test_sql_surface_runs_the_original_names(spark):
    from branchbook.plans.books import Books
    from branchbook.plans.catalog import register_views
    b = Books.from_testdata(spark, "/root/testdata/sf0.01", months=[199701, 199702, 199703, 199704, 199705],
                            materialize="table", strict=False)
    names = register_views(spark, b)
    assert "view_report_finance" in names and "report_finance_table" in names
    assert spark.sql("SELECT COUNT(*) AS n FROM report_finance_table WHERE month_key = 199705").first().n == 192
    top = spark.sql("SELECT * FROM view_heat_map").collect()
    assert len(top) == 150 and [r.month_key for r in top] == sorted(r.month_key for r in top)
    chart = spark.sql("SELECT * FROM view_col_chart WHERE month_key = 199701").collect()
    assert 0 < len(chart) <= 20
    assert spark.sql("SELECT COUNT(*) AS n FROM view_report_finance").first().n == 160


def test_bwo_zero_total_raises_like_the_original(spark):
    import pytest
    from pyspark.errors import PySparkException
    from branchbook.operators import ratios as RR
    snap = spark.createDataFrame([(202301, "b1", 0, 202301, 0, 2, 1)], S.KPI_MONTH_RAW)
    prov = spark.createDataFrame([("01", "b1", "B")], S.DIM_PROVINCE)
    cells = RR.snapshot_cells(snap, prov)
    with pytest.raises(PySparkException, match="(?i)divi"):
        RR.pre_writeoff_ratios(cells, RR.month_frame(spark, [202301])).collect()


def test_col_chart_drops_null_area_rows(spark):
    from branchbook.operators import views
    rep = spark.createDataFrame([(M, 1, None, D(5)), (M, 1, "B", D(7))],
                                "month_key int, id int, area_code string, amount decimal(38,10)")
    out = views.col_chart(rep, seeds.areas_df(spark), seeds.pnl_tree_df(spark)).collect()
    assert [(r.area_name, r.monthly_amount) for r in out] == [(seeds.AREAS[1][1], D(7))]


def test_materialization_modes_agree(spark):
    """Written tables, cached frames and a fully lazy plan give the same report."""
    from branchbook.plans.books import Books
    months = [199703, 199705]
    out = {}
    for mode in ("table", "persist", None):
        b = Books.from_testdata(spark, "/root/testdata/sf0.01", months=months, materialize=mode, strict=False)
        out[mode] = sorted((r.month_key, r.id, r.area_code or "", r.amount) for r in b.finance.collect())
        b.close()
    assert out["table"] == out["persist"] == out[None] and len(out["table"]) == 2 * 192
