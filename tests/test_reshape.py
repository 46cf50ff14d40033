import datetime as dt

from pyspark.sql import functions as F

from branchbook.functions.columns import month_end
from branchbook.operators import reshape
from branchbook.sources import schemas as S


def test_unpivot_emits_five_rows_even_when_all_null(spark):
    wide = [(199705, "X", "s1", "e1") + tuple([None] * 25)]
    vals = [199705, "Y", "s2", "e2"]
    for suffix, _, _ in S.WIDE_MEASURES:
        for i in range(1, 6):
            vals.append(0.5 * i if suffix == "approval_rate" else i * 10)
    df = spark.createDataFrame(wide + [tuple(vals)], S.KPI_ASM_WIDE)
    out = reshape.unpivot_kpi(df)
    assert out.schema == S.FACT_KPI_ASM
    rows = out.orderBy("sale_name", "month_col").collect()
    assert len(rows) == 10
    assert [r.month_col for r in rows[:5]] == [1, 2, 3, 4, 5]
    assert all(r.loan_to_new is None and r.approval_rate is None for r in rows[:5])
    # measures move in step: month m takes the m-th column of every measure
    r3 = rows[7]
    assert (r3.month_col, r3.loan_to_new, r3.psdn, r3.app_approved, r3.app_in, r3.approval_rate) == (3, 30, 30, 30, 30, 1.5)


def test_decode_analysis_code(spark):
    raw = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "702000030002", "d", "N.01.B.02.POS_77.x", 5, "D"),
         (dt.date(2024, 1, 5), "702000030002", "d", "N.01", 5, "D"),
         (dt.date(2024, 1, 5), "702000030002", "d", None, 5, "D")], S.TXN_RAW)
    out = reshape.decode_analysis_code(raw).collect()
    assert (out[0].network_unit, out[0].region_code, out[0].area_code, out[0].province_code, out[0].pos_code) == \
        ("N", "01", "B", "02", "POS_77")
    assert (out[1].network_unit, out[1].region_code, out[1].area_code, out[1].province_code, out[1].pos_code) == \
        ("N", "01", "", "", None)
    assert (out[2].network_unit, out[2].area_code, out[2].pos_code) == (None, None, None)


def test_month_end(spark):
    r = spark.createDataFrame([(202402,), (202312,), (202304,)], "m int").select(month_end("m").alias("d")).collect()
    assert [x.d for x in r] == [dt.date(2024, 2, 29), dt.date(2023, 12, 31), dt.date(2023, 4, 30)]


def test_unpivot_on_test_binding_is_five_times_sheet(spark):
    from branchbook.sources import bindings
    wide = bindings.kpi_asm_wide(spark, "/root/testdata/sf0.001")
    assert reshape.unpivot_kpi(wide).count() == 5 * wide.count()
    assert reshape.unpivot_kpi(wide).where(F.col("month_col").isNull()).count() == 0


def test_the_sheet_moves_no_orders_of_months_it_does_not_show(spark, tmp_path):
    import datetime as dt
    from branchbook.sources import bindings
    spark.createDataFrame([(i, 1, 2.0 + i, "N", dt.datetime(y, m, 3)) for i, (y, m) in enumerate([(1995, 2), (1995, 2), (1995, 9), (1996, 11), (1996, 12)])],
                          "l_orderkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "s", 0)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    wide = bindings.kpi_asm_wide(spark, str(tmp_path))
    assert sorted((r.month_key, r.feb_psdn, r.feb_loan, r.may_psdn) for r in wide.collect()) == [(199505, 2, 500, None), (199605, None, None, None)]
    assert "THEN l_orderkey" in wide._jdf.queryExecution().optimizedPlan().toString()
