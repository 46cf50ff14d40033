"""Allocation-ratio methods: hand-computed cases and the running-sum equivalence."""

import random
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from branchbook.operators import pnl, ratios as R
from branchbook.sources import schemas as S

PROV = [("01", "b1", "B"), ("02", "c1", "C")]
AREAS = [("A", "Head", "00"), ("B", "Bee", "01"), ("C", "Cee", "01")]


def snap(spark, rows):
    """rows: (kpi_month, city, op, wo_month, wo_bal, bucket, psdn)"""
    return spark.createDataFrame(rows, S.KPI_MONTH_RAW)


def kpi(spark, rows):
    """rows: (month_col, area_name, sale_name, loan)"""
    return spark.createDataFrame([(202305, a, s, f"{s}@x", m, loan, 1, 1, 1, 0.5) for m, a, s, loan in rows],
                                 S.FACT_KPI_ASM)


def test_bwo_gap_falls_into_null_area_and_fails_strict(spark):
    s = snap(spark, [(202301, "b1", 100, 202301, 10, 2, 1), (202302, "b1", 100, None, 0, 2, 1)])
    prov = spark.createDataFrame(PROV, S.DIM_PROVINCE)
    areas = spark.createDataFrame(AREAS, S.DIM_AREA)
    k = kpi(spark, [(2, "Bee", "x", 1)])
    months = R.month_frame(spark, [202302])
    loose = R.allocation_ratios(s, k, prov, areas, months, strict=False).where(F.col("method_code") == "BWO_GR2_5")
    got = sorted(((r.area_code, r.ratio) for r in loose.collect()), key=str)
    assert (None, None) in got and ("B", D("1.0000000000")) in got
    with pytest.raises(PySparkException):
        R.allocation_ratios(s, k, prov, areas, months, strict=True).collect()
    bad = R.ratio_violations(R.allocation_ratios(s, k, prov, areas, months, strict=False)).collect()
    assert [(r.rate_month, r.null_area, r.null_ratio) for r in bad] == [(202302, 1, 1)]


def test_running_writeoff_has_no_gap_rows(spark):
    s = snap(spark, [(202301, "b1", 1, 202301, 10, 1, 1), (202302, "b1", 1, None, 99, 1, 1),
                     (202303, "b1", 1, 202303, 5, 1, 1)])
    prov = spark.createDataFrame(PROV, S.DIM_PROVINCE)
    out = R.cumulative_writeoff(R.snapshot_cells(s, prov)).orderBy("month_key").collect()
    assert [(r.month_key, r.area_code, r.total_lk) for r in out] == [(202301, "B", 10), (202303, "B", 15)]


def test_window_running_sum_equals_theta_self_join(spark):
    rng = random.Random(7)
    rows = []
    for m in [202301, 202302, 202303, 202305, 202307, 202312]:
        for city in ["b1", "c1", "zz"]:
            for _ in range(rng.randint(0, 3)):
                wo = m if rng.random() < 0.6 else None
                rows.append((m, city, rng.randint(0, 1000), wo, rng.choice([None, rng.randint(0, 50)]),
                             rng.choice([None, 1, 2, 3, 5]), rng.randint(0, 4)))
    s = snap(spark, rows)
    prov = spark.createDataFrame(PROV, S.DIM_PROVINCE)
    fast = {(r.month_key, r.area_code): r.total_lk for r in R.cumulative_writeoff(R.snapshot_cells(s, prov)).collect()}
    area = {r[1]: r[2] for r in PROV}
    booked = {}
    for m, city, _, wo, amount, _, _ in rows:
        if wo == m and city in area:
            booked.setdefault(area[city], {}).setdefault(m, []).append(amount)
    want = {}
    for code, by_month in booked.items():
        total = None
        for m in sorted(by_month):
            known = [x for x in by_month[m] if x is not None]
            if known:
                total = (total or 0) + sum(known)
            want[m, code] = total
    assert fast == want


def test_sm_count_share_and_headcount_line(spark):
    areas = spark.createDataFrame(AREAS, S.DIM_AREA)
    k = kpi(spark, [(5, "Bee", "X", 1), (5, "Cee", "X", 1), (5, "Bee", "Y", 1), (5, "Bee", "Z", None)])
    months = R.month_frame(spark, [202305])
    hc = R.headcount_cells(k, areas)
    share = {r.area_code: r.ratio for r in R.headcount_ratios(hc, months).collect()}
    assert abs(float(share["B"]) - 2 / 3) < 1e-15 and abs(float(share["C"]) - 1 / 3) < 1e-15
    line = {r.area_code: r.amount for r in pnl.headcount_line(hc, months).collect()}
    assert line == {"B": D(2), "C": D(1), "A": D(2)}


def test_sm_count_in_june_gives_only_head_row(spark):
    s = snap(spark, [(202301, "b1", 100, 202301, 10, 2, 1)])
    prov = spark.createDataFrame(PROV, S.DIM_PROVINCE)
    areas = spark.createDataFrame(AREAS, S.DIM_AREA)
    k = kpi(spark, [(5, "Bee", "X", 1)])
    months = R.month_frame(spark, [202306])
    out = R.allocation_ratios(s, k, prov, areas, months).where(F.col("method_code") == "SM_COUNT").collect()
    assert [(r.area_code, r.ratio) for r in out] == [("A", D(0))]
    line = [(r.area_code, r.amount) for r in pnl.headcount_line(R.headcount_cells(k, areas), months).collect()]
    assert line == [("A", D(0))]


def test_head_rows_carry_their_own_method_names(spark):
    from branchbook.sources import seeds
    rows = R.head_zero_rows(R.month_frame(spark, [202301])).collect()
    assert sorted((r.method_code, r.method_name) for r in rows) == sorted(seeds.HEAD_METHOD_NAMES)
    assert {r.area_code for r in rows} == {"A"} and {r.ratio for r in rows} == {D(0)}
