"""Prefix sums over months, and the year to date, against direct sums."""

import random

import pytest
from pyspark.sql import functions as F

from branchbook.operators import ratios as R


@pytest.mark.parametrize("ytd", [False, True])
def test_sums_up_to_each_report_month(spark, ytd):
    r = random.Random(3)
    calendar = [y * 100 + m for y in (2021, 2022, 2023) for m in range(1, 13)]
    rows = [(r.choice(calendar[:30] + [None]), r.choice(["a", "b", None]), r.choice([None, 1, 5, -2]), r.choice([None, 10]))
            for _ in range(120)] + [(202312, "late", None, 1)]
    report = sorted(r.sample(calendar, 20)) + [202506]
    df = spark.createDataFrame(rows, "m int, k string, v long, w long")
    got = R.cumulate_to_months(df, R.month_frame(spark, report), "m", ["k"], {"v": F.col("v"), "w": F.col("w") * 2}, ytd)
    assert got.columns == ["report_month", "k", "v", "w"]

    def total(values):
        values = [x for x in values if x is not None]
        return sum(values) if values else None

    want = {}
    for p in report:
        for k in {x[1] for x in rows}:
            mine = [x for x in rows if x[0] is not None and x[1] == k and x[0] <= p and (not ytd or x[0] // 100 == p // 100)]
            if mine:
                want[p, k] = (total(x[2] for x in mine), total(x[3] and 2 * x[3] for x in mine))
    assert {(x.report_month, x.k): (x.v, x.w) for x in got.collect()} == want


def test_the_step_to_report_months_makes_no_more_rows_than_the_result(spark):
    """240 months of one key: 240 rows, not 240 * 241 / 2."""
    months = [y * 100 + m for y in range(2001, 2021) for m in range(1, 13)]
    df = spark.createDataFrame([(m, "k", 1) for m in months], "m int, k string, v long")
    got = R.cumulate_to_months(df, R.month_frame(spark, months), "m", ["k"], {"v": F.col("v")})
    assert [x.v for x in got.orderBy("report_month").collect()] == list(range(1, 241))
    # an interval [month, next month) per row is all that is handed on
    assert "lead(" in got._jdf.queryExecution().optimizedPlan().toString()
