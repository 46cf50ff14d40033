"""Monthly runner: month replacement, best-effort steps, error log, re-runs."""

import dataclasses
import os

from pyspark.sql import functions as F

from branchbook.plans import runner
from branchbook.sources import bindings, io, schemas as S

MONTHS = [199701, 199702, 199703, 199704, 199705]


def stage(spark, sf_dir, root):
    """Load a test scale's domain tables into Parquet, as an ingest would."""
    os.makedirs(root, exist_ok=True)
    io.stage_postings(bindings.txn_raw(spark, sf_dir), f"{root}/postings")
    io.stage_snapshot(bindings.kpi_month_raw(spark, sf_dir), f"{root}/snapshot")
    io.stage_kpi_sheet(bindings.kpi_asm_wide(spark, sf_dir), f"{root}/kpi_asm")
    bindings.dim_area(spark, sf_dir).write.parquet(f"{root}/areas")
    bindings.dim_province(spark, sf_dir).write.parquet(f"{root}/provinces")
    return root


def tables(inp, out):
    return runner.Tables(postings=f"{inp}/postings", snapshot=f"{inp}/snapshot", kpi_asm=f"{inp}/kpi_asm",
                         areas=f"{inp}/areas", provinces=f"{inp}/provinces",
                         rate_table=f"{out}/rate", finance_table=f"{out}/finance", asm_table=f"{out}/asm",
                         error_log=f"{out}/error_log")


def snapshot_of(spark, t, name):
    return sorted(tuple(r) for r in runner.read_output(spark, t, name, MONTHS).collect())


def test_run_month_good_then_failing_month_keeps_old_ratios(spark, scratch):
    good = stage(spark, "/root/testdata/sf0.01", f"{scratch}/in01")
    bad = stage(spark, "/root/testdata/sf0.001", f"{scratch}/in001")
    out = f"{scratch}/out"
    assert runner.run_month(spark, tables(good, out), MONTHS) == []
    rates_before = snapshot_of(spark, tables(good, out), "rates")
    fin_before = snapshot_of(spark, tables(good, out), "finance")
    asm_before = snapshot_of(spark, tables(good, out), "asm")
    assert len(rates_before) == 210 and len(fin_before) == 960 and len(asm_before) > 0

    # with kept monthly aggregates the same reports come out, one month at a time
    kept = dataclasses.replace(tables(good, f"{scratch}/kept"), postings_by_month=f"{scratch}/kept/postings",
                               cells_by_month=f"{scratch}/kept/cells")
    history = [y * 100 + m for y in (1995, 1996) for m in range(1, 13)]
    assert runner.run_month(spark, kept, MONTHS[0], changed=[*history, MONTHS[0]]) == []
    assert runner.run_month(spark, kept, MONTHS[1], changed=[MONTHS[1]]) == []
    first_two = [r for r in fin_before if r[0] in MONTHS[:2]]
    assert [r for r in snapshot_of(spark, kept, "finance")] == first_two

    # idempotent: running the same months again changes nothing
    assert runner.run_month(spark, tables(good, out), MONTHS) == []
    assert snapshot_of(spark, tables(good, out), "finance") == fin_before

    # the smallest scale has (area, month) cells without write-offs: the ratio
    # step fails its NOT NULL check for every month, logs one row per month,
    # and the stored ratios stay; the later steps still run.
    log = runner.run_month(spark, tables(bad, out), MONTHS)
    assert [(p, m) for p, m, _ in log] == [("rate_area_month", m) for m in MONTHS]
    assert snapshot_of(spark, tables(good, out), "rates") == rates_before
    elog = runner.read_error_log(spark, tables(bad, out)).collect()
    assert len(elog) == 5 and all(r.start_time <= r.end_time for r in elog)
    assert all("not-null" in r.error_message for r in elog)
    fin_after = snapshot_of(spark, tables(good, out), "finance")
    assert fin_after != fin_before and len(fin_after) > 0


def test_runner_step_exception_is_logged_and_next_steps_run(spark, scratch):
    t = runner.Tables(postings=f"{scratch}/missing", snapshot=f"{scratch}/missing", kpi_asm=f"{scratch}/missing",
                      rate_table=f"{scratch}/rate", finance_table=f"{scratch}/fin", asm_table=f"{scratch}/asm",
                      error_log=f"{scratch}/log")
    log = runner.run_month(spark, t, 202301)
    assert [p for p, _, _ in log] == ["rate_area_month", "report_finance", "report_asm"]
    assert runner.read_error_log(spark, t).where(F.col("run_month") == 202301).count() == 3


def test_a_zero_month_fails_alone(spark, scratch):
    """BWO divides by a zero total in the first of three months only."""
    rows = [(202301, "b1", 0, 202301, 0, 2, 1)] + [(m, "b1", 50, m, 10, 2, 1) for m in (202302, 202303)]
    spark.createDataFrame(rows, S.KPI_MONTH_RAW).write.partitionBy("kpi_month").parquet(f"{scratch}/s")
    spark.createDataFrame([("01", "b1", "B")], S.DIM_PROVINCE).write.parquet(f"{scratch}/prov")
    io.stage_postings(spark.createDataFrame([], S.TXN_RAW), f"{scratch}/p")
    spark.createDataFrame([], S.FACT_KPI_ASM).write.parquet(f"{scratch}/k")
    t = runner.Tables(postings=f"{scratch}/p", snapshot=f"{scratch}/s", kpi_asm=f"{scratch}/k", rate_table=f"{scratch}/rate",
                      finance_table=f"{scratch}/fin", asm_table=f"{scratch}/asm", error_log=f"{scratch}/log",
                      provinces=f"{scratch}/prov")
    log = runner.run_month(spark, t, [202301, 202302, 202303], steps=("ratios",))
    assert [(p, m) for p, m, _ in log] == [("rate_area_month", 202301)]
    got = runner.read_output(spark, t, "rates")
    assert {r.rate_month for r in got.collect()} == {202302, 202303}


def test_a_step_that_fails_in_one_plan_is_tried_by_halves(spark, scratch):
    t = runner.Tables(*[f"{scratch}/{x}" for x in ("p", "s", "k", "rate", "fin", "asm", "log")])
    log, runs = [], []

    def step(months, start):
        runs.append(len(months))
        if 2 in months:
            raise ValueError("first line\n" + "x" * 3000)
        return list(months)

    assert runner._each(spark, t, "proc", list(range(1, 81)), log, step) == [1, *range(3, 81)]
    assert len(runs) <= 2 * 7 + 1                   # log2(80) levels, not 80 runs
    row = runner.read_error_log(spark, t).collect()
    assert len(row) == 1 and row[0].run_month == 2 and row[0].error_message.endswith("x" * 3000)


def test_the_log_holds_the_right_instant_off_utc(spark, scratch):
    import datetime as dt
    import time
    old, os.environ["TZ"] = os.environ.get("TZ"), "Asia/Ho_Chi_Minh"
    time.tzset()
    try:
        at = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
        io.append_error_log(spark, f"{scratch}/log", "p", 1, "m", at, at)
    finally:
        os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
        time.tzset()
    got = spark.read.schema(S.ERROR_LOG).parquet(f"{scratch}/log").select(F.unix_timestamp("start_time")).first()[0]
    assert got == int(at.timestamp())
