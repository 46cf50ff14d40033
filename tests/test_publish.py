"""Atomic month replacement, accumulating loads, and runs of what is stale."""

import dataclasses
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.plans import runner
from branchbook.sources import bindings, io, schemas as S
from branchbook.sources.publish import Publisher, log_of, open_table
from branchbook.streaming.trigger import incremental_trigger

SCHEMA = T.StructType([T.StructField("m", T.IntegerType()), T.StructField("v", T.StringType())])


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def content(p, base, **kw):
    return sorted(tuple(r) for r in p.read(base, SCHEMA, **kw).collect())


def test_months_are_replaced_and_emptied(spark, scratch):
    p, base = Publisher(spark, f"{scratch}/log"), f"{scratch}/t"
    assert content(p, base) == []
    assert p.stage(rows(spark, (1, "a"), (2, "b"), (2, "c"), (9, "not asked for")), base, "m", months=[1, 2]) == ["1", "2"]
    p.commit()
    assert content(p, base) == [(1, "a"), (2, "b"), (2, "c")]
    p.stage(rows(spark, (1, "z")), base, "m", months=[2])
    p.commit()
    assert content(p, base) == [(1, "a")]
    p.stage(rows(spark, (2, "q")), base, "m", months=[2])
    p.commit()
    assert content(p, base) == [(1, "a"), (2, "q")] and content(p, base, months=[2]) == [(2, "q")]
    assert content(p, base, upto=1) == [(1, "a")]
    assert len(p.vacuum(base)) == 1 and content(p, base) == [(1, "a"), (2, "q")]


def test_nothing_is_seen_before_the_commit(spark, scratch):
    """A run that dies between two tables, or two months, leaves the old set."""
    a, b, log = f"{scratch}/a", f"{scratch}/b", f"{scratch}/log"
    p = Publisher(spark, log)
    for t in (a, b):
        p.stage(rows(spark, (1, "old"), (2, "old")), t, "m")
    p.commit()
    run = Publisher(spark, log)
    run.stage(rows(spark, (1, "new")), a, "m", months=[1])
    run.stage(rows(spark, (2, "new")), a, "m", months=[2])
    assert content(run, a) == [(1, "new"), (2, "new")]            # the run itself reads what it has staged
    reader = Publisher(spark, log)
    assert content(reader, a) == content(reader, b) == [(1, "old"), (2, "old")]
    assert content(run, a, pending=False) == [(1, "old"), (2, "old")]
    run.stage(rows(spark, (1, "new")), b, "m", months=[1, 2])
    files = len(glob.glob(f"{log}/*.parquet"))
    run.commit()
    assert len(glob.glob(f"{log}/*.parquet")) == files + 1          # one file makes all of it visible
    assert content(reader, a) == [(1, "new"), (2, "new")] and content(reader, b) == [(1, "new")]
    dead = Publisher(spark, log)
    dead.stage(rows(spark, (1, "lost")), a, "m")
    assert any("version=" in x for x in Publisher(spark, log).vacuum(a)) and content(reader, a) == [(1, "new"), (2, "new")]


def test_loads_keep_each_others_rows_without_a_month(spark, scratch):
    def load(date, amount, **kw):
        raw = spark.createDataFrame([(dt.date(2023, date, 3), "7020", "d", "N.01.B.02", amount, "D"),
                                     (None, "7020", "d", "N.01.B.02", amount * 100, "D")], S.TXN_RAW)
        return sorted((r.post_month or 0, r.amount) for r in io.stage_postings(raw, f"{scratch}/p", **kw).collect())

    load(1, 1)
    assert load(2, 2) == [(0, 100), (0, 200), (202301, 1), (202302, 2)]
    assert load(2, 2) == [(0, 100), (0, 200), (202301, 1), (202302, 2)]       # the same load replaces itself
    assert load(2, 3, load_id="feb")[:3] == [(0, 100), (0, 200), (0, 300)]
    assert load(2, 4, load_id="feb") == [(0, 100), (0, 200), (0, 400), (202301, 1), (202302, 4)]
    assert load(2, 5, append=True, load_id="more") == [(0, 100), (0, 200), (0, 400), (0, 500), (202301, 1), (202302, 4), (202302, 5)]


def test_a_large_month_is_written_by_many_tasks(spark, scratch):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(400_000, numPartitions=64).select(
            F.when(F.col("id") < 390_000, 1).otherwise((F.col("id") % 40 + 2).cast("int")).alias("m"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"))
        p = Publisher(spark, f"{scratch}/log")
        p.stage(df, f"{scratch}/t", "m")
        p.commit()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {m: len(glob.glob(f"{scratch}/t/version=*/slot={m}/*.parquet")) for m in (1, 2, 41)}
    assert files[1] >= 20 and files[2] <= 2 and files[41] <= 2
    assert p.read(f"{scratch}/t", SCHEMA).count() == 400_000


def test_fingerprints_tell_changed_months(spark, scratch):
    p = Publisher(spark, f"{scratch}/log")

    def prints(*data):
        p.stage(rows(spark, *data), f"{scratch}/t", "m", fingerprint=True)
        p.commit()
        return p.fingerprint(f"{scratch}/t")

    first = prints((1, "a"), (1, "b"), (2, None), (None, "x"))
    assert set(first) == {"1", "2"}
    assert prints((1, "b"), (1, "a")) == first                    # order does not matter
    assert prints((1, "b"), (1, "a"), (1, "a"))["1"] != first["1"]
    assert prints((2, ""))["2"] != first["2"]


def test_stale_months():
    months = [202301, 202302, 202303]
    assert runner.stale_months(months) == {"ratios": [], "finance": [], "asm": []}
    assert runner.stale_months(months, postings=["202302"]) == {"ratios": [], "finance": months[1:], "asm": months[1:]}
    assert runner.stale_months(months, snapshot=["202303"], postings=["202302"]) == {
        "ratios": months[2:], "finance": months[1:], "asm": months[1:]}
    assert runner.stale_months(months, sheet=True)["ratios"] == months


@pytest.fixture(scope="module")
def staged(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="branchbook-test-")
    sf = "/root/testdata/sf0.01"
    bindings.dim_area(spark, sf).write.parquet(f"{root}/areas")
    bindings.dim_province(spark, sf).write.parquet(f"{root}/provinces")
    io.stage_snapshot(bindings.kpi_month_raw(spark, sf), f"{root}/snapshot")
    io.stage_kpi_sheet(bindings.kpi_asm_wide(spark, sf), f"{root}/kpi_asm")
    return root


def warehouse(staged, root):
    return runner.Tables(postings=f"{root}/postings", snapshot=f"{staged}/snapshot", kpi_asm=f"{staged}/kpi_asm",
                         areas=f"{staged}/areas", provinces=f"{staged}/provinces", rate_table=f"{root}/rate",
                         finance_table=f"{root}/fin", asm_table=f"{root}/asm", error_log=f"{root}/log",
                         postings_by_month=f"{root}/kept/p", cells_by_month=f"{root}/kept/c")


def reports(spark, t):
    return {n: sorted(map(str, map(tuple, runner.read_output(spark, t, n).collect()))) for n in ("rates", "finance")}


def test_a_run_of_stale_months_equals_a_full_run(spark, scratch, staged, monkeypatch):
    raw = bindings.txn_raw(spark, "/root/testdata/sf0.01").cache()
    late = (F.col("transaction_date") >= "1997-03-01") & (F.col("transaction_date") < "1997-03-11")
    months = [199701, 199702, 199703, 199704]
    monkeypatch.setitem(runner.STEPS, "asm", lambda spark, t, months, log, out: list(months))
    t = warehouse(staged, f"{scratch}/a")
    io.stage_postings(raw.where(~late), t.postings)
    todo, log = runner.run_changed(spark, t, months)
    assert log == [] and todo["ratios"] == todo["finance"] == months
    assert runner.run_changed(spark, t, months) == ({"ratios": [], "finance": [], "asm": []}, [])
    raw.where(late).write.parquet(f"{scratch}/arrived")
    incremental_trigger(spark, f"{scratch}/arrived", f"{scratch}/ck", t)
    done = [e for e in runner.publisher(spark, t).entries() if e.table == t.finance_table]
    assert [e.slot for e in done] == [str(m) for m in months + months[2:]]          # only stale months ran again
    assert len([e for e in runner.publisher(spark, t).entries() if e.table == t.rate_table]) == 4
    full = warehouse(staged, f"{scratch}/b")
    io.stage_postings(raw, full.postings)
    assert runner.run_month(spark, dataclasses.replace(full, postings_by_month=None, cells_by_month=None), months) == []
    assert reports(spark, t) == reports(spark, full)
    # a batch that is tried again loads and runs nothing twice
    n = open_table(spark, t.postings, S.TXN).count()
    assert n == raw.count() and Publisher(spark, log_of(t.postings)).has_commit(f"{scratch}/ck#0")
    raw.unpersist()


def test_a_killed_run_changes_nothing(spark, scratch, staged, monkeypatch):
    t = dataclasses.replace(warehouse(staged, scratch), postings_by_month=None, cells_by_month=None)
    io.stage_postings(bindings.txn_raw(spark, "/root/testdata/sf0.01"), t.postings)
    months = [199701, 199702]
    assert runner.run_month(spark, t, months, steps=("ratios", "finance")) == []
    before = reports(spark, t)
    stage, calls = Publisher.stage, []

    def dies(self, df, table, *a, **kw):
        calls.append(table)
        if table == t.finance_table:
            stage(self, df, table, *a, **kw)
            raise KeyboardInterrupt             # the driver is killed after the tables were written
        return stage(self, df.withColumn("ratio", (F.col("ratio") * 2).cast("decimal(18,10)")), table, *a, **kw)

    monkeypatch.setattr(Publisher, "stage", dies)
    with pytest.raises(KeyboardInterrupt):
        runner.run_month(spark, t, months, steps=("ratios", "finance"))
    assert len(calls) == 2 and reports(spark, t) == before


def test_failed_months_are_tried_again(spark, scratch, staged, monkeypatch):
    t = warehouse(staged, scratch)
    io.stage_postings(bindings.txn_raw(spark, "/root/testdata/sf0.01"), t.postings)
    ran = []

    def step(name, bad):
        def f(spark, t, months, log, out):
            ran.append((name, list(months)))
            log += [(name, m, "x") for m in months if m in bad]
            runner._stage(out, t, "finance", spark.createDataFrame([(m, 1, "A", None) for m in months], S.REPORT_FINANCE), months)
        return f

    monkeypatch.setattr(runner, "STEPS", {"finance": step("finance", [199702])})
    runner.run_changed(spark, t, [199701, 199702])
    monkeypatch.setattr(runner, "STEPS", {"finance": step("finance", [])})
    runner.run_changed(spark, t)
    runner.run_changed(spark, t)
    assert ran == [("finance", [199701, 199702]), ("finance", [199702])]


def test_postings_are_decoded_where_they_are_written(spark, scratch):
    """Only the raw columns move; the stored rows are those of decoding first."""
    import datetime as dt
    from branchbook.operators import reshape
    from branchbook.sources import io
    raw = spark.createDataFrame([(dt.date(2023, 1, 5), "7020", "GL", "NU.01.B.05.POS_7", 5, "D"), (None, "7021", "GL", None, 6, "C")], S.TXN_RAW)
    moved = io.stage_postings(raw, f"{scratch}/p")
    want = reshape.decode_analysis_code(raw).withColumn("post_month", F.when(F.col("transaction_date").isNotNull(), 202301))
    assert moved.columns == want.columns and sorted(map(str, moved.collect())) == sorted(map(str, want.collect()))
