import datetime as dt

from branchbook.sources import schemas as S
from branchbook.streaming import monthly_trigger


def _postings(spark, dates):
    rows = [(d, "702000030002", "x", "NU.01.B.02", "NU", "01", "B", "02", None, 10, "D") for d in dates]
    return spark.createDataFrame(rows, S.TXN)


def test_trigger_runs_new_months_once(spark, scratch):
    src, ck = f"{scratch}/postings", f"{scratch}/ck"
    seen = []
    _postings(spark, [dt.date(2023, 1, 5), dt.date(2023, 2, 7)]).coalesce(1).write.parquet(src)
    monthly_trigger(spark, src, ck, seen.append)
    assert seen == [[202301, 202302]]
    monthly_trigger(spark, src, ck, seen.append)       # nothing new: no call
    assert seen == [[202301, 202302]]
    _postings(spark, [dt.date(2023, 3, 1)]).coalesce(1).write.mode("append").parquet(src)
    monthly_trigger(spark, src, ck, seen.append)
    assert seen == [[202301, 202302], [202303]]
    # a late posting: every later reported month is stale
    _postings(spark, [dt.date(2023, 2, 9)]).coalesce(1).write.mode("append").parquet(src)
    monthly_trigger(spark, src, ck, seen.append, reported=lambda: [202301, 202302, 202303])
    assert seen[-1] == [202302, 202303]
