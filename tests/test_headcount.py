"""Kept headcount bitmaps equal COUNT DISTINCT, load by load."""

import random

from branchbook.operators import headcount as H
from branchbook.operators import ratios as R
from branchbook.plans import runner
from branchbook.sources import schemas as S, seeds
from branchbook.sources.scratch import RunFolder


def sheet(spark, loads, seed, n=300):
    r = random.Random(seed)
    areas = [a[1] for a in seeds.AREAS[:4]] + ["Nowhere", None]
    rows = [(r.choice(loads), r.choice(areas), r.choice([None, *(f"p{i}" for i in range(40))]), "e", r.randint(1, 5),
             r.choice([None, 5, 6]), 1, 1, 1, .5) for _ in range(n)]
    return spark.createDataFrame(rows, S.FACT_KPI_ASM)


def cells(df):
    return sorted(map(str, (tuple(r) for r in df.select("month_col", "area_code", "n_sales", "is_total").collect())))


def test_bitmaps_of_loads_merge_to_the_distinct_count(spark):
    areas, store = seeds.areas_df(spark), RunFolder(spark).write
    first, second = sheet(spark, [202301], 1), sheet(spark, [202302, 202303], 2)
    names = H.new_names(first, spark.createDataFrame([], H.DICTIONARY), store)
    more = H.new_names(second, names, store)
    every = names.unionByName(more)
    rows = every.collect()
    assert sorted(r.number for r in rows) == list(range(len(rows))) and len({r.sale_name for r in rows}) == len(rows)
    kept = H.headcount_bitmaps(first, areas, names).unionByName(H.headcount_bitmaps(second, areas, every))
    assert cells(H.merged_headcount(kept)) == cells(R.headcount_cells(first.unionByName(second), areas))
    assert H.merged_headcount(kept.limit(0)).collect() == []


def test_a_new_load_reads_its_own_sheet_only(spark, scratch, monkeypatch):
    t = runner.Tables(*[f"{scratch}/{x}" for x in ("p", "s", "k", "rate", "fin", "asm", "log")], headcount_by_load=f"{scratch}/h")
    a, b, again = sheet(spark, [202301], 3), sheet(spark, [202302], 4), sheet(spark, [202301], 5)
    read = []
    real = runner.Publisher.read

    def spy(self, table, schema, **kw):
        if table == t.kpi_asm:
            read.append(kw.get("months"))
        return real(self, table, schema, **kw)

    monkeypatch.setattr(runner.Publisher, "read", spy)
    for df, load in ((a, 202301), (b, 202302), (again, 202301)):
        p = runner.Publisher(spark, runner.log_of(t.kpi_asm))
        p.stage(df, t.kpi_asm, "month_key", fingerprint=True)
        p.commit()
        runner.refresh_headcount(spark, t, [load])
    assert read == [[202301], [202302], [202301]]
    want = R.headcount_cells(again.unionByName(b), seeds.areas_df(spark))
    assert cells(runner.kept_headcount(spark, t)) == cells(want)
