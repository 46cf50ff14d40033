"""Ranking semantics (NULL order, tie-breaks) and the report views."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from branchbook.operators import asm as A
from branchbook.operators import views
from branchbook.sources import schemas as S, seeds
from branchbook.sources.scratch import RunFolder

M = 202305


def _rank_inputs(spark, cir, npl, hs_von):
    people = ["p1", "p2", "p3"]
    avg = spark.createDataFrame(
        [(M, "Bee", p, f"{p}@x", float(10 - i), 1, float(i), 1, 0.5, 1) for i, p in enumerate(people)],
        "month_key int, area_name string, sale_name string, email string, ltn_avg double, n_ltn long, "
        "psdn_avg double, n_psdn long, approval_rate_avg double, n_ar long")
    npl_asm = spark.createDataFrame([(M, "Bee", p, f"{p}@x", v) for p, v in zip(people, npl)],
                                    "month_key int, area_name string, sale_name string, email string, "
                                    "npl_truoc_wo_luy_ke double")
    look = []
    for p, c, h in zip(people, cir, hs_von):
        look.append((M, "Bee", p, f"{p}@x", 29, None if c is None else D(c)))
        look.append((M, "Bee", p, f"{p}@x", 31, D(h)))
    lookup = spark.createDataFrame(look, "month_key int, area_name string, sale_name string, email string, "
                                         "id int, amount decimal(38,10)")
    return {r.email: r for r in A.asm_rank(avg, npl_asm, lookup, RunFolder(spark).write).collect()}


def test_null_sorts_as_largest(spark):
    r = _rank_inputs(spark, cir=[10, None, 30], npl=[10.0, None, 10.0], hs_von=[5, 5, 9])
    # CIR dense rank DESC: NULL first
    assert (r["p2@x"].rank_cir, r["p3@x"].rank_cir, r["p1@x"].rank_cir) == (1, 2, 3)
    # NPL rank ASC: NULL last, ties share a rank
    assert (r["p1@x"].rank_npl, r["p3@x"].rank_npl, r["p2@x"].rank_npl) == (1, 1, 3)
    # return on funding: dense rank ascending
    assert (r["p1@x"].rank_hs_von, r["p2@x"].rank_hs_von, r["p3@x"].rank_hs_von) == (1, 1, 2)
    # margin/per-head missing for everybody: all NULL -> all rank 1
    assert {x.rank_margin for x in r.values()} == {1}


def test_row_number_ties_are_broken_by_email(spark):
    r = _rank_inputs(spark, cir=[1, 1, 1], npl=[1.0, 1.0, 1.0], hs_von=[1, 1, 1])
    # approval averages tie (0.5 each): email order decides
    assert [r[e].rank_approval for e in ("p1@x", "p2@x", "p3@x")] == [1, 2, 3]


def test_scores_and_final_ranks(spark):
    r = _rank_inputs(spark, cir=[10, None, 30], npl=[10.0, None, 10.0], hs_von=[5, 5, 9])
    avg = spark.createDataFrame([(M, "Bee", "p1", "p1@x", 1.0, 1, 1.0, 1, 0.5, 1)],
                                "month_key int, area_name string, sale_name string, email string, ltn_avg double, "
                                "n_ltn long, psdn_avg double, n_psdn long, approval_rate_avg double, n_ar long")
    assert r  # ranks computed
    ranked = A.asm_rank(avg, spark.createDataFrame([], "month_key int, area_name string, sale_name string, "
                                                        "email string, npl_truoc_wo_luy_ke double"),
                        spark.createDataFrame([], "month_key int, area_name string, sale_name string, "
                                                  "email string, id int, amount decimal(38,10)"),
                        RunFolder(spark).write)
    out = A.asm_score(ranked, RunFolder(spark).write).collect()
    assert len(out) == 1 and out[0].tong_diem == 8 and out[0].rank_final == 1 and out[0].rank_fin == 1
    assert [f.name for f in A.asm_score(ranked, RunFolder(spark).write).schema.fields] == [f.name for f in S.REPORT_ASM.fields]


def _report(spark, rows):
    return spark.createDataFrame(rows, "month_key int, id int, area_code string, amount decimal(38,10)")


def test_crosstab_columns_and_text_month(spark):
    rep = _report(spark, [(M, 3, "A", D(1)), (M, 3, "B", D(2)), (M, 3, "Z", D(9)), (M, 99, "B", D(3))])
    x = views.report_finance_crosstab(rep, seeds.areas_df(spark), seeds.pnl_tree_df(spark))
    names = [a[1] for a in seeds.AREAS]
    assert x.columns == ["month_key", "pnl_name", "sortorder"] + names
    rows = x.collect()
    assert len(rows) == 1  # line 99 is not in the tree; area Z fills no column
    r = rows[0]
    assert r.month_key == str(M) and r.pnl_name == "Lãi trong hạn"
    vals = [r[n] for n in names]
    assert vals[:2] == [D(1), D(2)] and vals[2:] == [None] * 6


def test_col_chart_null_and_gap(spark):
    rep = _report(spark, [(202301, 1, "B", D(5)), (202302, 1, "B", None), (202303, 1, "B", D(9)),
                          (202301, 20, "B", D(5)), (202303, 20, "B", D(9)), (202301, 20, "A", D(1))])
    out = views.col_chart(rep, seeds.areas_df(spark), seeds.pnl_tree_df(spark)).collect()
    by = {(r.pnl_name, r.month_key): r.monthly_amount for r in out}
    p1, p20 = seeds.PNL_TREE[0][2], seeds.PNL_TREE[19][2]
    assert [by[(p1, m)] for m in (202301, 202302, 202303)] == [D(5), None, D(9)]
    assert [by[(p20, m)] for m in (202301, 202303)] == [D(5), D(4)]
    assert len(out) == 5  # the head-office row is filtered before the LAG


def test_heat_map_small_month_keeps_everybody_once(spark):
    rows = []
    for i in range(4):
        rows.append(tuple([M, "Bee", f"p{i}@x", 8 + i, i + 1, 1.0, 1, 2.0, 1, 0.5, 1, 3.0, 1, 4, 1,
                           -7.5, 1, 1.0, 1, 1.0, 1, 1.0, 1, 4, 1]))
    rep = spark.createDataFrame(rows, S.REPORT_ASM)
    out = views.heat_map(rep).collect()
    assert len(out) == 20
    assert {r.email for r in out} == {f"p{i}@x" for i in range(4)}
    assert {r.value for r in out if r.kpi == seeds.HEAT_MAP_KPIS[4][0]} == {7.5}  # |CIR|


def test_heat_map_picks_top_and_bottom_three(spark):
    rows = [tuple([M, "Bee", f"p{i}@x", i, i + 1] + [1.0, 1] * 4 + [4, 1] + [1.0, 1] * 4 + [4, 1])
            for i in range(10)]
    rep = spark.createDataFrame(rows, S.REPORT_ASM)
    ranks = sorted({r.rank_for_sort for r in views.heat_map(rep).collect()})
    assert ranks == [1, 2, 3, 8, 9, 10]


def _sheet(spark, rows):
    return spark.createDataFrame(rows, S.FACT_KPI_ASM)


def test_rows_by_month_of_the_year_equal_the_joins_by_month(spark):
    """Emails under two names and areas, missing ones, an area name with two codes, lines that are missing, doubled or NULL."""
    names = [f.name for f in S.FACT_KPI_ASM.fields]

    def row(**kw):
        return tuple(kw.get(n) for n in names)

    rows = []
    for i, (email, area, sale) in enumerate([("x@x", "Bee", "x"), ("x@x", "Cee", "x2"), ("y@x", "Bee", "y"), ("z@x", "Zed", "z"), (None, "Bee", "n"),
                                             (None, "Cee", "n2"), ("t@x", "Two", "t"), ("u@x", None, "u")]):
        for load in (202105, 202205):
            for m in (1, 2, 3):
                rows.append(row(month_key=load, month_col=m, area_name=area, sale_name=sale, email=email, loan_to_new=None if i == 2 and m < 2 else 10 * i + m,
                                psdn=None if i == 3 else i, approval_rate=None if (i + m) % 4 == 0 else 0.25 * m))
    kpi = _sheet(spark, rows)
    areas = spark.createDataFrame([("B", "Bee", "01"), ("C", "Cee", "01"), ("T", "Two", "02"), ("U", "Two", "02")], S.DIM_AREA)
    months = spark.createDataFrame([(202201,), (202202,), (202207,)], "report_month int")
    fin = [(m, i, a, None if (i, a) == (30, "C") else D(i + len(a) if a in "TU" else i + ord(a)))
           for m in (202201, 202202, 202207) for i in (29, 30, 31, 32) for a in "BCTU" if (m, a, i) != (202202, "B", 31)]
    finance = _report(spark, [*fin, (202201, 29, "B", D(95)), (202201, 29, "B", D(95))])
    npl = spark.createDataFrame([(202201, "B", 1.5), (202202, "C", 2.5), (202201, "T", 3.5)], "month_key int, area_code string, npl_truoc_wo_luy_ke double")
    averages = A.asm_averages(kpi, months)
    want = A.asm_joined(averages, A.npl_by_asm(kpi, areas, npl, months), A.finance_lookup(kpi, areas, finance, months))
    rows = A.asm_rows(kpi, areas, finance, npl, months)
    got = rows.select(*want.columns, F.explode(F.sequence(F.lit(1), F.col(A.COPIES).cast("int")))).drop("col")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and want.count() > 60
    # ranks and scores of the copies are those of the rows one by one
    store = RunFolder(spark).write
    ranked = A.asm_rank(averages, A.npl_by_asm(kpi, areas, npl, months), A.finance_lookup(kpi, areas, finance, months), store)
    report = A.asm_report(kpi, areas, finance, npl, months, store)
    assert sorted(map(key, report.collect())) == sorted(map(key, A.asm_score(ranked, store).collect()))


def test_heat_map_sorts_only_rows_that_can_be_picked(spark):
    rep = spark.range(5000).select(*[(F.lit(M) if f.name == "month_key" else F.concat(F.lit("p"), F.col("id")) if f.name == "email"
                                      else F.when(F.col("id") != 4999, F.col("id") + 1) if f.name == "rank_final" else F.lit(None)).cast(f.dataType).alias(f.name)
                                     for f in S.REPORT_ASM.fields])
    assert views._cutoffs(rep, F.coalesce(F.col("rank_final").cast("bigint"), F.lit(2**63 - 1)), 3).first()["__upto"] < 200
    got = {(r.email, r.rank_for_sort) for r in views.heat_map(rep).collect()}
    assert got == {("p0", 1), ("p1", 2), ("p2", 3), ("p4999", None), ("p4998", 4999), ("p4997", 4998)}


def test_rows_gather_an_emails_inputs_in_one_exchange(spark):
    kpi = _sheet(spark, [])
    months = spark.createDataFrame([(202201,), (202207,)], "report_month int")
    areas = spark.createDataFrame([("B", "Bee", "01")], S.DIM_AREA)
    npl = spark.createDataFrame([], "month_key int, area_code string, npl_truoc_wo_luy_ke double")
    text = A.asm_rows(kpi, areas, _report(spark, []), npl, months)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftOuter, ((moy") == 0 and text.count("Aggregate [moy") == 2


def test_averages_are_ranked_once_for_months_that_read_the_same(spark):
    """The ROW_NUMBERs of the averages are taken per month of the year, not per
    report month, and are those of the rows of every month."""
    names = [f.name for f in S.FACT_KPI_ASM.fields]
    rows = [dict(month_key=202105, month_col=m, area_name=area, sale_name=f"s{i}", email=email, loan_to_new=10 + i % 3, psdn=i % 2, approval_rate=0.5)
            for m in (1, 2) for i, (area, email) in enumerate([("Bee", "x@x"), ("Cee", "x@x"), ("Bee", "y@x"), ("Cee", None), ("Bee", "z@x")])]
    kpi = _sheet(spark, [tuple(r.get(n) for n in names) for r in rows])
    areas = spark.createDataFrame([("B", "Bee", "01"), ("C", "Cee", "01")], S.DIM_AREA)
    found = {}
    for years in ((2021,), (2021, 2022, 2023)):
        keys = [y * 100 + m for y in years for m in (1, 2, 3)]
        months = spark.createDataFrame([(m,) for m in keys], "report_month int")
        finance = _report(spark, [(m, i, a, D(m + i + n)) for m in keys for i, _ in A.FINANCE_LOOKUPS for n, a in enumerate("BC")])
        npl = spark.createDataFrame([(m, "B", float(m % 7)) for m in keys], "month_key int, area_code string, npl_truoc_wo_luy_ke double")
        folder, written = RunFolder(spark), []

        def store(df, name):
            df = folder.write(df, name)
            written.append((name, df.count()))
            return df

        got = A.each_ranked(A.ranked_rows(kpi, areas, finance, npl, months, store))
        want = A.each_ranked(A.rank_rows(A.asm_rows(kpi, areas, finance, npl, months), folder.write))
        assert got.exceptAll(want.select(got.columns)).isEmpty() and want.select(got.columns).exceptAll(got).isEmpty()
        found[len(years)] = [n for name, n in written if name in ("ranked", "class_ranks")][:3]
    assert found[1] == found[3] and found[1][0] == found[1][2] < 40
