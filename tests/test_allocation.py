"""Hand-computed allocation cases (FIXTURES.md §4) and the fused-allocation invariants."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from branchbook.operators import allocation, pnl
from branchbook.sources import seeds

CUM = "report_month int, pnl_id int, area_code string, amount decimal(38,0)"
RATES = "rate_month int, method_code string, area_code string, ratio decimal(18,10)"
M = 202305


def _alloc(spark, cum_rows, rate_rows, line=3, method="AWO_GR1"):
    cum = spark.createDataFrame(cum_rows, CUM)
    rates = spark.createDataFrame(rate_rows, RATES)
    cat = spark.createDataFrame([(line, method)], "pnl_id int, method_code string")
    out = allocation.allocate_lines(cum, rates, cat).collect()
    return sorted(((r.area_code, r.amount) for r in out), key=lambda x: (x[0], x[1] is None, x[1]))


def test_allocation_normal(spark):
    got = _alloc(spark, [(M, 3, "00", D(1000)), (M, 3, "B", D(300))],
                 [(M, "AWO_GR1", "A", D(0)), (M, "AWO_GR1", "B", D("0.25")), (M, "AWO_GR1", "C", D("0.75"))])
    assert got == [("A", D(1000)), ("B", D(550)), ("C", D(750))]


def test_area_without_ratio_row_gets_no_row(spark):
    got = _alloc(spark, [(M, 3, "00", D(1000)), (M, 3, "D", D(300))],
                 [(M, "AWO_GR1", "A", D(0)), (M, "AWO_GR1", "B", D(1))])
    assert [a for a, _ in got] == ["A", "B"]


def test_no_head_posting_poisons_the_line(spark):
    got = _alloc(spark, [(M, 3, "B", D(300))], [(M, "AWO_GR1", "A", D(0)), (M, "AWO_GR1", "B", D("0.25"))])
    assert got == [("A", None), ("B", None)]


def test_placeholder_line_is_null_rows(spark):
    got = _alloc(spark, [(M, 3, "00", D(1000))], [(M, "AWO", "A", D(0)), (M, "AWO", "B", D(1))], line=9, method="AWO")
    assert got == [("A", None), ("B", None)]


def test_head_area_twice_reports_head_total_twice(spark):
    got = _alloc(spark, [(M, 3, "00", D(1000))],
                 [(M, "AWO_GR1", "A", D(0)), (M, "AWO_GR1", "A", D("0.1")), (M, "AWO_GR1", "B", D("0.9"))])
    assert got == [("A", D(1000)), ("A", D(1000)), ("B", D(900))]


def test_ratio_rounded_before_multiplying(spark):
    got = _alloc(spark, [(M, 3, "00", D(9000000000))],
                 [(M, "AWO_GR1", "B", D("0.3333333333"))])
    assert got == [("B", D("2999999999.7"))]


def test_rollup_skips_null_children(spark):
    leaves = spark.createDataFrame(
        [(M, 3, "B", D(5)), (M, 4, "B", None), (M, 3, "C", None), (M, 4, "C", None)],
        "month_key int, id int, area_code string, amount decimal(38,10)")
    out = {(r.id, r.area_code): r.amount for r in pnl.rollup_tree(leaves, seeds.closure_df(spark)).collect()}
    assert out[(2, "B")] == D(5) and out[(20, "B")] == D(5) and out[(1, "B")] == D(5)
    assert out[(2, "C")] is None and out[(1, "C")] is None
    assert (8, "B") not in out  # no leaf under 8 -> no row


def test_zero_denominator_gives_null_ratio(spark):
    rows = spark.createDataFrame([(M, 20, "B", D(0)), (M, 21, "B", D(5))],
                                 "month_key int, id int, area_code string, amount decimal(38,10)")
    out = {r.id: r.amount for r in pnl.ratio_lines(rows).collect()}
    assert out == {29: None}


def test_fused_selector_join_matches_codes_and_prefixes(spark):
    import datetime as dt
    txn = spark.createDataFrame(
        [(dt.date(2023, 1, 3), "790000050101", "B", 7),   # feeds lines 18 and 26
         (dt.date(2023, 1, 3), "851234567890", "00", 11),  # prefix 85 -> line 23
         (dt.date(2023, 2, 3), "999999999999", "B", 13),   # no line
         (None, "702000030002", "B", 17)],                 # NULL date never counts
        "transaction_date date, account_code string, area_code string, amount bigint")
    sel = [(k, v) for _, (_, k, vals) in seeds.ALLOCATED_LINES.items() for v in vals]
    out = allocation.line_postings_monthly(txn, seeds.line_selector_df(spark), seeds.prefix_lengths(), sel)
    got = sorted((r.pnl_id, r.area_code, r.post_month, r.amount) for r in out.collect())
    assert got == [(18, "B", 202301, 7), (23, "00", 202301, 11), (26, "B", 202301, 7)]


@pytest.fixture(scope="module")
def books01(spark):
    from branchbook.plans.books import Books
    return Books.from_testdata(spark, "/root/testdata/sf0.01", materialize="table")


def test_ratios_sum_to_one(books01):
    sums = books01.ratios.groupBy("rate_month", "method_code").agg(
        F.sum("ratio").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    # the sheet has the months January to May: from June on SM_COUNT has nobody
    # to count, and only the head office's zero row is left
    empty = [r for r in sums if r.n == 1]
    assert {r.method_code for r in empty} == {"SM_COUNT"} and all(r.s == 0 for r in empty)
    assert {r.rate_month for r in empty} == {m for m in books01.month_list if m % 100 >= 6}
    for r in sums:
        if r.n > 1:
            assert abs(float(r.s) - 1.0) <= r.n * 5e-11 + 1e-12, r


def test_areas_sum_to_direct_plus_head(books01):
    """Σ areas (excluding A) = Σ direct + head total × Σ ratios, per line/month."""
    leaves = books01.leaves.where((F.col("area_code") != "A") & F.col("amount").isNotNull())
    tot = {(r.month_key, r.id): float(r.s) for r in
           leaves.groupBy("month_key", "id").agg(F.sum("amount").alias("s")).collect()}
    cum = books01.cumulative_postings
    head = {(r.report_month, r.pnl_id): float(r.amount) for r in cum.where(F.col("area_code") == "00").collect()}
    direct = {}
    for r in cum.where(F.col("area_code") != "00").collect():
        direct[(r.report_month, r.pnl_id)] = direct.get((r.report_month, r.pnl_id), 0.0) + float(r.amount)
    assert tot
    for k, v in tot.items():
        expect = direct.get(k, 0.0) + head[k]
        assert abs(v - expect) <= 1e-6 * abs(expect) + 1.0, (k, v, expect)


def test_fused_equals_per_line_original_shape(spark, books01):
    """The one-scan allocation equals the original per-line formulation
    (scalar head total + LEFT JOIN with the predicates in ON, grouped by area and ratio)."""
    from branchbook.functions.columns import month_end
    txn = books01.txn
    rates = books01.ratios
    fused = {(r.month_key, r.id, r.area_code): r.amount for r in books01.leaves.collect()}
    months = [r[0] for r in books01.months.collect()]
    for line in (3, 23, 26):
        method, kind, vals = seeds.ALLOCATED_LINES[line]
        sel = (F.col("account_code").isin(vals) if kind == "code"
               else F.col("account_code").startswith(vals[0]))
        for m in (months[0], months[-1]):
            me = spark.range(1).select(month_end(F.lit(m)).alias("d")).first().d
            t = txn.where(sel & (F.col("transaction_date") <= F.lit(me)))
            f_total = t.where(F.col("area_code") == "00").agg(F.sum("amount").alias("s")).first().s
            b = rates.where((F.col("method_code") == method) & (F.col("rate_month") == m)).alias("b")
            j = b.join(t.alias("a"), F.col("a.area_code") == F.col("b.area_code"), "left")
            g = j.groupBy("b.area_code", "b.ratio").agg(F.sum("a.amount").alias("s")).collect()
            for r in g:
                if r.area_code == "A":
                    exp = None if f_total is None else D(f_total)
                else:
                    exp = None if f_total is None else D(r.s or 0) + r.ratio * D(f_total)
                got = fused[(m, line, r.area_code)]
                assert (got is None and exp is None) or got == exp, (line, m, r.area_code, got, exp)
