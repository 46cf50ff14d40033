"""Benchmark of the headline reports; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_RUNS (2).  Every timed flow starts from the raw test tables with a fresh
set of books (no intermediate is reused across flows or runs) and writes all
its rows to the ``noop`` sink; one warm-up pass runs first (JVM code
generation), then the median of the runs is kept.

Flows:
  ratios            all 7 allocation methods, 5 months
  finance_report    the P&L report (21 allocated lines, rollups, headcount,
                    ratios) for 5 months
  asm_report        salesperson ranking for the 5 months (includes finance)
  finance_80_months the P&L report for all snapshot months in one plan
  views             crosstab + heat map + column chart over the reports
  one_month_run     the runner for one more month with kept monthly aggregates
                    (staging and history are prepared outside the timing)

Comparison (reported under "comparison", not in the total): the 21 allocated
lines of one month from a stored posting table, fused (one scan) vs one
filtered aggregate per line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from branchbook.operators import allocation, views  # noqa: E402
from branchbook.plans import runner  # noqa: E402
from branchbook.plans.books import Books, monthly_postings  # noqa: E402
from branchbook.session import local_session  # noqa: E402
from branchbook.sources import bindings, io, seeds  # noqa: E402


MONTHS = [199701, 199702, 199703, 199704, 199705]


def sink(*frames):
    """Every row goes to the noop sink; returns how many there were (counted by
    the write itself), so that equal work shows in the output."""
    rows = 0
    for df in frames:
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        rows += seen.get["n"]
    return rows


def _run(b: Books, fn):
    try:
        return fn(b)
    finally:
        b.close()


def flows(spark, sf):
    def books(months=MONTHS):
        return Books.from_testdata(spark, sf, months=months, materialize="table", strict=False)

    def view_set(b):
        tree = seeds.pnl_tree_df(spark)
        return sink(views.report_finance_crosstab(b.finance, b.areas, tree), views.heat_map(b.asm),
                    views.col_chart(b.finance, b.areas, tree))

    root = tempfile.mkdtemp(prefix="branchbook-bench-")
    t = runner.Tables(postings=f"{root}/p", snapshot=f"{root}/s", kpi_asm=f"{root}/k", areas=f"{root}/areas",
                      provinces=f"{root}/prov", rate_table=f"{root}/rate", finance_table=f"{root}/fin",
                      asm_table=f"{root}/asm", error_log=f"{root}/log", postings_by_month=f"{root}/pm",
                      cells_by_month=f"{root}/cm", headcount_by_load=f"{root}/hc")

    def prepare():
        io.stage_postings(bindings.txn_raw(spark, sf), t.postings)
        io.stage_snapshot(bindings.kpi_month_raw(spark, sf), t.snapshot)
        io.stage_kpi_sheet(bindings.kpi_asm_wide(spark, sf), t.kpi_asm)
        bindings.dim_area(spark, sf).write.parquet(t.areas)
        bindings.dim_province(spark, sf).write.parquet(t.provinces)
        runner.refresh_headcount(spark, t, [y * 100 + bindings.LOAD_MONTH for y in range(1992, 1999)])
        runner.refresh_aggregates(spark, t, [y * 100 + m for y in (1995, 1996) for m in range(1, 13)] + MONTHS)

    def one_month():
        runner.run_month(spark, t, MONTHS[-1], changed=[MONTHS[-1]])
        return sum(runner.read_output(spark, t, name, [MONTHS[-1]]).count() for name in ("rates", "finance", "asm"))

    return prepare, {
        "ratios": lambda: _run(books(), lambda b: sink(b.ratios)),
        "finance_report": lambda: _run(books(), lambda b: sink(b.finance)),
        "asm_report": lambda: _run(books(), lambda b: sink(b.asm)),
        "finance_80_months": lambda: _run(books(months=None), lambda b: sink(b.finance)),
        "views": lambda: _run(books(), view_set),
        "one_month_run": one_month,
    }


def allocation_comparison(spark, sf):
    """Fused vs per-line allocation for one month, same stored inputs."""
    b = Books.from_testdata(spark, sf, months=MONTHS[-1:], materialize="table", strict=False)
    txn = b.folder.write(b.txn, "bench_postings")            # a stored posting table
    rates = b.folder.write(b.ratios, "bench_rates")
    catalog = seeds.line_catalog_df(spark)

    def allocated(monthly, lines=None):
        cum = allocation.line_postings_cumulative(monthly, b.months)
        cat = catalog if lines is None else catalog.where(F.col("pnl_id") == lines)
        return allocation.allocate_lines(cum, rates, cat)

    def fused():
        return sink(allocated(monthly_postings(spark, txn)))

    def per_line():
        selectors = seeds.line_selector_df(spark)
        return sum(sink(allocated(allocation.line_postings_monthly(
            txn, selectors.where(F.col("pnl_id") == line), seeds.prefix_lengths(),
            [(kind, v) for v in vals]), line)) for line, (_, kind, vals) in sorted(seeds.ALLOCATED_LINES.items()))

    return {"allocation_fused_1m": fused, "allocation_per_line_1m": per_line}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="branchbook-bench")
    prepare, fl = flows(spark, sf)
    prepare()
    # warm-up: the views flow runs every code path of the other flows
    # (bindings, ratios, finance, ASM, views) once, for JVM code generation
    fl["views"]()
    times = {name: [] for name in fl}
    rows = {}
    for _ in range(runs):
        for name, fn in fl.items():
            t0 = time.perf_counter()
            rows[name] = fn()
            times[name].append(time.perf_counter() - t0)
    med = {name: round(statistics.median(v), 3) for name, v in times.items()}
    comp = allocation_comparison(spark, sf)
    for fn in comp.values():  # warm-up
        fn()
    comp_t = {name: [] for name in comp}
    for _ in range(runs):
        for name, fn in comp.items():
            t0 = time.perf_counter()
            fn()
            comp_t[name].append(time.perf_counter() - t0)
    comparison = {name: round(statistics.median(v), 3) for name, v in comp_t.items()}
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "report_pipeline_median_sec", "value": round(sum(med.values()), 3), "unit": "sec",
                      "queries": med, "rows": rows, "comparison": comparison, "sf": sf_label, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
