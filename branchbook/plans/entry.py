"""The smoke-test flagship: one P&L line end to end, as a single lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.operators import allocation
from branchbook.plans.books import Books
from branchbook.sources import seeds

FLAGSHIP_LINE = 3


def flagship(spark: SparkSession, sf_dir: str, line: int = FLAGSHIP_LINE) -> DataFrame:
    """Allocated amounts of one line for every report month and area.

    Built lazily (nothing is materialised): the ratio plan is filtered to the
    line's method, the filter reaches every branch of the ratio union, so only
    that method's snapshot aggregate runs and only its NOT NULL checks fire.
    (Line 3 uses AWO_GR1, which is well formed on every test scale; the
    smallest scale has months without write-offs, which make BWO_GR2_5 fail
    its NOT NULL check exactly as the original's insert does.)
    """
    b = Books.from_testdata(spark, sf_dir, materialize=None)
    method = seeds.ALLOCATED_LINES[line][0]
    rates = b.ratios.where(F.col("method_code") == method)
    catalog = seeds.line_catalog_df(spark).where(F.col("pnl_id") == line)
    monthly = b.monthly_postings.where(F.col("pnl_id") == line)
    cum = allocation.line_postings_cumulative(monthly, b.months)
    out = allocation.allocate_lines(cum, rates, catalog)
    return out.select("month_key", "id", "area_code", F.round("amount", 4).cast("double").alias("amount"))
