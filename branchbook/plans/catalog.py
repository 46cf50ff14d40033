"""SQL surface: the warehouse's tables and views under their original names.

Users of the original query its tables and four reporting views by name;
``register_views`` publishes the same names as temporary views of a Spark
session, so those queries run unchanged through ``spark.sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchbook.operators import views
from branchbook.plans.books import Books
from branchbook.sources import seeds


def register_views(spark: SparkSession, books: Books, ordered_views: bool = True, kpi_asm_data: DataFrame | None = None,
                   fact_txn_month_raw_data: DataFrame | None = None, error_log: DataFrame | None = None) -> list[str]:
    """Register dimension, fact, report tables and the 4 views (and the raw
    tables and the error log, where given); returns the names."""
    tree = seeds.pnl_tree_df(spark)
    tables = {
        "dim_region_table": books.regions,
        "dim_area_table": books.areas,
        "dim_province_table": books.provinces,
        "dim_pnl_structure": tree,
        "fact_kpi_asm": books.kpi_asm,
        "fact_txn_month_data": books.txn,
        "fact_kpi_month_raw_data": books.snapshot,
        "rate_allocation_area_month": books.ratios,
        "report_finance_table": books.finance,
        "report_asm_final_table": books.asm,
        "view_report_asm": views.view_report_asm(books.asm),
        "view_report_finance": views.report_finance_crosstab(books.finance, books.areas, tree),
        "view_heat_map": views.heat_map(books.asm, ordered=ordered_views),
        "view_col_chart": views.col_chart(books.finance, books.areas, tree, ordered=ordered_views),
    }
    raw = {"kpi_asm_data": kpi_asm_data, "fact_txn_month_raw_data": fact_txn_month_raw_data, "error_log": error_log}
    tables |= {name: df for name, df in raw.items() if df is not None}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
