"""One set of books: the domain tables plus the aggregates every report shares.

The reports re-use a handful of small aggregates many times (the snapshot
cells feed five ratio methods, the NPL step and the write-off running sum; the
allocated lines feed the rollups, the ratio lines and the ASM lookups).  Left
lazy, each consumer would re-plan the large scans behind them.  ``Books``
computes each shared aggregate once and cuts its lineage with a Parquet table
in a run folder under ``spark.checkpoint.dir`` (a shared folder on a cluster),
which ``close()`` removes, so:

* every large table is scanned once per run, whatever reads the aggregate;
* a lost executor never forces a re-scan of the facts for a checkpointed step;
* what is checkpointed is bounded by months x areas x lines (or by headcount),
  not by the size of the facts.

Written (lineage cut): the KPI sheet, the monthly posting aggregate, the
ratio table, the allocated lines, the finance and ASM reports — the steps whose
plans are long or are read by several later plans.  Cached only: the snapshot
cells, the headcount cells and, where they are asked for themselves, the
per-salesperson ASM inputs — short scan -> aggregate lineages, rebuilt from their shuffle output if a cached
block is lost.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.operators import asm as A
from branchbook.operators import allocation, pnl, ratios as R, reshape
from branchbook.sources import bindings, seeds
from branchbook.sources.scratch import RunFolder


class Books:
    def __init__(self, spark: SparkSession, *, txn: DataFrame, snapshot: DataFrame, kpi_asm: DataFrame,
                 areas: DataFrame, provinces: DataFrame, regions: DataFrame, months, materialize: str | None = "persist",
                 strict: bool = True, rate_table: DataFrame | None = None, folder: RunFolder | None = None,
                 postings_by_month: DataFrame | None = None, cells_by_month: DataFrame | None = None,
                 headcount: DataFrame | None = None):
        self.spark = spark
        self.folder = folder or RunFolder(spark)
        # stored monthly aggregates to use instead of scanning the facts
        self._postings_by_month, self._cells_by_month, self._headcount = postings_by_month, cells_by_month, headcount
        self.rate_table = rate_table    # stored ratios to use instead of computing them
        self.txn = txn                  # decoded postings (fact_txn_month_data)
        self.snapshot = snapshot        # fact_kpi_month_raw_data
        self.kpi_asm = kpi_asm          # fact_kpi_asm (long)
        self.areas = areas
        self.provinces = provinces
        self.regions = regions
        self.materialize = materialize
        if isinstance(months, DataFrame):
            # a month list derived from data (e.g. the sheet's months) is a
            # parameter bounded by the calendar: its distinct values become an
            # inline table, so every plan that reads it sees a LocalTableScan
            months = [r[0] for r in months.select(F.col(months.columns[0]).cast("int")).distinct().collect()
                      if r[0] is not None]
        self.month_list = sorted({int(m) for m in months})
        self.last_month = max(self.month_list, default=None)
        self.months = R.month_frame(spark, self.month_list)
        self.strict = strict

    # -- construction ------------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, months=None, wide: DataFrame | None = None, **kw) -> Books:
        """Bind the domain tables to the TPC-H-like test tables.  ``wide``: the
        KPI sheet, if it is derived already."""
        kpi = reshape.unpivot_kpi(wide if wide is not None else bindings.kpi_asm_wide(spark, sf_dir))
        snapshot = bindings.kpi_month_raw(spark, sf_dir)
        folder = kw.pop("folder", None) or RunFolder(spark)
        # the sheet is derived from the largest test table; keep it like a
        # loaded sheet (one row per salesperson, load and sheet month)
        kpi = keep(kpi, "fact_kpi_asm", kw.get("materialize", "persist"), folder)
        if months is None:
            months = snapshot.select(F.col("kpi_month").alias("report_month"))
        return cls(spark,
                   txn=reshape.decode_analysis_code(bindings.txn_raw(spark, sf_dir)),
                   snapshot=snapshot,
                   kpi_asm=kpi,
                   areas=bindings.dim_area(spark, sf_dir),
                   provinces=bindings.dim_province(spark, sf_dir),
                   regions=bindings.dim_region(spark, sf_dir),
                   months=months, folder=folder, **kw)

    def _keep(self, df: DataFrame, name: str = "step") -> DataFrame:
        return keep(df, name, self.materialize, self.folder)

    def _small(self, df: DataFrame) -> DataFrame:
        """Cache a small input read several times by one plan whose own plan
        is small (no lineage cut needed; rebuilt from lineage if lost)."""
        return self.folder.persist(df) if self.materialize else df

    def close(self) -> None:
        """Release all cached frames and remove the written steps."""
        self.folder.close()

    # -- shared aggregates ---------------------------------------------------
    @cached_property
    def cells(self) -> DataFrame:
        """Snapshot per (kpi_month, area): one scan for every ratio and NPL."""
        if self._cells_by_month is not None:
            return self._cells_by_month
        return self._small(R.snapshot_cells(self.snapshot, self.provinces, self.last_month))

    @cached_property
    def headcount_cells(self) -> DataFrame:
        if self._headcount is not None:
            return self._small(self._headcount)
        return self._small(R.headcount_cells(self.kpi_asm, self.areas))

    @cached_property
    def monthly_postings(self) -> DataFrame:
        """Postings per (line, area, month): the one scan of the ledger."""
        if self._postings_by_month is not None:
            return self._postings_by_month
        return self._keep(monthly_postings(self.spark, self.txn, self.last_month), "monthly_postings")

    @cached_property
    def ratios(self) -> DataFrame:
        if self.rate_table is not None:
            return self.rate_table
        return self._keep(R.allocation_ratios(self.snapshot, self.kpi_asm, self.provinces, self.areas,
                                              self.months, strict=self.strict, cells=self.cells,
                                              headcount=self.headcount_cells), "ratios")

    @cached_property
    def cumulative_postings(self) -> DataFrame:
        return allocation.line_postings_cumulative(self.monthly_postings, self.months)

    @cached_property
    def leaves(self) -> DataFrame:
        return self._keep(allocation.allocate_lines(self.cumulative_postings, self.ratios,
                                                    seeds.line_catalog_df(self.spark)), "leaves")

    @cached_property
    def rollups(self) -> DataFrame:
        return pnl.rollup_tree(self.leaves, seeds.closure_df(self.spark))

    @cached_property
    def headcount_line(self) -> DataFrame:
        return pnl.headcount_line(self.headcount_cells, self.months)

    @cached_property
    def ratio_lines(self) -> DataFrame:
        base = self.leaves.unionByName(self.rollups).unionByName(self.headcount_line)
        return pnl.ratio_lines(base)

    @cached_property
    def finance(self) -> DataFrame:
        """``report_finance_table`` for all report months."""
        base = self.leaves.unionByName(self.rollups).unionByName(self.headcount_line)
        return self._keep(base.unionByName(pnl.ratio_lines(base)), "finance")

    @cached_property
    def writeoff_cumulative(self) -> DataFrame:
        return R.cumulative_writeoff(self.cells)

    @cached_property
    def npl_by_area(self) -> DataFrame:
        return A.npl_by_area(self.cells, self.writeoff_cumulative, self.months)

    @cached_property
    def asm_averages(self) -> DataFrame:
        return self._small(A.asm_averages(self.kpi_asm, self.months))

    @cached_property
    def npl_by_asm(self) -> DataFrame:
        return self._small(A.npl_by_asm(self.kpi_asm, self.areas, self.npl_by_area, self.months))

    @cached_property
    def finance_lookup(self) -> DataFrame:
        return self._small(A.finance_lookup(self.kpi_asm, self.areas, self.finance, self.months))

    @cached_property
    def asm(self) -> DataFrame:
        """``report_asm_final_table`` for all report months (kept with equal rows as one)."""
        return A.unfold_scores(self._keep(A.scored_rows(self.asm_rank_rows, self.folder.write), "asm"))

    @cached_property
    def asm_rank_rows(self) -> DataFrame:
        return A.ranked_rows(self.kpi_asm, self.areas, self.finance, self.npl_by_area, self.months, self.folder.write)

    @cached_property
    def asm_ranked(self) -> DataFrame:
        return A.each_ranked(self.asm_rank_rows)

    def head_totals(self) -> DataFrame:
        return allocation.head_totals(self.cumulative_postings, self.months)


def monthly_postings(spark: SparkSession, txn: DataFrame, last_month: int | None = None,
                     only: list[int] | None = None) -> DataFrame:
    """The monthly aggregate of a ledger for all allocated lines."""
    sel_values = [(k, v) for _, (_, k, vals) in seeds.ALLOCATED_LINES.items() for v in vals]
    return allocation.line_postings_monthly(txn, seeds.line_selector_df(spark), seeds.prefix_lengths(), sel_values,
                                            last_month, only)


def keep(df: DataFrame, name: str, mode: str | None, folder: RunFolder) -> DataFrame:
    """``persist``: cache (computed once by the first plan that needs it,
    rebuilt from lineage if an executor is lost); ``table``: write and read
    back (lineage cut); ``None``: leave lazy."""
    if mode == "persist":
        return folder.persist(df)
    if mode == "table":
        return folder.write(df, name)
    return df
