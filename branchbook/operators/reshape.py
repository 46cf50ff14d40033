"""Ingest reshapes: wide KPI sheet -> long facts, dotted analysis code -> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.functions.columns import first_match, split_part
from branchbook.sources.schemas import FACT_KPI_ASM, WIDE_MEASURES, WIDE_MONTHS

POS_PATTERN = "POS_[0-9]+"  # FIXED VALUE: point-of-sale token inside an analysis code


def unpivot_kpi(wide: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``kpi_asm_data`` (one row per salesperson, 5 months x 5 measures side by
    side) -> ``fact_kpi_asm`` (one row per salesperson and month).

    All five measures move *in step* (month m takes the m-th column of every
    measure), and all five rows are emitted even when a month's measures are
    all NULL.  A single ``stack`` generator does it in one pass, inside the
    scan's stage; no join, no shuffle.  ``extra``: more columns to pass through.
    """
    args = [F.lit(len(WIDE_MONTHS))]
    for i, m in enumerate(WIDE_MONTHS, start=1):
        args.append(F.lit(i))
        args += [F.col(f"{m}_{suffix}").cast(dtype) for suffix, _, dtype in WIDE_MEASURES]
    out_names = ["month_col"] + [name for _, name, _ in WIDE_MEASURES]
    long = wide.select("month_key", "area_name", "sale_name", "email", *extra, F.stack(*args).alias(*out_names))
    return long.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_KPI_ASM.fields], *extra)


def decode_analysis_code(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``fact_txn_month_raw_data`` -> ``fact_txn_month_data``.

    The analysis code ``network.region.area.province...`` is split on the
    literal dot (fields out of range are '' and a NULL code gives NULLs), and
    the ``POS_<digits>`` token is extracted anywhere in it (NULL if absent).
    ``extra``: more columns to pass through.
    """
    code = F.col("analysis_code")
    return raw.select(
        "transaction_date", "account_code", "account_description", "analysis_code",
        split_part(code, ".", 1).alias("network_unit"),
        split_part(code, ".", 2).alias("region_code"),
        split_part(code, ".", 3).alias("area_code"),
        split_part(code, ".", 4).alias("province_code"),
        first_match(code, POS_PATTERN).alias("pos_code"),
        "amount", "d_c", *extra,
    )
