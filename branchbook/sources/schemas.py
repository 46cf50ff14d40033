"""Declared schemas of the raw, dimension, fact and report tables.

Raw tables are always read with these schemas (never inferred: account codes
would turn into numbers).  Type choices, decided once here:

* money is an integer amount (``long``) on input; sums are kept as exact
  decimals so allocation and rollups are order-independent and lossless;
* ``ratio`` is ``decimal(18,10)`` and is rounded to that scale *before* it
  multiplies a head-office total;
* ``report_finance.amount`` is ``decimal(38,10)`` (exact); the ratio lines are
  computed in double and stored at the same scale;
* padded ``char`` columns of the original become trimmed strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

RATIO_TYPE = T.DecimalType(18, 10)
AMOUNT_TYPE = T.DecimalType(38, 10)
# a head-office total multiplied by a decimal(18,10) ratio stays exact
# (decimal(38,10)) only while the total fits 19 digits
HEAD_TOTAL_TYPE = T.DecimalType(19, 0)
CUM_SUM_TYPE = T.DecimalType(38, 0)

# FIXED VALUES: month prefixes of the wide KPI sheet, in month order.
WIDE_MONTHS = ["jan", "feb", "mar", "apr", "may"]
WIDE_MEASURES = [
    ("loan", "loan_to_new", T.LongType()),
    ("psdn", "psdn", T.IntegerType()),
    ("app_approved", "app_approved", T.IntegerType()),
    ("app_in", "app_in", T.IntegerType()),
    ("approval_rate", "approval_rate", T.FloatType()),
]


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


DIM_REGION = T.StructType([_f("region_id", T.StringType(), False), _f("region_name", T.StringType(), False)])
DIM_AREA = T.StructType([
    _f("area_code", T.StringType(), False),
    _f("area_name", T.StringType(), False),
    _f("region_id", T.StringType(), False),
])
DIM_PROVINCE = T.StructType([
    _f("province_id", T.StringType(), False),
    _f("province_name", T.StringType(), False),
    _f("area_code", T.StringType(), False),
])
DIM_PNL = T.StructType([
    _f("pnl_id", T.IntegerType(), False),
    _f("pnl_code", T.StringType(), False),
    _f("pnl_name", T.StringType(), False),
    _f("pnl_parent_id", T.IntegerType()),
    _f("pnl_level", T.IntegerType(), False),
    _f("sortorder", T.IntegerType(), False),
])

KPI_ASM_WIDE = T.StructType(
    [_f("month_key", T.LongType()), _f("area_name", T.StringType()),
     _f("sale_name", T.StringType()), _f("email", T.StringType())]
    + [_f(f"{m}_{suffix}", dtype) for suffix, _, dtype in WIDE_MEASURES for m in WIDE_MONTHS]
)
FACT_KPI_ASM = T.StructType([
    _f("month_key", T.LongType()),
    _f("area_name", T.StringType()),
    _f("sale_name", T.StringType()),
    _f("email", T.StringType()),
    _f("month_col", T.IntegerType()),
    _f("loan_to_new", T.LongType()),
    _f("psdn", T.IntegerType()),
    _f("app_approved", T.IntegerType()),
    _f("app_in", T.IntegerType()),
    _f("approval_rate", T.FloatType()),
])

TXN_RAW = T.StructType([
    _f("transaction_date", T.DateType()),
    _f("account_code", T.StringType()),
    _f("account_description", T.StringType()),
    _f("analysis_code", T.StringType()),
    _f("amount", T.LongType()),
    _f("d_c", T.StringType()),
])
TXN = T.StructType([
    _f("transaction_date", T.DateType()),
    _f("account_code", T.StringType()),
    _f("account_description", T.StringType()),
    _f("analysis_code", T.StringType()),
    _f("network_unit", T.StringType()),
    _f("region_code", T.StringType()),
    _f("area_code", T.StringType()),
    _f("province_code", T.StringType()),
    _f("pos_code", T.StringType()),
    _f("amount", T.LongType()),
    _f("d_c", T.StringType()),
])

KPI_MONTH_RAW = T.StructType([
    _f("kpi_month", T.IntegerType()),
    _f("pos_city", T.StringType()),
    _f("outstanding_principal", T.LongType()),
    _f("write_off_month", T.IntegerType()),
    _f("write_off_balance_principal", T.LongType()),
    _f("max_bucket", T.IntegerType()),
    _f("psdn", T.IntegerType()),
])

RATE_ALLOCATION = T.StructType([
    _f("rate_month", T.IntegerType(), False),
    _f("method_code", T.StringType(), False),
    _f("method_name", T.StringType(), False),
    _f("area_code", T.StringType(), False),
    _f("ratio", RATIO_TYPE, False),
])
REPORT_FINANCE = T.StructType([
    _f("month_key", T.IntegerType(), False),
    _f("id", T.IntegerType(), False),
    _f("area_code", T.StringType()),
    _f("amount", AMOUNT_TYPE),
])
REPORT_ASM = T.StructType([
    _f("month_key", T.IntegerType(), False),
    _f("area_name", T.StringType()),
    _f("email", T.StringType()),
    _f("tong_diem", T.LongType()),
    _f("rank_final", T.IntegerType()),
    _f("ltn_avg", T.DoubleType()),
    _f("rank_ltn_avg", T.IntegerType()),
    _f("psdn_avg", T.DoubleType()),
    _f("rank_psdn_avg", T.IntegerType()),
    _f("approval_rate_avg", T.DoubleType()),
    _f("rank_approval_rate_avg", T.IntegerType()),
    _f("npl_truoc_wo_luy_ke", T.DoubleType()),
    _f("rank_npl_truoc_wo_luy_ke", T.IntegerType()),
    _f("diem_quymo", T.LongType()),
    _f("rank_ptkd", T.IntegerType()),
    _f("cir", T.DoubleType()),
    _f("rank_cir", T.IntegerType()),
    _f("margin", T.DoubleType()),
    _f("rank_margin", T.IntegerType()),
    _f("hs_von", T.DoubleType()),
    _f("rank_hs_von", T.IntegerType()),
    _f("hsbp_nhan_su", T.DoubleType()),
    _f("rank_hsbq_nhan_su", T.IntegerType()),
    _f("diem_fin", T.LongType()),
    _f("rank_fin", T.IntegerType()),
])
ERROR_LOG = T.StructType([
    _f("log_id", T.StringType(), False),
    _f("proc_name", T.StringType(), False),
    _f("run_month", T.IntegerType(), False),
    _f("error_message", T.StringType()),
    _f("start_time", T.TimestampType()),
    _f("end_time", T.TimestampType()),
])
