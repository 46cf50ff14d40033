"""Derive the warehouse's domain tables from the TPC-H-like test tables.

The test data has no ledger, KPI sheet or loan snapshot, so each domain table
is a deterministic query over the star schema (the same derivation is written
in SQL for the oracle, see ``plans/oracle.py``):

* area dimension      <- ``region`` (B..F) plus the head-office row ``A``;
* province dimension  <- ``nation`` (province = nation, area = its region);
* ledger postings     <- ``lineitem`` x ``supplier`` x ``nation``;
* loan snapshot       <- ``orders`` x ``customer`` x ``nation``;
* wide KPI sheet      <- per supplier and year of ``lineitem`` (the sheet's columns
  are the months January to May; one load per year).

Dimension tables with a size fixed by the TPC-H specification (region: 5,
nation: 25) are broadcast explicitly; ``supplier`` and ``customer`` grow with
the scale factor, so their join strategy is left to the optimizer and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.functions.columns import yyyymm
from branchbook.sources import seeds
from branchbook.sources.local import local_table

# FIXED VALUES of the binding: 21 account codes, chosen by
# index = 7 * (A -> 0, N -> 1, R -> 2 for l_returnflag) + l_linenumber - 1.
# Every non-placeholder line is present, 790000050101 feeds lines 18 and 26,
# and the last code matches no line.
BINDING_ACCOUNTS = [
    "702000030002", "702000030012", "716000000001", "719000030002", "719000030003",
    "803000000001", "802000000002", "801000000001", "702000010001", "816000000001",
    "809000000002", "831000000001", "850000000001", "860000000001", "870000000001",
    "882200050001", "790000050101", "790000050001", "819000000001", "832000000001",
    "999999999999",
]
LOAD_MONTH = 5           # month of a year's sheet load (month_key = year * 100 + 5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _area_letter(regionkey) -> F.Column:
    return F.expr(f"chr(66 + {regionkey})")


def _region_id(regionkey: str) -> F.Column:
    return F.concat(F.lit("0"), (F.floor(F.col(regionkey) / 2) + 1).cast("int").cast("string"))


def dim_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select(
        _area_letter("r_regionkey").alias("area_code"),
        F.col("r_name").alias("area_name"),
        _region_id("r_regionkey").alias("region_id"),
    )
    head = local_table(spark, [seeds.AREAS[0]], "area_code string, area_name string, region_id string")
    return head.unionByName(regions)


def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("province_id"),
        F.col("n_name").alias("province_name"),
        _area_letter("n_regionkey").alias("area_code"),
    )


def dim_region(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return seeds.regions_df(spark)


def txn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger postings (``fact_txn_month_raw_data``)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
    flag_idx = (F.when(F.col("l_returnflag") == "A", 0)
                .when(F.col("l_returnflag") == "N", 1)
                .when(F.col("l_returnflag") == "R", 2))
    idx = flag_idx * 7 + F.col("l_linenumber")  # 1-based
    account = F.element_at(F.array(*[F.lit(a) for a in BINDING_ACCOUNTS]), idx)
    area_part = F.when(F.col("s_suppkey") % 10 == 0, F.lit(seeds.HEAD_POSTING_AREA)).otherwise(
        _area_letter("n_regionkey"))
    base = F.concat_ws(".", F.lit("NU"), _region_id("n_regionkey"), area_part,
                       F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    analysis = F.when(F.col("s_suppkey") % 7 == 3, base).otherwise(
        F.concat(base, F.lit(".POS_"), F.col("s_suppkey").cast("string")))
    return j.select(
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        account.alias("account_code"),
        F.concat(F.lit("GL "), account).alias("account_description"),
        analysis.alias("analysis_code"),
        F.round(F.col("l_extendedprice") * 100, 0).cast("bigint").alias("amount"),
        F.col("l_linestatus").alias("d_c"),
    )


def kpi_month_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly loan snapshot (``fact_kpi_month_raw_data``)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    month = yyyymm("o_orderdate")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return j.select(
        month.alias("kpi_month"),
        F.col("n_name").alias("pos_city"),
        F.round(F.col("o_totalprice") * 100, 0).cast("bigint").alias("outstanding_principal"),
        F.when(F.col("o_orderstatus") == "F", month).alias("write_off_month"),
        F.round(F.col("o_totalprice") * 10, 0).cast("bigint").alias("write_off_balance_principal"),
        F.when(digit != 4, digit).alias("max_bucket"),
        (F.col("o_orderkey") % 5).cast("int").alias("psdn"),
    )


def kpi_asm_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide KPI sheet (``kpi_asm_data``): one row per supplier ("salesperson")
    and year with postings; months of the year without any stay NULL."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate")
    # per order first, then per supplier and month: the distinct order count
    # becomes a plain count, and both levels aggregate map-side.  Of the months
    # that the sheet does not show it only takes that the year has postings: they
    # are one group per supplier and year (``m`` NULL), whatever the order
    month = F.month("l_shipdate")
    shown = month <= LOAD_MONTH
    per_order = (li.groupBy("l_suppkey", F.year("l_shipdate").alias("y"), F.when(shown, month).alias("m"),
                            F.when(shown, F.col("l_orderkey")).alias("l_orderkey"))
                 .agg(F.sum(F.round(F.col("l_extendedprice") * 100, 0).cast("bigint")).alias("loan"),
                      F.count(F.lit(1)).alias("n"),
                      F.count(F.when(F.col("l_returnflag") == "N", 1)).alias("n_ok")))
    monthly = (per_order.groupBy("l_suppkey", "y", "m")
               .agg(F.sum("loan").alias("loan"),
                    F.count(F.lit(1)).cast("int").alias("psdn"),
                    F.sum("n").cast("int").alias("app_in"),
                    F.sum("n_ok").cast("int").alias("app_approved")))
    names = ["jan", "feb", "mar", "apr", "may"]
    aggs = []
    for i, mname in enumerate(names, start=1):
        sel = F.col("m") == i
        aggs += [F.max(F.when(sel, F.col(c))).alias(f"{mname}_{c}") for c in ("loan", "psdn", "app_approved", "app_in")]
    wide = monthly.groupBy("l_suppkey", "y").agg(*aggs)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    reg = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    base = (wide.join(sup, F.col("s_suppkey") == F.col("l_suppkey"))
            .join(nat, sup.s_nationkey == nat.n_nationkey)
            .join(reg, F.col("n_regionkey") == F.col("r_regionkey")))
    cols = [
        (F.col("y") * 100 + LOAD_MONTH).cast("bigint").alias("month_key"),
        F.col("r_name").alias("area_name"),
        F.col("s_name").alias("sale_name"),
        F.concat(F.lit("asm"), F.col("s_suppkey").cast("string"), F.lit("@example.com")).alias("email"),
    ]
    for suffix in ["loan", "psdn", "app_approved", "app_in"]:
        cols += [F.col(f"{m}_{suffix}") for m in names]
    cols += [(F.col(f"{m}_app_approved").cast("double") / F.col(f"{m}_app_in")).cast("float").alias(f"{m}_approval_rate")
             for m in names]
    return base.select(*cols)
