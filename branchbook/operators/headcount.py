"""Distinct headcounts that can be kept and merged.

``COUNT(DISTINCT sale_name)`` per month of the year and area mixes all loads of
the sheet, so plain counts of a new load cannot be added to old ones.  Sets can:
every load keeps, per month and area, an exact bitmap of the salespeople it has,
and the headcount is the number of bits of the OR over all loads.  A new load
reads its own rows and the kept bitmaps, never an old sheet.

Bits need numbers: a dictionary gives every name one, for good.  New names get
the next numbers from a range-partitioned row number, so no task holds all of
them.  Numbers are dense, so a bitmap block of 4 KB covers 32,768 people.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.operators import ranking
from branchbook.operators.geo import area_by_name

DICTIONARY = "sale_name string, number long"


def new_names(sheet: DataFrame, known: DataFrame, store) -> DataFrame:
    """sale_name and number of the names that ``known`` does not have yet."""
    names = sheet.where(F.col("sale_name").isNotNull()).select("sale_name").distinct()
    fresh = names.join(known.select("sale_name"), "sale_name", "left_anti")
    last = known.agg(F.coalesce(F.max("number"), F.lit(-1)).alias("last")).scalar()
    numbered = ranking.row_number(fresh, [F.col("sale_name").asc()], None, store, "n")
    return numbered.select("sale_name", (F.col("n") + last).cast("bigint").alias("number"))


def headcount_bitmaps(sheet: DataFrame, areas: DataFrame, dictionary: DataFrame) -> DataFrame:
    """month_key, month_col, area_code, block and the bitmap of the salespeople
    with a loan figure, of the loads in ``sheet``.  A group without any name has
    an empty bitmap (its headcount is 0, not missing)."""
    rows = area_by_name(sheet.where(F.col("loan_to_new").isNotNull())
                        .select("month_key", "month_col", "area_name", "sale_name"), areas)
    # the same name several times is one bit: known before the dictionary join
    rows = rows.select("month_key", "month_col", "area_code", "sale_name").distinct().join(dictionary, "sale_name", "left")
    return rows.groupBy("month_key", "month_col", "area_code", F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged_headcount(bitmaps: DataFrame) -> DataFrame:
    """``ratios.headcount_cells`` from kept bitmaps: month_col, area_code,
    n_sales and ``is_total`` (all areas together)."""
    def counted(keys: list[str], area, total: bool) -> DataFrame:
        blocks = bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        return blocks.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n_sales")).select(
            "month_col", area, "n_sales", F.lit(total).alias("is_total"))

    none = F.lit(None).cast("string").alias("area_code")
    return counted(["month_col", "area_code"], F.col("area_code"), False).unionByName(counted(["month_col"], none, True))
