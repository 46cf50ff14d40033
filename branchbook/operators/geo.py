"""Geographic lookups: city -> province -> area -> region.

The joins carry no hint: a dimension may come from a user's table, so the
optimizer broadcasts it by its measured size (the seeds hold 4 regions, 8 areas
and 64 provinces) and joins a large one by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def city_to_area(df: DataFrame, provinces: DataFrame, city_col: str = "pos_city", how: str = "left") -> DataFrame:
    """Attach ``area_code`` to rows by their city name.

    ``how='left'`` keeps unmatched cities with a NULL area (the ratio steps),
    ``how='inner'`` drops them (the write-off and NPL steps).
    """
    p = provinces.select(F.col("province_name").alias(city_col), "area_code")
    return df.join(p, city_col, how)


def area_by_name(df: DataFrame, areas: DataFrame, name_col: str = "area_name", how: str = "left") -> DataFrame:
    """Attach ``area_code`` by area name (salesperson sheets carry names)."""
    a = areas.select(F.col("area_name").alias(name_col), "area_code")
    return df.join(a, name_col, how)


def geo_rollup(snapshot: DataFrame, provinces: DataFrame, areas: DataFrame, regions: DataFrame) -> DataFrame:
    """Outstanding balance and loan count per month, region and area.

    Two equi-joins (city -> area, area -> region) and one grouped
    sum with map-side partial aggregation; unknown cities stay as a NULL area.
    """
    geo = (areas.select("area_code", "area_name", "region_id")
           .join(regions.select("region_id", "region_name"), "region_id", "left"))
    rows = city_to_area(snapshot.select("kpi_month", "pos_city", "outstanding_principal"), provinces)
    return (rows.join(geo, "area_code", "left")
            .groupBy("kpi_month", "region_id", "region_name", "area_code", "area_name")
            .agg(F.sum(F.col("outstanding_principal").cast("decimal(19,0)")).alias("outstanding"),
                 F.count(F.lit(1)).alias("n_loans")))
