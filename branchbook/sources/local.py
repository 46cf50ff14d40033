"""Small constant tables as SQL inline tables.

A seed built from a Python list through ``createDataFrame`` becomes a scan of
a Python RDD, deserialised by Python workers at run time.  An inline table
(``VALUES``) is a ``LocalRelation``: it lives in the plan, is evaluated on the
driver and broadcast from there, with no Python in the execution path.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, Decimal)):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_table(spark: SparkSession, rows, schema) -> DataFrame:
    """``rows`` (tuples) as a DataFrame with ``schema`` (StructType or DDL)."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], st)
    names = [f"c{i}" for i in range(len(st.fields))]
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
    return df.select(*[F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, st.fields)])
