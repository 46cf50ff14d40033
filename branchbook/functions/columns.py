"""Column expressions shared by the operators.

All of these are built-in Spark expressions (they stay inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_part(c, delimiter: str, n: int) -> Column:
    """n-th field of ``c`` split on a literal delimiter; '' when out of range,
    NULL when ``c`` is NULL (not a regex split)."""
    return F.split_part(col(c), F.lit(delimiter), F.lit(n))


def first_match(c, pattern: str) -> Column:
    """First substring matching ``pattern``; NULL when nothing matches."""
    return F.regexp_substr(col(c), F.lit(pattern))


def yyyymm(date_col) -> Column:
    """Integer period key YYYYMM of a date or timestamp."""
    c = col(date_col)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def month_end(month_key) -> Column:
    """Last calendar day of an integer YYYYMM month."""
    return F.last_day(F.to_date(col(month_key).cast("string"), "yyyyMM"))


def month_of_year(month_key) -> Column:
    return (col(month_key) % 100).cast("int")


def safe_ratio(num, den, scale: float = 1.0) -> Column:
    """num / NULLIF(den, 0) * scale, computed in double."""
    d = col(den).cast("double")
    return col(num).cast("double") / F.when(d != 0, d) * F.lit(scale)


def desc_pg(c) -> Column:
    """Descending with NULLs first, the ordering of the original database."""
    return col(c).desc_nulls_first()


def asc_pg(c) -> Column:
    """Ascending with NULLs last, the ordering of the original database."""
    return col(c).asc_nulls_last()


def require_not_null(c, message: str) -> Column:
    """Pass ``c`` through, failing the query at run time on a NULL.

    This is the NOT NULL constraint of the original target table, expressed
    lazily: it costs nothing until rows flow and aborts the whole job (the
    whole insert) on the first violation.
    """
    c = col(c)
    return F.when(c.isNull(), F.raise_error(F.lit(message))).otherwise(c)
