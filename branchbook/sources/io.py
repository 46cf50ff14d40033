"""Readers and writers for the warehouse tables.

Raw inputs are read with their declared schemas (never inferred); the
original's GUI import of spreadsheets is re-aimed as CSV -> Parquet staging.
Loads go through ``sources.publish``: a month is replaced without touching the
others, and a load becomes visible as a whole.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.operators import reshape
from branchbook.sources import schemas as S
from branchbook.sources.publish import SLOT, Publisher, log_of


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a declared schema: column pruning and filter pushdown reach
    the scan, and an empty or partly written folder never changes the types."""
    return spark.read.schema(schema).parquet(path)


BAD_RECORD = "bad_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV export of a spreadsheet, parsed with the declared schema.

    A row with a malformed field keeps its text in ``bad_record`` (NULL
    otherwise), so that a load can count or reject such rows; see ``bad_records``.
    """
    full = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    return (spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD).option("dateFormat", date_format).csv(path))


def bad_records(df: DataFrame) -> DataFrame:
    """One row: how many rows were read and how many had a malformed field."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(BAD_RECORD).alias("n_bad"))


def _load(df: DataFrame, out: str, month_col: str, append: bool, load_id: str | None,
          commit_id: str | None = None, derive=None) -> DataFrame:
    """Load rows into a month table.  By default a load replaces exactly the
    months it brings (re-runnable) and its own rows without a month, and leaves
    all others as they are; ``append`` adds rows, as the original's INSERT does.
    The fingerprints of its months tell a later run which months changed."""
    p = Publisher(df.sparkSession, log_of(out))
    p.stage(df, out, month_col, adds=append, load_id=load_id, fingerprint=True, derive=derive)
    p.commit(commit_id)
    return p.read(out, derive(df).schema if derive else df.schema)


def stage_postings(raw: DataFrame, out: str, append: bool = False, load_id: str | None = None,
                   commit_id: str | None = None) -> DataFrame:
    """Raw ledger postings -> decoded ``fact_txn_month_data`` by ``post_month``.
    Postings without a date belong to no month; ``load_id`` (a file's name, say;
    by default a fingerprint of those rows) tells whose they are."""
    month = (F.year("transaction_date") * 100 + F.month("transaction_date")).cast("int")

    def decoded(rows: DataFrame) -> DataFrame:
        return reshape.decode_analysis_code(rows, ["post_month", *[c for c in rows.columns if c == SLOT]])

    raw = raw.select("transaction_date", "account_code", "account_description", "analysis_code", "amount", "d_c", month.alias("post_month"))
    return _load(raw, out, "post_month", append, load_id, commit_id, decoded)


def stage_kpi_sheet(wide: DataFrame, out: str, append: bool = False, load_id: str | None = None) -> DataFrame:
    """Wide KPI sheet -> long ``fact_kpi_asm``, one folder per load (``month_key``)."""
    def unpivoted(rows: DataFrame) -> DataFrame:
        return reshape.unpivot_kpi(rows, [c for c in rows.columns if c == SLOT])

    return _load(wide.drop(BAD_RECORD), out, "month_key", append, load_id, derive=unpivoted)


def stage_snapshot(raw: DataFrame, out: str, append: bool = False, load_id: str | None = None) -> DataFrame:
    """Loan snapshot -> ``fact_kpi_month_raw_data`` by ``kpi_month``."""
    return _load(raw.drop(BAD_RECORD), out, "kpi_month", append, load_id)


def append_error_log(spark: SparkSession, path: str, proc_name: str, run_month: int, message: str,
                     start: dt.datetime, end: dt.datetime) -> None:
    """One row per failed step and month (real start and end times)."""
    row = (uuid.uuid4().hex, proc_name, int(run_month), message, start, end)
    spark.createDataFrame([row], S.ERROR_LOG).write.mode("append").parquet(path)
