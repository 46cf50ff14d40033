"""Fused allocation of the 21 P&L lines (head-office total x area ratio).

Per line, area and report month the original computes

    area 'A'   -> head total
    otherwise  -> COALESCE(direct postings, 0) + COALESCE(ratio, 0) * head total

where "head total" is the line's postings booked at head office (area part
'00') and "direct" the postings booked to the area, both cumulative over all
dates up to the month end, and the spine is the ratio table's rows for the
line's method.  It does so with two posting scans per line (42 per month).

Here the postings are scanned **once** for all lines and all months:

* each posting is matched to its lines through a broadcast selector bridge
  (exact account code, or ``prefix:`` + leading characters) with one
  equi-join; an account may feed several lines;
* ``groupBy(line, area, posting month)`` is the only large shuffle, and
  partial aggregation makes it tiny (lines x areas x months);
* cumulation, head/direct split and the CASE run on that small table.

Money stays exact: amounts are summed as ``decimal(19,0)``, cumulatively as
``decimal(38,0)``, the head total is multiplied as ``decimal(19,0)`` by the
``decimal(18,10)`` ratio, giving an exact ``decimal(38,10)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.functions.columns import yyyymm
from branchbook.operators.ratios import cumulate_to_months
from branchbook.sources import seeds
from branchbook.sources.schemas import AMOUNT_TYPE, CUM_SUM_TYPE, HEAD_TOTAL_TYPE, RATIO_TYPE


def _selector_filter(selectors: list[tuple[str, str]]) -> F.Column:
    """Predicate keeping only postings some line could use (pushed to the scan
    as IN / StartsWith filters when postings are read from Parquet)."""
    codes = [v for k, v in selectors if k == "code"]
    cond = F.col("account_code").isin(codes) if codes else F.lit(False)
    for k, v in selectors:
        if k == "prefix":
            cond = cond | F.col("account_code").startswith(v)
    return cond


def posting_keys(prefix_lengths: list[int]) -> F.Column:
    """All bridge keys a posting can match: its code and each prefix key."""
    keys = [F.col("account_code")]
    keys += [F.concat(F.lit("prefix:"), F.substring("account_code", 1, n)) for n in prefix_lengths]
    return F.array(*keys)


def line_postings_monthly(txn: DataFrame, selectors: DataFrame, prefix_lengths: list[int],
                          selector_values: list[tuple[str, str]] | None = None,
                          last_month: int | None = None, only: list[int] | None = None) -> DataFrame:
    """(pnl_id, area_code, post_month, amount) — one scan of the postings.

    NULL dates never satisfy ``date <= month end`` and are dropped.
    ``last_month``: the last report month; the bound on the date reaches the
    Parquet scan, and that on ``post_month`` prunes the folders of a staged
    ledger.  ``only``: aggregate just these posting months.
    """
    rows = txn.where(F.col("transaction_date").isNotNull())
    if last_month is not None:
        y, m = divmod(int(last_month), 100)
        end = dt.date(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)
        rows = rows.where(F.col("transaction_date") <= F.lit(end))
        if "post_month" in txn.columns:
            rows = rows.where(F.col("post_month") <= F.lit(int(last_month)))
    if only is not None:
        month = F.col("post_month") if "post_month" in txn.columns else yyyymm("transaction_date")
        rows = rows.where(month.isin([int(x) for x in only]))
    if selector_values is not None:
        rows = rows.where(_selector_filter(selector_values))
    keyed = rows.select("area_code", yyyymm("transaction_date").alias("post_month"), "amount",
                        F.explode(posting_keys(prefix_lengths)).alias("match_key"))
    bridge = F.broadcast(selectors.select("match_key", "pnl_id"))  # seed-sized
    return (keyed.join(bridge, "match_key")
            .groupBy("pnl_id", "area_code", "post_month")
            .agg(F.sum(F.col("amount").cast("decimal(19,0)")).alias("amount")))


def line_postings_cumulative(monthly: DataFrame, months: DataFrame, year_to_date: bool = False) -> DataFrame:
    """(report_month, pnl_id, area_code, amount) summed over post_month <= month
    (the original's cumulation has no lower bound; ``year_to_date`` sets one:
    the first month of the report month's year)."""
    return cumulate_to_months(monthly, months, "post_month", ["pnl_id", "area_code"],
                              {"amount": F.col("amount").cast(CUM_SUM_TYPE)}, year_to_date)


def allocate_lines(cumulative: DataFrame, ratios: DataFrame, line_catalog: DataFrame) -> DataFrame:
    """Combine cumulative postings with the ratio spine -> allocated line rows.

    The spine is the distinct (month, method, area, ratio) rows of the ratio
    table (the original groups by area *and* ratio, so a head-office area
    present twice gives two rows, each the head total).  Lines whose
    selectors match nothing (placeholders) or with no head postings yield NULL
    amounts on every spine row: ``ratio * NULL`` is NULL.
    """
    rm = cumulative.columns[0]
    spine = (ratios.select(F.col("rate_month").alias(rm), "method_code", "area_code", "ratio").distinct()
             .join(F.broadcast(line_catalog), "method_code"))
    head = (cumulative.where(F.col("area_code") == seeds.HEAD_POSTING_AREA)
            .select(rm, "pnl_id", F.col("amount").alias("head_total")))
    direct = cumulative.select(rm, "pnl_id", "area_code", F.col("amount").alias("direct"))
    j = spine.join(direct, [rm, "pnl_id", "area_code"], "left").join(head, [rm, "pnl_id"], "left")
    head_total = F.col("head_total").cast(HEAD_TOTAL_TYPE)
    share = (F.coalesce(F.col("ratio"), F.lit(0).cast(RATIO_TYPE)) * head_total).cast(T.DecimalType(28, 10))
    other = F.coalesce(F.col("direct"), F.lit(0)).cast(T.DecimalType(27, 0)) + share
    amount = F.when(F.col("area_code") == seeds.HEAD_AREA, head_total.cast(AMOUNT_TYPE)).otherwise(other)
    return j.select(F.col(rm).alias("month_key"), F.col("pnl_id").alias("id"), "area_code",
                    amount.cast(AMOUNT_TYPE).alias("amount"))


def head_totals(cumulative: DataFrame, months: DataFrame) -> DataFrame:
    """Per report month and line: the cumulative head-office total (NULL when
    nothing was booked at head office — the original's scalar ``f_total``)."""
    rm = cumulative.columns[0]
    line_ids = F.array(*[F.lit(i) for i in sorted(seeds.ALLOCATED_LINES)])
    spine = months.select(F.col(months.columns[0]).alias(rm), F.explode(line_ids).alias("pnl_id"))
    head = cumulative.where(F.col("area_code") == seeds.HEAD_POSTING_AREA).select(rm, "pnl_id", "amount")
    return spine.join(head, [rm, "pnl_id"], "left").select(
        F.col(rm).alias("month_key"), F.col("pnl_id").alias("id"), F.col("amount").alias("head_total"))
