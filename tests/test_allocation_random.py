"""Fused allocation vs a brute-force evaluation of the per-line semantics on
random inputs (NULL dates, unknown areas, prefixes, shared accounts, placeholder
lines, months without head postings, the head-office area present twice)."""

import calendar
import datetime as dt
import random
from decimal import Decimal as D

import pytest

from branchbook.operators import allocation, ratios as R
from branchbook.sources import seeds

MONTHS = [202301, 202302, 202304]


def _month_end(m):
    y, mo = divmod(m, 100)
    return dt.date(y, mo, calendar.monthrange(y, mo)[1])


def _matches(line, account):
    _, kind, vals = seeds.ALLOCATED_LINES[line]
    return account in vals if kind == "code" else any(account.startswith(v) for v in vals)


def brute_force(postings, rates):
    out = []
    for m in MONTHS:
        me = _month_end(m)
        for line, (method, _, _) in seeds.ALLOCATED_LINES.items():
            rows = [p for p in postings if p[0] is not None and p[0] <= me and _matches(line, p[1])]
            head_rows = [p[3] for p in rows if p[2] == "00"]
            head = D(sum(head_rows)) if head_rows else None
            spine = {(a, r) for (rm, meth, a, r) in rates if rm == m and meth == method}
            for area, ratio in spine:
                if area == "A":
                    amt = head
                else:
                    direct = D(sum(p[3] for p in rows if p[2] == area))
                    amt = None if head is None else direct + (ratio or D(0)) * head
                out.append((m, line, area, amt))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_fused_allocation_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    accounts = [v for _, (_, k, vals) in seeds.ALLOCATED_LINES.items() if k == "code" for v in vals]
    accounts += ["850000000001", "861234000000", "870000000009", "999999999999", "8", ""]
    postings = []
    for _ in range(600):
        day = rng.choice([None] + [dt.date(2022, 12, 20), dt.date(2023, 1, 15), dt.date(2023, 2, 28),
                                   dt.date(2023, 3, 1), dt.date(2023, 4, 30), dt.date(2023, 5, 1)])
        postings.append((day, rng.choice(accounts), rng.choice(["00", "B", "C", "Z", ""]),
                         rng.randint(-50, 1000)))
    rates = []
    for m in MONTHS:
        for code, _ in seeds.METHODS:
            rates.append((m, code, "A", D(0)))
            if rng.random() < 0.2:
                rates.append((m, code, "A", D("0.1000000000")))     # head area twice
            for a in ("B", "C"):
                if rng.random() < 0.8:
                    rates.append((m, code, a, D(rng.randint(0, 10**10)) / D(10**10)))
    if seed == 2:  # a month without any head posting: every line of it is NULL
        postings = [p for p in postings if not (p[2] == "00" and p[0] is not None and p[0] <= dt.date(2023, 1, 31))]
    txn = spark.createDataFrame(postings, "transaction_date date, account_code string, area_code string, amount bigint")
    rt = spark.createDataFrame(rates, "rate_month int, method_code string, area_code string, ratio decimal(18,10)")
    sel = [(k, v) for _, (_, k, vals) in seeds.ALLOCATED_LINES.items() for v in vals]
    monthly = allocation.line_postings_monthly(txn, seeds.line_selector_df(spark), seeds.prefix_lengths(), sel)
    cum = allocation.line_postings_cumulative(monthly, R.month_frame(spark, MONTHS))
    got = sorted(((r.month_key, r.id, r.area_code, r.amount) for r in
                  allocation.allocate_lines(cum, rt, seeds.line_catalog_df(spark)).collect()), key=str)
    assert got == brute_force(postings, rates)
