"""Balance-based ratio methods vs a brute-force evaluation on random snapshots
(unknown cities, NULL buckets and balances, months without rows, write-off gaps)."""

import random
from decimal import ROUND_HALF_UP, Decimal as D, localcontext

import pytest
from pyspark.sql import functions as F

from branchbook.operators import ratios as R
from branchbook.sources import schemas as S

CITY = {"b1": "B", "b2": "B", "c1": "C", "d1": "D"}
MONTHS = [202301, 202302, 202303, 202305]
FILTERS = {
    "AWO": lambda b: True,
    "AWO_GR1": lambda b: b == 1 or b is None,
    "AWO_GR2": lambda b: b == 2,
    "AWO_GR2_5": lambda b: b in (2, 3, 4, 5),
}


def _q(num, den):
    with localcontext() as ctx:
        ctx.prec = 60
        return (D(num) / D(den)).quantize(D("1e-10"), rounding=ROUND_HALF_UP)


def _shares(parts):
    total = sum(v for v in parts.values() if v is not None)
    return {a: (None if v is None or total == 0 else _q(v, total)) for a, v in parts.items()}


def brute(rows):
    out = {}
    for p in MONTHS:
        upto = [r for r in rows if r[0] <= p]
        for code, keep in FILTERS.items():
            parts = {}
            for r in upto:
                if keep(r[5]):
                    a = CITY.get(r[1])
                    parts.setdefault(a, None)
                    if r[2] is not None:
                        parts[a] = (parts[a] or 0) + r[2]
            for a, v in _shares(parts).items():
                out[(p, code, a)] = v
        parts = {}
        for r in upto:
            a = CITY.get(r[1])
            parts.setdefault(a, None)
            if r[6] is not None:
                parts[a] = (parts[a] or 0) + r[6]
        for a, v in _shares(parts).items():
            out[(p, "WO_PSDN", a)] = v
        # BWO_GR2_5
        wo_months = {}
        for r in rows:
            a = CITY.get(r[1])
            if a is not None and r[3] == r[0]:
                cell = wo_months.setdefault((r[0], a), None)
                if r[4] is not None:
                    wo_months[(r[0], a)] = (cell or 0) + r[4]
        def lk(m, a):
            vals = [v for (mm, aa), v in wo_months.items() if aa == a and mm <= m and v is not None]
            return sum(vals) if vals else None
        op25 = {}
        for r in rows:
            if r[5] in (2, 3, 4, 5):
                k = (r[0], CITY.get(r[1]))
                op25.setdefault(k, None)
                if r[2] is not None:
                    op25[k] = (op25[k] or 0) + r[2]
        amount, lks = {}, {}
        for (m, a), v in op25.items():
            if m > p:
                continue
            b_area = a if (a is not None and (m, a) in wo_months) else None
            amount.setdefault(b_area, None)
            lks.setdefault(b_area, None)
            if v is not None:
                amount[b_area] = (amount[b_area] or 0) + v
            t = lk(m, a) if b_area is not None else None
            if t is not None:
                lks[b_area] = (lks[b_area] or 0) + t
        vals = {a: (None if amount[a] is None or lks[a] is None else amount[a] + lks[a]) for a in amount}
        total = sum(v for v in vals.values() if v is not None)
        for a, v in vals.items():
            out[(p, "BWO_GR2_5", a)] = None if v is None else _q(v, total)
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_balance_ratios_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for m in MONTHS[:-1] + [202304]:
        for _ in range(rng.randint(5, 25)):
            city = rng.choice(list(CITY) + ["nowhere"])
            rows.append((m, city, rng.choice([None] + [rng.randint(1, 10**6)] * 4),
                         m if rng.random() < 0.6 else rng.choice([None, m - 1]),
                         rng.choice([None, rng.randint(1, 1000)]), rng.choice([None, 1, 2, 3, 4, 5]),
                         rng.choice([None, rng.randint(0, 9)])))
    snap = spark.createDataFrame(rows, S.KPI_MONTH_RAW)
    prov = spark.createDataFrame([("01", c, a) for c, a in CITY.items()], S.DIM_PROVINCE)
    cells = R.snapshot_cells(snap, prov)
    months = R.month_frame(spark, MONTHS)
    parts = R.balance_ratios(cells, months).unionByName(R.pre_writeoff_ratios(cells, months))
    # the table stores decimal(18,10), as allocation_ratios casts
    got = {(r.rate_month, r.method_code, r.area_code): r.ratio
           for r in parts.select("rate_month", "method_code", "area_code",
                                 F.col("ratio").cast("decimal(18,10)").alias("ratio")).collect()}
    exp = brute(rows)
    diff = {k: (got.get(k, "MISSING"), exp.get(k, "MISSING")) for k in set(got) | set(exp) if got.get(k, "M") != exp.get(k, "M")}
    assert not diff, sorted(diff.items(), key=str)[:8]
