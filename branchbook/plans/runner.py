"""Monthly batch runner: ratios -> finance report -> ASM report, best effort.

The original runs three procedures for one month, each in its own
sub-transaction of one call: a failing step logs one error row and the next
step still runs (on whatever the previous tables hold).  Here each step

1. builds its result for all requested months as one Spark plan,
2. checks it (NOT NULL on the ratio table, per month),
3. stages the months as new versions (``sources.publish``) only after the build
   succeeded — so a failing month keeps its previous data, as the original's
   rolled-back DELETE does,
4. on failure appends one error-log row per month and carries on.

The next step reads what this run has staged over what is live, and one commit
at the end makes all tables and months of the run visible together: readers see
the warehouse before the run or after it, never a part of it, and a killed run
has changed nothing.

``run_changed`` runs what is stale only.  Every load leaves order-free
fingerprints of its months; a run commits, with its results, those it was built
from.  Months whose fingerprints differ have changed, and a fixed rule says what
they make stale (``stale_months``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.operators import asm as A
from branchbook.operators import headcount as H
from branchbook.operators import ratios as R
from branchbook.plans.books import Books, monthly_postings
from branchbook.sources import io, schemas as S, seeds
from branchbook.sources.publish import SLOT, Entry, Publisher, log_of, open_table
from branchbook.sources.scratch import RunFolder


@dataclass
class Tables:
    """Where the runner reads and writes.  Dimension paths left as ``None``
    use the fixed seed dimensions."""
    postings: str          # decoded fact_txn_month_data (Parquet)
    snapshot: str          # fact_kpi_month_raw_data (Parquet)
    kpi_asm: str           # fact_kpi_asm (Parquet)
    rate_table: str        # out: versions of rate_allocation_area_month
    finance_table: str     # out: versions of report_finance_table
    asm_table: str         # out: versions of report_asm_final_table
    error_log: str         # out: error_log (append)
    # kept monthly aggregates (optional): with them a run reads only the facts
    # of the months that changed since the last one
    postings_by_month: str | None = None
    cells_by_month: str | None = None
    headcount_by_load: str | None = None    # bitmaps per sheet load, and (in /names) the dictionary
    areas: str | None = None
    provinces: str | None = None
    regions: str | None = None
    commits: str | None = None      # commit log of the three outputs; by default beside the error log

    @property
    def commit_log(self) -> str:
        return self.commits or f"{self.error_log}_commits"


#: Output tables: field of ``Tables``, schema, month column.
OUTPUTS = {"rates": ("rate_table", S.RATE_ALLOCATION, "rate_month"),
           "finance": ("finance_table", S.REPORT_FINANCE, "month_key"),
           "asm": ("asm_table", S.REPORT_ASM, "month_key")}


def publisher(spark: SparkSession, t: Tables) -> Publisher:
    return Publisher(spark, t.commit_log)


def read_output(spark: SparkSession, t: Tables, name: str, months=None) -> DataFrame:
    """The published months of an output table: ``rates``, ``finance`` or ``asm``."""
    field, schema, _ = OUTPUTS[name]
    return publisher(spark, t).read(getattr(t, field), schema, months=months)


def _stage(out: Publisher, t: Tables, name: str, df: DataFrame, months: list[int], derive=None) -> None:
    """``derive``: the table's rows from rows of ``df`` (see ``Publisher.stage``)."""
    field, schema, month_col = OUTPUTS[name]

    def typed(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *[c for c in rows.columns if c == SLOT])

    out.stage(df if derive else typed(df), getattr(t, field), month_col, months=months,
              derive=(lambda rows: typed(derive(rows, [c for c in rows.columns if c == SLOT]))) if derive else None)


def _dims(spark: SparkSession, t: Tables):
    areas = io.read_table(spark, t.areas, S.DIM_AREA) if t.areas else seeds.areas_df(spark)
    provinces = io.read_table(spark, t.provinces, S.DIM_PROVINCE) if t.provinces else seeds.provinces_df(spark)
    regions = io.read_table(spark, t.regions, S.DIM_REGION) if t.regions else seeds.regions_df(spark)
    return areas, provinces, regions


def _facts(spark: SparkSession, t: Tables, last: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The staged facts; only folders of months up to ``last`` are opened."""
    txn = T.StructType([*S.TXN.fields, T.StructField("post_month", T.IntegerType())])
    return open_table(spark, t.postings, txn, last), open_table(spark, t.snapshot, S.KPI_MONTH_RAW, last)


def refresh_aggregates(spark: SparkSession, t: Tables, months: list[int]) -> None:
    """Rebuild the kept monthly aggregates of the months whose facts changed."""
    months = sorted({int(m) for m in months})
    txn, snapshot = _facts(spark, t)

    def keep(df: DataFrame, path: str, month_col: str) -> None:
        p = Publisher(spark, log_of(path))
        p.stage(df, path, month_col, months=months)
        p.commit()

    if t.postings_by_month:
        keep(monthly_postings(spark, txn, only=months), t.postings_by_month, "post_month")
    if t.cells_by_month:
        keep(R.snapshot_cells(snapshot.where(F.col("kpi_month").isin(months)), _dims(spark, t)[1]), t.cells_by_month, "kpi_month")


def refresh_headcount(spark: SparkSession, t: Tables, loads: list[int]) -> None:
    """Rebuild the kept headcount bitmaps of the sheet loads that changed."""
    loads = sorted({int(x) for x in loads})
    path = t.headcount_by_load
    sheet = Publisher(spark, log_of(t.kpi_asm)).read(t.kpi_asm, S.FACT_KPI_ASM, months=loads)
    folder = RunFolder(spark)
    try:
        names = Publisher(spark, log_of(f"{path}/names"))
        schema = T._parse_datatype_string(H.DICTIONARY)
        fresh = H.new_names(sheet, names.read(f"{path}/names", schema), folder.write)
        names.stage(fresh.withColumn("part", F.lit(0)), f"{path}/names", "part", adds=True)
        names.commit()
        p = Publisher(spark, log_of(path))
        p.stage(H.headcount_bitmaps(sheet, _dims(spark, t)[0], names.read(f"{path}/names", schema)), path, "month_key", months=loads)
        p.commit()
    finally:
        folder.close()


def kept_headcount(spark: SparkSession, t: Tables) -> DataFrame | None:
    """Headcounts from the kept bitmaps of all loads, if any are there."""
    p = Publisher(spark, log_of(t.headcount_by_load)) if t.headcount_by_load else None
    if p is None or not any(found[-1].version for found in p.live(t.headcount_by_load).values()):
        return None
    return H.merged_headcount(p.read(t.headcount_by_load, None))


def _kept(spark: SparkSession, path: str | None, last: int) -> DataFrame | None:
    """A kept aggregate up to the last report month, if any of it is there."""
    p = Publisher(spark, log_of(path)) if path else None
    if p is None or not any(found[-1].version and int(s) <= last for s, found in p.live(path).items()):
        return None
    return p.read(path, None, upto=last)


def books_for(spark: SparkSession, t: Tables, months: list[int], rate_table: DataFrame | None = None) -> Books:
    areas, provinces, regions = _dims(spark, t)
    last = max(months)
    txn, snapshot = _facts(spark, t, last)
    return Books(spark, txn=txn, snapshot=snapshot, kpi_asm=open_table(spark, t.kpi_asm, S.FACT_KPI_ASM),
                 areas=areas, provinces=provinces, regions=regions, months=months,
                 materialize="table", strict=False, rate_table=rate_table, headcount=kept_headcount(spark, t),
                 postings_by_month=_kept(spark, t.postings_by_month, last), cells_by_month=_kept(spark, t.cells_by_month, last))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _each(spark: SparkSession, t: Tables, proc: str, months: list[int], log: list, step) -> list[int]:
    """Run ``step`` for all months in one plan; if that fails, for each half, so
    that a bad month fails alone (one error row for it, the others built) and
    costs about log2(months) runs."""
    if not months:
        return []
    start = _now()
    try:
        return step(months, start)
    except Exception as e:  # noqa: BLE001 — best effort, as the original
        if len(months) == 1:
            msg = f"{type(e).__name__}: {e}"
            io.append_error_log(spark, t.error_log, proc, months[0], msg, start, _now())
            log.append((proc, months[0], msg))
            return []
    half = len(months) // 2
    return [m for part in (months[:half], months[half:]) for m in _each(spark, t, proc, part, log, step)]


def step_ratios(spark: SparkSession, t: Tables, months: list[int], log: list, out: Publisher) -> list[int]:
    """rate_area_month for the months; returns the months staged."""
    def step(months, start):
        b = books_for(spark, t, months)
        try:
            built = b.ratios        # written table; strict=False keeps NULLs for the check
            bad = {r["rate_month"]: (r["null_area"], r["null_ratio"])
                   for r in R.ratio_violations(built).collect()   # one row per month
                   if r["null_area"] or r["null_ratio"]}
            good = [m for m in months if m not in bad]
            if good:
                _stage(out, t, "rates", built, good)
        finally:
            b.close()
        for m, (na, nr) in sorted(bad.items()):
            msg = (f'null value in column "{"area_code" if na else "ratio"}" of relation '
                   f'"rate_allocation_area_month" violates not-null constraint ({na} NULL areas, {nr} NULL ratios)')
            io.append_error_log(spark, t.error_log, "rate_area_month", m, msg, start, _now())
            log.append(("rate_area_month", m, msg))
        return good
    return _each(spark, t, "rate_area_month", months, log, step)


def step_finance(spark: SparkSession, t: Tables, months: list[int], log: list, out: Publisher) -> list[int]:
    def step(months, start):
        # the step reads the stored ratios (possibly older ones, if this run's
        # ratio step failed for a month — as the original does)
        rates = out.read(t.rate_table, S.RATE_ALLOCATION, months=months)
        b = books_for(spark, t, months, rate_table=rates)
        try:
            _stage(out, t, "finance", b.finance, months)
        finally:
            b.close()
        return list(months)
    return _each(spark, t, "report_finance", months, log, step)


def step_asm(spark: SparkSession, t: Tables, months: list[int], log: list, out: Publisher) -> list[int]:
    def step(months, start):
        b = books_for(spark, t, months)
        try:
            fin = out.read(t.finance_table, S.REPORT_FINANCE, months=months)
            # the copies of a row are made where they are written
            scored = A.scored_report(b.kpi_asm, b.areas, fin, b.npl_by_area, b.months, b.folder.write)
            _stage(out, t, "asm", scored, months, A.unfold_scores)
        finally:
            b.close()
        return list(months)
    return _each(spark, t, "report_asm", months, log, step)


STEPS = {"ratios": step_ratios, "finance": step_finance, "asm": step_asm}


def _run_steps(spark: SparkSession, t: Tables, months: dict[str, list[int]], out: Publisher) -> list[tuple]:
    log: list[tuple] = []
    for name, step in STEPS.items():
        if months.get(name):
            step(spark, t, months[name], log, out)
    return log


def run_month(spark: SparkSession, t: Tables, months, steps=("ratios", "finance", "asm"), changed=()) -> list[tuple]:
    """Run the three steps in order for one month or a list of months, and
    publish their results together.

    ``changed``: fact months loaded since the last run; their kept monthly
    aggregates are rebuilt first (if ``t`` keeps any).

    Returns the error rows written by this run (also appended to
    ``t.error_log``); an empty list means every step succeeded.
    """
    months = [int(months)] if isinstance(months, int) else sorted({int(m) for m in months})
    if changed:
        refresh_aggregates(spark, t, list(changed))
    out = publisher(spark, t)
    log = _run_steps(spark, t, {s: months for s in steps}, out)
    out.commit()
    return log


# -- what changed, and what that makes stale -----------------------------------

INPUT, FAILED = "input:", "failed"


def _changed(spark: SparkSession, t: Tables, out: Publisher) -> dict[str, dict[str, str | None]]:
    """Input table -> slots whose content differs from what the last
    incremental run was built from (with the fingerprint of now)."""
    found = {}
    for path in (t.postings, t.snapshot, t.kpi_asm):
        now = Publisher(spark, log_of(path)).fingerprint(path)
        before = {s: e[-1].fingerprint for s, e in out.live(INPUT + path).items()}
        found[path] = {s: now.get(s) for s in {*now, *before} if now.get(s) != before.get(s)}
    return found


def stale_months(reported, postings=(), snapshot=(), sheet=False) -> dict[str, list[int]]:
    """The report months that changed inputs make stale, per step.

    * Snapshot month c: write-offs cumulate, so the ratios of all months from c
      on, and with them the finance and salesperson reports.
    * Postings of month c: lines cumulate without a lower bound, so the finance
      and salesperson reports from c on; the ratios do not read postings.
    * The KPI sheet: its months are months of the year, so every report month
      may read it: all reports.
    """
    months = sorted({int(m) for m in reported})
    first = min((int(c) for c in snapshot), default=None)
    ratios = [m for m in months if sheet or first is not None and m >= first]
    cut = min((int(c) for c in postings), default=None)
    finance = [m for m in months if m in set(ratios) or cut is not None and m >= cut]
    return {"ratios": ratios, "finance": finance, "asm": list(finance)}


def run_changed(spark: SparkSession, t: Tables, months=(), commit_id: str | None = None,
                steps=("ratios", "finance", "asm")) -> tuple[dict, list[tuple]]:
    """Run the stale months only: equal to a full run of all report months.

    Report months are those published so far and ``months`` (new ones run all
    steps).  Months that failed in the last run are tried again.  Returns the
    months run per step and the error rows.
    """
    out = publisher(spark, t)
    changed = _changed(spark, t, out)
    known = {int(s) for s in out.live(t.finance_table)}
    again = {int(s) for s, e in out.live(FAILED).items() if e[-1].version}
    new = {int(m) for m in months} - known
    todo = stale_months(known | again, changed[t.postings], changed[t.snapshot], bool(changed[t.kpi_asm]))
    todo = {s: sorted({*found, *again, *new}) for s, found in todo.items() if s in steps}
    facts = {int(s) for p in (t.postings, t.snapshot) for s in changed[p]}
    if facts and (t.postings_by_month or t.cells_by_month):
        refresh_aggregates(spark, t, sorted(facts))
    if changed[t.kpi_asm] and t.headcount_by_load:
        refresh_headcount(spark, t, [int(s) for s in changed[t.kpi_asm]])
    log = _run_steps(spark, t, todo, out)
    for path, slots in changed.items():
        out.pending += [Entry(INPUT + path, s, "built" if f else None, fingerprint=f) for s, f in sorted(slots.items())]
    bad = {m for _, m, _ in log}
    out.pending += [Entry(FAILED, str(m), "failed" if m in bad else None) for m in sorted(again | bad)]
    out.commit(commit_id)
    return todo, log


def read_error_log(spark: SparkSession, t: Tables) -> DataFrame:
    return io.read_table(spark, t.error_log, S.ERROR_LOG)
