"""Salesperson (ASM) ranking: averages, NPL, finance lookups, ranks, scores.

All steps run for every report month at once.  The sheet filters look at the
month of the year only (at most 12 results can differ), so averages and
lookups are computed per month of the year and then attached to the report
months; so are the joins that feed the ranks (``asm_rows``), and equal rows are
one row with their number until the last step.  Ranks are range-partitioned (``operators.ranking``): no task holds a
whole month.

Ordering follows the original database: NULLs sort as the largest value
(first when descending, last when ascending).  ROW_NUMBER ties, arbitrary in
the original, are broken by (email, area_name, sale_name) so results are
reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.columns import month_of_year
from branchbook.operators import ranking
from branchbook.operators import ratios as R
from branchbook.operators.geo import area_by_name
from branchbook.operators.ranking import RankSpec
from branchbook.sources.local import local_table
from branchbook.sources.schemas import REPORT_ASM

TIE_BREAK = ["email", "area_name", "sale_name"]
FINANCE_LOOKUPS = [(29, "cir"), (30, "margin"), (31, "hs_von"), (32, "hsbp_nhan_su")]
OF_THE_AREAS = ["npl_truoc_wo_luy_ke", *[n for _, n in FINANCE_LOOKUPS]]


def _months_join(df: DataFrame, months: DataFrame, cond) -> DataFrame:
    """Equality with the (calendar-bounded, inline) month list: broadcast hash join."""
    return df.join(F.broadcast(months), cond)


def _up_to_month_of_year(df: DataFrame, months: DataFrame, sheet_month: str) -> DataFrame:
    """Repeat rows for each month of the year p (of some report month) with
    ``sheet_month <= p``: at most 12 times, an explode over a literal list."""
    arr = F.array(*[F.lit(m) for m in sorted({m % 100 for m in R.month_values(months)})])
    return df.withColumn("moy", F.explode(F.filter(arr, lambda p: F.col(sheet_month) <= p)))


def _to_report_months(df: DataFrame, months: DataFrame) -> DataFrame:
    """Rows per month of the year -> rows per report month (``month_key``)."""
    rm = months.columns[0]
    return (_months_join(df, months, F.col("moy") == month_of_year(F.col(rm)))
            .withColumn("month_key", F.col(rm)).drop("moy", rm))


def asm_averages(fact_kpi_asm: DataFrame, months: DataFrame) -> DataFrame:
    """Per report month and (area_name, sale_name, email): the averages of
    loan_to_new, psdn and approval_rate over month_col <= month % 100, each
    over its non-NULL values, with ``n_*`` telling whether the group exists in
    the original's per-measure table (it does iff it has a non-NULL value).
    Groups without any value exist in none of them and are left out.
    """
    return _to_report_months(_averages(fact_kpi_asm, months), months).select(
        "month_key", "area_name", "sale_name", "email", "ltn_avg", "n_ltn", "psdn_avg", "n_psdn", "approval_rate_avg", "n_ar")


def _averages(fact_kpi_asm: DataFrame, months: DataFrame) -> DataFrame:
    """``asm_averages`` per month of the year (``moy``); ``n_now``: the rows with
    an approval rate of that month itself."""
    pre = fact_kpi_asm.groupBy("month_col", "area_name", "sale_name", "email").agg(
        F.sum(F.col("loan_to_new").cast("decimal(19,0)")).alias("s_ltn"), F.count("loan_to_new").alias("n_ltn"),
        F.sum("psdn").alias("s_psdn"), F.count("psdn").alias("n_psdn"),
        F.sum(F.col("approval_rate").cast("double")).alias("s_ar"), F.count("approval_rate").alias("n_ar"))
    g = _up_to_month_of_year(pre, months, "month_col").groupBy("moy", "area_name", "sale_name", "email").agg(
        F.sum("s_ltn").alias("s_ltn"), F.sum("n_ltn").alias("n_ltn"),
        F.sum("s_psdn").alias("s_psdn"), F.sum("n_psdn").alias("n_psdn"),
        F.sum("s_ar").alias("s_ar"), F.sum("n_ar").alias("n_ar"),
        F.sum(F.when(F.col("month_col") == F.col("moy"), F.col("n_ar")).otherwise(0)).alias("n_now"))
    g = g.where(F.col("n_ltn") + F.col("n_psdn") + F.col("n_ar") > 0)

    def avg(s, n):
        return F.when(F.col(n) > 0, F.col(s).cast("double") / F.col(n))

    return g.select(
        "moy", "area_name", "sale_name", "email", avg("s_ltn", "n_ltn").alias("ltn_avg"), "n_ltn",
        avg("s_psdn", "n_psdn").alias("psdn_avg"), "n_psdn", avg("s_ar", "n_ar").alias("approval_rate_avg"), "n_ar", "n_now")


def measure_averages(averages: DataFrame) -> DataFrame:
    """The original's three per-measure tables, one row per measure and group
    that has a value."""
    long = averages.select("month_key", "area_name", "sale_name", "email", F.stack(
        F.lit(3), F.lit("loan_to_new"), F.col("n_ltn"), F.col("ltn_avg"), F.lit("psdn"), F.col("n_psdn"),
        F.col("psdn_avg"), F.lit("approval_rate"), F.col("n_ar"), F.col("approval_rate_avg")).alias(
            "measure", "n", "average"))
    return long.where(F.col("n") > 0).drop("n")


def npl_by_area(cells: DataFrame, writeoff_cum: DataFrame, months: DataFrame) -> DataFrame:
    """NPL before write-off for the report month itself, per area:

        (bucket 3-5 balance + cumulative write-off) * 100
        / NULLIF(total balance + cumulative write-off, 0)

    An area needs all three inputs in that month (inner joins): a bucket 3-5
    loan, any loan, and a write-off booked in the month.  Areas come from an
    inner city lookup.
    """
    rm = months.columns[0]
    c = cells.where(F.col("area_code").isNotNull() & (F.col("n_npl") > 0) & (F.col("n_all") > 0))
    c = _months_join(c, months, F.col("kpi_month") == F.col(rm))
    w = writeoff_cum.select(F.col("month_key").alias("kpi_month"), "area_code", "total_lk")
    j = c.join(w, ["kpi_month", "area_code"])
    wo = F.coalesce(F.col("total_lk"), F.lit(0)).cast("decimal(38,0)")
    num = (F.coalesce(F.col("s_npl"), F.lit(0)).cast("decimal(38,0)") + wo) * 100
    den = F.coalesce(F.col("s_tot"), F.lit(0)).cast("decimal(38,0)") + wo
    npl = num.cast("double") / F.when(den != 0, den.cast("double"))
    return j.select(F.col(rm).alias("month_key"), "area_code", npl.alias("npl_truoc_wo_luy_ke"))


def npl_by_asm(fact_kpi_asm: DataFrame, areas: DataFrame, npl_area: DataFrame, months: DataFrame) -> DataFrame:
    """Area NPL attached to every sheet row of the report month with an
    approval rate (not de-duplicated, as in the original)."""
    rm = months.columns[0]
    rows = fact_kpi_asm.where(F.col("approval_rate").isNotNull()).select(
        "month_col", "area_name", "sale_name", "email")
    rows = _months_join(rows, months, F.col("month_col") == month_of_year(F.col(rm)))
    rows = area_by_name(rows, areas).select(F.col(rm).alias("month_key"), "area_name", "sale_name", "email",
                                            "area_code")
    # npl_area has one row per (month, area); its measured size decides the join
    return rows.join(npl_area, ["month_key", "area_code"], "left").select(
        "month_key", "area_name", "sale_name", "email", "npl_truoc_wo_luy_ke")


def finance_lookup(fact_kpi_asm: DataFrame, areas: DataFrame, finance: DataFrame, months: DataFrame) -> DataFrame:
    """The area's lines 29-32 for every salesperson seen up to the month with
    an approval rate: distinct (month, area_name, sale_name, email, id,
    amount).  One join for the four lines instead of four."""
    people = _to_report_months(_people(fact_kpi_asm, areas, months), months)
    lines = finance.where(F.col("id").isin([i for i, _ in FINANCE_LOOKUPS])).select(
        "month_key", "area_code", "id", "amount")
    return people.join(lines, ["month_key", "area_code"]).select(
        "month_key", "area_name", "sale_name", "email", "id", "amount").distinct()


def _people(fact_kpi_asm: DataFrame, areas: DataFrame, months: DataFrame) -> DataFrame:
    """Salespeople with an approval rate up to the month of the year, and the areas of their area name."""
    people = (fact_kpi_asm.where(F.col("approval_rate").isNotNull())
              .select("month_col", "area_name", "sale_name", "email"))
    people = area_by_name(people.distinct(), areas)
    return _up_to_month_of_year(people, months, "month_col").select(
        "moy", "area_name", "sale_name", "email", "area_code").distinct()


def asm_joined(averages: DataFrame, npl_asm: DataFrame, lookup: DataFrame) -> DataFrame:
    """The 8-way left join on (email, month) feeding the ranks.

    The loan-average table drives the join; every other input joins by
    email alone, so an email under two names or areas fans out, as in the
    original.
    """
    l_ = averages.where(F.col("n_ltn") > 0).select("month_key", "email", "area_name", "sale_name", "ltn_avg")
    p_ = averages.where(F.col("n_psdn") > 0).select("month_key", "email", "psdn_avg")
    ar = averages.where(F.col("n_ar") > 0).select("month_key", "email", "approval_rate_avg")
    n_ = npl_asm.select("month_key", "email", "npl_truoc_wo_luy_ke")
    j = l_.join(p_, ["month_key", "email"], "left").join(ar, ["month_key", "email"], "left") \
          .join(n_, ["month_key", "email"], "left")
    for lid, name in FINANCE_LOOKUPS:
        one = lookup.where(F.col("id") == lid).select("month_key", "email", F.col("amount").alias(name))
        j = j.join(one, ["month_key", "email"], "left")
    return j


COPIES = "n_copies"


def _email_rows(fact_kpi_asm: DataFrame, areas: DataFrame, months: DataFrame) -> DataFrame:
    """Per month of the year, a row per identity with a loan average, and what its
    email joins: the other averages (``__p``, ``__ar``), the areas that give NPLs
    and how many each (``__npl``), the identities that get lines (``__who``)."""
    # the identities of an email (each alone, if it has none: NULL joins nothing), gathered once
    nobody = F.col("email").isNull()
    names = areas.groupBy("area_name").agg(F.collect_list(F.struct("area_code")).alias("codes"))
    g = (_averages(fact_kpi_asm, months).join(names, "area_name", "left")
         .groupBy("moy", "email", F.when(nobody, F.struct("area_name", "sale_name")).alias("__alone"))
         .agg(F.collect_list(F.struct("area_name", "sale_name", "ltn_avg", "n_ltn", "psdn_avg", "n_psdn", "approval_rate_avg",
                                      "n_ar", "n_now", "codes")).alias("__all")))
    s = F.col("__all")
    joined = lambda count: F.filter(F.when(~nobody, s), lambda x: x[count] > 0)
    # a sheet row of the month itself gives a row with its area's NPL (which may be missing)
    now = joined("n_now")
    named = lambda **of: F.named_struct(*[x for k, c in of.items() for x in (F.lit(k), c)])
    rated = F.transform(F.array_distinct(F.transform(now, lambda x: named(area_name=x["area_name"], codes=x["codes"]))), lambda a: named(
        codes=F.coalesce(a["codes"], F.array(F.struct(F.lit(None).cast("string").alias("area_code")))),
        n=F.aggregate(F.filter(now, lambda x: x["area_name"].eqNullSafe(a["area_name"])), F.lit(0).cast("bigint"),
                      lambda n, x: n + x["n_now"])))
    npl_of = F.flatten(F.transform(rated, lambda a: F.transform(a["codes"], lambda c: named(area_code=c["area_code"], n=a["n"]))))
    # the identities of an email whose areas' lines it gets
    who = F.array_distinct(F.flatten(F.transform(F.filter(joined("n_ar"), lambda x: x["codes"].isNotNull()), lambda x: F.transform(
        F.filter(x["codes"], lambda c: c["area_code"].isNotNull()), lambda c: named(
            area_name=x["area_name"], sale_name=x["sale_name"], area_code=c["area_code"])))))
    return g.select("moy", "email", F.transform(joined("n_psdn"), lambda x: x["psdn_avg"]).alias("__p"),
                 F.transform(joined("n_ar"), lambda x: x["approval_rate_avg"]).alias("__ar"), npl_of.alias("__npl"), who.alias("__who"),
                 F.inline(F.transform(F.filter(s, lambda x: x["n_ltn"] > 0), lambda x: named(
                     area_name=x["area_name"], sale_name=x["sale_name"], ltn_avg=x["ltn_avg"]))))


def _npl(npl_area: DataFrame) -> DataFrame:
    return npl_area.select("month_key", F.col("area_code").alias("__npl_area"), "npl_truoc_wo_luy_ke")


def _lookup_rows(finance: DataFrame) -> DataFrame:
    return finance.where(F.col("id").isin([i for i, _ in FINANCE_LOOKUPS]) & F.col("area_code").isNotNull())


def _lines(finance: DataFrame) -> DataFrame:
    """Per month and area the distinct amounts of lines 29-32."""
    return _lookup_rows(finance).groupBy("month_key", "area_code").agg(
        *[F.collect_set(F.when(F.col("id") == i, F.struct("amount"))).alias(name) for i, name in FINANCE_LOOKUPS])


def _line_maps(lines: DataFrame) -> DataFrame:
    return lines.groupBy("month_key").agg(F.map_from_entries(F.collect_list(F.struct(
        "area_code", F.struct(*[n for _, n in FINANCE_LOOKUPS])))).alias("__lines"))


def _amounts(name: str):
    """The distinct (identity, amount) of the email's areas: almost always one identity."""
    of = lambda w: F.coalesce(F.try_element_at("__lines", w["area_code"])[name], F.array().cast("array<struct<amount:decimal(38,10)>>"))
    every = F.array_distinct(F.flatten(F.transform("__who", lambda w: F.transform(
        of(w), lambda x: F.struct(w["area_name"], w["sale_name"], x["amount"].alias("amount"))))))
    return F.when(F.size("__who") == 1, of(F.col("__who")[0])).otherwise(F.transform(every, lambda x: F.struct(x["amount"].alias("amount"))))


def _with_amounts(j: DataFrame) -> DataFrame:
    """A row per amount of each line."""
    for _, name in FINANCE_LOOKUPS:
        j = j.withColumn("__x", F.explode_outer(_amounts(name))).withColumn(name, F.col("__x.amount")).drop("__x")
    return j


def asm_rows(fact_kpi_asm: DataFrame, areas: DataFrame, finance: DataFrame, npl_area: DataFrame,
             months: DataFrame) -> DataFrame:
    """The rows of ``asm_joined(asm_averages, npl_by_asm, finance_lookup)``, equal
    ones as one row with their number (``n_copies``).

    What a month takes from the sheet depends on the month of the year only, so
    the joins by email are taken inside one row per email and month of the year,
    which holds the email's identities: one exchange for all of them.  What it
    takes from the areas (NPL, lines 29-32) is months x areas rows and is
    broadcast to the rows after they are attached to the report months.
    """
    j = _email_rows(fact_kpi_asm, areas, months)
    for many, of in (("__p", F.explode_outer("__p").alias("psdn_avg")), ("__ar", F.explode_outer("__ar").alias("approval_rate_avg")),
                     ("__npl", F.inline_outer("__npl").alias("__npl_area", "__n"))):
        j = j.select(*[c for c in j.columns if c != many], of)
    j = j.withColumn(COPIES, F.coalesce("__n", F.lit(1))).drop("__n")
    j = _to_report_months(j, months)

    j = j.join(F.broadcast(_npl(npl_area)), ["month_key", "__npl_area"], "left")
    j = _with_amounts(j.join(F.broadcast(_line_maps(_lines(finance))), "month_key", "left"))
    return j.select("month_key", "email", "area_name", "sale_name", "ltn_avg", "psdn_avg", "approval_rate_avg",
                    "npl_truoc_wo_luy_ke", *[n for _, n in FINANCE_LOOKUPS], COPIES)


RANKS = [
    RankSpec("rank_ltn", "row_number", "ltn_avg", descending=True),
    RankSpec("rank_psdn", "row_number", "psdn_avg", descending=True),
    RankSpec("rank_approval", "row_number", "approval_rate_avg", descending=True),
    RankSpec("rank_npl", "rank", "npl_truoc_wo_luy_ke"),
    RankSpec("rank_cir", "dense_rank", "cir", descending=True),
    RankSpec("rank_margin", "dense_rank", "margin", descending=True),
    RankSpec("rank_hs_von", "dense_rank", "hs_von"),
    RankSpec("rank_hsbp", "dense_rank", "hsbp_nhan_su", descending=True),
]
SCORE_RANKS = [
    RankSpec("rank_final", "row_number", "tong_diem"),
    RankSpec("rank_ptkd", "row_number", "diem_quymo"),
    RankSpec("rank_fin", "rank", "diem_fin"),
]


ROW_NUMBERS = [s.name for s in RANKS if s.function == "row_number"]


def rank_rows(rows: DataFrame, store) -> DataFrame:
    """The 8 ranks of ``asm_rows``, written: a row per distinct row, ``__row``
    in the order that breaks ties, and the ROW_NUMBERs of its first copy.  Rows
    of one identity (an email with several sheet rows fans out) are told apart
    by the loan average, largest first, and the other inputs."""
    rest = [F.col(c) for c in ("psdn_avg", "approval_rate_avg", "npl_truoc_wo_luy_ke", *[n for _, n in FINANCE_LOOKUPS])]
    tie = [*[F.col(c) for c in TIE_BREAK], -F.col("ltn_avg"), *rest]
    base = ranking.numbered_rows(rows, "month_key", tie, store)
    return store(ranking.rank_columns(base, RANKS, "month_key", store, copies=COPIES), "ranks")


def _month_classes(finance: DataFrame, months: DataFrame) -> DataFrame:
    """month_key, moy, class: months of one class (named by its first month) read
    the same months of the sheet, and in each line the same areas have amounts and
    equal ones, so that an email has as many rows in all of them."""
    amount = F.coalesce(F.col("amount").cast("string"), F.lit(""))
    lines = (_lookup_rows(finance).select("month_key", "id", "area_code", amount.alias("a")).distinct()
             .groupBy("month_key", "id").agg(F.sort_array(F.collect_list(F.struct("area_code", "a"))).alias("s")))
    equal = F.transform("s", lambda x: F.struct(x["area_code"].alias("area"), F.array_position(F.array_distinct("s.a"), x["a"]).alias("n")))
    shape = lines.select("month_key", F.struct("id", equal.alias("equal")).alias("line")).groupBy("month_key").agg(
        F.sort_array(F.collect_list("line")).alias("shape"))
    rm = months.columns[0]
    found = months.select(F.col(rm).alias("month_key"), month_of_year(F.col(rm)).alias("moy")).join(shape, "month_key", "left")
    found = found.groupBy("moy", "shape").agg(F.min("month_key").alias("class"), F.collect_list("month_key").alias("of"))
    # bounded by the calendar: an inline table
    rows = sorted((m, r["moy"], r["class"]) for r in found.select("moy", "class", "of").collect() for m in r["of"])
    return local_table(months.sparkSession, rows, "month_key int, moy int, class int")


def _class_rows(fact_kpi_asm: DataFrame, areas: DataFrame, finance: DataFrame, months: DataFrame, classes: DataFrame) -> DataFrame:
    """``_email_rows`` per class of months, a row per identity and averages that
    its email joins; ``__weight``: the rows that it is in each month of the class."""
    def counted(c: str, name: str):
        return F.explode_outer(F.transform(F.array_distinct(c), lambda v: F.struct(
            v.alias(name), F.size(F.filter(c, lambda x: x.eqNullSafe(v))).cast("bigint").alias("n"))))

    j = _email_rows(fact_kpi_asm, areas, months)
    for many, name in (("__p", "psdn_avg"), ("__ar", "approval_rate_avg")):
        j = j.withColumn(many, counted(many, name)).withColumn(name, F.col(many)[name]).withColumn(many, F.coalesce(F.col(many)["n"], F.lit(1).cast("bigint")))
    nowhere = F.array(F.struct(F.lit(None).cast("string").alias("area_code"), F.lit(1).cast("bigint").alias("n")))
    npl = F.transform(F.when(F.size("__npl") > 0, F.col("__npl")).otherwise(nowhere), lambda x: F.struct(
        x["area_code"].alias("area_code"), (x["n"] * F.col("__p") * F.col("__ar")).alias("n")))
    j = j.withColumn("__npl", npl).drop("__p", "__ar").join(F.broadcast(classes.select("moy", "class").distinct()), "moy").drop("moy")
    j = j.join(F.broadcast(_line_maps(_lines(finance)).withColumnRenamed("month_key", "class")), "class", "left")
    lookups = F.lit(1).cast("bigint")
    for _, name in FINANCE_LOOKUPS:
        lookups = lookups * F.greatest(F.lit(1), F.size(_amounts(name)))
    j = j.withColumn("__lookups", lookups).drop("__lines")
    return j.withColumn("__one", (F.size("__npl") == 1) & (F.coalesce(F.size("__who"), F.lit(0)) <= 1) & (F.col("__lookups") == 1)).withColumn(
        "__weight", F.aggregate("__npl", F.lit(0).cast("bigint"), lambda n, x: n + x["n"]) * F.col("__lookups")).drop("__lookups")


def _month_rows(classed: DataFrame, finance: DataFrame, npl_area: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``asm_rows`` from those of the classes; ``__before``: the rows of
    the same class row that come earlier."""
    months, npl, lines = F.broadcast(classes.select("class", "month_key")), F.broadcast(_npl(npl_area)), _lines(finance)
    fanned = classed.where(~F.col("__one"))
    others = [c for c in classed.columns if c not in ("__npl", "__one", "__weight")]
    fanned = fanned.select(*others, F.inline("__npl").alias("__npl_area", COPIES)).join(months, "class").join(npl, ["month_key", "__npl_area"], "left")
    fanned = _with_amounts(fanned.join(F.broadcast(_line_maps(lines)), "month_key", "left"))
    earlier = Window.partitionBy("month_key", "__row").orderBy(*[F.col(c).asc_nulls_last() for c in OF_THE_AREAS]).rowsBetween(Window.unboundedPreceding, -1)
    fanned = fanned.withColumn("__before", F.coalesce(F.sum(COPIES).over(earlier), F.lit(0)))
    # an email of one area: a lookup each
    first = F.get("__npl", F.lit(0))
    one = classed.where("__one").select(*others, first["area_code"].alias("__npl_area"), first["n"].alias(COPIES),
                                        F.get("__who", F.lit(0))["area_code"].alias("__area"))
    amounts = lines.select("month_key", F.col("area_code").alias("__area"), *[F.get(n, F.lit(0))["amount"].alias(n) for _, n in FINANCE_LOOKUPS])
    one = (one.join(months, "class").join(npl, ["month_key", "__npl_area"], "left").join(F.broadcast(amounts), ["month_key", "__area"], "left")
           .withColumn("__before", F.lit(0).cast("bigint")))
    keep = [c for c in one.columns if c not in ("class", "__who", "__npl_area", "__area")]
    return one.select(*keep).unionByName(fanned.select(*keep))


def ranked_rows(fact_kpi_asm: DataFrame, areas: DataFrame, finance: DataFrame, npl_area: DataFrame, months: DataFrame, store) -> DataFrame:
    """``rank_rows`` of ``asm_rows``.

    The ROW_NUMBERs order by averages, which depend on the month of the year only:
    they are taken once per class of months (``_month_classes``), over the rows as
    they are before they are attached to months.  RANK and DENSE_RANK order by
    values of areas, taken once per distinct combination.
    """
    classes = _month_classes(finance, months)
    tie = [*[F.col(c) for c in TIE_BREAK], -F.col("ltn_avg"), F.col("psdn_avg"), F.col("approval_rate_avg")]
    rows = ranking.prefix_sums(_class_rows(fact_kpi_asm, areas, finance, months, classes), [c.asc_nulls_last() for c in tie], ["class"],
                               None, store, "__place")
    most = rows.agg(F.max("__weight")).first()[0] or 1      # numbers leave room for the rows of a class row
    numbered = lambda month: F.shiftleft(F.col(month).cast("bigint"), 44) + F.col("__place") * F.lit(most)
    classed = ranking.rank_columns(rows.withColumn("__row", numbered("class")), [s for s in RANKS if s.function == "row_number"], "class",
                                   store, copies="__weight")
    j = _month_rows(store(classed, "class_ranks"), finance, npl_area, classes)
    j = j.withColumns({"__row": numbered("month_key") + F.col("__before"),
                       **{n: (F.col(n) + F.col("__before")).cast("int") for n in ROW_NUMBERS}})
    j = j.select("month_key", "email", "area_name", "sale_name", "ltn_avg", "psdn_avg", "approval_rate_avg", *OF_THE_AREAS, COPIES, "__row", *ROW_NUMBERS)
    return store(ranking.value_ranks(j, [s for s in RANKS if s.function != "row_number"], "month_key", store, COPIES), "ranks")


def _each(ranked: DataFrame) -> DataFrame:
    """The copies of ``rank_rows`` one by one (``__copy`` from 0): equal rows take
    consecutive places in every ROW_NUMBER."""
    one = ranked.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col(COPIES).cast("int") - 1)))
    return one.withColumns({n: F.col(n) + F.col("__copy") for n in ROW_NUMBERS})


def each_ranked(ranked: DataFrame) -> DataFrame:
    """``rank_rows`` as the rows of ``asm_rank``."""
    return _each(ranked).drop("__copy", "__row", COPIES)


def asm_rank(averages: DataFrame, npl_asm: DataFrame, lookup: DataFrame, store) -> DataFrame:
    """The joined inputs with the 8 ranks, all from one range exchange."""
    return each_ranked(rank_rows(asm_joined(averages, npl_asm, lookup).withColumn(COPIES, F.lit(1).cast("bigint")), store))


def _with_scores(ranked: DataFrame) -> DataFrame:
    scale = F.col("rank_ltn") + F.col("rank_psdn") + F.col("rank_approval") + F.col("rank_npl")
    fin = F.col("rank_cir") + F.col("rank_margin") + F.col("rank_hs_von") + F.col("rank_hsbp")
    return ranked.select("*", scale.cast("bigint").alias("diem_quymo"), fin.cast("bigint").alias("diem_fin"),
                         (scale + fin).cast("bigint").alias("tong_diem"))


def _report_columns(s: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    renamed = {"rank_ltn_avg": "rank_ltn", "rank_psdn_avg": "rank_psdn",
               "rank_approval_rate_avg": "rank_approval", "rank_npl_truoc_wo_luy_ke": "rank_npl",
               "rank_hsbq_nhan_su": "rank_hsbp"}
    cols = []
    for f in REPORT_ASM.fields:
        src = renamed.get(f.name, f.name)
        cols.append(F.col(src).cast(f.dataType).alias(f.name))
    return s.select(*cols, *extra)


def asm_score(ranked: DataFrame, store) -> DataFrame:
    """Scale score (4 ranks), finance score (4 ranks), total, and their ranks."""
    return _report_columns(ranking.ranks_together(_with_scores(ranked), SCORE_RANKS, "month_key",
                                                  [F.col(c) for c in (*TIE_BREAK, "rank_ltn")], store))


def scored_rows(ranked: DataFrame, store) -> DataFrame:
    """``rank_rows`` with ``__numbers``, the (rank_final, rank_ptkd) of each copy, and
    rank_fin.  Copies differ in their ROW_NUMBERs, so in their scores; ``__row`` and
    ``__copy`` order them like TIE_BREAK and rank_ltn, so only narrow entries are
    sorted and the wide rows, one for all copies, move once."""
    return ranking.rank_columns(_with_scores(ranked), SCORE_RANKS, "month_key", store, copies=COPIES,
                                each=_with_scores(_each(ranked)), folded=True)


def unfold_scores(scored: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``scored_rows`` as the rows of the report.  ``extra``: more columns to pass through."""
    names = [*ROW_NUMBERS, "diem_quymo", "tong_diem"]
    plus = {n: F.col(n) + F.col("__copy") * (1 if n in ROW_NUMBERS else len(ROW_NUMBERS)) for n in names}
    return _report_columns(ranking.unfolded(scored).withColumns(plus), extra)


def score_rows(ranked: DataFrame, store) -> DataFrame:
    """``asm_score`` of ``rank_rows``."""
    return unfold_scores(scored_rows(ranked, store))


def scored_report(fact_kpi_asm: DataFrame, areas: DataFrame, finance: DataFrame, npl_area: DataFrame,
                  months: DataFrame, store) -> DataFrame:
    """``asm_report`` before ``unfold_scores``."""
    return scored_rows(ranked_rows(fact_kpi_asm, areas, finance, npl_area, months, store), store)


def asm_report(fact_kpi_asm: DataFrame, areas: DataFrame, finance: DataFrame, npl_area: DataFrame,
               months: DataFrame, store) -> DataFrame:
    return unfold_scores(scored_report(fact_kpi_asm, areas, finance, npl_area, months, store))
