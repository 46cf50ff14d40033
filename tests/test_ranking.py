"""Range-partitioned ranking equals the window functions (ties, NULLs, groups)."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from branchbook.operators import ranking
from branchbook.sources.scratch import RunFolder


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    rows = [(rng.choice([1, 2, 3]), i, rng.choice([None, 1.0, 2.0, 2.0, 3.5, 7.0, 7.0, 9.0]))
            for i in range(400)]
    return spark.createDataFrame(rows, "g int, id int, v double")


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_row_number_rank_dense_rank_match_windows(spark, data, groups):
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    w = Window.partitionBy(*groups).orderBy(*order) if groups else Window.orderBy(*order)
    wk = Window.partitionBy(*groups).orderBy(F.col("v").desc_nulls_first()) if groups else \
        Window.orderBy(F.col("v").desc_nulls_first())
    exp = {r.id: (r.rn, r.rk, r.dr) for r in data.select(
        "id", F.row_number().over(w).alias("rn"), F.rank().over(wk).alias("rk"),
        F.dense_rank().over(wk).alias("dr")).collect()}
    rn = {r.id: r.rn for r in ranking.row_number(data, order, groups, RunFolder(spark).write, "rn", num_partitions=7).collect()}
    rk = {r.id: r.rk for r in ranking.rank(data, ["v"], [F.col("v").desc_nulls_first()], groups, RunFolder(spark).write, "rk").collect()}
    dr = {r.id: r.dr for r in
          ranking.dense_rank(data, ["v"], [F.col("v").desc_nulls_first()], groups, RunFolder(spark).write, "dr").collect()}
    assert len(rn) == len(rk) == len(dr) == 400
    assert {i: (rn[i], rk[i], dr[i]) for i in exp} == exp


def test_a_hot_key_is_one_row_of_the_key_table(spark):
    """100,000 rows over two values: no written slice holds them."""
    df = spark.range(100_000).select((F.col("id") % 1000 == 0).cast("int").alias("v"))
    written = []

    def store(x, name):
        written.append(RunFolder(spark).write(x, name))
        return written[-1]

    got = ranking.rank(df, ["v"], [F.col("v").asc()], [], store).groupBy("v", "rank").count().collect()
    assert sorted(map(tuple, got)) == [(0, 1, 99_900), (1, 99_901, 100)]
    assert [w.count() for w in written] == [2]


def test_ranks_together_match_windows_with_one_range_exchange(spark):
    from decimal import Decimal as D
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, None]), i, rng.choice([None, -1.5, 0.0, -0.0, 2.0, 7.25]), rng.choice([None, D("1.5"), D("-3"), D("0E-10")]),
             rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, id int, v double, x decimal(38,10), n long, t string").repartition(5)
    S = ranking.RankSpec
    specs = [S("rn_v", "row_number", "v", descending=True), S("rn_n", "row_number", "n"), S("rk_v", "rank", "v"),
             S("rk_x", "rank", "x", descending=True), S("dr_x", "dense_rank", "x"), S("dr_n", "dense_rank", "n", descending=True)]
    written = []

    def store(y, name):
        written.append(y._jdf.queryExecution().analyzed().toString().count("RepartitionByExpression"))
        return RunFolder(spark).write(y, name)

    got = ranking.ranks_together(df, specs, "g", [F.col("t"), F.col("id")], store, num_partitions=6)
    assert got.columns == [*df.columns, *[s.name for s in specs]] and len(written) == 2

    def over(spec):
        v = F.col(spec.value)
        by = [v.desc_nulls_first() if spec.descending else v.asc_nulls_last()]
        if spec.function == "row_number":
            by += [F.col("t").asc_nulls_last(), F.col("id")]
        return getattr(F, spec.function)().over(Window.partitionBy("g").orderBy(*by))

    want = df.select("id", *[over(s).alias(s.name) for s in specs]).collect()
    key = lambda r: tuple(r)
    assert sorted(map(key, got.select("id", *[s.name for s in specs]).collect())) == sorted(map(key, want))


def test_ranks_together_of_an_empty_table(spark):
    df = spark.createDataFrame([], "g int, v double")
    got = ranking.ranks_together(df, [ranking.RankSpec("r", "rank", "v"), ranking.RankSpec("n", "row_number", "v")], "g",
                                 [F.col("v")], RunFolder(spark).write)
    assert got.columns == ["g", "v", "r", "n"] and got.collect() == []


def test_running_sums_need_no_second_exchange_of_the_rows(spark):
    """The slice is written with its running sums: the rows move once, and the plan over what is written has none."""
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 2000).alias("v"))
    got = ranking.prefix_sums(df, [F.col("v").asc()], ["g"], F.col("v"), RunFolder(spark).write, "before", num_partitions=5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and not [x for x in plan.split("\n") if "hashpartitioning" in x and "v#" in x]
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "v", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("before"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_equal_rows_are_ranked_as_one_with_their_number(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3), (1, "b", 1.0, 1), (1, "c", None, 2)], "g int, id string, v double, n long")
    S = ranking.RankSpec
    specs = [S("rn", "row_number", "v"), S("rk", "rank", "v"), S("dr", "dense_rank", "v")]
    store = RunFolder(spark).write
    base = ranking.numbered_rows(df, "g", [F.col("id")], store, 3)
    got = ranking.rank_columns(base, specs, "g", store, 3, copies="n").select("id", "rn", "rk", "dr").collect()
    assert sorted(map(tuple, got)) == [("a", 2, 2, 2), ("b", 1, 1, 1), ("c", 5, 5, 3)]


def test_rank_columns_move_the_wide_rows_once_for_all_copies(spark):
    store = RunFolder(spark).write
    rows = [(g, v, n) for g in (1, None) for v, n in ((2.0, 3), (1.0, 1), (None, 2))]
    base = ranking.numbered_rows(spark.createDataFrame(rows, "g int, v double, n long"), "g", [F.col("v")], store, 3)
    each = base.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1))).withColumn("v", F.col("v") + F.col("__copy"))
    specs = [ranking.RankSpec("up", "row_number", "v"), ranking.RankSpec("rk", "rank", "n"), ranking.RankSpec("down", "row_number", "v", descending=True)]
    folded = ranking.rank_columns(base, specs, "g", store, 3, copies="n", each=each, folded=True)
    assert folded.count() == len(rows)
    got = {(r.g, r.v, r["__copy"]): (r.up, r.rk, r.down) for r in ranking.unfolded(folded).collect()}
    one = {(2.0, 0): (2, 4, 5), (2.0, 1): (3, 4, 4), (2.0, 2): (4, 4, 3), (1.0, 0): (1, 1, 6), (None, 0): (5, 2, 1), (None, 1): (6, 2, 2)}
    assert got == {(g, *k): v for g in (1, None) for k, v in one.items()}
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [__row" not in plan and plan.count("SortMergeJoin [__row") == 1
