"""Closures of any tree, the general crosstab, and the row-level reconcile."""

import datetime as dt
from decimal import Decimal as D

import pytest

from branchbook.operators import checks, pnl, views
from branchbook.sources import seeds

TREE = "pnl_id long, pnl_parent_id long"


def closure(spark, tree, **kw):
    return sorted(map(tuple, pnl.tree_closure(spark.createDataFrame(tree, TREE), **kw).collect()))


def errors(spark, tree, **kw):
    return sorted(map(tuple, pnl.tree_errors(spark.createDataFrame(tree, TREE), **kw).collect()))


def test_the_seed_tree_gives_the_fixed_closure(spark):
    rolled = spark.createDataFrame([(i,) for i in seeds.ROLLUP_LINES], "id int")
    found = pnl.tree_closure(seeds.pnl_tree_df(spark), rolled).collect()
    leaves = set(seeds.ALLOCATED_LINES)
    assert sorted(tuple(r) for r in found if r.leaf_id in leaves) == seeds.rollup_closure()
    assert pnl.tree_errors(seeds.pnl_tree_df(spark), rolled).collect() == []


def test_a_tree_of_other_ids_and_depth(spark):
    deep = [(1000, -1)] + [(1000 + i, 999 + i) for i in range(1, 30)] + [(7, None)]
    assert closure(spark, deep) == sorted((1000 + i, 1000 + j) for i in range(30) for j in range(i))
    assert errors(spark, deep) == []
    assert {e for _, e in errors(spark, deep, max_depth=10)} == {"too_deep"}
    assert all(a - b < 10 for a, b in closure(spark, deep, max_depth=10))


def test_cycles_orphans_and_duplicates_are_error_rows(spark):
    tree = [(1, -1), (2, 1), (3, 2), (10, 11), (11, 12), (12, 10), (13, 12), (20, 99), (2, 1), (30, 30)]
    assert errors(spark, tree) == [(2, "duplicate"), (10, "cycle"), (11, "cycle"), (12, "cycle"), (13, "cycle"),
                                   (20, "orphan"), (30, "cycle")]
    assert closure(spark, tree) == [(2, 1), (3, 1), (3, 2)]          # lines of a cycle roll up nowhere
    assert closure(spark, []) == [] and errors(spark, []) == []


def test_a_rollup_through_a_user_closure(spark):
    leaves = spark.createDataFrame([(202301, 3, "B", D(5)), (202301, 4, "B", None), (202301, 2, "B", D(1))],
                                   "month_key int, id long, area_code string, amount decimal(38,10)")
    tree = spark.createDataFrame([(1, -1), (2, 1), (3, 2), (4, 1)], TREE)
    got = {r.id: r.amount for r in pnl.rollup_tree(leaves, pnl.tree_closure(tree), bounded=False).collect()}
    assert got == {1: 6, 2: 5}


def test_crosstab_semantics(spark):
    rows = [("r1", "a", 1, 10.0, "x"), ("r1", "a", 3, None, "y"), ("r1", "a", 2, 30.0, "z"), ("r1", "b", 0, 5.0, "first"),
            ("r2", "other", 1, 7.0, "u"), ("r3", None, 1, 8.0, None), ("r4", "b", 1, 1.0, "p"), ("r4", "b", 1, 2.0, "q")]
    df = spark.createDataFrame(rows, "name string, cat string, at int, v double, note string")
    got = views.crosstab(df, ["b", "a", "c"], "name", "cat", "v", extra=["note"], order=["at"])
    assert got.columns == ["name", "note", "b", "a", "c"]
    assert sorted(map(tuple, got.collect())) == [
        ("r1", "first", 5.0, None, None),            # the last row of (r1, a) has a NULL value
        ("r2", "u", None, None, None), ("r3", None, None, None, None),
        ("r4", "p", 2.0, None, None)]
    cats = spark.createDataFrame([("a",), ("b",)], "c string")
    assert views.crosstab(df, cats, ["name"], "cat", "v").columns == ["name", "a", "b"]
    for bad in (["a", "a"], ["a", None]):
        with pytest.raises(ValueError):
            views.crosstab(df, bad, "name", "cat", "v")


def test_amounts_swapped_inside_a_key_are_found(spark):
    schema = "account_code string, day date, amount long, note string"
    d = dt.date(2023, 1, 1)
    raw = spark.createDataFrame([("1", d, 5, "a"), ("1", d, 7, "b"), ("2", d, 1, None), ("2", d, 1, None), (None, None, 3, "n")], schema)
    swapped = spark.createDataFrame([("1", d, 7, "a"), ("1", d, 5, "b"), ("2", d, 1, None), ("2", d, 1, None), (None, None, 3, "n")], schema)
    assert {r.status for r in checks.reconcile(raw, swapped, ["account_code"], "amount").collect()} == {"match"}
    got = sorted(map(str, (tuple(r) for r in checks.reconcile_rows(raw, swapped, ["account_code"]).collect())))
    assert got == sorted(map(str, [("raw_only", "1", d, 5, "a", 1), ("raw_only", "1", d, 7, "b", 1),
                                   ("staged_only", "1", d, 7, "a", 1), ("staged_only", "1", d, 5, "b", 1)]))
    assert checks.reconcile_rows(raw, raw, ["account_code"]).collect() == []
    lost = spark.createDataFrame([("1", d, 5, "a"), ("1", d, 7, "b"), ("2", d, 1, None)] + [(None, None, 3, "n")] * 3, schema)
    got = sorted(map(str, (tuple(r) for r in checks.reconcile_rows(raw, lost, ["account_code"]).collect())))
    assert got == sorted(map(str, [("raw_only", "2", d, 1, None, 1), ("staged_only", None, None, 3, "n", 2)]))


def test_the_walks_of_tree_errors_are_taken_once(spark, scratch):
    written = []

    def store(df, name):
        written.append(name)
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    tree = spark.createDataFrame([(1, -1), (2, 1), (10, 11), (11, 10), (20, 99)], TREE)
    found = pnl.tree_errors(tree, store=store)
    assert sorted(map(tuple, found.collect())) == [(10, "cycle"), (11, "cycle"), (20, "orphan")] and written == ["tree", "edges"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("UnionLoop ") == 1


def test_the_tree_query_reads_every_order(spark, scratch):
    """Customers of more than six orders: all of a cycle are found, and no chain is cut to orphans."""
    from branchbook.plans.queries import q_tree_errors
    orders = [(10 + i, 2) for i in range(9)] + [(30 + i, 3) for i in range(9)] + [(50, 4), (60, 5), (70, None)]
    orders += [(100 + i, 6) for i in range(20)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{scratch}/orders.parquet")
    assert sorted(map(tuple, q_tree_errors(spark, scratch).collect())) == [(k, "cycle") for k, c in orders if c in (2, 4, 6)]
