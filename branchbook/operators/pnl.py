"""P&L lines derived from other lines: rollups, headcount, financial ratios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.functions.columns import month_of_year, safe_ratio
from branchbook.sources import seeds
from branchbook.sources.schemas import AMOUNT_TYPE


#: Levels that a walk up a tree takes at most.
MAX_DEPTH = 64

_WALK = """
WITH RECURSIVE walk(leaf_id, ancestor_id, depth, path) AS (
  SELECT id, parent_id, 1, array(id) FROM {edges}
  UNION ALL
  SELECT w.leaf_id, e.parent_id, w.depth + 1, array_append(w.path, w.ancestor_id)
  FROM walk w JOIN {edges} e ON e.id = w.ancestor_id
  WHERE w.depth < {limit} AND NOT array_contains(w.path, w.ancestor_id)
)
SELECT leaf_id, ancestor_id, depth, array_contains(path, ancestor_id) AS closes FROM walk LIMIT ALL
"""


def _walks(tree: DataFrame, rolled: DataFrame | None, max_depth: int, store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """One row per line and step up: the ancestor reached, and whether that
    closes a cycle (the walk ends there).  A recursive query: each level is one
    equi-join with the tree, and a tree has few levels.  ``store`` writes the
    steps that every level reads; without it each level derives them again."""
    edges = tree.select(F.col("pnl_id").alias("id"), F.col("pnl_parent_id").alias("parent_id")).distinct()
    edges = edges.join((edges.select("id") if rolled is None else rolled).toDF("parent_id").distinct(), "parent_id", "left_semi")
    edges = store(edges, "edges") if store else edges
    return tree.sparkSession.sql(_WALK, edges=edges, limit=int(max_depth))


def tree_closure(tree: DataFrame, rolled: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """leaf_id, ancestor_id of a user's line tree (``pnl_id``, ``pnl_parent_id``)
    of any ids and depth: every rolled-up line above a line.

    ``rolled``: the ids that are filled by rolling up (default: every line that
    has children); a walk up ends below the first line that is not.  Lines
    whose walk runs into a cycle, or is longer than ``max_depth``, roll up
    nowhere; ``tree_errors`` lists them.
    """
    walks = _walks(tree, rolled, max_depth)
    bad = walks.where(F.col("closes") | (F.col("depth") >= max_depth)).select("leaf_id").distinct()
    return walks.join(bad, "leaf_id", "left_anti").select("leaf_id", "ancestor_id").distinct()


def tree_errors(tree: DataFrame, rolled: DataFrame | None = None, max_depth: int = MAX_DEPTH, root: int = -1,
                store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """pnl_id and what is wrong with its place in the tree: ``cycle`` (its walk
    up comes back to a line it has passed), ``too_deep``, ``orphan`` (a parent
    that is not in the tree; roots have ``root`` or NULL) or ``duplicate``."""
    tree = store(tree.select("pnl_id", "pnl_parent_id"), "tree") if store else tree
    # the walks are read once: a second reader would walk again
    ended = _walks(tree, rolled, max_depth, store).where(F.col("closes") | (F.col("depth") >= max_depth)).select(
        F.col("leaf_id").alias("pnl_id"), F.when(F.col("closes"), "cycle").otherwise("too_deep").alias("error")).distinct()
    ids = tree.select(F.col("pnl_id").alias("parent")).distinct()
    named = tree.where((F.col("pnl_parent_id") != root) & F.col("pnl_parent_id").isNotNull())
    orphan = named.join(ids, named.pnl_parent_id == ids.parent, "left_anti").select("pnl_id", F.lit("orphan").alias("error"))
    twice = tree.groupBy("pnl_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pnl_id", F.lit("duplicate").alias("error"))
    return ended.unionByName(orphan).unionByName(twice)


def rollup_tree(leaves: DataFrame, closure: DataFrame, bounded: bool = True) -> DataFrame:
    """Parent lines as sums of their children, for all levels in one aggregate.

    The original inserts level by level (2, 8, 13 from leaves; 20 from 2/8/13;
    21; then 1 from 20/21/26), re-reading its own output.  Because a parent is
    a plain SUM of its children, it equals the SUM over the allocated leaves
    below it: the broadcast closure table (leaf -> each rolled-up ancestor)
    turns the five statements into one join and one ``groupBy``.  SUM skips
    NULL children; a parent whose leaves are all NULL is NULL; a parent row
    exists for an area iff some leaf row below it does.  Sums are exact
    decimals, so the result does not depend on summation order.

    ``bounded``: the closure is that of the fixed tree (60 rows) and is
    broadcast; a user's closure (``tree_closure``) joins as its size asks for.
    """
    closure = F.broadcast(closure) if bounded else closure
    j = leaves.join(closure, leaves["id"] == closure["leaf_id"])
    return (j.groupBy("month_key", F.col("ancestor_id").alias("id"), "area_code")
            .agg(F.sum("amount").cast(AMOUNT_TYPE).alias("amount")))


def headcount_line(hc: DataFrame, months: DataFrame) -> DataFrame:
    """Line 27: distinct salespeople per area, plus an ``A`` row holding the
    global distinct count (always present, 0 when the month has no data).

    ``hc`` is ``ratios.headcount_cells`` (the same aggregate feeds SM_COUNT).
    An area name without a match gives a NULL-area row, as in the original.
    """
    rm = months.columns[0]
    key = F.col("month_col") == month_of_year(F.col(rm))
    per_area = (hc.where(~F.col("is_total")).join(F.broadcast(months), key)
                .select(F.col(rm).alias("month_key"), "area_code", "n_sales"))
    total = (months.join(hc.where(F.col("is_total")), key, "left")
             .select(F.col(rm).alias("month_key"), F.lit(seeds.HEAD_AREA).alias("area_code"),
                     F.coalesce(F.col("n_sales"), F.lit(0)).alias("n_sales")))
    return per_area.unionByName(total).select(
        "month_key", F.lit(seeds.HEADCOUNT_LINE).alias("id"), "area_code",
        F.col("n_sales").cast(AMOUNT_TYPE).alias("amount"))


def ratio_lines(report: DataFrame) -> DataFrame:
    """Lines 29-32 (CIR, margin, return on funding, profit per head).

    Each is ``SUM(CASE id in numerator THEN amount ELSE 0) /
    NULLIF(SUM(CASE id in denominator THEN amount ELSE 0), 0) * scale`` over the
    rows of its own id set, grouped by area; a ratio row exists for an area iff
    one of its ids has a row there.  All four come from one aggregate over the
    month's report rows.
    """
    spec = sorted(seeds.RATIO_LINES.items())
    used = sorted({i for _, (num, den, _) in spec for i in num + den})
    amount = F.col("amount")
    aggs = []
    for rid, (num, den, _) in spec:
        ids = num + den
        aggs += [
            F.count(F.when(F.col("id").isin(ids), 1)).alias(f"n{rid}"),
            F.sum(F.when(F.col("id").isin(num), amount).when(F.col("id").isin(ids), F.lit(0))).alias(f"num{rid}"),
            F.sum(F.when(F.col("id").isin(den), amount).when(F.col("id").isin(ids), F.lit(0))).alias(f"den{rid}"),
        ]
    g = report.where(F.col("id").isin(used)).groupBy("month_key", "area_code").agg(*aggs)
    args = [F.lit(len(spec))]
    for rid, (_, _, scale) in spec:
        args += [F.lit(rid), F.col(f"n{rid}"), safe_ratio(f"num{rid}", f"den{rid}", scale)]
    long = g.select("month_key", "area_code", F.stack(*args).alias("id", "n", "value"))
    return long.where(F.col("n") > 0).select(
        "month_key", "id", "area_code", F.col("value").cast(AMOUNT_TYPE).alias("amount"))
