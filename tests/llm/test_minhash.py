"""Operator 2 against all pairs compared directly."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from branchbook.llm import minhash as M
from branchbook.llm.common import Workspace
from branchbook.llm.components import components


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def corpus(seed):
    r = random.Random(seed)
    rows, k = [], 0
    for _ in range(8):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(1, 120))]
        for _ in range(r.randint(1, 14)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = f"x{r.randint(0, 99)}"
            if r.random() < .3:
                w = [x.upper() for x in w]
            rows.append((k, " ".join(w)))
            k += 1
    chain = [f"c{i}" for i in range(300)]
    rows += [(k + i, " ".join(chain[15 * i:15 * i + 150])) for i in range(8)]     # a chain of neighbours
    return rows + [(900, None), (901, " \n"), (902, "a b"), (903, "A  B"), (904, "a b c")]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return M.near_duplicates(df, Workspace(spark, "t")).collect()


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)}
        assert got == brute(rows)


def test_links_that_no_centre_has_are_found_in_blocks(spark, monkeypatch):
    for name, n in (("FEW_BLOCK", 2), ("ALL_BLOCK", 3), ("PAIRS", 2)):
        monkeypatch.setattr(M, name, n)
    monkeypatch.setattr(M, "first_pairs", lambda keys: keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
                        .join(keys, "key").select(F.col("doc").alias("u"), F.col("doc").alias("v")).distinct())
    rows = corpus(3)
    assert {r.doc_id: r.component_id for r in run(spark, rows)} == {i: c for i, (_, c, _) in brute(rows).items()}


def test_batches_may_cut_a_block():
    n = 30
    r = random.Random(1)
    rows = [(k // 10, 0, 0, few, k, k, 0, M.SKETCHES) for k in range(n) for few in (True, False)]
    rows.sort(key=lambda x: (x[0], not x[3]))
    names = ["key", "fb", "ab", "few", "doc", "comp", "i", "j"]
    t = pa.table(dict(zip(names, map(list, zip(*rows)))))
    t = t.append_column("halves", pa.array([[7] * 32] * len(rows), pa.list_(pa.int64())))
    t = t.append_column("bits", pa.array([b"x" * 96] * len(rows)))
    cuts = sorted(r.sample(range(1, len(rows)), 7))
    parts = [t.slice(a, b - a).combine_chunks().to_batches()[0] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    seen = set()
    for table, block in M._by_block(iter(parts), lambda t, b: iter([(t, b)])):
        doc = table.column("doc").to_numpy()
        for u, v in M._plausible(table, block):
            seen |= set(zip(doc[u].tolist(), doc[v].tolist()))
    assert seen == {(u, v) for u in range(n) for v in range(n) if u != v and u // 10 == v // 10}


def test_nulls_repeats_and_empty(spark):
    got = run(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, "A b c d e f"), (10, "")])
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in got) == [
        ("10", 10, True), ("5", 5, True), ("5", 5, True), ("9", 5, False), ("None", None, True)]
    assert run(spark, []) == []


def test_rows_of_one_id_with_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (9, a + " more"), (10, b + " more"), (12, "alone " + b[:20]), (5, None), (5, "x y")]
    got = run(spark, rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(
        [(5, 36, 5, True)] * 2 + [(9, 37, 5, False), (10, 37, 5, False), (12, 4, 12, True), (5, 0, 5, True), (5, 1, 5, True)])


def test_one_row_of_a_group_stays(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a, 1), (5, a, 2), (None, a, 3), (4, a + " x", 4), (None, b, 5), (None, b, 6), (7, b + " y", 7), (7, "z", 8),
            (None, None, 9), (None, "", 10), (None, "q q q", 11), (None, "q q q", 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc int").repartition(3)
    kept = sorted(M.deduplicated(df, Workspace(spark, "t")).collect(), key=lambda r: r.doc)
    assert [r.doc for r in kept[:-1]] == [4, 7, 8, 9, 10] and kept[-1].doc in (11, 12)
    assert M.deduplicated(df.limit(0), Workspace(spark, "t")).collect() == []


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 50), (60, 100), (60, 50)], "u long, v long")
    got = {r.node: r.comp for r in components(e, Workspace(spark, "t"), "c").collect()}
    assert got == {i: 0 for i in range(1, 21)} | {60: 50, 100: 50}
