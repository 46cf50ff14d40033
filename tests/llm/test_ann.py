"""Operator 3: recall and exact scores against brute force."""

import numpy as np
import pytest

from branchbook.llm import ann as A
from branchbook.llm.common import Workspace


def brute(ids, x):
    out = {}
    for i in ids[ids % 20 == 0]:
        q = x[ids == i][0]
        score = (x * q).sum(axis=1)
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != i][:20]
        out[int(i)] = [(int(ids[k]), float(score[k])) for k in order]
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    out = {}
    for r in sorted(A.nearest(df, Workspace(spark, "t")).collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("n,blocks", [(500, 4096), (3000, 200)])
def test_recall_and_scores(spark, monkeypatch, n, blocks):
    monkeypatch.setattr(A, "BLOCK", blocks)
    monkeypatch.setattr(A, "QUERY_BLOCK", 64)
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = run(spark, [(i, x[i].tolist(), 0) for i in range(n)])
    want = brute(np.arange(n), x.astype(float))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= .9
    full = x.astype(float)
    for q, v in got.items():
        assert [s for _, s in v] == sorted((s for _, s in v), reverse=True)
        assert all(abs(s - (full[q] * full[i]).sum()) < 1e-12 for i, s in v)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))
    assert recall(run(spark, rows), want) >= .9


def test_copies_norms_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(60, 8)) * rng.uniform(.1, 3, size=(60, 1))).astype(np.float32)
    x[5:50] = x[5]                                    # a hot vector, with queries among its copies
    rows = [(i, x[i].tolist(), 0) for i in range(60)]
    bad = [(100, None, 0), (120, [0.0] * 8, 0), (140, [1.0] * 7 + [float("nan")], 0), (160, [1.0, None] * 4, 0),
           (180, [1.0] * 7 + [float("inf")], 0), (None, [1.0] * 8, 0), (200, [], 0), (220, [1.0], 0)]
    got = run(spark, rows + bad + [rows[20], rows[3]])
    assert got == brute(np.arange(60), x.astype(float))
    assert run(spark, bad[:6]) == {} and run(spark, []) == {}


def test_rotation_keeps_length():
    x = np.random.default_rng(0).normal(size=(5, 128))
    assert np.allclose(np.linalg.norm(A.rotated(x, 3), axis=1) / 128 ** 1.5, np.linalg.norm(x, axis=1))


def norms(kind, n):
    x = np.random.default_rng(7).normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "outlier":
        x[n // 2] *= 100
    else:
        x *= np.exp(.5 * np.random.default_rng(8).normal(size=(n, 1)))
    return x.astype(np.float32)


@pytest.mark.parametrize("kind,block", [("outlier", 4096), ("outlier", 500), ("spread", 4096), ("spread", 300)])
def test_recall_does_not_depend_on_the_largest_norm(spark, monkeypatch, kind, block):
    monkeypatch.setattr(A, "BLOCK", block)
    n = 5000
    x = norms(kind, n)
    got = run(spark, [(i, x[i].tolist(), 0) for i in range(n)])
    want = brute(np.arange(n), x.astype(float))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= .9


def test_queries_that_see_too_few_meet_all_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 50)
    monkeypatch.setattr(A, "TABLES", 1)
    monkeypatch.setattr(A, "probes", lambda rows, dim: 1)
    x = norms("outlier", 400)
    assert run(spark, [(i, x[i].tolist(), 0) for i in range(400)]) == brute(np.arange(400), x.astype(float))

def test_each_dimension_is_a_table_of_its_own(spark):
    r = np.random.default_rng(3)
    x, y = r.normal(size=(300, 16)).astype(np.float32), r.normal(size=(30, 17)).astype(np.float32)
    stray = [(1000, [1.0] * 40, 0)]                     # the longest vector, alone in its dimension
    rows = [(i, x[i].tolist(), 0) for i in range(300)] + [(300 + i, y[i].tolist(), 0) for i in range(30)]
    assert run(spark, rows + stray) == {**brute(np.arange(300), x.astype(float)),
                                        **brute(np.arange(300, 330), y.astype(float))}
