"""Operator 11 against a run of every order, document by document."""

import random
import re
from collections import defaultdict
from itertools import permutations

from branchbook.llm import interaction as I
from branchbook.llm.common import Workspace

DOCS = "doc_id long, text string, source string, good int, step string"
LABELS = "doc_id long, quality int, toxic int"


def fails(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, *_ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
             "E": i is not None and i > first[t]}
        out.append({k for k, v in f.items() if v})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    marks = fails(rows)
    out, shapley = {}, defaultdict(int)
    parts = {r[2] or "" for r in rows}
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            left = [(r[0], m) for r, m in zip(rows, marks) if (r[2] or "") == part]
            gone = []
            for k, f in enumerate(order):
                lost = [x for x in left if f in x[1]]
                stay = [x for x in left if f not in x[1]]
                out[part, order, k + 1] = [
                    len(stay), len(lost), sum(f in m for _, m in gone), sum(m == {f} for _, m in left + gone),
                    sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
                shapley[part, f] += len(lost)
                left, gone = stay, gone + lost
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, rows, labels):
    df = spark.createDataFrame([(*r[:3], 7, "x") for r in rows], DOCS).repartition(3)
    got = I.audit(df, spark.createDataFrame(labels, LABELS), Workspace(spark, "t"))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    return {tuple(r[:3]): tuple(r[3:]) for r in got.collect()}


def corpus(seed, n=250):
    r = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [r.choice(["a", "b", "C", "DD", "é", f"w{r.randint(0, 99)}", f"x{r.randint(0, 999)}"]) for _ in range(r.randint(0, 110))]
        if r.random() < .3:
            words = [w.lower() for w in words]
        if r.random() < .2:
            words.append(r.choice(["#", "a|b", "$5", "*"]))
        texts.append(r.choice([" ", "\n", "\x0b"]).join(words))
    texts += [r.choice(texts) for _ in range(n // 2)] + [None, "", None]
    rows = [(i, t, r.choice(["s0", "s0", "s1", "s'2", None, ""])) for i, t in enumerate(texts)]
    r.shuffle(rows)
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 0, 1])) for i in r.sample(range(len(rows)), n)]
    return rows, labels


def test_against_every_order(spark):
    for seed in range(2):
        rows, labels = corpus(seed)
        assert run(spark, rows, labels) == brute(rows, labels)


def test_nulls_repeats_hot_texts_and_empty_table(spark):
    hot = " ".join(f"w{i}" for i in range(60))
    rows = [(i, hot, "s") for i in range(100, 160)] + [(100, hot, "s"), (100, hot, "t"), (None, hot, "s"), (None, None, None),
                                                      (3, "A" * 200_000, "s"), (4, "x " * 100_000, "t"), (3, None, "s")]
    labels = [(100, 1, 0), (100, 0, 1), (101, 1, 1), (None, 1, 1), (3, 0, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)
    assert run(spark, rows, []) == brute(rows, [])
    assert run(spark, [], labels) == {}


def test_masks_of_text():
    assert I.text_mask(b"") == 1
    assert I.text_mask(("ÉÉ " * 60).encode()) == 2                  # only A-Z are capitals
    assert I.text_mask(" ".join(f"w{i}" for i in range(50)).encode()) == 0
    assert I.text_mask(b"AB cd" + b" e" * 60) & 4 == 0 and I.text_mask(b"ABCDEFG cd" + b" e" * 60) & 4


def test_the_recursion_enumerates_every_prefix_once(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 31, 2, 0, 2)], "part string, mask int, n long, good long, toxic long")
    rows = I.prefix_steps(cells).collect()
    assert len(rows) == 5 + 20 + 60 + 120 + 120 == len({r.prefix for r in rows})
    plan = I.prefix_steps(cells)._jdf.queryExecution().optimizedPlan().toString()
    assert "UnionLoop" in plan
