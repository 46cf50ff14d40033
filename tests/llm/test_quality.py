"""Operator 4 against a direct reading of its rules, and its edge cases."""

import random

from branchbook.llm import quality as Q
from branchbook.llm.common import Workspace

WS = " \t\n\x0b\x0c\r"


def words(t):
    for c in WS:
        t = t.replace(c, " ")
    return [x for x in t.split(" ") if x]


def counts(t):
    t = t or ""
    w = words(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {k for k in tri if tri.count(k) > 1}
    covered = {i + j for i, k in enumerate(tri) if k in twice for j in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int").repartition(3)
    return {r.doc_id: r for r in Q.judge(df, Workspace(spark, "t")).collect()}


def test_counts_and_base_rules(spark):
    r = random.Random(1)
    vocab = ["a", "é", "the", "x#", "|", "日本", "b"]
    texts = ["".join(r.choice(vocab) + r.choice([" ", " ", "\n", "\t", "\x1c"]) for _ in range(r.randint(0, 90)))
             for _ in range(80)] + [None, "", " \n ", "line one\nline one\n\nline one", "z " * 400]
    got = run(spark, [(i, t, r.choice(["en", None]), r.choice(["s", "t", None]), 0) for i, t in enumerate(texts)])
    for i, t in enumerate(texts):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == counts(t), t
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert not (g.base_failed and g.kept)


def test_fences_follow_the_group(spark):
    """Symbols are usual in one source and junk in the other."""
    r = random.Random(2)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    rows = [(i, " ".join(word() for _ in range(80)), "en", "prose", 0) for i in range(150)]
    rows += [(200 + i, " ".join(word() + "#" for _ in range(80)), "en", "tags", 0) for i in range(150)]
    rows += [(500, " ".join(word() + "#" for _ in range(80)), "en", "prose", 0)]
    got = run(spark, rows)
    assert not got[500].kept and all(g.kept for i, g in got.items() if i != 500)


def test_filter_and_empty(spark):
    rows = [(1, "short", "en", "s", 7), (2, " ".join(f"w{i}" for i in range(60)), None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    out = Q.filter_documents(df, Workspace(spark, "t")).collect()
    assert [(r.doc_id, r.n_words) for r in out] == [(2, 8)]
    assert Q.judge(df.limit(0), Workspace(spark, "t")).collect() == []
