"""Operator 5 against a direct reading of its contract."""

import hashlib
import random

import pytest
from branchbook.llm import substrings as S
from branchbook.llm.common import Workspace

WS = " \t\n\x0b\x0c\r"


def words(text):
    out, cur = [], ""
    for c in text or "":
        if c in WS:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += c
    return out + ([cur] if cur else [])


def brute(rows):
    first = {}
    docs = sorted((i, words(t)) for i, t in rows)
    for i, w in docs:
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s:s + 20]), (i, s))
    out = {}
    for i, w in docs:
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s:s + 20])] < (i, s):
                gone |= set(range(s, s + 20))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = S.remove_repeats(df, Workspace(spark, "t")).collect()
    return got


def corpus(seed, n=40):
    r = random.Random(seed)
    passage = [[f"p{k}w{j}" for j in range(r.choice([19, 20, 21, 35, 60]))] for k in range(4)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(r.randint(0, 5)):
            if r.random() < .5:
                w += r.choice(passage)
            else:
                w += [f"é{r.randint(0, 500)}" for _ in range(r.randint(0, 30))]
        rows.append((i, r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(n + k, rows[k][1]) for k in range(5)]
    rows += [(n + 10, None), (n + 11, ""), (n + 12, "a " * 100), (n + 13, "b c " * 30)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, rows)}
    assert got == brute(rows)


def test_difference_cover():
    for a in range(S.PERIOD):
        for b in range(S.PERIOD):
            assert any((a + k) % S.PERIOD in S.COVER and (b + k) % S.PERIOD in S.COVER for k in range(S.PERIOD))
    assert S.ANCHOR + S.PERIOD - 1 == S.WINDOW


def test_nulls_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = run(spark, [(1, text), (1, text), (None, text), (2, text)])
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 0), ("1", 0), ("2", 30), ("None", 0)]
    assert run(spark, []) == []


def brute_rows(rows):
    """Rows that share an id are documents each, none earlier than the other."""
    least = {}
    docs = [(i, words(t)) for i, t in rows]
    for i, w in docs:
        for s in range(len(w) - 19):
            if i is not None:
                least[tuple(w[s:s + 20])] = min(i, least.get(tuple(w[s:s + 20]), i))
    out = []
    for i, w in docs:
        gone, own = set(), set()
        for s in range(len(w) - 19):
            t = tuple(w[s:s + 20])
            if i is not None and (least[t] < i or t in own):
                gone |= set(range(s, s + 20))
            own.add(t)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_repeated_ids_with_different_texts(spark, seed):
    r = random.Random(seed)
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    rows = [(1, a), (2, a), (2, b), (2, a + " " + b), (2, " ".join(a.split()[:22])), (3, b + " " + b), (None, a), (2, None)]
    rows += [(r.choice([4, 4, 5, 6, None]), t) for _, t in corpus(seed)]
    got = sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept_sha256) for x in run(spark, rows))
    assert got == brute_rows(rows)


def test_documents_keep_their_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text, "x", 5), (2, "head " + text, "y", 6), (3, text, None, None)],
                               "doc_id long, text string, start string, n_chars long")
    out = {r.doc_id: r for r in S.deduplicated(df, Workspace(spark, "t")).collect()}
    assert set(out) == {1, 2} and out[1].text == text and out[2].text == "head"
    assert (out[2].n_chars, out[2].start) == (4, "y")


def test_query_digest_of_unchanged_text(spark):
    r = run(spark, [(7, "one  two\nthree")])[0]
    assert r.kept_sha256 == hashlib.sha256(b"one two three").hexdigest() and r.kept_text is None
