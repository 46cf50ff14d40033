"""Operator 12 against a direct reading of its contract."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from branchbook.llm import divergence as D
from branchbook.llm.common import Workspace

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows):
    docs, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        found = terms(text)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang, names in sources.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        total = Counter()
        for s in names:
            total.update(counts[lang, s])

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        q_lang = share(total)
        p = {s: share(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names if o != s]
            own = [(-((p[s][t] - q_lang[t]) ** 2 // q_lang[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q_lang[t]]
            for part, found in (("pair", pairs), ("term", own)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, o, -v, k + 1) for k, (v, o) in enumerate(found) if part == "pair" or k < 200]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "doc_id long, text string, lang string, source string, n long, term string").repartition(3)
    got = D.audit(df, Workspace(spark, "t"))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


def corpus(seed, n=150):
    r = random.Random(seed)
    vocab = ["a", "abcdefgh", "abcdefghi", "abcdefghij", "ABCDEFGH", "é", "École", "naïve", "日本", "x" * 17, "x" * 16, "x" * 18]
    vocab += [f"{a}{b}" for a in ("prefixprefix", "pre", "the") for b in ("", "a", "b", "ab", "ß")]
    rows = []
    for i in range(n):
        mine = r.sample(vocab, r.randint(1, len(vocab)))
        words = [r.choice(mine) for _ in range(r.randint(0, 60))]
        rows.append((i, r.choice([" ", "-", "1", "\n", "\x00", "_"]).join(words), r.choice(["en", "en", "de", None]),
                     r.choice(["s0", "s0", "s0", "s1", "s2", None, "é"])))
    return rows + [(n, None, "fr", "s0"), (n + 1, "only once", "fr", "s9"), (n + 2, "", "", ""), (3, rows[3][1], "en", "s1")]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(D, "PAIRS", 3)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_more_terms_than_ranks_and_ties(spark):
    rows = [(i, " ".join("".join(map(chr, (97 + k // 26, 97 + k % 26))) for k in range(300)), "en", s)
            for i, s in enumerate(["a", "a", "a", "b"])] + [(9, "zz zz", "en", "b")]
    rows += [(10, "aa ab " * 3, "en", "c")]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_languages_without_terms(spark):
    assert run(spark, []) == []
    rows = [(1, "x", "en", "a"), (2, "y", "en", "b"), (3, None, None, None)]
    assert run(spark, rows) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_sorted_runs_are_the_sorted_terms():
    r = random.Random(4)
    pool = ["a" * k for k in range(1, 40)] + ["b", "ab" * 9, "ab" * 9 + "c", "a" * 8 + "b"]
    words = [r.choice(pool) for _ in range(3000)]
    data = " ".join(words).encode().translate(D._TERM_BYTE) + bytes(16)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size + 1) - size - 1
    order, run_of = D.sorted_runs(np.ndarray(len(data) - 7, ">u8", data, strides=(1,)), start, size)
    assert [words[k] for k in order] == sorted(words)
    assert order.tolist() == sorted(range(len(words)), key=lambda k: (words[k], k))
    names = sorted(set(words))
    assert [names[k] for k in run_of] == sorted(words)


def test_very_long_terms():
    rows = [("en", s, ("y" * 500_000 + e).encode()) for s, e in (("a", ""), ("a", ""), ("b", "z"))]
    got = {(r["source"], len(r["term"])): (r["n"], r["docs"]) for b in D.shard_counts(rows) for r in b.to_pylist()}
    assert got == {("a", 0): (0, 0), ("b", 0): (0, 0), ("a", 500_000): (2, 2), ("b", 500_001): (1, 1)}
