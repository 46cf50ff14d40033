"""Operator 7 against Python's regular expressions and held-out strings."""

import hashlib
import random
import re
import string

from branchbook.llm import secrets as S

PATTERNS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, re.I | re.A),
    "access": (r"AKIA[A-Z0-9]+", 0, 18, re.A),
    "hex": (r"[0-9a-f]+", 0, 16, re.A),
}


def brute(text):
    out = []
    for n, (kind, (p, g, least, flags)) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or "", flags):
            if len(m[g]) >= least:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    out.sort()
    return [x[2] for x in out]


def texts(seed, n=120):
    r = random.Random(seed)
    alnum = string.ascii_letters + string.digits
    bits = ["password", "TOKEN", "api_key", "ApiKey", "secret", '"', "'", " ", "  ", ":", "=", "AKIA", "\n", "é", "😀",
            "over ", "deadbeefdeadbeef", "0123456789abcdef0", "passwd="]
    out = []
    for _ in range(n):
        s = "".join(r.choice(bits) if r.random() < .75 else "".join(r.choices(alnum, k=r.randint(1, 25)))
                    for _ in range(r.randint(0, 40)))
        out.append(s)
    return out + ["", None, "token=password=abcdefghijklmn", "token: secret: abcdefghijklmnop", "AKIAAKIA" + "B" * 14]


def test_base_spans(spark):
    rows = list(enumerate(texts(1)))
    got = {r.doc_id: r for r in S.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = brute(t)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == want
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in want) for k in PATTERNS)


def sample(spark, seed):
    r = random.Random(seed)
    syll = ["the", "re", "tion", "an", "er", "get", "Set", "value", "_", "Name", "in", "ing", "max", "user"]
    word = ["".join(r.choices(syll, k=8)) for _ in range(400)]
    rand = ["".join(r.choices(string.ascii_letters + string.digits, k=30)) for _ in range(400)]
    return word, rand


def test_models_separate_held_out_strings(spark):
    word, rand = sample(spark, 3)
    df = spark.createDataFrame([(w, False, 1) for w in word] + [(w, True, 1) for w in rand],
                               "value string, random boolean, n long")
    model = S.train(df)
    word, rand = sample(spark, 4)
    held = spark.createDataFrame([(w, False) for w in word] + [(w, True) for w in rand], "value string, random boolean")
    from pyspark.sql import functions as F
    got = held.select("random", (S.score(F.col("value"), model) >= S.MIN_LLR).alias("hit")).collect()
    assert sum(r.hit == r.random for r in got) / len(got) > 0.98


def test_masking_keeps_columns_and_handles_empty(spark):
    t = "x password=abcdefabcdef0123 y deadbeefdeadbeef z"
    df = spark.createDataFrame([(1, t, "a", 5), (2, None, None, None), (3, "plain é", "b", 7)],
                               "doc_id long, text string, spans string, n_chars long")
    out = {r.doc_id: r for r in S.masked(df).collect()}
    assert out[1].text == "x [secret] y [secret] z" and out[1].n_chars == len(out[1].text) and out[1].spans == "a"
    assert out[3].text == "plain é" and out[3].n_chars == 7 and out[2].text == ""
    assert S.report(df.limit(0)).collect() == []


def test_secrets_in_one_run_with_other_text_are_masked(spark, monkeypatch):
    r = random.Random(6)
    alnum = string.ascii_letters + string.digits
    rand = lambda n: "".join(r.choices(alnum, k=n))
    word = lambda: "".join(r.choices(["the", "re", "tion", "an", "er", "get", "value", "in", "ing", "user"], k=3))
    rows = [f"token={rand(40)}" for _ in range(200)] + [" ".join(word() for _ in range(40)) for _ in range(200)]
    seen = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    model = S.train(S.labelled_samples(seen))            # the planted ones are held out
    monkeypatch.setattr(S, "train", lambda samples: model)
    keys = [rand(40) for _ in range(4)]
    path = "/".join(word() for _ in range(12))
    rows += [f"id 1234567890123456789-{keys[0]} end", f"see {keys[1]}/token=abcdefabcdef0123 end",
             f"at {path}/{keys[2]} end", f"at {'_'.join(word() for _ in range(9))}-{keys[3]} end", f"at {path} end"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {x.doc_id: x.text for x in S.masked(df).collect()}
    assert not [k for k in keys if any(k[i:i + 8] in t for t in out.values() for i in range(33))]
    assert out[404] == rows[404] and all(out[i].endswith(" end") for i in range(400, 405))
