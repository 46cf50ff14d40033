"""The pipeline against its stages' rules applied one after another in Python."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from branchbook.llm import secrets

from tests.llm import test_minhash, test_secrets, test_substrings


def documents():
    r = random.Random(3)
    vocab = [f"{a}{b}" for a in ("tion", "the", "ing", "er", "re", "an") for b in ("ly", "ed", "es", "or", "at", "on", "is")]
    passage = " ".join(f"shared{i}" for i in range(55))
    rows = []
    for i in range(60):
        rows.append(" ".join(r.choice(vocab) + str(r.randint(0, 999)) for _ in range(r.randint(90, 400))))
    rows += [rows[0], rows[1].upper(), rows[2] + " tail"]                      # copies
    rows += [rows[3] + "\n" + passage, passage + " " + rows[4] + " " + rows[5], "short text", None, "### " * 100]
    rows.append(rows[6] + " password=Ab3xYz9QwErTy12 end " + " ".join(r.choice(vocab) for _ in range(60)))
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(rows)]


def test_stages_follow_their_rules(spark, tmp_path):
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    state = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        state.append({r.doc_id: r.text for r in docs.collect()})
    good, near, sub, masked = state
    texts = {i: t for i, t, *_ in rows}
    assert set(texts) - set(good) == {i for i, t in texts.items() if t in (None, "short text", "### " * 100)}
    groups = test_minhash.brute(list(good.items()))
    assert set(near) == {i for i, (_, _, kept) in groups.items() if kept}
    assert {60, 61, 62}.isdisjoint(near)
    want = test_substrings.brute(list(near.items()))
    assert {i: len(t.split()) for i, t in sub.items()} == {i: n - gone for i, (n, gone, _) in want.items() if n > gone}
    assert sum(t.count("shared0 ") for t in sub.values()) == 1
    for i, t in masked.items():
        assert all(x not in t for x in ("password=Ab3", )) and (t == sub[i] or secrets.MASK in t)
        assert not test_secrets.brute(t)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    sizes = {}
    for r in packed:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in masked.items()}
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048 and len(fill) <= 1.2 * -(-sum(fill.values()) // 2048)
    assert np.array([r.offset for r in packed]).min() == 0


def write(spark, rows, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    """Each row has its own verdict: a good text stays beside a bad one of its id."""
    r = random.Random(8)
    good = [" ".join(f"w{r.randint(0, 9999)}" for _ in range(120)) for _ in range(4)]
    texts = [(7, good[0]), (7, "too short"), (None, "short"), (None, good[1]), (None, good[1]), (8, good[2]), (8, good[2]), (8, good[3])]
    write(spark, [(i, t, "en", "s", len(t)) for i, t in texts], tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    state = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        state.append(sorted((str(x.doc_id), x.text) for x in docs.collect()))
    named = [(str(i), t) for i, t in texts]
    assert state[0] == sorted(x for x in named if x[1] in good)
    assert state[1] == state[2] == state[3] == sorted(set(state[0]))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(x.doc_id) for x in packed) == ["7", "8", "8", "None"]


def test_empty_table(spark, tmp_path):
    write(spark, [], tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
