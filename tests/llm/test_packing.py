"""Operator 6: ids against the tokenizer on whole texts, and the packing's rules."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from branchbook.llm import packing as P
from branchbook.llm.common import Workspace

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", " ", "Don't stop, it's 12.5% off!!", "a b\x0bc\x1cd", "Été ̈x Ökoß İstanbul ΣΑΣ",
        "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "dogs', cats.\nfoo., bar,baz. 3,4 .", "日本語 テキスト, ok.",
        " em　wide", "x" * 5000, "I'LL we'RE o'clock'S '"]


def test_ids_equal_whole_text_encoding():
    t = Tokenizer.from_file(PATH)
    r = random.Random(1)
    alphabet = list("abcXYZ019.,'!-<|> \n\té́ß 日'") + ["'s", "'ll", "the", "tion"]
    texts = HARD + ["".join(r.choices(alphabet, k=r.randint(0, 200))) for _ in range(500)]
    got = P.ChunkEncoder(PATH).encode([x.encode() for x in texts])
    for x, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_remembered_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 10)
    e = P.ChunkEncoder(PATH)
    for k in range(20):
        e.encode([b" ".join(b"w%d" % (k * 8 + j) for j in range(8))])
    assert len(e.now) <= 20 and len(e.old) <= 20


def test_a_batch_does_not_walk_all_remembered_chunks():
    class Remembered(dict):
        def keys(self):
            raise AssertionError("walked")
        __iter__ = keys

    e = P.ChunkEncoder(PATH)
    e.encode([b"the cat"])
    e.now = Remembered(e.now)
    want = Tokenizer.from_file(PATH).encode("the cat sat", add_special_tokens=False).ids
    assert np.frombuffer(e.encode([b"the cat sat"])[0], "<u4").tolist() == want


def check(rows, texts):
    t = Tokenizer.from_file(PATH)
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [0] for i, x in texts}
    bins = {}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r.start == 2048 * r.piece
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    return len(bins), -(-sum(map(len, ids.values())) // 2048)


@pytest.mark.parametrize("cell", [4096, 60])
def test_packing(spark, monkeypatch, cell):
    monkeypatch.setattr(P, "CELL", cell)
    r = random.Random(cell)
    texts = [(i, " ".join(r.choices(["the", "cat", "sat", "on"], k=r.choice([3, 300, 900, 1500, 2047, 2048, 5000]))))
             for i in range(150)] + [(200, None), (201, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = P.pack(df, PATH, Workspace(spark, "t")).collect()
    used, bound = check(rows, texts)
    assert used <= bound * 1.2
    assert P.pack(df.limit(0), PATH, Workspace(spark, "t")).collect() == []


def test_genetic_steps_keep_every_item_and_reach_a_planted_optimum():
    r = random.Random(5)
    sizes = []
    for _ in range(120):                       # perfect bins of three items
        a = r.randint(300, 1000)
        b = r.randint(300, 2048 - a - 300)
        sizes += [a, b, 2048 - a - b]
    pop = P.evolve(sizes, [], "x")
    first = len(set(pop[0].tolist()))
    for k in range(3):
        pop = P.evolve(sizes, pop, f"x{k}")
        for a in pop:
            assert np.bincount(a, weights=sizes).max() <= 2048 and len(a) == len(sizes)
    assert len(set(pop[0].tolist())) <= first <= 126
