"""Operator 13: the files against plain arrays, and against the tokenizer library."""

import io
import os
import random
import zlib

import numpy as np
import public_tokenizers as T
import pyarrow as pa
import pytest
from branchbook.llm import chunkbpe, dac
from tokenizers import Tokenizer

PATH = T.path("byte_bpe_50k.json")


class Memory(io.BytesIO):
    def read_at(self, n, at):
        self.seek(at)
        self.asked = getattr(self, "asked", 0) + n
        return self.read(n)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def packed(ids, doc_ids, lengths):
    build, f, at = dac.DacBuilder(), Memory(), 0
    for i, n in zip(doc_ids, lengths):
        build.add(i, ids[at:at + n])
        at += n
    build.write(f)
    return f


@pytest.mark.parametrize("n, high", [(0, 1), (1, 1), (700, 256), (5000, 300), (5000, 1 << 16), (3000, 1 << 24), (3000, 1 << 32)])
def test_codes(n, high):
    r = np.random.default_rng(n + high % 1000)
    ids = (r.random(n) ** 4 * high).astype(np.uint32)
    lengths = [0, n // 3, n - n // 3, 0]
    d = dac.DacFile(packed(ids, [3, None, -5, 7], lengths))
    assert d.n_levels == max(1, -(-int(ids.max(initial=0)).bit_length() // 8))
    assert np.array_equal(d.tokens(0, n), ids)
    for i in [*range(min(n, 40)), *r.integers(0, max(n, 1), min(n, 200)).tolist()]:
        assert d.token(i) == ids[i]
    for _ in range(50):
        lo, hi = sorted(r.integers(0, n + 1, 2).tolist())
        assert np.array_equal(d.tokens(lo, hi), ids[lo:hi])
    doc_ids, valid, starts = d.documents()
    assert [i if v else None for i, v in zip(doc_ids.tolist(), valid)] == [3, None, -5, 7]
    assert starts.tolist() == [0, 0, n // 3, n, n]
    with pytest.raises(IndexError):
        d.token(n)


def test_a_token_reads_a_few_bytes_only():
    ids = np.random.default_rng(1).integers(0, 50_000, 200_000).astype(np.uint32)
    f = packed(ids, [1], [len(ids)])
    d = dac.DacFile(f)
    f.asked = 0
    assert d.token(150_001) == ids[150_001]
    assert f.asked <= 2 + 1 + 4 + 64


def texts():
    r = random.Random(5)
    bits = ["word", "don't", "we'll", "'s", "É", "é,", "naïve", "12a3", "&&&", "--", "(x)", "日本", "ß's", "×-", "a÷b", " ", "　",
            "ﬁx", "x²", "“q”", "\x1c", "\x85", "<b>", "<|endoftext|>", "<|"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "", "\x0b ", "   \n\n "]
    out = ["", " ", "\n\n", "a", " a", "end ", "end\n", "x\n\ny", "x \n y", "a" * 300, "<|endoftext|>", "a <|endoftext|> b"]
    return out + ["".join(r.choice(bits) + r.choice(gaps) for _ in range(r.randint(1, 40))) for _ in range(1500)]


def test_encoder_like_the_library(tokenizer):
    enc = chunkbpe.ChunkEncoder(PATH)
    got = enc.encode([t.encode() for t in texts()])
    for t, ids in zip(texts(), got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_memory_of_chunks_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(chunkbpe, "REMEMBERED", 30)
    enc, r = chunkbpe.ChunkEncoder(PATH), random.Random(2)
    for _ in range(8):
        t = " ".join("".join(r.choices("abcd", k=3)) for _ in range(20))
        assert np.frombuffer(enc.encode([t.encode()])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert len(enc.now) <= 60


def brute(rows, tokenizer):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents(spark, tmp_path, tokenizer, monkeypatch):
    r = random.Random(9)
    rows = [(i, t) for i, t in zip(r.sample(range(-500, 5000), 600), texts())] + [(9000, None), (9001, "")]
    r.shuffle(rows)
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, start int").repartition(5)
    got = dac.report(df, PATH, f"file://{tmp_path}/a").collect()
    assert sorted(map(tuple, got), key=lambda x: x[1]) == brute(rows, tokenizer)
    m = dac.manifest(f"{tmp_path}/a")
    assert [x["base"] for x in m] == np.cumsum([0] + [x["n_tokens"] for x in m])[:-1].tolist()
    ids = [x for i, t in sorted(rows) for x in tokenizer.encode(t or "", add_special_tokens=False).ids + [0]]
    at = [r.randrange(len(ids)) for _ in range(900)] + [0, len(ids) - 1]
    wanted = spark.createDataFrame([(p,) for p in [*at, None, -1, len(ids)]], "position long")
    found = dac.tokens_at(wanted, f"{tmp_path}/a").collect()
    assert sorted((str(x.position), str(x.token)) for x in found) == sorted(
        [(str(p), str(ids[p])) for p in at] + [("None", "None"), ("-1", "None"), (str(len(ids)), "None")])


def test_nulls_repeats_and_empty_table(spark, tmp_path, tokenizer):
    rows = [(None, "first"), (None, "first"), (4, "x y"), (4, "x y"), (4, "other"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(map(tuple, dac.report(df, PATH, f"{tmp_path}/b").collect()), key=lambda x: x[1])
    assert got == brute(rows, tokenizer)
    assert dac.report(df.limit(0), PATH, f"{tmp_path}/c").collect() == []


def test_small_files_and_leftovers_of_failed_tasks(tmp_path, monkeypatch, tokenizer):
    monkeypatch.setattr(dac, "FILE_TOKENS", 10)
    monkeypatch.setattr(dac, "READ_TOKENS", 7)
    monkeypatch.setattr(dac.TaskContext, "get", classmethod(lambda cls: type("C", (), {"partitionId": lambda self: 3})()))
    w = dac.DacWriter(str(tmp_path))
    docs = [(k, np.arange(k * 300, k * 300 + k % 9, dtype="<u4").tobytes()) for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([x for _, x in docs])], ["doc_id", "ids"])
    w.write(iter([batch]))                                    # an attempt that is lost
    w.commit([w.write(iter([batch])), None])
    assert len(os.listdir(tmp_path)) > 2 * 10
    reader = dac.DacReader(str(tmp_path))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["doc_id"], r["ids"]) for r in rows] == docs
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(x) // 4 for _, x in docs])[:-1].tolist()
