"""Operator 13: token ids in files of directly addressable codes.

An id is cut into 8-bit chunks, lowest first, as few as it needs.  Level 0 of a
file holds the first chunk of every token, level 1 the second chunk of those
tokens that have one, and so on.  Each level but the last has a continuation
bitmap (one bit a token: is there a next chunk?) and a rank directory (the ones
before every 512th bit).  So token ``i`` is found by one look at each level: its
chunk, its bit, and the rank of that bit, which is the token's place in the next
level.  Nothing is decoded on the way, neither a block nor a neighbour.

On Spark the files are a data source, ``dac`` (``register`` names it to a
session): documents are put into ascending ``doc_id`` order by a range
partitioning, every task encodes and writes its range in one Python worker, and
closes a file after ``FILE_TOKENS`` tokens, so that its memory is bounded.  Tasks write files of
names of their own; the commit lists the files of the successful attempts in
``manifest.json`` with the number of tokens before each file.  What failed
attempts leave is in no manifest and is never read.  Paths are opened with
``pyarrow.fs`` (local and mounted folders, HDFS, object stores).

Defined results: null text is empty and holds the end id alone; null doc ids
come first; rows that share a ``doc_id`` stand in the order of the table's
files; an empty table gives a manifest without files.  Other columns of the
input take no part.
"""

from __future__ import annotations

import json
import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType

from branchbook.llm.chunkbpe import encoder
from branchbook.llm.common import chunks

MAGIC, LEVELS, STEP = b"DAC1", 4, 512
#: Tokens after which a task closes a file, and tokens of one batch read back.
FILE_TOKENS, READ_TOKENS = 1 << 24, 1 << 20
#: Bytes of text encoded at once.
ENCODE_BYTES = 2 << 20
#: Lookups in one file from which on its levels are read whole.
MANY = 512
_HEAD = struct.Struct("<4sIQQ" + "QQQQ" * LEVELS + "QQQ")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint32)

# -- one file -----------------------------------------------------------------


class DacBuilder:
    """Levels of a file as its tokens arrive (at most three bytes a token of a
    16-bit vocabulary), written section by section."""

    def __init__(self):
        self.chunks: list[list[np.ndarray]] = [[] for _ in range(LEVELS)]
        self.more: list[list[np.ndarray]] = [[] for _ in range(LEVELS)]
        self.doc_ids: list = []
        self.lengths: list[int] = []
        self.n_tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_tokens += len(ids)
        left = ids
        for chunks_, more_ in zip(self.chunks, self.more):
            chunks_.append(left.astype(np.uint8))
            left = left >> np.uint32(8)
            more = left > 0
            left = left[more]
            more_.append(more)
            if not len(left):
                break

    def write(self, f) -> None:
        sizes = [sum(map(len, c)) for c in self.chunks]
        n = max([k + 1 for k, s in enumerate(sizes) if s], default=1)
        if n < LEVELS:
            self.more[n - 1] = []            # the last level has no bitmap
        bits_size = [(s + 7) // 8 for s in sizes]
        rank_size = [4 * ((s + STEP - 1) // STEP) for s in sizes]
        at, head = _HEAD.size, []
        for k in range(n):
            last = k + 1 == n
            head += [sizes[k], at, 0 if last else at + sizes[k], 0 if last else at + sizes[k] + bits_size[k]]
            at += sizes[k] + (0 if last else bits_size[k] + rank_size[k])
        docs = len(self.lengths)
        head += [0, 0, 0, 0] * (LEVELS - n) + [at, at + 8 * docs, at + 9 * docs]
        f.write(_HEAD.pack(MAGIC, n, self.n_tokens, docs, *head))
        for k in range(n):
            for c in self.chunks[k]:
                f.write(c.tobytes())
            if k + 1 < n:
                packed = np.packbits(np.concatenate(self.more[k]), bitorder="little")
                per_step = np.add.reduceat(_ONES[packed], np.arange(0, len(packed), STEP // 8))
                f.write(packed.tobytes())
                f.write(np.concatenate(([0], np.cumsum(per_step)[:-1])).astype("<u4").tobytes())
        f.write(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes())
        f.write(np.array([i is not None for i in self.doc_ids], np.uint8).tobytes())
        f.write(np.concatenate(([0], np.cumsum(self.lengths, dtype=np.int64))).astype("<i8").tobytes())


class DacFile:
    """Reads an open random-access file (``read_at``), only the bytes it needs."""

    def __init__(self, f):
        self.f = f
        x = _HEAD.unpack(f.read_at(_HEAD.size, 0))
        if x[0] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.n_levels, self.n_tokens, self.n_docs = x[1:4]
        self.levels = [x[4 + 4 * k:8 + 4 * k] for k in range(self.n_levels)]
        self.docs = x[4 + 4 * LEVELS:]

    def _read(self, at: int, n: int, dtype=np.uint8) -> np.ndarray:
        size = np.dtype(dtype).itemsize
        return np.frombuffer(self.f.read_at(n * size, at), dtype)

    def _rank(self, k: int, i: int) -> int:
        """Ones of level k's bitmap before place i (also one past the end)."""
        n, _, bits, ranks = self.levels[k]
        step = min(i, max(n - 1, 0)) // STEP
        before = int(self._read(ranks + 4 * step, 1, "<u4")[0]) if n else 0
        return before + int(self._flags(k, step * STEP, i).sum())

    def _flags(self, k: int, lo: int, hi: int) -> np.ndarray:
        bits = self.levels[k][2]
        if hi <= lo:
            return np.zeros(0, np.uint8)
        data = self._read(bits + lo // 8, (hi + 7) // 8 - lo // 8)
        return np.unpackbits(data, bitorder="little")[lo % 8:lo % 8 + hi - lo]

    def token(self, i: int) -> int:
        """The id at place i: a chunk, a bit and a rank from each level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for k in range(self.n_levels):
            value |= int(self._read(self.levels[k][1] + i, 1)[0]) << (8 * k)
            if k + 1 == self.n_levels or not self._flags(k, i, i + 1)[0]:
                return value
            i = self._rank(k, i)
        return value

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """The ids at places lo to hi; each level is read only where they stand."""
        out = np.zeros(max(hi - lo, 0), np.uint32)
        here = np.arange(len(out))
        for k in range(self.n_levels):
            if not len(here):
                break
            out[here] |= self._read(self.levels[k][1] + lo, hi - lo).astype(np.uint32) << np.uint32(8 * k)
            if k + 1 < self.n_levels:
                here = here[self._flags(k, lo, hi).astype(bool)]
                lo = self._rank(k, lo)
                hi = lo + len(here)
        return out

    def pick(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places: one by one, or from whole levels if many."""
        if len(places) >= MANY:
            return self.tokens(0, self.n_tokens)[places]
        return np.array([self.token(int(i)) for i in places], np.uint32)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc ids, which of them are not null, and the place of each first token (and the end)."""
        ids, valid, starts = self.docs
        return (self._read(ids, self.n_docs, "<i8"), self._read(valid, self.n_docs).astype(bool),
                self._read(starts, self.n_docs + 1, "<i8"))


# -- the data source ----------------------------------------------------------


def _place(path: str):
    """File system and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def manifest(path: str) -> list[dict]:
    """The files in order: file, base (tokens before it), n_tokens, n_docs."""
    fs, root = _place(path)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        return json.loads(f.read())


@dataclass
class Written(WriterCommitMessage):
    files: list        # [partition, number in it, file, n_tokens, n_docs]


@dataclass
class FilePart(InputPartition):
    file: str
    base: int


class DacWriter(DataSourceArrowWriter):
    """Takes columns doc_id and ids (binary, little-endian unsigned 32-bit), or
    doc_id and text to be encoded by ``tokenizer`` and closed by ``end_id``."""

    def __init__(self, path: str, tokenizer: str | None = None, end_id: int = 0):
        self.path, self.tokenizer, self.end = path, tokenizer, int(end_id).to_bytes(4, "little")

    def _documents(self, b: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
        if self.tokenizer is None:
            for doc_id, data in zip(b.column(0).to_pylist(), b.column(1)):
                yield doc_id, np.frombuffer(data.as_buffer(), "<u4")
            return
        encode = encoder(self.tokenizer).encode
        rows = ((i.as_py(), t.as_buffer()) for i, t in zip(b.column(0), b.column(1).fill_null("").cast(pa.binary())))
        for part in chunks(rows, 1, ENCODE_BYTES):
            for (doc_id, _), ids in zip(part, encode([t.to_pybytes() for _, t in part])):
                yield doc_id, np.frombuffer(ids + self.end, "<u4")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _place(self.path)
        fs.create_dir(root, recursive=True)
        done, part = [], TaskContext.get().partitionId()
        build = DacBuilder()

        def close() -> None:
            name = f"{uuid.uuid4().hex}.dac"
            with fs.open_output_stream(f"{root}/{name}") as f:
                build.write(f)
            done.append([part, len(done), name, build.n_tokens, len(build.lengths)])

        for b in iterator:
            for doc_id, ids in self._documents(b):
                build.add(doc_id, ids)
                if build.n_tokens >= FILE_TOKENS:
                    close()
                    build = DacBuilder()
        if build.lengths:
            close()
        return Written(done)

    def commit(self, messages: list) -> None:
        fs, root = _place(self.path)
        fs.create_dir(root, recursive=True)
        base, out = 0, []
        for _, _, name, tokens, docs in sorted(x for m in messages if m for x in m.files):
            out.append({"file": name, "base": base, "n_tokens": tokens, "n_docs": docs})
            base += tokens
        with fs.open_output_stream(f"{root}/manifest.json") as f:
            f.write(json.dumps(out).encode())

    def abort(self, messages: list) -> None:
        fs, root = _place(self.path)
        for _, _, name, *_ in (x for m in messages if m for x in m.files):
            fs.delete_file(f"{root}/{name}")


class DacReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list:
        return [FilePart(x["file"], x["base"]) for x in manifest(self.path)] or [FilePart("", 0)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, root = _place(self.path)
        with fs.open_input_file(f"{root}/{partition.file}") as f:
            d = DacFile(f)
            ids, valid, starts = d.documents()
            at = 0
            while at < d.n_docs:
                to = max(at + 1, int(np.searchsorted(starts, starts[at] + READ_TOKENS, "right")) - 1)
                lo, hi = int(starts[at]), int(starts[to])
                data = d.tokens(lo, hi).astype("<u4").tobytes()
                cut = (4 * (starts[at:to + 1] - lo)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:to], mask=~valid[at:to]), pa.array(starts[at:to] + partition.base),
                     pa.array(np.diff(starts[at:to + 1])), pa.array([data[x:y] for x, y in zip(cut, cut[1:])], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])
                at = to


class DacSource(DataSource):
    """``spark.read.format("dac").load(path)``; writes columns doc_id and ids, or
    doc_id and text with the options ``tokenizer`` and ``end_id``."""

    @classmethod
    def name(cls) -> str:
        return "dac"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> DacReader:
        return DacReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DacWriter:
        text = isinstance(schema.fields[1].dataType, StringType)
        return DacWriter(self.options["path"], self.options["tokenizer"] if text else None, self.options.get("end_id", 0))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DacSource)


# -- on Spark -----------------------------------------------------------------


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id and text in ascending doc_id order.  The row number splits a
    doc_id that very many rows share."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.monotonically_increasing_id().alias("row"))
    return d.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0) -> None:
    """Encode the documents (``tokenizer``: path of a tokenizer file that the
    executors have) and write the files and their manifest to ``path``."""
    register(docs.sparkSession)
    ordered(docs).write.format("dac").option("tokenizer", tokenizer).option("end_id", end_id).mode("append").save(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every document of the files."""
    register(spark)
    return spark.read.format("dac").load(path)


def _locate_batches(bases: list[int], total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(0).to_pylist()
            file = [bisect_right(bases, i) - 1 if i is not None and 0 <= i < total else None for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(file, pa.int32())], ["position", "file"])
    return run


def _lookup_batches(path: str, files: list[dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(path)
        for b in batches:
            at, file = b.column(0), b.column(1)
            token = np.zeros(b.num_rows, np.int64)
            number = np.array([-1 if x is None else x for x in file.to_pylist()], np.int64)
            place = np.array([x or 0 for x in at.to_pylist()], np.int64)
            for k in np.unique(number[number >= 0]).tolist():
                mine = number == k
                with fs.open_input_file(f"{root}/{files[k]['file']}") as f:
                    token[mine] = DacFile(f).pick(place[mine] - files[k]["base"])
            yield pa.RecordBatch.from_arrays([at, pa.array(token, mask=number < 0)], ["position", "token"])
    return run


def tokens_at(wanted: DataFrame, path: str) -> DataFrame:
    """position and token of every row of ``wanted`` (its column ``position``
    counts tokens over all files; null or outside: null token).  The lookups are
    dealt by file and position, so that a file that very many rows ask for is
    read by several tasks.  Tasks get one manifest entry per file."""
    files = manifest(path)
    bases = [x["base"] for x in files]
    total = files[-1]["base"] + files[-1]["n_tokens"] if files else 0
    rows = wanted.select(F.col("position").cast("long").alias("position")).mapInArrow(
        _locate_batches(bases, total), "position long, file int")
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("position"), F.lit(8))).repartition("file", "salt")
    return dealt.sortWithinPartitions("file").select("position", "file").mapInArrow(
        _lookup_batches(path, files), "position long, token long")


def report(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """Write the documents' ids and read them back: doc_id, start, n_tokens, ids_crc32."""
    write_tokens(docs, tokenizer, path)
    return read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
