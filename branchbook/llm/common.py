"""Helpers shared by the operators of this subpackage.

* ``Workspace`` - tables written under the shared folder the session names in
  ``spark.checkpoint.dir``; they cut lineage and survive lost executors.
* vectorised word and window hashing over raw UTF-8 bytes (NumPy, no per-word
  Python objects); words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``.
"""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.session import ensure_checkpoint_dir

#: Bytes of text hashed at once inside a task (a longer document goes alone).
CHUNK_BYTES = 1 << 20


class Workspace:
    """A run folder for written steps.  ``drop`` frees a step that no later one
    reads; what is left goes when the Python process ends (results are lazy and
    may still read their last step)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = f"{name}-{uuid.uuid4().hex}"
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{self.name}"
        atexit.register(self._remove, self.root)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a step as Parquet and read it back with its known schema."""
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.root}/{name}")

    def close(self) -> None:
        """Remove all steps, once what they led to has been written."""
        self._remove(self.root)

    @staticmethod
    def _remove(path: str) -> None:
        """Folders of the local or mounted file system; an object store's are
        left to its lifecycle rule."""
        url = urlparse(path)
        if url.scheme in ("", "file") and os.path.isdir(url.path):
            shutil.rmtree(url.path, ignore_errors=True)


#: Name of the column that tells rows apart whatever their doc ids.
ROW = "__row"


def keyed(docs: DataFrame, ws: Workspace, name: str = "rows") -> DataFrame:
    """The rows, written once, with a number of their own in ``ROW``.  Ids may
    be null or repeat; steps that meet again do so by this number, which is
    fixed by the written table and so the same in every later job and retry."""
    return ws.write(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


# -- hashing ------------------------------------------------------------------

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[[9, 10, 11, 12, 13, 32]] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE, _WBASE, _WBASE2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(0xA24BAED4963EE407)


def _inverse(odd: int) -> int:
    return pow(int(odd), -1, 1 << 64)


_INV, _WINV, _WINV2 = _U(_inverse(_BASE)), _U(_inverse(_WBASE)), _U(_inverse(_WBASE2))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = _powers.get(int(base))
    if p is None or len(p) < n:
        p = np.full(max(n, 1024), base, np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        if n <= 2 * CHUNK_BYTES:
            _powers[int(base)] = p
    return p[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), so that polynomial hashes look random."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Words:
    """The words of a list of documents: ``h`` (64-bit hash of each word),
    ``n`` (words of each document), ``first`` (index of each document's first
    word) and the byte spans ``start``/``end`` in ``data``."""

    def __init__(self, docs: list[bytes], lower: bool = False):
        self.data = b"\n".join(docs)
        self.bytes = b = np.frombuffer(self.data, np.uint8)
        self.doc_start = np.cumsum([0] + [len(d) + 1 for d in docs])[:-1]
        self.doc_end = self.doc_start + np.fromiter(map(len, docs), np.int64, len(docs))
        flat = np.zeros(len(b) + 2, np.int8)
        flat[1:-1] = ~_IS_SPACE[b]
        edge = np.diff(flat)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[b] * _power(_BASE, len(b)), out=total[1:])
        self.h = mix((total[self.end] - total[self.start]) * _power(_INV, len(b) + 1)[self.start])
        self.first = np.searchsorted(self.start, self.doc_start)
        self.last = np.append(self.first[1:], len(self.start))
        self.n = self.last - self.first

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word indexes) of the windows of ``k`` consecutive words that
        lie in one document, and their hashes."""
        m = len(self.h) - k + 1
        if m <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        total = np.zeros(len(self.h) + 1, np.uint64)
        np.cumsum(self.h * _power(_WBASE, len(self.h)), out=total[1:])
        at = np.flatnonzero(np.arange(m) + k <= np.repeat(self.last, self.n)[:m])
        return at, mix((total[at + k] - total[at]) * _power(_WINV, m)[at] + _U(k))

    def second(self, k: int, at: np.ndarray) -> np.ndarray:
        """Another 64 bits of the windows of ``k`` words that start at ``at``."""
        total = np.zeros(len(self.h) + 1, np.uint64)
        np.cumsum(mix(self.h) * _power(_WBASE2, len(self.h)), out=total[1:])
        return mix((total[at + k] - total[at]) * _power(_WINV2, len(self.h) + 1)[at] + _U(k))


def encode(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(rows: Iterable[tuple], text_at: int, limit: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Group rows so that a group's texts hold about ``limit`` bytes."""
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += len(r[text_at])
        if size >= limit:
            yield out
            out, size = [], 0
    if out:
        yield out


def batch_rows(batch, *names: str) -> Iterator[tuple]:
    """Rows of an Arrow record batch as tuples; the column ``text`` as bytes."""
    cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
    lists = [[b if b is not None else None for b in c.cast("binary").to_pylist()] if n == "text" else c.to_pylist()
             for n, c in zip(names, cols)]
    return zip(*lists)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
