"""Operator 10: byte-level BPE in DuckDB, inside the partitions.

Every match of the split pattern is a word.  A worker keeps a DuckDB database
of its own (one thread, bounded memory) with the merge table: all pairs of
tokens whose joined bytes are a token, whose id is the rank.  The words of a
batch that the worker has not seen are token-position rows (first one row per
byte) of a recursive query: each step joins neighbours with the merge table and
contracts each word's leftmost pair of least rank; a word without a pair leaves
the recursion.  An ordered aggregation over its last rows gives the ids.  The
bytes that a document's ids decode to are another ordered aggregation, over the
ids joined with the token table, in blocks of ``DECODE_IDS`` ids.

A word that is a token needs no step (as in the tokenizer library).  The query
looks at a word once per merge, so its work is quadratic in the word; words of
more than ``LONG`` bytes (no prose has them) are merged outside it, with a heap
of pairs and n log n steps.  Seen words are kept in two generations of
``REMEMBERED`` words.

Defined results: null text is empty (0 tokens, digests of the empty string);
equal or null doc ids are each reported; invalid UTF-8 is replaced first; a text
or a word may have any length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import batch_rows, chunks

#: Longest word of the recursive query (positions have 6 bits there).
LONG = 40
REMEMBERED = 400_000
#: Bytes of unseen words that one recursive query takes; ids decoded at once.
QUERY_BYTES, DECODE_IDS = 1 << 20, 1 << 19

# ``here`` holds a pair's rank, its place and the place of its second token, so
# the least one of a word says which rows to join and which one goes.
ENCODE_SQL = """
WITH RECURSIVE s(w, pos, tok, done) AS (
  SELECT w, pos, tok, false FROM start
  UNION ALL
  SELECT w, pos, CASE WHEN here = best THEN best >> 12 ELSE tok END, best IS NULL
  FROM (SELECT *, min(here) OVER (PARTITION BY w) AS best
        FROM (SELECT n.w, n.pos, n.tok, (m.id << 12) | (n.pos << 6) | n.after_pos AS here
              FROM (SELECT w, pos, tok, lead(tok) OVER o AS after, lead(pos) OVER o AS after_pos FROM s WHERE NOT done
                    WINDOW o AS (PARTITION BY w ORDER BY pos)) n
              LEFT JOIN merges m ON m.a = n.tok AND m.b = n.after))
  WHERE best IS NULL OR pos <> (best & 63)
)
SELECT w, string_agg(tok::VARCHAR, ' ' ORDER BY pos) AS ids FROM s WHERE done GROUP BY w
"""

DECODE_SQL = "SELECT block, string_agg(txt, '' ORDER BY pos) FROM ids JOIN tokens USING (id) GROUP BY block ORDER BY block"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always the leftmost pair of least rank, from a heap of
    pairs; neighbours are a linked list, and pairs that are gone are skipped."""
    part = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
    alive = [True] * len(part)

    def pair(i: int) -> tuple | None:
        j = after[i]
        if j >= len(part):
            return None
        rank = ranks.get(part[i] + part[j])
        return None if rank is None else (rank, i, part[i], part[j])

    heap = [x for x in map(pair, range(len(part))) if x]
    heapq.heapify(heap)
    while heap:
        _, i, x, y = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(part) or part[i] != x or part[j] != y:
            continue
        part[i] += part[j]
        alive[j] = False
        after[i] = after[j]
        if after[i] < len(part):
            before[after[i]] = i
        for k in (before[i], i):
            new = pair(k) if k >= 0 else None
            if new:
                heapq.heappush(heap, new)
    return [ranks[p] for p, a in zip(part, alive) if a]


class Encoder:
    """Ids of texts and the bytes that ids decode to, by DuckDB."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        self.ranks = ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.now: dict[str, str] = {}       # word -> its ids, joined by blanks
        self.old: dict[str, str] = {}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t))
                  if t[:k] in ranks and t[k:] in ranks]
        a, b, c = map(np.array, zip(*merges))
        db = self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        db.register("m", pa.table({"a": a.astype(np.int64), "b": b.astype(np.int64), "id": c}))
        db.register("t", pa.table({"id": list(ranks.values()), "txt": [t.decode("latin-1") for t in ranks]}))
        db.execute("CREATE TABLE merges AS SELECT a, b, id::BIGINT AS id FROM m; "
                   "CREATE TABLE tokens AS SELECT id::INTEGER AS id, txt FROM t")

    def _query(self, words: list[tuple[str, bytes]]) -> None:
        size = np.array([len(b) for _, b in words], np.int64)
        data = np.frombuffer(b"".join([b for _, b in words]), np.uint8)
        begin = np.repeat(np.cumsum(size) - size, size)
        self.db.register("start", pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), size),
                                            "pos": np.arange(len(data)) - begin, "tok": self.byte_id[data].astype(np.int64)}))
        for w, ids in self.db.execute(ENCODE_SQL).fetchall():
            self.now[words[w][0]] = ids

    def _learn(self, missing: list[str]) -> None:
        batch: list[tuple[str, bytes]] = []
        size = 0
        for word in missing:
            seen = self.old.get(word)
            if seen is not None:
                self.now[word] = seen
                continue
            b = word.encode()
            token = self.ranks.get(b)
            if token is not None:
                self.now[word] = str(token)
            elif len(b) > LONG:
                self.now[word] = " ".join(map(str, merge_long(b, self.ranks)))
            else:
                batch.append((word, b))
                size += len(b)
                if size >= QUERY_BYTES:
                    self._query(batch)
                    batch, size = [], 0
        if batch:
            self._query(batch)

    def encode(self, texts: list[str]) -> list[str]:
        """The ids of each text, joined by blanks."""
        split = [self.split(t) for t in texts]
        if len(self.now) > REMEMBERED:
            self.now, self.old = {}, self.now
        self._learn(list(set().union(*split) - self.now.keys()))
        get = self.now.__getitem__
        return [" ".join(map(get, words)) for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes that each text's ids stand for."""
        out = [[] for _ in ids]
        blocks = [(k, x[i:i + DECODE_IDS]) for k, x in enumerate(ids) for i in range(0, len(x), DECODE_IDS)]
        at = 0
        while at < len(blocks):
            to, n = at, 0
            while to < len(blocks) and (to == at or n + len(blocks[to][1]) <= DECODE_IDS):
                n += len(blocks[to][1])
                to += 1
            some = [x for _, x in blocks[at:to]]
            self.db.register("ids", pa.table({"block": np.repeat(np.arange(at, to, dtype=np.int32), [len(x) for x in some]),
                                              "pos": np.arange(n, dtype=np.int32), "id": np.concatenate(some)}))
            for block, text in self.db.execute(DECODE_SQL).fetchall():
                out[blocks[block][0]].append(text.encode("latin-1"))
            at = to
        return [b"".join(x) for x in out]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder; it outlives a task (this function is pickled by
    name, so all tasks of a worker share the module's cache)."""
    return Encoder(path, pattern)


def _encode_batches(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            # unseen words are learned for about 8 MB of text at once
            for part in chunks(((i, t or b"") for i, t in batch_rows(b, "doc_id", "text")), 1, 8 << 20):
                got = enc.encode([t.decode("utf-8", "replace") for _, t in part])
                ids = [np.fromstring(x, np.int32, sep=" ") if x else np.empty(0, np.int32) for x in got]
                cols = [pa.array([r[0] for r in part], pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([sha(x.encode()) for x in got]), pa.array([sha(d) for d in enc.decode(ids)])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes (and the ids)
    of every document.  ``path``: a rank file that the executors have."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_encode_batches(path, pattern, with_ids), schema)
