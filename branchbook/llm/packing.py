"""Operator 6: best-fit packing of token sequences by a grouping genetic algorithm.

Documents become token ids (closed by id 0); longer ones than ``CAPACITY`` are
cut into pieces.  Full pieces are sequences of their own.  The others are dealt
by a hash into cells of about ``CELL`` pieces, and each cell is packed by
``ISLANDS`` islands of a grouping genetic algorithm:

* crossover injects whole well-filled bins of one parent into the other,
  removes the bins that hold duplicates and best-fits the displaced pieces;
* mutation empties some bins and best-fits their pieces again;
* after each of ``EPOCHS`` epochs every island's best packing migrates to the
  next island (an equi-join on (cell, island)).

Islands are rows of a table that is written after each epoch, so a lost
executor repeats one epoch of some islands; a cell is bounded, and the number
of cells grows with the input.  Random choices are seeded by cell, island and
epoch.  An island stops at the lower bound (tokens / capacity, rounded up).

Defined results: null and empty text is the single id 0; rows that share a
``doc_id`` (or have none) are packed each on its own; an empty table gives no
sequences.  Chunks between ASCII white space are encoded once per worker and
remembered in a bounded table: the tokenizer never joins text across white
space, which the tests hold against whole texts.
"""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import Workspace, batch_rows, chunks

CAPACITY = 2048
CELL, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 3, 2, 6, 4
REMEMBERED = 500_000
END = (0).to_bytes(4, "little")

# -- tokens -------------------------------------------------------------------

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_SPACE_BYTE = np.zeros(256, bool)
_SPACE_BYTE[[9, 10, 11, 12, 13, 32]] = True


def _spaced(docs: list[bytes]) -> list[bytes]:
    """The documents in lower case, with a blank between a word and a single
    full stop or comma that ends it (they are tokens of their own anyway, and
    the words are then seen again more often)."""
    data = b"\n".join(docs).lower() + b"\n"
    b = np.frombuffer(data, np.uint8)
    at = np.flatnonzero((b[1:-1] == 46) | (b[1:-1] == 44)) + 1
    at = at[_WORD_BYTE[b[at - 1]] & _SPACE_BYTE[b[at + 1]]]
    out = np.insert(b, at, 32).tobytes()
    ends = np.cumsum([len(d) + 1 for d in docs])
    ends = (ends + np.searchsorted(at, ends)).tolist()
    return [out[x:y] for x, y in zip([0, *ends], ends)]


class ChunkEncoder:
    """Ids (little-endian unsigned 32-bit) of white-space separated chunks,
    remembered in two generations of at most ``REMEMBERED`` chunks each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # for chunks that normalizing and splitting leave as they are
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.now: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, missing: list[bytes]) -> None:
        plain, other = [], []
        for c in missing:
            ids = self.old.get(c)
            if ids is not None:
                self.now[c] = ids
                continue
            t = c.decode("utf-8", "replace")
            # lower-case Latin letters: one word, already in normal form
            is_plain = c.islower() if c.isalpha() else t.isalpha() and max(t) < "\u0250" and t == t.lower()
            (plain if is_plain else other).append((c, t))
        for (c, _), e in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)):
            self.now[c] = np.array(e.ids, "<u4").tobytes()
        e = self.plain.encode(" ".join([t for _, t in plain]), add_special_tokens=False)
        ids = np.array(e.ids, "<u4").tobytes()
        cut = (4 * np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(plain) + 1))).tolist()
        for (c, _), a, b in zip(plain, cut, cut[1:]):
            self.now[c] = ids[a:b]

    def encode(self, docs: list[bytes]) -> list[bytes]:
        # a special token's letters count; other text is lower-cased anyway
        split = [d.split() if b"<|" in d else s.split() for d, s in zip(docs, _spaced(docs))]
        if len(self.now) > REMEMBERED:
            self.now, self.old = {}, self.now
        # (a set less a dict's keys would walk all that is remembered)
        self._learn(list(filterfalse(self.now.__contains__, set().union(*split))))
        get = self.now.__getitem__
        return [b"".join(map(get, s)) for s in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder; it outlives a task (this function is pickled by
    name, so all tasks of a worker share the module's cache)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(path)


def _piece_batches(path: str):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 4 * CAPACITY
        for b in batches:
            for part in chunks(((i, b"" if t is None else t) for i, t in batch_rows(b, "doc_id", "text")), 1):
                out = []
                for (doc_id, _), ids in zip(part, encoder(path).encode([r[1] for r in part])):
                    ids += END
                    for k in range(0, len(ids), size):
                        one = ids[k:k + size]
                        out.append((doc_id, k // size, k // 4, len(one) // 4, zlib.crc32(one), one))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                                pa.int64(), pa.binary()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return pieces


def token_pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and the ids of every piece.
    ``tokenizer``: path of a tokenizer file that the executors have."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _piece_batches(tokenizer),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


# -- the genetic algorithm ----------------------------------------------------


class Packing:
    """Bins of item indexes; ``fill`` per bin."""

    def __init__(self, sizes: list[int]):
        self.sizes, self.bins, self.fill = sizes, [], []
        self._free: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
        self._mask = 0

    def add_bin(self, items: list[int]) -> None:
        self.bins.append(items)
        self.fill.append(sum(self.sizes[i] for i in items))
        self._offer(len(self.bins) - 1)

    def _offer(self, k: int) -> None:
        room = CAPACITY - self.fill[k]
        self._free[room].append(k)
        self._mask |= 1 << room

    def best_fit(self, items: list[int]) -> None:
        """Each item into the fullest bin that still has room for it."""
        for i in items:
            s = self.sizes[i]
            m = self._mask >> s
            if not m:
                self.add_bin([i])
                continue
            room = s + (m & -m).bit_length() - 1
            k = self._free[room].pop()
            if not self._free[room]:
                self._mask ^= 1 << room
            self.bins[k].append(i)
            self.fill[k] += s
            self._offer(k)

    def score(self) -> tuple[int, int]:
        """Fewer bins first, then unevenly filled ones (their room is of use)."""
        return len(self.bins), -sum(f * f for f in self.fill)

    def assignment(self) -> np.ndarray:
        out = np.empty(len(self.sizes), np.int32)
        for k, b in enumerate(self.bins):
            out[b] = k
        return out


def _from_assignment(sizes: list[int], a: np.ndarray) -> Packing:
    p = Packing(sizes)
    order = np.argsort(a, kind="stable")
    for b in np.split(order, np.flatnonzero(np.diff(a[order])) + 1) if len(a) else []:
        p.add_bin(b.tolist())
    return p


def _rebuilt(p: Packing, keep: list[list[int]], loose: list[int], order) -> Packing:
    out = Packing(p.sizes)
    for b in keep:
        out.add_bin(list(b))
    out.best_fit(sorted(loose, key=order))
    return out


def crossover(a: Packing, b: Packing, rng: random.Random) -> Packing:
    """Inject a random half of the best-filled bins of ``b`` into ``a``."""
    good = [x for x, f in zip(b.bins, b.fill) if f >= CAPACITY - rng.choice((0, 1, 4, 16))]
    rng.shuffle(good)
    injected = good[:max(1, len(good) // 2)]
    taken = {i for x in injected for i in x}
    keep, loose = list(injected), []
    for x in a.bins:
        if taken.isdisjoint(x):
            keep.append(x)
        else:
            loose += [i for i in x if i not in taken]
    return _rebuilt(a, keep, loose, lambda i: -a.sizes[i])


def mutate(p: Packing, rng: random.Random) -> Packing:
    """Empty the worst and some random bins; best-fit in a slightly mixed order."""
    n = len(p.bins)
    worst = sorted(range(n), key=p.fill.__getitem__)[:1 + n // 50]
    out = set(worst) | set(rng.sample(range(n), min(n, 1 + n // 10)))
    loose = [i for k in out for i in p.bins[k]]
    return _rebuilt(p, [b for k, b in enumerate(p.bins) if k not in out], loose,
                    lambda i: -p.sizes[i] * rng.uniform(.9, 1.1))


def evolve(sizes: list[int], population: list[np.ndarray], seed: str) -> list[np.ndarray]:
    """One epoch of an island; the best packing first."""
    rng = random.Random(seed)
    bound = -(-sum(sizes) // CAPACITY)
    pop = [_from_assignment(sizes, a) for a in population]
    while len(pop) < POPULATION:
        p = Packing(sizes)
        spread = .15 * len(pop)
        p.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i] * rng.uniform(1 - spread, 1 + spread)))
        pop.append(p)
        if len(p.bins) == bound:
            break
    pop.sort(key=Packing.score)
    for _ in range(GENERATIONS):
        if len(pop[0].bins) == bound:
            break
        children = []
        for _ in range(POPULATION):
            a, b = rng.sample(pop, 2)
            children.append(crossover(a, b, rng) if rng.random() < .7 else mutate(a, rng))
        pop = sorted(pop + children, key=Packing.score)[:POPULATION]
    return [p.assignment() for p in pop]


_STATE = ("cell long, island int, items array<long>, sizes array<int>, population array<binary>, "
          "n_bins int, spread long")


def _epoch(number: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                sizes = [int(s) for s in r.sizes]
                start = [np.frombuffer(p, np.int32) for p in r.population]
                if r.migrant is not None:
                    start = [np.frombuffer(r.migrant, np.int32), *start][:POPULATION]
                best = evolve(sizes, start, f"{r.cell}/{r.island}/{number}")
                fill = np.bincount(best[0], weights=sizes).astype(np.int64)
                yield pd.DataFrame([{"cell": r.cell, "island": r.island, "items": r.items, "sizes": sizes,
                                     "population": [p.tobytes() for p in best], "n_bins": len(fill),
                                     "spread": -int((fill * fill).sum())}])
    return run


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            a, sizes = np.frombuffer(r.best, np.int32), np.asarray(r.sizes, np.int64)
            order = np.argsort(a, kind="stable")
            ends = np.cumsum(sizes[order])
            first = np.concatenate(([True], np.diff(a[order]) > 0))
            before = (ends - sizes[order])[first][np.cumsum(first) - 1]
            yield pd.DataFrame({"item": np.asarray(r.items)[order], "offset": ends - sizes[order] - before,
                                "sequence_id": r.cell * (1 << 20) + a[order].astype(np.int64)})


def place(pieces: DataFrame, ws: Workspace) -> DataFrame:
    """``pieces`` (item, length below CAPACITY) to item, sequence_id, offset."""
    cells = max(1, round(pieces.count() / CELL))
    dealt = (pieces.withColumn("cell", F.pmod(F.xxhash64("item"), F.lit(cells)))
             .groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("item", "length"))).alias("x")))
    state = dealt.select(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("x.item").alias("items"),
        F.col("x.length").cast("array<int>").alias("sizes"), F.array().cast("array<binary>").alias("population"),
        F.lit(None).cast("binary").alias("migrant")).repartition(max(ISLANDS, cells), "cell", "island")
    for e in range(EPOCHS):
        if e:
            elite = state.select("cell", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"),
                                 F.col("population")[0].alias("migrant"))
            state = state.drop("n_bins", "spread").join(elite, ["cell", "island"])
        state = ws.write(state.mapInPandas(_epoch(e), _STATE), f"epoch-{e}")
        if e:
            ws.drop(f"epoch-{e - 1}")
    best = state.groupBy("cell").agg(F.min_by(F.struct("items", "sizes", F.col("population")[0].alias("best")),
                                              F.struct("n_bins", "spread", "island")).alias("b"))
    return best.select("cell", "b.*").mapInPandas(_places, "item long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, ws: Workspace) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id
    and offset."""
    pieces = token_pieces(docs, tokenizer).drop("ids").withColumn("item", F.monotonically_increasing_id())
    pieces = ws.write(pieces, "pieces")
    full = F.col("length") == CAPACITY
    places = place(pieces.where(~full).select("item", "length"), ws)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    alone = pieces.where(full).withColumns({"sequence_id": -1 - F.col("item"), "offset": F.lit(0).cast("long")})
    return pieces.where(~full).join(places, "item").select(cols).unionByName(alone.select(cols))
