"""Operator 2: near-duplicates by MinHash with tensored banding.

Words are lower-cased (A-Z); a document's set holds its distinct 5-word
shingles as 64-bit hashes (a shorter text is one shingle).  Two collections A
and B of ``SKETCHES`` sketches are computed, each sketch hashing ``ROWS``
minhashes; the tables' keys are all pairs (A_i, B_j).  ``SKETCHES``**2 = 256
tables of 6 rows thus need 2 * 16 * 3 = 96 minhashes instead of 1536.  At a
similarity of 0.75 a pair meets in some table with probability 0.9997, above
0.8 with 0.99998.

* Equal sets are one class before any table is built (a group of exact copies
  is one row from there on).
* A sketch that a single class has cannot meet another one, so only sketches
  seen twice are combined into keys.
* Candidates are confirmed on the full sets: 100 * common >= 75 * union.
* No bucket is expanded into all its pairs.  A class's degree is the size of
  all its buckets; the member of highest degree is a bucket's centre (in a
  group of near copies, the text closest to the common origin).  Each class is
  compared with the best centre of its buckets, which finds nearly all links.
* What is left are buckets whose members lie in several components.  Members
  outside a bucket's largest component are compared with its other components
  in blocks of bounded size; a pair is looked at in the first table that it
  shares, and only if ``AGREE`` of its 96 minhashes agree (a pair of similarity
  0.75 misses that with probability 1e-8) are its sets compared, inside the
  block: the sets travel once for each block that needs them, and only links
  leave it.  So every candidate pair is in one component, or refuted: of the
  links that the tables find, none is lost.

Rows and classes are known by a row number of their own (``common.keyed``); a
``doc_id`` only names a component, by the smallest one in it.

Defined results: null text, or text without words, has an empty set, is linked
with nothing and is its own component; a null ``doc_id`` gets a null component
and is kept; rows that share a ``doc_id`` are documents each, linked by their
texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import ROW, Words, Workspace, batch_rows, chunks, keyed, mix
from branchbook.llm.components import components

SHINGLE, PERCENT = 5, 75
SKETCHES, ROWS = 16, 3
#: Equal minhashes (8 bits of each) without which the sets are not compared.
AGREE = 48
#: Rows of the two sides of a block of a bucket, and pairs looked at together.
FEW_BLOCK, ALL_BLOCK, PAIRS = 1024, 4096, 1 << 17

_rng = np.random.Generator(np.random.PCG64(5))
_MUL = _rng.integers(1, 2**63, 2 * SKETCHES * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, 2 * SKETCHES * ROWS, dtype=np.uint64)


def shingle_sets(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The documents' sets one after another (sorted within each), and sizes."""
    w = Words(docs, lower=True)
    at, h = w.windows(SHINGLE)
    doc = w.doc_of_word()[at]
    short = np.flatnonzero((w.n > 0) & (w.n < SHINGLE))
    whole = [np.bitwise_xor.reduce(mix(w.h[w.first[k]:w.last[k]] + np.arange(1, w.n[k] + 1, dtype=np.uint64)))
             for k in short]
    doc, h = np.append(doc, short), np.append(h, np.array(whole, np.uint64))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(docs))


def _texts(batch, *more: str) -> Iterator[list[tuple]]:
    return chunks(((i, b"" if t is None else t, *x) for i, t, *x in batch_rows(batch, ROW, "text", *more)), 1)


def sketches(h: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per (non-empty) set: 2 * SKETCHES sketches, and 8 bits of each minhash."""
    x = mix(h)
    out = np.empty((len(start), 2 * SKETCHES), np.uint64)
    bits = np.empty((len(start), len(_MUL)), np.uint8)
    for s in range(2 * SKETCHES):
        key = np.full(len(start), s + 1, np.uint64)
        for r in range(ROWS):
            k = s * ROWS + r
            least = np.minimum.reduceat(x * _MUL[k] + _ADD[k], start)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
            bits[:, k] = mix(least) >> np.uint64(56)
        out[:, s] = key
    return out, bits


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in _texts(b, "doc_id"):
            h, n = shingle_sets([r[1] for r in part])
            full = np.flatnonzero(n)
            start = (np.cumsum(n) - n)[full]
            halves: list = [None] * len(part)
            bits: list = [None] * len(part)
            one, two = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
            if len(full):
                sk, low = sketches(h, start)
                for k, row, x in zip(full, sk.view(np.int64), low):
                    halves[k], bits[k] = row, x.tobytes()
                one[full], two[full] = np.add.reduceat(mix(h), start), np.add.reduceat(mix(~h), start)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64()),
                 pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(halves, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                [ROW, "doc_id", "n_shingles", "s1", "s2", "halves", "bits"])


def _size_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in _texts(b):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets([r[1] for r in part])[1].astype(np.int64))], ["n_shingles"])


def signatures(docs: DataFrame) -> DataFrame:
    return docs.mapInArrow(_signature_batches,
                           f"{ROW} long, doc_id long, n_shingles long, s1 long, s2 long, halves array<long>, bits binary")


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in _texts(b):
            h, n = shingle_sets([r[1] for r in part])
            offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))], ["doc", "items"])


def shared_halves(classes: DataFrame) -> DataFrame:
    """doc and its sketches of either collection that another class has too:
    arrays ``a`` and ``b`` of (place, sketch).  ``classes``: doc, halves."""
    half = classes.select("doc", F.posexplode("halves").alias("at", "half"))
    shared = half.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    pair = F.struct(F.col("at").cast("byte").alias("at"), "half")
    mine = half.join(shared, "half").groupBy("doc").agg(F.collect_list(F.when(F.col("at") < SKETCHES, pair)).alias("a"),
                                                       F.collect_list(F.when(F.col("at") >= SKETCHES, pair)).alias("b"))
    return mine.where((F.size("a") > 0) & (F.size("b") > 0))


def table_keys(mine: DataFrame) -> DataFrame:
    """key, doc and the places of the two sketches that make the key."""
    return (mine.select("doc", "b", F.explode("a").alias("x")).select("doc", "x", F.explode("b").alias("y"))
            .select(F.xxhash64("x.half", "y.half").alias("key"), "doc", F.col("x.at").alias("i"), F.col("y.at").alias("j")))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    a = sets.select(F.col("doc").alias("u"), F.col("items").alias("iu"))
    b = sets.select(F.col("doc").alias("v"), F.col("items").alias("iv"))
    both = F.size(F.array_intersect("iu", "iv"))
    return (pairs.join(b, "v").join(a, "u")
            .select("u", "v", both.alias("common"), (F.size("iu") + F.size("iv")).alias("total"))
            .where(100 * F.col("common") >= PERCENT * (F.col("total") - F.col("common"))).select("u", "v"))


def _labelled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows with ``doc`` and the component it has so far."""
    return (rows.join(comp, rows.doc == comp.node, "left")
            .withColumn("comp", F.coalesce("comp", "doc")).drop("node"))


def first_pairs(keys: DataFrame) -> DataFrame:
    """(u, v): each class that shares a bucket with the best centre among its
    buckets (itself, if it is)."""
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    keys = keys.join(shared, "key").select("key", "doc", "n")
    degree = keys.groupBy("doc").agg(F.sum("n").alias("degree"))
    rank = F.struct("degree", (-F.col("doc")).alias("doc"))
    centres = keys.join(degree, "doc").groupBy("key").agg(F.max(rank).alias("centre"))
    best = keys.join(centres, "key").groupBy("doc").agg(F.max("centre").alias("centre"))
    return best.select(F.col("doc").alias("u"), (-F.col("centre.doc")).alias("v"))


def mixed_blocks(keys: DataFrame, classes: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, dealt into blocks:
    ``few`` marks the copies that stand for members outside the bucket's
    largest component, the others are all members."""
    rows = _labelled(keys, comp)
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"))
    buckets = buckets.where(F.col("n") > F.col("top.n")).select(
        "key", F.col("top.comp").alias("top"), F.ceil(F.col("n") / ALL_BLOCK).cast("int").alias("alls"),
        F.ceil((F.col("n") - F.col("top.n")) / FEW_BLOCK).cast("int").alias("fews"))
    rows = rows.join(buckets, "key")
    deal = lambda n: F.pmod(F.xxhash64("doc", "key"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    few = rows.where(F.col("comp") != F.col("top")).withColumns(
        {"few": F.lit(True), "fb": deal("fews"), "ab": each("alls")})
    every = rows.withColumns({"few": F.lit(False), "ab": deal("alls"), "fb": each("fews")})
    both = few.unionByName(every).select("key", "fb", "ab", "few", "doc", "comp", "i", "j")
    return both.join(classes.select("doc", "halves", "bits"), "doc")


def _by_block(batches: Iterator[pa.RecordBatch], each) -> Iterator[pa.RecordBatch]:
    """``each(table, block numbers)`` over whole blocks of rows that are sorted
    by block; a block may span batches."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        rest = t if rest is None else pa.concat_tables([rest, t])
        block = np.column_stack([rest.column(c).to_numpy() for c in ("key", "fb", "ab")])
        last = int(np.flatnonzero((block != block[-1]).any(axis=1)).max(initial=-1)) + 1
        if last:
            yield from each(rest.slice(0, last).combine_chunks(), block[:last])
            rest = rest.slice(last).combine_chunks()
    if rest is not None and rest.num_rows:
        block = np.column_stack([rest.column(c).to_numpy() for c in ("key", "fb", "ab")])
        yield from each(rest.combine_chunks(), block)


def _column(t: pa.Table, name: str):
    return t.column(name).combine_chunks()


def _plausible(t: pa.Table, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (few, other) of the pairs of different components that meet
    here first and agree in enough minhashes, some at a time."""
    comp, i, j = (_column(t, c).to_numpy() for c in ("comp", "i", "j"))
    few = _column(t, "few").to_numpy(zero_copy_only=False)
    halves = _column(t, "halves").flatten().to_numpy().reshape(len(comp), 2 * SKETCHES)
    bits = np.frombuffer(b"".join(_column(t, "bits").to_pylist()), np.uint8).reshape(len(comp), -1)
    number = np.cumsum(np.concatenate(([False], (block[1:] != block[:-1]).any(axis=1))))
    left, right = np.flatnonzero(few), np.flatnonzero(~few)
    lo, hi = np.searchsorted(number[right], number[left]), np.searchsorted(number[right], number[left], "right")
    ends = np.cumsum(hi - lo)
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
        n = (hi - lo)[at:to]
        u = np.repeat(left[at:to], n)
        v = right[np.repeat(lo[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        apart = comp[u] != comp[v]
        u, v = u[apart], v[apart]
        for half, place in ((slice(0, SKETCHES), i), (slice(SKETCHES, None), j - SKETCHES)):
            first = np.argmax(halves[u, half] == halves[v, half], axis=1) == place[u]
            u, v = u[first], v[first]
        close = (bits[u] == bits[v]).sum(axis=1) >= AGREE
        yield u[close], v[close]
        at = to


_BLOCK_ROW = ["key", "fb", "ab", "few", "doc", "comp", "i", "j"]


def _wanted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that are in some plausible pair of their block."""
    def each(t, block):
        flags = np.zeros(t.num_rows, bool)
        for u, v in _plausible(t, block):
            flags[u] = flags[v] = True
        if flags.any():
            yield from t.select(_BLOCK_ROW).filter(pa.array(flags)).to_batches()
    return _by_block(batches, each)


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plausible pairs whose full sets are similar enough.  Components that
    a block has linked are one from there on, so their other pairs are left."""
    def each(t, block):
        doc, comp = _column(t, "doc").to_numpy(), _column(t, "comp").to_numpy()
        items = _column(t, "items")
        start, values = items.offsets.to_numpy(), items.values.to_numpy()
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        links = []
        for us, vs in _plausible(t, block):
            for u, v in zip(us.tolist(), vs.tolist()):
                a, b = top(int(comp[u])), top(int(comp[v]))
                if a != b:
                    x, y = values[start[u]:start[u + 1]], values[start[v]:start[v + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * common >= PERCENT * (len(x) + len(y) - common):
                        up[a] = b
                        links.append((int(max(doc[u], doc[v])), int(min(doc[u], doc[v]))))
        if links:
            u, v = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
    return _by_block(batches, each)


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "fb", "ab").sortWithinPartitions("key", "fb", "ab")


def link_classes(classes: DataFrame, docs: DataFrame, ws: Workspace) -> DataFrame:
    """node, comp over the classes of equal sets (see ``components``)."""
    keys = table_keys(ws.write(shared_halves(classes.select("doc", "halves")), "halves"))
    first = ws.write(first_pairs(keys), "first")    # one row for each class that shares a bucket
    members = first.select(F.col("u").alias("doc"))
    texts = docs.join(members, docs[ROW] == members.doc, "left_semi")
    sets = ws.write(texts.mapInArrow(_set_batches, "doc long, items array<long>"), "sets")
    links = ws.write(confirmed(first.where("u <> v"), sets), "links")
    comp = components(links, ws, "comp-a")

    # only classes that share a bucket have rows in several components
    blocks = mixed_blocks(keys.join(members, "doc", "left_semi"), classes, comp)
    wanted = _in_blocks(blocks).mapInArrow(
        _wanted_batches, "key long, fb int, ab int, few boolean, doc long, comp long, i byte, j byte")
    wanted = ws.write(wanted, "wanted")
    full = wanted.join(classes.select("doc", "halves", "bits"), "doc").join(sets, "doc")
    more = ws.write(_in_blocks(full).mapInArrow(_link_batches, "u long, v long"), "links-more")
    ws.drop("halves", "first", "sets", "wanted")
    return components(links.unionByName(more), ws, "comp-b")


def _components(rows: DataFrame, ws: Workspace) -> DataFrame:
    """ROW, doc_id, n_shingles and ``best``: (no id?, doc_id, row) of the first
    document of the component; null for an empty set.  ``rows``: ROW, doc_id, text."""
    sig = ws.write(signatures(rows), "signatures")
    narrow = sig.select(ROW, "doc_id", "n_shingles", "s1", "s2")
    me = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col(ROW).alias("row"))
    best = narrow.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min(me).alias("best"), F.min(ROW).alias("doc"))
    best = ws.write(best, "best")
    # a class is named by one of its rows, whose sketches stand for all
    classes = ws.write(sig.join(best.select("doc"), sig[ROW] == best.doc).select("doc", "halves", "bits"), "classes")
    comp = ws.write(link_classes(classes, rows, ws), "comp")
    nodes = comp.unionByName(comp.select(F.col("comp").alias("node"), "comp").distinct())
    least = nodes.join(best, nodes.node == best.doc).groupBy("comp").agg(F.min("best").alias("least"))
    named = ws.write(nodes.join(ws.write(least, "least"), "comp").select("node", "least"), "named")
    ids = (best.join(named, best.doc == named.node, "left")
           .select("n_shingles", "s1", "s2", F.coalesce("least", "best").alias("best")))
    found = narrow.join(ws.write(ids, "ids"), ["n_shingles", "s1", "s2"], "left").select(ROW, "doc_id", "n_shingles", "best")
    found = ws.write(found, "found")
    ws.drop("signatures", "best", "classes", "comp", "least", "named", "ids")
    return found


def _plain() -> list:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]


def near_duplicates(docs: DataFrame, ws: Workspace) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    rows = keyed(docs.select(_plain()), ws)
    found = _components(rows.where(F.col("doc_id").isNotNull()), ws)
    nameless = rows.where(F.col("doc_id").isNull()).mapInArrow(
        _size_batches, "n_shingles long").select(F.lit(None).cast("long").alias("doc_id"), "n_shingles",
                                                 F.lit(None).cast("long").alias("component_id"))
    every = found.select("doc_id", "n_shingles", F.coalesce("best.id", "doc_id").alias("component_id")).unionByName(nameless)
    return every.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, ws: Workspace) -> DataFrame:
    """One document of each component, with all columns of the input: that of
    the smallest ``doc_id`` (a row without one only if all are), the first row
    among equals.  Rows without an id take part; documents without words stay."""
    rows = keyed(docs, ws)
    found = _components(rows.select(ROW, *_plain()), ws)
    gone = found.where(F.col("best.row") != F.col(ROW)).select(ROW)
    return rows.join(gone, ROW, "left_anti").drop(ROW)
