"""Operator 5: substring deduplication with difference-cover anchors.

A window is ``WINDOW`` (20) consecutive words of one document.  Every word
covered by a window whose word sequence also starts earlier (in a document
with a smaller ``doc_id``, or earlier in the same document) is removed; all
windows are judged on the input.

``COVER`` = {0, 1, 3, 9} is a difference cover modulo ``PERIOD`` = 13: for any
two starts there is an offset below 13 at which both positions fall into the
cover.  So two equal 20-word windows share an *aligned* anchor, an 8-word
window (20 - 13 + 1) that starts at a cover position, and only 4/13 of the
positions are hashed and shuffled.  Anchors that occur twice are extended: the
20-word windows around them, and only those, are hashed whole and compared.

Hot passages: each task first combines equal anchors (windows) of its batch,
so that a passage of a third of all documents reaches the shuffle once a batch
and the rest of its occurrences, already known to be repeated, are spread by a
random key.  Exact copies of a text are settled by a digest and take no part
in the extension.  Candidate windows are compared by 96 bits of hash.

Rows meet again by a number of their own (``common.keyed``); a ``doc_id`` only
says which of two documents is the earlier one.

Defined results: null or empty text has 0 words and the digest of the empty
string; a row with a null ``doc_id`` loses nothing and is nobody's earlier
copy; rows that share a ``doc_id`` are documents each, and none of them is
earlier than another one (so they keep what they have in common).  Texts
shorter than a window lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchbook.llm.common import ROW, Words, Workspace, batch_rows, chunks, keyed, mix

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Rows in one Arrow batch of anchors or windows sent back to Spark.
OUT_ROWS = 100_000

_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _anchors(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the anchors of a list of documents."""
    at, h = w.windows(ANCHOR)
    keep = _IN_COVER[(at - np.repeat(w.first, w.n)[at]) % PERIOD]
    return at[keep], h[keep]


def _send(cols: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(cols[0]), OUT_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + OUT_ROWS]) for c in cols], names)      # masked: null


def _spread(key: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Keys to shuffle by: rows known to be repeats get a key of their own."""
    own = mix(np.arange(len(key), dtype=np.uint64) + mix(key))
    return np.where(again, own, key).view(np.int64)


def _texts(batch, *more: str) -> Iterator[list[tuple]]:
    rows = ((i, b"" if t is None else t, *x) for i, t, *x in batch_rows(batch, ROW, "text", *more))
    return chunks(rows, 1)


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, hashes = [], []
        for part in _texts(b):
            w = Words([r[1] for r in part])
            at, h = _anchors(w)
            ids.append(np.array([r[0] for r in part], np.int64)[w.doc_of_word()[at]])
            hashes.append(h)
        if not ids:
            continue
        doc, h = np.concatenate(ids), np.concatenate(hashes)
        _, first, inv, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        again = first[inv] != np.arange(len(h))     # all but the first of the batch
        yield from _send([_spread(h, again), h.view(np.int64), doc, (n[inv] > 1)], ["key", "hash", ROW, "known"])


def shared_anchors(docs: DataFrame) -> DataFrame:
    """Row number and the hashes of its anchors that occur at least twice."""
    rows = docs.mapInArrow(_anchor_batches, f"key long, hash long, {ROW} long, known boolean")
    n = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return (rows.withColumn("n", n).where(F.col("known") | (F.col("n") > 1))
            .groupBy(ROW).agg(F.collect_set("hash").alias("anchors")))


def later_copies(docs: DataFrame) -> DataFrame:
    """Row numbers of the documents whose whole text also stands in an earlier
    one.  The least doc_id of a digest is a map-side minimum; it meets the rows
    by (digest, doc_id), so a text with very many copies makes no hot key."""
    d = docs.select(ROW, "doc_id", F.unhex(F.md5("text")).alias("digest"))
    first = d.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    return d.where("digest IS NOT NULL").join(first, ["digest", "doc_id"], "left_anti").select(ROW, F.lit(True).alias("copy"))


def _runs(flags: np.ndarray) -> list[int]:
    """begin, end, begin, end, ... of the runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).tolist()


_STATE = (f"{ROW} long, doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, "
          "text string, starts array<int>")


def _extend_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles documents without shared anchors and later copies; the others
    get the runs of window starts that hold a shared anchor."""
    for b in batches:
        for part in _texts(b, "anchors", "copy", "doc_id"):
            w = Words([r[1] for r in part])
            at, h = _anchors(w)
            which = w.doc_of_word()[at]
            out = []
            for k, (row, text, anchors, copy, doc_id) in enumerate(part):
                n = int(w.n[k])
                if n < WINDOW or not (anchors or copy):
                    words = text.split()
                    out.append((row, doc_id, n, 0, _digest(b" ".join(words)), None, None, None))
                elif copy:
                    out.append((row, doc_id, n, n, _digest(b""), "", None, None))
                else:
                    lo, hi = np.searchsorted(which, [k, k + 1])
                    hit = at[lo:hi][np.isin(h[lo:hi], np.array(anchors, np.int64).view(np.uint64))] - w.first[k]
                    flags = np.zeros(n + 1, np.int64)       # +1 where a start begins to hold the anchor
                    np.add.at(flags, np.maximum(hit - (PERIOD - 1), 0), 1)
                    np.add.at(flags, hit + 1, -1)
                    runs = _runs(np.cumsum(flags)[:n - WINDOW + 1] > 0)
                    out.append((row, doc_id, n, None, None, None, text.decode("utf-8", "surrogatepass"), runs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                                                            pa.string(), pa.string(), pa.list_(pa.int32())))],
                [ROW, "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "text", "starts"])


def _in_runs(runs: list[int], n: int) -> np.ndarray:
    flags = np.zeros(n + 1, np.int8)
    flags[np.array(runs[::2], int)] = 1
    np.add.at(flags, np.array(runs[1::2], int), -1)
    return np.cumsum(flags)[:n] > 0


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidate windows.  Those that start earlier in the same row, or in a
    smaller doc_id of the batch, are already known to be repeats."""
    for b in batches:
        rows, ids, starts, hashes, more = [], [], [], [], []
        for part in _texts(b, "starts", "doc_id"):
            w = Words([r[1] for r in part])
            at, h = w.windows(WINDOW)
            take = np.concatenate([_in_runs(r[2] or [], int(n)) for r, n in zip(part, w.n)])[at]
            at = at[take]
            doc = w.doc_of_word()[at]
            rows.append(np.array([r[0] for r in part], np.int64)[doc])
            ids.append(np.array([r[3] for r in part], np.int64)[doc])
            starts.append(at - w.first[doc])
            hashes.append(h[take])
            more.append(w.second(WINDOW, at))
        if not ids:
            continue
        row, doc, start, h, h2 = map(np.concatenate, (rows, ids, starts, hashes, more))
        order = np.lexsort((start, row, doc, h2, h))
        row, doc, start, h, h2 = row[order], doc[order], start[order], h[order], h2[order]
        if len(h):
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])))
            again = doc != doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
            again[1:] |= ~new[1:] & (row[1:] == row[:-1])
            # known repeats go with their row and need no comparison
            key = np.where(again, row, h.view(np.int64))
            place = np.where(again, start, (h2 >> np.uint64(32) << np.uint64(32)).view(np.int64) | start)
            yield from _send([key, place, row, np.ma.masked_array(doc, again)], ["key", "place", ROW, "doc_id"])


def repeated_starts(pending: DataFrame) -> DataFrame:
    """Row number and the starts of its windows that also start earlier.  A
    window travels as four numbers: 64 bits of hash; 32 more and its start; its
    row; its document (null: a known repeat)."""
    rows = pending.select(ROW, "doc_id", "text", "starts").mapInArrow(
        _window_batches, f"key long, place long, {ROW} long, doc_id long").repartition("key")
    # the exchange by key is what the window needs: its second key is cut out after it
    rows = rows.withColumn("key2", F.expr("shiftright(place, 32)"))
    least = F.min("doc_id").over(Window.partitionBy("key", "key2"))
    return (rows.withColumn("least", least).where(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
            .groupBy(ROW).agg(F.collect_set(F.expr("cast(place & 4294967295L AS int)")).alias("removed")))


def _remove_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for row, doc_id, n, text, removed in batch_rows(b, ROW, "doc_id", "n_words", "text", "removed"):
            flags = np.zeros(n + 1, np.int64)
            at = np.array(removed or [], int)
            flags[at] += 1
            flags[at + WINDOW] -= 1
            gone = np.cumsum(flags)[:n] > 0
            kept = b" ".join(x for x, g in zip(text.split(), gone.tolist()) if not g)
            lost = int(gone.sum())
            out.append((row, doc_id, n, lost, _digest(kept), kept.decode("utf-8", "surrogatepass") if lost else None))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                                                            pa.string()))], _RESULT)


_RESULT = [ROW, "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]


def _judged(rows: DataFrame, ws: Workspace, last_use: str | None = None) -> DataFrame:
    """``_RESULT`` of every row.  ``rows``: ROW, doc_id, text.  ``last_use``: the
    step that nobody reads once the rows are settled or pending."""
    known = rows.where(F.col("doc_id").isNotNull())
    anchors = ws.write(shared_anchors(known), "anchors")
    joined = (rows.join(anchors, ROW, "left").join(later_copies(known), ROW, "left")
              .select(ROW, "doc_id", "text", "anchors", "copy"))
    state = ws.write(joined.mapInArrow(_extend_batches, _STATE), "state")
    ws.drop("anchors", *([last_use] if last_use else []))
    pending = state.where(F.col("text").isNotNull())
    removed = repeated_starts(pending)
    done = (pending.join(removed, ROW, "left").select(ROW, "doc_id", "n_words", "text", "removed")
            .mapInArrow(_remove_batches, f"{ROW} long, doc_id long, n_words long, n_removed long, "
                                         "kept_sha256 string, kept_text string"))
    return state.where(F.col("text").isNull()).select(_RESULT).unionByName(done)


def _plain() -> list:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]


def remove_repeats(docs: DataFrame, ws: Workspace) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and
    kept_text (the kept words joined by one space; null if none was removed)."""
    return _judged(keyed(docs.select(_plain()), ws, "texts"), ws, last_use="texts").drop(ROW)


def deduplicated(docs: DataFrame, ws: Workspace) -> DataFrame:
    """The documents without their repeated words (columns of the input; a
    text left without words goes)."""
    rows = keyed(docs, ws)
    found = _judged(rows.select(ROW, *_plain()), ws).where(F.col("n_removed") > 0)
    changed = ws.write(found.select(F.col(ROW).alias("__changed"), F.col("kept_text").alias("__kept")), "changed")
    joined = rows.join(changed, rows[ROW] == changed["__changed"], "left").where("__kept IS NULL OR __kept <> ''")
    new = {"text": F.coalesce("__kept", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__kept").isNotNull(), F.length("__kept")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType)
    return joined.withColumns(new).select(*[f"`{c}`" for c in docs.columns])
