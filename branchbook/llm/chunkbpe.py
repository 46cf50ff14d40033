"""Byte-level BPE ids of whole texts, chunk by chunk (used by operator 13).

The tokenizer library splits a text with a fixed pattern before it merges
bytes.  Some of its cuts can be seen from two bytes:

* before a blank that a visible character follows (a word takes at most the
  last blank of a run of white space);
* between a letter (ASCII or U+00C0-U+017F) and an ASCII mark;
* around an ASCII control space that a visible ASCII character follows, and
  between a visible ASCII character and a control space.

So a text is cut there, each chunk is encoded once per worker by the library
itself, and remembered.  A chunk that follows a blank is written without it; any
other one starts with ``NO_BLANK``.  Neither ``CUT`` nor ``NO_BLANK`` occurs in
UTF-8.  Blanks before characters whose first byte may begin a white-space
character (U+0085, U+00A0, U+1680, U+2000-U+205F, U+3000) are no cuts.  A text
that may hold a special token (``<|``) is encoded whole, as it is.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

CUT, NO_BLANK = b"\xff", b"\xfe"
#: Chunks remembered in each of two generations.
REMEMBERED = 200_000

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xE0] = True
_VISIBLE[0xE4:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK[48:58] = False
_MARK &= ~_LETTER
_GRAPH = np.zeros(256, bool)
_GRAPH[0x21:0x7F] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[9:14] = True


def _inner_cuts(b: np.ndarray) -> np.ndarray:
    """Places (index of the byte after the cut) where a chunk without a blank begins."""
    x, y = b[:-1], b[1:]
    # second byte of U+00C0-U+017F, but for the signs U+00D7 and U+00F7
    latin = np.zeros(len(b), bool)
    latin[1:] = (x >= 0xC3) & (x <= 0xC5) & ~((x == 0xC3) & ((y == 0x97) | (y == 0xB7)))
    cut = (_LETTER[x] | latin[:-1]) & _MARK[y]
    cut |= _GRAPH[x] & _CONTROL[y]
    last = _CONTROL[x] & _GRAPH[y]
    cut |= last
    cut[:-1] |= last[1:]
    return np.flatnonzero(cut) + 1


def cut_chunks(docs: list[bytes]) -> tuple[list[bytes], list[int]]:
    """All chunks of the documents, and where each document's chunks end."""
    b = np.frombuffer(NO_BLANK + (CUT + NO_BLANK).join(docs), np.uint8).copy()
    blank = np.flatnonzero((b[:-1] == 32) & _VISIBLE[b[1:]])
    inner = _inner_cuts(b)
    b[blank] = CUT[0]
    marks = np.tile(np.array([CUT[0], NO_BLANK[0]], np.uint8), len(inner))
    chunks = np.insert(b, np.repeat(inner, 2), marks).tobytes().split(CUT)
    ends = np.cumsum([len(d) + 2 for d in docs]) - 1          # where a document's bytes end in ``b``
    cuts = np.searchsorted(blank, ends) + np.searchsorted(inner, ends) + np.arange(1, len(docs) + 1)
    return chunks, cuts.tolist()


class ChunkEncoder:
    """Ids (little-endian unsigned 32-bit) of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # many one-word chunks at a time: each after a blank, or each on a line
        self.blanks, self.lines = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.blanks.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "merged_with_next"), level])
        self.lines.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "isolated"), level])
        vocab = self.tokenizer.get_vocab()
        self.after_blank = np.zeros(max(vocab.values()) + 1, bool)       # tokens that start with a blank
        self.after_blank[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self.line = vocab["\u010a"]
        self.now: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn_words(self, chunks: list[bytes], words: list[str], line: bool) -> None:
        parts = range(0, len(chunks), 2000)
        if line:
            found = self.lines.encode_batch_fast(["".join([w + "\n" for w in words[k:k + 2000]]) for k in parts],
                                                 add_special_tokens=False)
        else:
            found = self.blanks.encode_batch_fast([" " + " ".join(words[k:k + 2000]) for k in parts],
                                                  add_special_tokens=False)
        for k, e in zip(parts, found):
            ids = np.array(e.ids, "<u4")
            data = ids.tobytes()
            if line:
                last = np.flatnonzero(ids == self.line)
                first = np.concatenate(([0], last[:-1] + 1))
            else:
                first = np.flatnonzero(self.after_blank[ids])
                last = np.append(first[1:], len(ids))
            for c, x, y in zip(chunks[k:k + 2000], (4 * first).tolist(), (4 * last).tolist()):
                self.now[c] = data[x:y]

    def _learn(self, missing: list[bytes]) -> None:
        words: tuple[list, list] = ([], [])
        lines: tuple[list, list] = ([], [])
        other: tuple[list, list] = ([], [])
        for c in missing:
            ids = self.old.get(c)
            if ids is not None:
                self.now[c] = ids
                continue
            alone = c[:1] == NO_BLANK
            t = (c[1:] if alone else c).decode("utf-8", "replace")
            to = (lines if alone else words) if t.isalpha() else other
            to[0].append(c)
            to[1].append(t if alone or to is words else " " + t)
        self._learn_words(*words, False)
        self._learn_words(*lines, True)
        for c, e in zip(other[0], self.tokenizer.encode_batch_fast(other[1], add_special_tokens=False)):
            self.now[c] = np.array(e.ids, "<u4").tobytes()

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids,
                        "<u4").tobytes()

    def encode(self, docs: list[bytes]) -> list[bytes]:
        special = {k: self._whole(d) for k, d in enumerate(docs) if b"<|" in d}
        chunks, ends = cut_chunks([b"" if k in special else d for k, d in enumerate(docs)])
        if len(self.now) > REMEMBERED:
            self.now, self.old = {}, self.now
        self._learn(list(set(chunks) - self.now.keys()))
        found = list(map(self.now.__getitem__, chunks))
        return [special[k] if k in special else b"".join(found[x:y]) for k, (x, y) in enumerate(zip([0, *ends], ends))]


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder; it outlives a task (this function is pickled by
    name, so all tasks of a worker share the module's cache)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(path)
