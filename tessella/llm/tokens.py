"""Exact, cached encoding of whole columns with the public tokenizer files.

A text is cut where both tokenizers always start a new pre-token, every distinct piece is encoded once per
task, and ids are put together by array gathers. Texts that spell a special token are encoded as they are.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import public_tokenizers
import pyarrow as pa

from .text import LOWER, flat, hash_spans

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
_TABLE_BITS = 22
_CACHE_ENTRIES = 1_600_000
_OTHER, _ALNUM, _MARK, _QUOTE, _BLANK, _BREAK = range(6)  # beyond ASCII or control, then the ASCII kinds
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _MARK
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _ALNUM
_KIND[39] = _QUOTE
_KIND[32] = _BLANK
_KIND[[9, 10, 11, 12, 13]] = _BREAK


class Encoder:
    """Encodes Arrow string columns. ``path`` is a tokenizer file; ``blanks_split`` says that white space never
    belongs to a token, so that every blank is a place to cut; ``lower`` that case makes no difference."""

    def __init__(self, path: str, blanks_split: bool, lower: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.blanks_split = blanks_split
        self.lower = lower
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros(1 << _TABLE_BITS, np.uint64)  # open addressing; 0 is free
        self.slot = np.zeros(1 << _TABLE_BITS, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int64)

    def encode_list(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum())), n

    def cuts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Starts of the pieces that can be encoded on their own."""
        kind = _KIND[buf]
        here = np.zeros(len(buf), bool)
        prev, cur = kind[:-1], kind[1:]
        # a letter or digit next to an ASCII mark, in either order; an apostrophe may join a suffix to it
        here[1:] = ((cur == _MARK) | (cur == _QUOTE)) & (prev == _ALNUM) | (cur == _ALNUM) & (prev == _MARK)
        if self.blanks_split:
            here |= kind >= _BLANK
        else:
            graphic = (kind != _OTHER) & (kind < _BLANK)
            here[1:] |= (cur >= _BLANK) & graphic[:-1]  # white space begins
            here[1:] |= (prev == _BREAK) & graphic[1:]  # a line break ends
            last = (kind[:-1] >= _BLANK) & graphic[1:]  # the last white space of a run stands apart or goes with the next word
            inner = off[(off > 0) & (off < len(buf))]
            last[inner - 1] = False  # a row's end has no next word
            here[:-1] |= last
        here[off[:-1][off[:-1] < off[1:]]] = True
        return np.flatnonzero(here)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after another, and the number of ids of each row."""
        buf, off = flat(col)
        n_rows = len(off) - 1
        if self.lower:
            buf = LOWER[buf]
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n_rows, np.int64)
        starts = self.cuts(buf, off)
        ends = np.append(starts[1:], len(buf))
        rows = np.searchsorted(off, starts, "right") - 1
        special = np.flatnonzero((buf[:-1] == 60) & (buf[1:] == 124))
        plain = None
        if special.size:
            odd = np.unique(np.searchsorted(off, special, "right") - 1)
            plain = np.isin(rows, odd)
            starts, ends, rows = starts[~plain], ends[~plain], rows[~plain]
        slots = self._slots(buf, hash_spans(buf, starts, ends), starts, ends)
        lens = self.len[slots]
        counts = np.bincount(rows, lens, n_rows).astype(np.int64)
        before = np.cumsum(lens) - lens
        ids = self.ids[np.repeat(self.at[slots] - before, lens) + np.arange(int(lens.sum()))] if len(lens) else np.zeros(0, np.uint32)
        if plain is None:
            return ids, counts
        own, n = self.encode_list([col[int(i)].as_py() for i in odd])
        parts, begin, k = [], np.cumsum(counts) - counts, np.cumsum(n) - n
        last = 0
        for i, at, m in zip(odd, k, n, strict=True):
            parts += [ids[last:begin[i]], own[at:at + m]]
            last = begin[i]
            counts[i] = m
        return np.concatenate([*parts, ids[last:]]), counts

    def piece_counts(self, buf: np.ndarray, starts: np.ndarray, whole: bool = False) -> np.ndarray:
        """How many ids each piece of one text has; ``whole``: the text is one piece and may spell a special token."""
        if not len(starts):
            return np.zeros(0, np.int64)
        if whole:
            return self.encode_list([buf.tobytes().decode("utf-8", "replace")])[1]
        if self.lower:
            buf = LOWER[buf]
        ends = np.append(starts[1:], len(buf))
        slots = self._slots(buf, hash_spans(buf, starts, ends), starts, ends)
        return self.len[slots]

    def _slots(self, buf, hashes, starts, ends) -> np.ndarray:
        """The cache entry of every piece; new pieces are encoded once and entered."""
        if len(self.len) > _CACHE_ENTRIES:
            self.reset()
        out, missing = self._find(hashes)
        if missing.size:
            uniq, first = np.unique(hashes[missing], return_index=True)
            raw, first = memoryview(buf), missing[first]
            ids, n = self.encode_list([bytes(raw[a:b]).decode("utf-8", "replace")
                                       for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            self._enter(uniq, len(self.len) + np.arange(len(uniq), dtype=np.int32))
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
            self.len = np.concatenate([self.len, n])
            self.ids = np.concatenate([self.ids, ids])
            out[missing] = self._find(hashes[missing])[0]
        return out

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        out = self.slot[at]
        key = self.keys[at]
        open_ = np.flatnonzero(key != hashes)
        missing = []
        while open_.size:
            free = self.keys[at[open_]] == 0
            missing.append(open_[free])
            open_ = open_[~free]
            at[open_] = (at[open_] + 1) & ((1 << _TABLE_BITS) - 1)
            hit = self.keys[at[open_]] == hashes[open_]
            out[open_[hit]] = self.slot[at[open_[hit]]]
            open_ = open_[~hit]
        return out, np.concatenate(missing) if missing else np.zeros(0, np.int64)

    def _enter(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        at = (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        while hashes.size:
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]
            won = self.keys[at] == hashes
            self.slot[at[won]] = slots[won]
            hashes, slots, at = hashes[~won], slots[~won], (at[~won] + 1) & ((1 << _TABLE_BITS) - 1)


@functools.lru_cache(maxsize=4)
def encoder(name: str) -> Encoder:
    """The process-wide encoder of a tokenizer file given by name or by path."""
    path = name if os.path.sep in name else public_tokenizers.path(name)
    folds = os.path.basename(path).startswith("word_")
    return Encoder(path, folds, folds)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each row."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1
