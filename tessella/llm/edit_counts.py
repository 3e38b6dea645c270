"""Edit-aware token counts: a segment tree over each document's pre-tokens, of which an edit touches a few leaves."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import chunks, flat
from .tokens import BYTE_BPE, Encoder, encoder

#: Personal data that the query's edits replace: mail addresses, then runs of digits.
REDACTIONS = ((re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"), "[mail]"), (re.compile(rb"[0-9]+"), "#"))
_EDITS = "array<struct<start:long,stop:long,replacement:string>>"


class CountTree:
    """Sums of bytes and tokens over the leaves of one text.

    A leaf is a stretch that encodes on its own. An edit joins the leaves it touches, and one more on either side
    as context, into one leaf; it takes in further neighbours until both its ends are places where the tokenizer
    always starts a new piece. Only that stretch is encoded again, its pieces become the leaves in its place, so
    that leaves stay short however many edits follow, and the sums above it are renewed.
    """

    def __init__(self, raw: bytes, enc: Encoder, starts: np.ndarray, tokens: np.ndarray):
        self.enc, self.raw, self.changed, self.encoded = enc, raw, {}, 0
        self.starts, self.n = starts, len(starts)
        self.size = 1 << max(1, self.n).bit_length()
        self.bytes, self.tokens = (np.zeros(2 * self.size, np.int64) for _ in range(2))
        self.bytes[self.size:self.size + self.n] = np.diff(np.append(starts, len(raw)))
        self.tokens[self.size:self.size + self.n] = tokens
        for tree in (self.bytes, self.tokens):
            at = self.size
            while at > 1:
                tree[at // 2:at] = tree[at:2 * at].reshape(-1, 2).sum(1)
                at //= 2

    @property
    def n_bytes(self) -> int:
        return int(self.bytes[1])

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def leaf(self, k: int) -> bytes:
        if k in self.changed:
            return self.changed[k]
        return self.raw[self.starts[k]:self.starts[k + 1] if k + 1 < self.n else len(self.raw)]

    def text(self) -> bytes:
        out, at = [], 0
        for k in sorted(self.changed):
            out += [self.raw[at:self.starts[k]], self.changed[k]]
            at = self.starts[k + 1] if k + 1 < self.n else len(self.raw)
        return b"".join([*out, self.raw[at:]])

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a byte, and the byte's place in it; the last leaf with any text for the end."""
        position, node = min(position, max(self.n_bytes - 1, 0)), 1
        while node < self.size:
            node *= 2
            if position >= self.bytes[node]:
                position -= int(self.bytes[node])
                node += 1
        return node - self.size, position

    def _beside(self, k: int, step: int) -> int:
        """The next leaf with text in a direction, or -1."""
        k += step
        while 0 <= k < self.n and not self.bytes[self.size + k]:
            k += step
        return k if 0 <= k < self.n else -1

    def _cut_between(self, left: bytes, right: bytes) -> bool:
        both = np.frombuffer(left[-2:] + right[:2], np.uint8)
        return len(left[-2:]) in self.enc.cuts(both, np.array([0, len(both)]))

    def edit(self, start: int, stop: int, replacement: bytes) -> None:
        """Replace the bytes from ``start`` to ``stop`` of the present text."""
        stop = min(max(stop, start), self.n_bytes)
        start = min(start, stop)
        if not self.n:
            self.n, self.starts = 1, np.zeros(1, np.int64)
            self.changed[0] = b""
        if self.n_bytes:
            a, off = self.find(start)
            z, _ = self.find(max(start, stop - 1))
            begin = start - off if start < self.n_bytes else start - len(self.leaf(a))
        else:
            a = z = begin = 0
        if (k := self._beside(a, -1)) >= 0:  # context on either side
            a, begin = k, begin - len(self.leaf(k))
        if (k := self._beside(z, 1)) >= 0:
            z = k
        old = b"".join(self.leaf(k) for k in range(a, z + 1))
        new = old[:start - begin] + replacement + old[stop - begin:]
        while (k := self._beside(a, -1)) >= 0 and not self._cut_between(self.leaf(k), new):
            a, new = k, self.leaf(k) + new
        while (k := self._beside(z, 1)) >= 0 and not self._cut_between(new, self.leaf(k)):
            z, new = k, new + self.leaf(k)
        self.encoded += len(new)
        buf, room = np.frombuffer(new, np.uint8), z + 1 - a
        whole = b"<|" in new
        starts = np.zeros(min(len(new), 1), np.int64) if whole else self.enc.cuts(buf, np.array([0, len(new)]))
        counts = self.enc.piece_counts(buf, starts, whole)
        first = np.minimum(np.arange(len(starts)), room - 1)  # pieces beyond the leaves go to the last one
        ends = np.append(starts[1:], len(new))
        for k in range(room):
            own = (starts[k], ends[k] if k < room - 1 else len(new)) if k < len(starts) else (0, 0)
            self.changed[a + k] = new[own[0]:own[1]]
        for tree, v in ((self.bytes, ends - starts), (self.tokens, counts)):
            tree[self.size + a:self.size + z + 1] = np.bincount(first, v, room).astype(np.int64)
        lo, hi = (self.size + a) // 2, (self.size + z) // 2
        while lo:
            for tree in (self.bytes, self.tokens):
                tree[lo:hi + 1] = tree[2 * lo:2 * hi + 2].reshape(-1, 2).sum(1)
            lo, hi = lo // 2, hi // 2


def trees(texts: pa.Array, enc: Encoder) -> Iterator[CountTree]:
    """The tree of each text; pre-token counts come from the encoder's cache of distinct pieces."""
    buf, off = flat(texts)
    starts = enc.cuts(buf, off) if len(buf) else np.zeros(0, np.int64)
    counts = enc.piece_counts(buf, starts)
    at = np.searchsorted(starts, off)
    for row in range(len(texts)):
        raw, own = buf[off[row]:off[row + 1]].tobytes(), slice(at[row], at[row + 1])
        if b"<|" in raw:  # may spell a special token, which no cut may divide
            yield CountTree(raw, enc, np.zeros(1, np.int64), enc.piece_counts(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64), True))
        else:
            yield CountTree(raw, enc, starts[own] - off[row], counts[own])


def redaction_edits(raw: bytes) -> list[tuple[int, int, str]]:
    """Edits that hide personal data, from the end of the text to its start, so that earlier places stay right."""
    found: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []
    for pattern, to in REDACTIONS:
        for m in pattern.finditer(raw):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                found.append((m.start(), m.end(), to))
        taken = [(a, b) for a, b, _ in found]
    return sorted(found, reverse=True)


def with_redactions(docs: DataFrame) -> DataFrame:
    """``docs`` with a column edits (byte ranges of the text and what replaces them), in place of one of that name."""
    names = [c for c in docs.columns if c.lower() != "edits"]
    kept = docs.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("replacement", pa.string())]))
        for chunk in chunks(batches):
            edits = [[dict(zip(("start", "stop", "replacement"), e, strict=True)) for e in redaction_edits((t or "").encode())]
                     for t in chunk.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(edits, kind)], [*names, "edits"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *T.StructType.fromDDL(f"edits {_EDITS}").fields]))


def count_edited(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """doc_id, n_before, n_tokens, n_edits, n_bytes, encoded_bytes and the edited text of every row of ``doc_id, text, edits``.

    Edits apply in turn, each to the text that the one before left; ranges beyond the text are cut to it, null
    edits are none, a null replacement deletes. n_tokens equals a full encoding of the edited text. A text that
    has or gets "<|" is encoded whole, since it may spell a special token. Null text is empty. Other columns are
    ignored; an empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("edits").cast(_EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for chunk in chunks(batches):
            out = []
            for tree, edits in zip(trees(chunk.column("text"), enc), chunk.column("edits").to_pylist(), strict=True):
                before = tree.n_tokens
                edits = [e for e in edits or [] if e is not None]
                for e in edits:
                    tree.edit(max(e["start"] or 0, 0), e["stop"] or 0, (e["replacement"] or "").encode())
                text, n = tree.text(), tree.n_tokens
                if edits and b"<|" in text:
                    n = len(enc.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
                out.append((before, n, len(edits), len(text), tree.encoded, text.decode("utf-8", "replace")))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.string())],
                ["doc_id", "n_before", "n_tokens", "n_edits", "n_bytes", "encoded_bytes", "text"])

    return base.mapInArrow(run, "doc_id long, n_before long, n_tokens long, n_edits long, n_bytes long, encoded_bytes long, text string")
