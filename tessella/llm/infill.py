"""Fill-in-the-middle rewriting: a document is cut at two unit boundaries and its parts are put in another order.

Units are runs of ASCII letters and single other code points. The byte offsets where units end are an ordered set
with the containers of roaring bitmaps: offsets are grouped by their upper bits, and each group is kept as a sorted
array, as a bitmap or as runs, whichever is smallest. Running cardinalities of the containers find the one that
holds the k-th boundary, and a select inside it gives the cut.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import chunks, flat

BLOCK = 1 << 16  # offsets of a container
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW = 90, 20  # percentages of the third and the fourth draw
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_BIT_COUNT = np.array([bin(b).count("1") for b in range(256)], np.int64)


class ArrayContainer:
    """Sorted offsets."""

    def __init__(self, offsets: np.ndarray):
        self.offsets = offsets.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.offsets[k])


class BitmapContainer:
    """One bit per offset, with the number of bits before every byte."""

    def __init__(self, flags: np.ndarray):
        self.bits = np.packbits(flags, bitorder="little")
        self.before = np.cumsum(_BIT_COUNT[self.bits]) - _BIT_COUNT[self.bits]

    def select(self, k: int) -> int:
        byte = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[byte:byte + 1], bitorder="little"))
        return 8 * byte + int(inside[k - self.before[byte]])


class RunContainer:
    """Starts of runs of neighbouring offsets, with the number of offsets before every run."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.cumsum(lengths) - lengths

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + int(k - self.before[run])


def container(flags: np.ndarray, offsets: np.ndarray):
    """The smallest container: 2 bytes an offset, 4 a run, or an eighth of the block."""
    new = np.flatnonzero(np.diff(offsets, prepend=-2) != 1)
    array, runs, bitmap = 2 * len(offsets), 4 * len(new), (len(flags) + 7) // 8
    if runs < min(array, bitmap):
        return RunContainer(offsets[new], np.diff(new, append=len(offsets)))
    return ArrayContainer(offsets) if array <= bitmap else BitmapContainer(flags)


class BoundarySet:
    """The ascending byte offsets of a UTF-8 text where a unit may end, 0 included."""

    def __init__(self, data: np.ndarray):
        self.containers, self.base, self.before, self.size = [], [], [], 0
        for base in range(0, len(data) + 1, BLOCK):
            flags = _ends(data, base, min(base + BLOCK, len(data) + 1))
            offsets = np.flatnonzero(flags)
            if len(offsets):
                self.containers.append(container(flags, offsets))
                self.base.append(base)
                self.before.append(self.size)
                self.size += len(offsets)

    def __len__(self) -> int:
        return self.size

    def select(self, k: int) -> int:
        """The offset with ``k`` boundaries before it."""
        at = bisect_right(self.before, k) - 1
        return self.base[at] + self.containers[at].select(k - self.before[at])


def _ends(data: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which offsets from ``a`` up to ``b`` lie neither inside a code point nor between two letters."""
    flags = np.ones(b - a, bool)
    first, last = max(a, 1), min(b, len(data))  # offsets with a byte on both sides
    if first < last:
        letter = _LETTER[data[first - 1:last]]
        flags[first - a:last - a] = (data[first:last] & 0xC0 != 0x80) & ~(letter[1:] & letter[:-1])
    return flags


def code_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero(data[i:i + (1 << 20)] & 0xC0 != 0x80)) for i in range(0, len(data), 1 << 20))


def draws(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first groups of the sha256 of seed, colon and id (nothing for null)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for batch in batches:
        for b in chunks([batch]):
            buf, off = flat(b.column("text"))
            h1, h2, plain, spm = (b.column(c).to_pylist() for c in ("h1", "h2", "plain", "spm"))
            count, form, before, inside, out = [], [], [], [], []
            for i in range(b.num_rows):
                data = buf[off[i]:off[i + 1]]
                ends, text = BoundarySet(data), data.tobytes()
                count.append(len(ends) - 1)
                if plain[i] or not text or any(x in text for x in marks):
                    form.append(PLAIN)
                    before.append(None)
                    inside.append(None)
                    out.append(text)
                    continue
                low, high = (ends.select(k) for k in sorted((h1[i] % len(ends), h2[i] % len(ends))))
                form.append(SPM if spm[i] else PSM)
                before.append(code_points(data[:low]))
                inside.append(code_points(data[low:high]))
                head, mid, tail = text[:low], text[low:high], text[high:]
                out.append(b"".join((s, tail, p, head, m, mid) if spm[i] else (p, head, s, tail, m, mid)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n": pa.array(count, pa.int64()), "form": pa.array(form, pa.string()),
                "prefix_chars": pa.array(before, pa.int64()), "middle_chars": pa.array(inside, pa.int64()),
                "output": pa.array(out, pa.binary()).cast(pa.string())})


def fill_in_middle(docs: DataFrame, seed: str = "1") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every row of ``docs`` (doc_id, text).

    Prefix and middle end after as many units as the first two draws of the document say. An empty text (null is
    empty), one that holds a marker, and a tenth of all others stay plain, with null lengths. Equal rows give equal
    rows; a null doc_id draws from the seed alone. Other columns are ignored; no rows give no rows.
    """
    h = draws(F.col("doc_id"), seed)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), h[0].alias("h1"), h[1].alias("h2"),
                       (h[2] % 100 >= PLAIN_FROM).alias("plain"), (h[3] % 100 < SPM_BELOW).alias("spm"))
    return rows.mapInArrow(_rewrite, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text a rewritten document came from. The first two markers delimit all parts, because no part holds one
    and no marker ends as a marker begins."""
    out = F.col(output)

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        a, b = F.locate(second, out), F.locate(MIDDLE, out)
        return (F.substring(out, F.lit(len(first) + 1), a - len(first) - 1), F.substring(out, a + len(second), b - a - len(second)),
                F.substring(out, b + len(MIDDLE), F.length(out)))

    head, tail, mid = parts(PREFIX, SUFFIX)
    tail2, head2, mid2 = parts(SUFFIX, PREFIX)
    return F.when(F.col(form) == PSM, F.concat(head, mid, tail)).when(F.col(form) == SPM, F.concat(head2, mid2, tail2)).otherwise(out)
