"""Hierarchical language identification: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .linear import Rows, calibrate, fit_svm, margin, sigmoid, stack
from .text import LOWER, chunks, flat
from .workers import lean

UNKNOWN = "und"
DIMENSIONS = 1 << 13
STRETCH, CHUNK = 1 << 18, 1 << 19  # bytes that are counted at a time, and of the rows that are judged at a time
TRAIN_ROWS = 1600  # the bound of the labelled sample, over all languages
#: Families by ISO 639-1 code. A language that is not listed is a family of its own.
FAMILIES = {"germanic": ("en", "de", "nl", "sv", "da", "no", "is"), "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
            "slavic": ("ru", "pl", "cs", "uk", "sk", "bg", "sr", "hr", "sl"), "turkic": ("tr", "az", "kk", "uz"), "uralic": ("fi", "et", "hu")}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def features(col: pa.Array) -> Rows:
    """Byte trigrams and bytes of each whole lower-cased text with all but letters blanked, hashed, as square roots of shares."""
    buf, off = flat(col)
    n = len(off) - 1
    found = [_stretch(buf, off, a) for a in range(0, len(buf), STRETCH)] or [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    uniq, counts = found[0]
    if len(found) > 1:
        uniq, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in found])).astype(np.int64)
    at = np.searchsorted(uniq // DIMENSIONS, np.arange(n + 1))
    total = np.maximum(np.bincount(uniq // DIMENSIONS, counts, n), 1)
    return Rows(at, uniq % DIMENSIONS, np.sqrt(counts / total[uniq // DIMENSIONS]))


def _stretch(buf: np.ndarray, off: np.ndarray, a: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of ``STRETCH`` bytes of a column from ``a`` on as keys (row and feature), and how often each occurs."""
    size = min(STRETCH, len(buf) - a)
    keep = LOWER[buf[a:a + size + 2]]
    letter = ((keep >= 97) & (keep <= 122)) | (keep >= 128)
    x = np.where(letter, keep, 32).astype(np.int64)
    first = int(np.searchsorted(off, a, "right")) - 1
    row = np.repeat(np.arange(len(off) - 1), np.diff(np.clip(off, a, a + len(x)))) - first
    grams = min(size, len(x) - 2)
    if grams > 0:
        gram = (x[:grams] * 65537 + x[1:grams + 1] * 257 + x[2:grams + 2]) * 0x9E3779B1 >> 7
        inside = (row[:grams] == row[2:grams + 2]) & (letter[:grams] | letter[1:grams + 1] | letter[2:grams + 2])
        key = row[:grams][inside] * DIMENSIONS + 256 + gram[inside] % (DIMENSIONS - 256)
    else:
        key = np.zeros(0, np.int64)
    single = letter[:size]
    key = np.concatenate([key, row[:size][single] * DIMENSIONS + x[:size][single]])
    if (row[-1] + 1) * DIMENSIONS < 2 * len(key):
        counts = np.bincount(key)
        uniq = np.flatnonzero(counts)
        counts = counts[uniq]
    else:
        uniq, counts = np.unique(key, return_counts=True)
    return uniq + first * DIMENSIONS, counts


def has_letter(col: pa.Array) -> np.ndarray:
    """Whether each text has a Unicode letter; texts with an ASCII letter are not decoded."""
    buf, off = flat(col)
    ascii_letter = (LOWER[buf] >= 97) & (LOWER[buf] <= 122)
    total = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(ascii_letter, out=total[1:])
    out = total[off[1:]] > total[off[:-1]]
    for i in np.flatnonzero(~out & (off[1:] > off[:-1])):
        out[i] = any(ch.isalpha() for ch in buf[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


class Hierarchy:
    """One SVM per family against the rest, one per pair of languages of a family, each with a calibrated margin."""

    def __init__(self, x: Rows, langs: list[str]):
        self.langs = sorted(set(langs))
        lang = np.array([self.langs.index(v) for v in langs])
        names = [_FAMILY.get(v, v) for v in self.langs]
        self.families = sorted(set(names))
        self.family_of = np.array([self.families.index(v) for v in names])
        self.family_models = [self._fit(x, self.family_of[lang] == f) for f in range(len(self.families))] if len(self.families) > 1 else []
        self.members = [np.flatnonzero(self.family_of == f) for f in range(len(self.families))]
        self.pairs = {}
        for inside in self.members:
            for a, b in combinations(inside.tolist(), 2):
                rows = np.flatnonzero((lang == a) | (lang == b))
                self.pairs[a, b] = self._fit(x.take(rows), lang[rows] == a)

    @staticmethod
    def _fit(x: Rows, y: np.ndarray):
        y = y.astype(float)
        fold = np.arange(len(y)) % 4 == 3  # every fourth row only calibrates
        if fold.sum() < 8 or len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
            w = fit_svm(x, y, DIMENSIONS)
            return (w, *calibrate(margin(x, w), y))
        rows = np.flatnonzero(~fold)
        w = fit_svm(x.take(rows), y[rows], DIMENSIONS)
        rows = np.flatnonzero(fold)
        return (w, *calibrate(margin(x.take(rows), w), y[rows]))

    @staticmethod
    def _share(x: Rows, model) -> np.ndarray:
        w, slope, offset = model
        return sigmoid(slope * margin(x, w) + offset)

    def predict(self, x: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Language number and score of each row: the family's share times the language's mean share over its duels."""
        n = len(x)
        family_share = np.ones((n, 1))
        if self.family_models:
            family_share = np.stack([self._share(x, m) for m in self.family_models], 1) + 1e-9
            family_share /= family_share.sum(1, keepdims=True)
        family = family_share.argmax(1)
        lang, score = np.zeros(n, np.int64), np.zeros(n)
        for f, inside in enumerate(self.members):
            rows = np.flatnonzero(family == f)
            if not rows.size:
                continue
            part, place = x.take(rows), {k: i for i, k in enumerate(inside.tolist())}
            votes, share = np.zeros((len(rows), len(inside))), np.zeros((len(rows), len(inside)))
            for (a, b), model in self.pairs.items():
                if a in place:
                    p = self._share(part, model)
                    votes[:, place[a]] += p >= 0.5
                    votes[:, place[b]] += p < 0.5
                    share[:, place[a]] += p
                    share[:, place[b]] += 1 - p
            best = (votes + share / max(1, len(inside))).argmax(1)
            lang[rows] = inside[best]
            own = share[np.arange(len(rows)), best] / max(1, len(inside) - 1) if len(inside) > 1 else 1.0
            score[rows] = family_share[rows, f] * own
        return lang, np.clip(score, 0, 1)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of whole training texts and of a short piece of each, so that short texts are learned too."""
    for chunk in chunks(batches, limit=CHUNK):
        lang = chunk.column("lang")
        whole = chunk.column("text").to_pylist()
        cut = [t[len(t) // 3:len(t) // 3 + 20 + 17 * (len(t) % 13)] for t in whole]
        for texts in (whole, cut):
            x = features(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_pydict({
                "lang": lang, "col": pa.ListArray.from_arrays(pa.array(x.at, pa.int32()), pa.array(x.col.astype(np.int32))),
                "val": pa.ListArray.from_arrays(pa.array(x.at, pa.int32()), pa.array(x.val.astype(np.float32)))})


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS) -> Hierarchy | None:
    """Fit on ``text, lang`` rows without nulls: about ``max_rows`` of them at most, as many of each language, chosen by
    a hash of the row. None without any language."""
    rows = (labelled.where("text IS NOT NULL AND lang IS NOT NULL")
            .select("text", "lang", (F.shiftrightunsigned(F.xxhash64(*labelled.columns), 11) / F.lit(float(1 << 53))).alias("_u")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    each = max(1, max_rows // len(counts))
    share = F.create_map(*[v for k, n in sorted(counts.items()) for v in (F.lit(k), F.lit(min(1.0, each / n)))])
    got = (rows.where(F.col("_u") < share[F.col("lang")]).select("text", "lang").mapInArrow(lean(_sampled), "lang string, col array<int>, val array<float>")
           .limit(4 * max_rows + 64).toArrow().combine_chunks())
    if not got.num_rows:
        return None
    col, val = got.column("col").combine_chunks(), got.column("val").combine_chunks()
    at = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())]).astype(np.int64)
    x = Rows(at, col.flatten().to_numpy().astype(np.int64), val.flatten().to_numpy().astype(np.float64))
    langs = got.column("lang").to_pylist()
    order = np.random.default_rng(5).permutation(len(langs))
    return Hierarchy(stack([x.take(order)]), [langs[i] for i in order])


def identify(docs: DataFrame, model: Hierarchy | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1; or by other names) from the column ``text`` alone, in place of columns of these names.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. The whole
    text counts. Other columns pass through; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c.lower() not in names]
    kept = docs.select(*others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for chunk in chunks(batches, limit=CHUNK):
            col = chunk.column("text")
            lang, score = [UNKNOWN] * chunk.num_rows, np.zeros(chunk.num_rows)
            if m is not None:
                known = has_letter(col)
                best, share = m.predict(features(col))
                lang = [m.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score = np.where(known, share, 0.0)
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*others, *names])

    return kept.mapInArrow(lean(run), StructType([*kept.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no prediction learns from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
