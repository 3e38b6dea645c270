"""Quality and toxicity by co-training: a text view and a page-metadata view teach each other, then vote.

Both views start from a bounded sample of labelled documents. In each round every document is scored by both; the
documents of which one view is certain, by its calibration on labelled rows that trained neither, are handed to the
other, up to a documented share of the labelled training rows. Which of them is decided by a hash of the text over all
documents, so copies count once wherever they lie. At the end the calibrated margins are combined on the same spare
rows, and all documents are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..session import materialize
from .linear import Rows, calibrate, fit_logistic, margin, sigmoid, stack
from .text import ALNUM, LOWER, chunks, flat, hash_spans, word_spans
from .workers import lean

LABELLED_ROWS = 5000  # the bound of the labelled sample
ROUNDS = 2
CONFIDENCE = 0.98  # calibrated probability from which a view is certain of a class
EXCHANGE_SHARE = 0.02  # bound on the texts that a view hands to the other per round and class, as a share of the labelled training rows
TARGETS = ("quality", "toxic")
TEXT_DIMENSIONS = 1 << 17
META_DIMENSIONS = 1 << 9
_MIN_ROWS = 3  # a word counts for a model when this many training documents have it
_SIGMA = 3.5
_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _share_bin(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share as one of 16 bins that are fine near 0."""
    share = part / np.maximum(whole, 1)
    return np.clip(np.floor(4 * (np.log10(share + 1e-4) + 4)), 0, 15).astype(np.int64)


def views(batch: pa.RecordBatch) -> tuple[Rows, Rows]:
    """The text view (distinct hashed words of the whole text) and the metadata view (source, language, declared
    length and the page's layout: shares of capitals, marks, digits, breaks, bars, and repeated words)."""
    raw, off = flat(batch.column("text"))
    low = LOWER[raw]
    n = batch.num_rows
    starts, ends, rows = word_spans(low, off, ALNUM)
    h = hash_spans(low, starts, ends)
    key = np.unique(rows * TEXT_DIMENSIONS + (h >> np.uint64(20)).astype(np.int64) % TEXT_DIMENSIONS)
    at = np.searchsorted(key // TEXT_DIMENSIONS, np.arange(n + 1))
    text = Rows(at, key % TEXT_DIMENSIONS, np.ones(len(key)))

    def count(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[off[1:]] - total[off[:-1]]

    size = np.diff(off)
    words = np.bincount(rows, minlength=n)
    declared = batch.column("n_chars").cast(pa.float64(), safe=False).fill_null(0).to_numpy(zero_copy_only=False)
    marks = (raw > 32) & (raw < 127) & ~ALNUM[low]
    bins = [_share_bin(count((raw >= 65) & (raw <= 90)), size), _share_bin(count(marks), size),
            _share_bin(count((raw >= 48) & (raw <= 57)), size), _share_bin(count(raw == 10), size), _share_bin(count(raw == 124), size),
            _share_bin(words - np.diff(at), words), np.clip(np.log2(np.maximum(declared, 0) + 1), 0, 15).astype(np.int64),
            np.clip(np.log2(words + 1), 0, 15).astype(np.int64)]
    named = [_hashed(batch.column("source"), 64), _hashed(batch.column("lang"), 32)]
    cols = np.stack([*(16 * k + b for k, b in enumerate(bins)), 256 + named[0], 384 + named[1]], 1)
    meta = Rows(np.arange(n + 1) * cols.shape[1], cols.reshape(-1), np.ones(cols.size))
    return text, meta


def _hashed(col: pa.Array, size: int) -> np.ndarray:
    coded = col.cast(pa.string()).fill_null("").dictionary_encode()
    buf, off = flat(coded.dictionary)
    h = np.zeros(len(off) - 1, np.uint64)
    some = off[1:] > off[:-1]
    h[some] = hash_spans(buf, off[:-1][some], off[1:][some])
    return (h % np.uint64(size)).astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)]


def _pack(x: Rows) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(x.at, pa.int32()), pa.array(x.col.astype(np.int32)))


def _unpack(col) -> Rows:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    at = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    cols = col.flatten().to_numpy().astype(np.int64)
    return Rows(at, cols, np.ones(len(cols)))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        text, meta = views(chunk)
        yield pa.RecordBatch.from_pydict({"quality": chunk.column("quality"), "toxic": chunk.column("toxic"), "text": _pack(text), "meta": _pack(meta)})


def _limits(curve: tuple[float, float], confidence: float) -> tuple[float, float]:
    """Margins up to which (class 0) and from which (class 1) a calibrated view is certain; none where it tells nothing."""
    slope, shift = curve
    if slope <= 0:
        return -np.inf, np.inf
    odds = np.log(confidence / (1 - confidence))
    return (-odds - shift) / slope, (odds - shift) / slope


def _certain(shared, k: int):
    """Of a task's documents of which a view is certain, those of the ``k`` smallest text hashes, per target, view and class.

    The smallest of all tasks are the smallest of the whole table, however it is cut. Texts with several metadata
    are represented by the least.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (models, limits), best = shared.value, {}
        for chunk in chunks(batches):
            pair = views(chunk)
            key = np.array([xxhash.xxh3_64_intdigest(t or "") >> 1 for t in chunk.column("text").to_pylist()], np.int64)
            for target in TARGETS:
                for view in (0, 1):
                    m = margin(pair[view], models[target][view])
                    low, high = limits[target][view]
                    for label, sure in enumerate((m <= low, m >= high)):
                        held = best.setdefault((target, view, label), {})
                        at = np.flatnonzero(sure)
                        if len(held) == k:
                            at = at[key[at] <= max(held)]
                        # a text beyond the k smallest of this chunk cannot be among those of the task
                        at = at[key[at] <= np.unique(key[at])[:k][-1]] if len(at) else at
                        for i in at.tolist():
                            text, meta = (p.col[p.at[i]:p.at[i + 1]].astype(np.int32) for p in pair)
                            old = held.get(int(key[i]))
                            if old is None or meta.tolist() < old[1].tolist():
                                held[int(key[i])] = (text, meta)
                        for h in sorted(held)[k:]:
                            del held[h]
        for (target, view, label), held in best.items():
            if held:
                text, meta = zip(*held.values(), strict=True)
                n = len(held)
                yield pa.RecordBatch.from_pydict({
                    "target": [target] * n, "view": pa.array([view] * n, pa.int32()), "label": pa.array([label] * n, pa.int32()),
                    "hash": pa.array(list(held), pa.int64()), "text": pa.array(text, pa.list_(pa.int32())), "meta": pa.array(meta, pa.list_(pa.int32()))})
    return run


def pseudo_labels(base: DataFrame, models: dict, limits: dict, most: int) -> dict[tuple[str, int, int], pa.Table]:
    """Per target, view and class at most ``most`` different texts (hash, text, meta) of which the view is certain, over all documents."""
    shared = base.sparkSession.sparkContext.broadcast((models, limits))
    sure = materialize(base.mapInArrow(lean(_certain(shared, most)), "target string, view int, label int, hash long, text array<int>, meta array<int>"))
    once = sure.groupBy("target", "view", "label", "hash").agg(F.min(F.struct("meta", "text")).alias("r"))
    place = F.row_number().over(Window.partitionBy("target", "view", "label").orderBy("hash"))
    top = once.withColumn("_n", place).where(F.col("_n") <= most).orderBy("target", "view", "label", "hash").select("target", "view", "label", "hash", "r.text", "r.meta").toArrow()
    shared.destroy()
    return {(t, v, c): top.filter((pc.field("target") == t) & (pc.field("view") == v) & (pc.field("label") == c)).select(["hash", "text", "meta"])
            for t in TARGETS for v in (0, 1) for c in (0, 1)}


def _telling(x: Rows, y: np.ndarray, n: int) -> np.ndarray:
    """Features whose log odds between the classes are at least ``_SIGMA`` standard errors from 0."""
    one = x.back(y, n) + 0.5
    other = x.back(1 - y, n) + 0.5
    odds = np.log(one / (y.sum() + 1)) - np.log(other / ((1 - y).sum() + 1))
    return np.abs(odds) >= _SIGMA * np.sqrt(1 / one + 1 / other)


def _fit(x: Rows, y: np.ndarray, weight: np.ndarray, view: int) -> np.ndarray:
    n = (TEXT_DIMENSIONS, META_DIMENSIONS)[view]
    keep = np.bincount(x.col, minlength=n) >= _MIN_ROWS
    if view == 0:
        keep &= _telling(x, y, n)
    inside = keep[x.col]
    total = np.concatenate([[0], np.cumsum(inside)])
    x = Rows(total[x.at], x.col[inside], x.val[inside])
    share = np.where(y == 1, 1 / max((weight * y).sum(), 1e-9), 1 / max((weight * (1 - y)).sum(), 1e-9))
    return fit_logistic(x, y, n, weight * share, l2=1e-5 if view == 0 else 1e-4)


class Combined:
    """For each target the weights of both views, their calibration, and the logistic combination of the two."""

    def __init__(self):
        self.models: dict[str, list[np.ndarray]] = {}
        self.curves: dict[str, list[tuple[float, float]]] = {}
        self.mixer: dict[str, np.ndarray] = {}

    def logits(self, target: str, pair: tuple[Rows, Rows]) -> np.ndarray:
        return np.stack([np.clip(a * margin(x, w) + b, -12, 12)
                         for x, w, (a, b) in zip(pair, self.models[target], self.curves[target], strict=True)], 1)

    def score(self, target: str, pair: tuple[Rows, Rows]) -> np.ndarray:
        w = self.mixer[target]
        return sigmoid(self.logits(target, pair) @ w[:-1] + w[-1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = LABELLED_ROWS, rounds: int = ROUNDS, exchange_share: float = EXCHANGE_SHARE,
          confidence: float = CONFIDENCE) -> Combined | None:
    """Fit on about ``max_rows`` labelled documents at most, chosen by a hash of doc_id; each round looks at every document.

    A view hands over texts of whose class it is certain to ``confidence``, at most ``exchange_share`` of the labelled
    training rows (and one at least) per class and round; equal texts count once.

    Labels are 0 or 1; rows with null labels or ids teach nothing, and several rows of one doc_id count as their
    largest labels. None when nothing is labelled.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    n = known.count()
    if not n:
        return None
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(11)), 11) / F.lit(float(1 << 53)) < F.lit(max_rows / n)
    sample = (known.where(drawn).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
              .limit(2 * max_rows))
    base = _base(docs)
    got = (base.join(F.broadcast(sample), "doc_id")  # at most 2 * max_rows rows of three numbers
           .mapInArrow(lean(_labelled), "quality int, toxic int, text array<int>, meta array<int>").limit(2 * max_rows).toArrow())
    if not got.num_rows:
        return None
    order = np.random.default_rng(3).permutation(got.num_rows)
    pair = tuple(_unpack(got.column(c)).take(order) for c in ("text", "meta"))
    label = {t: (got.column(t).to_numpy()[order] > 0).astype(float) for t in TARGETS}
    fold = np.arange(len(order)) % 4 == 3 if len(order) >= 16 else np.zeros(len(order), bool)
    rows, spare = np.flatnonzero(~fold), np.flatnonzero(fold if fold.any() else ~fold)
    x = {(t, v): [pair[v].take(rows)] for t in TARGETS for v in (0, 1)}
    y = {(t, v): [label[t][rows]] for t in TARGETS for v in (0, 1)}

    def fit_all():
        out = {}
        for t in TARGETS:
            out[t] = []
            for v in (0, 1):
                given = np.concatenate([np.ones(len(y[t, v][0])), *(np.full(len(p), 0.5) for p in y[t, v][1:])])
                out[t].append(_fit(stack(x[t, v]), np.concatenate(y[t, v]), given, v))
        return out

    held = tuple(p.take(spare) for p in pair)

    def curves_of(models):
        return {t: [calibrate(margin(held[v], models[t][v]), label[t][spare]) for v in (0, 1)] for t in TARGETS}

    models = fit_all()
    for _ in range(rounds):
        limits = {t: [_limits(c, confidence) for c in pairs] for t, pairs in curves_of(models).items()}
        for (t, v, c), found in pseudo_labels(base, models, limits, max(1, int(exchange_share * len(rows)))).items():
            if found.num_rows:
                x[t, 1 - v].append(_unpack(found.column(("meta", "text")[v])))
                y[t, 1 - v].append(np.full(found.num_rows, float(c)))
        models = fit_all()
    out = Combined()
    out.models, out.curves = models, curves_of(models)
    for t in TARGETS:
        z = out.logits(t, held)
        out.mixer[t] = fit_logistic(Rows(np.arange(len(z) + 1) * 2, np.tile([0, 1], len(z)), z.reshape(-1)), label[t][spare], 2, l2=1e-3)
    return out


def _base(docs: DataFrame) -> DataFrame:
    """The columns that the views read, null where a table lacks one."""
    kinds = dict(zip(_COLUMNS, ("bigint", "string", "string", "string", "bigint"), strict=True))
    return docs.select(*[(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


def score(docs: DataFrame, model: Combined | None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with quality and toxic (probabilities) and keep: good enough and not toxic, in place of columns of these names.

    Without a model the probabilities are null and everything is kept. Null texts have no words and are judged
    by the metadata view; nulls in metadata are a value of their own. Needs the columns text, lang, source and
    n_chars; all others pass through. An empty table stays empty.
    """
    added = ("quality", "toxic", "keep")
    names = [c for c in docs.columns if c.lower() not in added]
    kept = docs.select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for chunk in chunks(batches):
            n = chunk.num_rows
            if m is None:
                got = [pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array([True] * n, pa.bool_())]
            else:
                pair = views(chunk)
                good, bad = m.score("quality", pair), m.score("toxic", pair)
                got = [pa.array(good), pa.array(bad), pa.array((good >= threshold) & (bad < threshold))]
            yield pa.RecordBatch.from_arrays([*chunk.columns, *got], [*names, *added])

    return kept.mapInArrow(lean(run), StructType([*kept.schema.fields, StructField("quality", DoubleType()), StructField("toxic", DoubleType()),
                                            StructField("keep", BooleanType())]))
