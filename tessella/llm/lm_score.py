"""Masked pseudo-likelihood: a bidirectional window network predicts every word of a document from both sides.

The network knows the most frequent words of the whole corpus, more of them the larger the corpus, and hash buckets.
A word of a bucket has its exact share of the bucket's occurrences, from the table of all word counts (joined by Spark).
Words fall into classes of similar total frequency. From three words on either side the network predicts the class of
the masked word, and by a second softmax the word inside the class: the hidden layer times the word's output
embedding, on top of the log of its share of the class (from corpus counts). Training is data parallel: every task trains a copy on all its documents and the copies are averaged, weighted by their
words; over the rounds every word of every document is predicted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import sums
from .text import ALNUM, LOWER, chunks, flat, hash_spans, word_spans

WORDS, BUCKETS = 8192, 1024  # at least so many words of their own; they grow with the square root of all distinct words
GROWTH = 16
SIDE = 3
WIDTH, HIDDEN, CLASSES = 16, 24, 64
ROUNDS = 2
_BATCH = 4096
PEAK = 60.0  # exp of logits up to here stays well inside the range of floats
_OFFSETS = [k for k in range(-SIDE, SIDE + 1) if k]


class Vocabulary:
    """Word hash to id: 0 is the edge of a document, then frequent words, then buckets; with classes and shares."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, bucket_counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.bucket_counts = np.maximum(bucket_counts, 1).astype(np.float64)
        self.count = np.concatenate([[0], counts[order], bucket_counts]).astype(np.float64) + 1
        self.count[0] = 0
        by = np.argsort(-self.count, kind="stable")
        mass = np.cumsum(np.sqrt(self.count[by]))
        self.cls = np.zeros(len(self.count), np.int64)
        self.cls[by] = np.minimum((mass / mass[-1] * CLASSES).astype(np.int64), CLASSES - 1)
        per = np.bincount(self.cls, self.count, CLASSES)
        with np.errstate(divide="ignore"):
            self.log_share = np.log(self.count) - np.log(per[self.cls])
        self.log_share[0] = 0
        # words in the order of their classes: places, first place of each class, and shares
        self.slot = np.empty(len(by), np.int64)
        self.slot[by] = np.arange(len(by))
        self.bounds = np.searchsorted(self.cls[by], np.arange(CLASSES + 1))
        self.offset = self.log_share[by].astype(np.float32)
        self.offset[self.slot[0]] = -1e9  # the edge of a document is never predicted
        self.share = np.exp(self.offset)

    def __len__(self) -> int:
        return len(self.count)

    def rare(self, ids: np.ndarray) -> np.ndarray:
        """Which ids are buckets."""
        return ids > len(self.hashes)

    def bucket_log(self, ids: np.ndarray) -> np.ndarray:
        """The log of all occurrences in the bucket of each id that is one."""
        return np.log(self.bucket_counts[ids - len(self.hashes) - 1])

    def ids(self, h: np.ndarray) -> np.ndarray:
        n = len(self.hashes)
        out = n + 1 + (h % np.uint64(len(self.bucket_counts))).astype(np.int64)
        if n:
            at = np.minimum(np.searchsorted(self.hashes, h), n - 1)
            known = self.hashes[at] == h
            out[known] = at[known] + 1
        return out


class Network:
    """tanh(sum of embeddings x place matrices) into class logits and word logits; all weights lie in one flat vector.

    The words' output embeddings start at 0, lie in the order of classes and stand beside ``parts``.
    """

    def __init__(self, vocabulary: int, flat_weights: np.ndarray | None = None, seed: int = 23):
        self.shapes = [(vocabulary, WIDTH), (2 * SIDE, WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (vocabulary, HIDDEN)]
        size = sum(int(np.prod(s)) for s in self.shapes)
        if flat_weights is None:
            rng = np.random.default_rng(seed)
            flat_weights = np.concatenate([*((rng.standard_normal(int(np.prod(s))) * (0.3 if len(s) > 1 else 0)) for s in self.shapes[:-1]), np.zeros(vocabulary * HIDDEN)])
        self.flat = np.array(flat_weights, np.float32)
        self.squares = np.full(size, 1e-3, np.float32)
        self.parts, self.places = [], []
        at = 0
        for s in self.shapes:
            n = int(np.prod(s))
            self.parts.append(self.flat[at:at + n].reshape(s))
            self.places.append((at, n))
            at += n
        self.words = self.parts.pop()
        self.word_squares = self.squares[self.places.pop()[0]:].reshape(self.words.shape)

    def tables(self) -> np.ndarray:
        """Each word's contribution to the hidden layer from each place."""
        emb, place, _, _, _ = self.parts
        return np.einsum("vw,kwh->kvh", emb, place).astype(np.float32)

    def hidden(self, tables: np.ndarray, context: np.ndarray) -> np.ndarray:
        hidden = np.tile(self.parts[2], (len(context), 1))
        for k in range(2 * SIDE):
            hidden += tables[k][context[:, k]]
        return np.tanh(hidden, out=hidden)

    def class_log_probs(self, tables: np.ndarray, context: np.ndarray) -> np.ndarray:
        return self.classes(self.hidden(tables, context))

    def classes(self, hidden: np.ndarray) -> np.ndarray:
        """Log-probabilities of all classes."""
        logits = hidden @ self.parts[3] + self.parts[4]
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def class_log_prob(self, hidden: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The log-probability of one class for each row."""
        logits = hidden @ self.parts[3]
        logits += self.parts[4]
        if not _peak(self.parts[3].T) + np.abs(self.parts[4]).max() < PEAK:
            logits -= logits.max(1, keepdims=True)
        mine = logits[np.arange(len(cls)), cls]
        return mine - np.log(np.exp(logits, out=logits) @ np.ones(CLASSES, np.float32))

    def word_log_probs(self, vocabulary: Vocabulary, hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The log-probability of each target word inside its class, over all words of the class."""
        order, groups = _by_class(vocabulary, target)
        hidden, slot, high = hidden.take(order, 0), vocabulary.slot[target[order]], not _peak(self.words) < PEAK
        found = np.empty(len(target), np.float32)
        for i, j, lo, hi in groups:
            logits = hidden[i:j] @ self.words[lo:hi].T
            if high:
                logits -= logits.max(1, keepdims=True)
            found[i:j] = logits[np.arange(j - i), slot[i:j] - lo]
            found[i:j] -= np.log(np.exp(logits, out=logits) @ vocabulary.share[lo:hi])
        out = np.empty(len(target))
        out[order] = found + vocabulary.offset[slot]
        return out

    def step(self, vocabulary: Vocabulary, context: np.ndarray, target: np.ndarray, rate: float = 0.08) -> None:
        """One step of adaptive gradient descent on a batch of words and their neighbours, taken in the order of classes.

        What is done for a row or a word alone (normalizing, the target's own part) stays out of the products of rows
        and words, which are passed over by exp and by the shares only.
        """
        emb, place, bias, out, out_bias = self.parts
        n = len(target)
        order, groups = _by_class(vocabulary, target)
        context, target = context.take(order, 0), target[order]
        x = emb.take(context, 0).reshape(n, -1)
        hidden = x @ place.reshape(-1, HIDDEN)
        hidden += bias
        np.tanh(hidden, out=hidden)
        p = hidden @ out
        p += out_bias
        if not _peak(out.T) + np.abs(out_bias).max() < PEAK:
            p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p *= (1 / (p @ np.full(CLASSES, n, np.float32)))[:, None]
        p[np.arange(n), vocabulary.cls[target]] -= np.float32(1 / n)
        d_hidden = p @ out.T
        slot, high = vocabulary.slot[target], not _peak(self.words) < PEAK
        d_hidden -= self.words.take(slot, 0) / np.float32(n)
        one, count = np.ones(max(hi - lo for _, _, lo, hi in groups), np.float32), np.arange(n)
        for i, j, lo, hi in groups:
            words, h, sq = self.words[lo:hi], hidden[i:j], self.word_squares[lo:hi]
            e = h @ words.T
            if high:
                e -= e.max(1, keepdims=True)
            np.exp(e, out=e)
            e *= vocabulary.share[lo:hi]
            total = e @ one[:hi - lo]
            per = (1 / total)[:, None]
            d_hidden[i:j] += (e @ words) * (per / np.float32(n))
            e[count[:j - i], slot[i:j] - lo] -= total
            _descend(words, sq, e.T @ (h * (per / np.float32(j - i))), rate)
        d_hidden *= 1 - hidden * hidden
        d_place = (x.T @ d_hidden).reshape(place.shape)
        d_x = d_hidden @ place.reshape(-1, HIDDEN).T
        here = np.zeros(len(emb), bool)
        here[context] = True
        word = np.flatnonzero(here)
        rank = np.empty(len(emb), np.intp)
        rank[word] = np.arange(0, len(word) * WIDTH, WIDTH)
        at = rank[context.reshape(-1)][:, None] + np.arange(WIDTH)
        d_emb = np.bincount(at.reshape(-1), d_x.reshape(-1), len(word) * WIDTH).astype(np.float32).reshape(-1, WIDTH)
        for (at, size), part, grad in zip(self.places[1:], self.parts[1:], (d_place, d_hidden.sum(0), hidden.T @ p, p.sum(0)), strict=True):
            _descend(part, self.squares[at:at + size].reshape(part.shape), grad, rate)
        sq = self.squares[:emb.size].reshape(emb.shape)
        moved, squares = emb.take(word, 0), sq.take(word, 0)
        _descend(moved, squares, d_emb, rate)
        emb[word], sq[word] = moved, squares


def _peak(weights: np.ndarray) -> float:
    """No logit is beyond this, as a hidden layer lies in -1 to 1. Only logits beyond PEAK are shifted by their maximum."""
    return float((np.abs(weights) @ np.ones(weights.shape[1], np.float32)).max())


def _descend(part: np.ndarray, squares: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """An adaptive step in place; ``grad`` is used up."""
    root = grad * grad
    squares += root
    np.sqrt(squares, out=root)
    grad /= root
    grad *= np.float32(rate)
    part -= grad


def _by_class(vocabulary: Vocabulary, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """The targets' order by class; for each class among them the first and last of its targets and of its words."""
    cls = vocabulary.cls[target].astype(np.int16)
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    bounds = vocabulary.bounds.tolist()
    return order, [(cuts[c], cuts[c + 1], bounds[c], bounds[c + 1]) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


def _words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buf, off = flat(col)
    buf = LOWER[buf]
    starts, ends, rows = word_spans(buf, off, ALNUM)
    return hash_spans(buf, starts, ends), rows


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def counted():
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    for chunk in chunks(batches):
        held.append(_words(chunk.column("text"))[0])
        size += len(held[-1])
        if size > 1 << 21:
            yield counted()
            held, size = [], 0
    if held:
        yield counted()


def word_counts(docs: DataFrame) -> DataFrame:
    """h, n: the count of every word of every text, by its hash."""
    return materialize(docs.select("text").mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))


def corpus_vocabulary(docs: DataFrame, words: int | None = None, counts: DataFrame | None = None) -> Vocabulary:
    """The driver gets ``words`` of all word counts (by default a number that follows the distinct words) and the sums of the buckets."""
    counts = word_counts(docs) if counts is None else counts
    words = max(WORDS, int(GROWTH * counts.count() ** 0.5)) if words is None else words
    top = counts.orderBy(F.desc("n"), "h").limit(words).toArrow()
    h = top.column("h").to_numpy().view(np.uint64)
    rest = np.zeros(BUCKETS)
    # numbers are unsigned in the kernels: a power of two keeps the bucket the low bits
    for r in counts.groupBy(F.col("h").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).agg(F.sum("n").alias("n")).collect():
        rest[r["b"]] = r["n"]
    np.subtract.at(rest, (h % np.uint64(BUCKETS)).astype(np.int64), top.column("n").to_numpy())
    return Vocabulary(h, top.column("n").to_numpy(), rest)


def _padded(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with edges around each document, and the place of each word among them."""
    new = np.ones(len(rows), bool)
    new[1:] = rows[1:] != rows[:-1]
    place = np.arange(len(ids)) + SIDE * np.cumsum(new)
    out = np.zeros(len(ids) + SIDE * (int(new.sum()) + 1), np.int64)
    out[place] = ids
    return out, place


def _targets(h: np.ndarray, rows: np.ndarray, round_: int, rounds: int) -> np.ndarray:
    """The positions a round predicts: in each document every ``rounds``-th, from a start of its own, so that the rounds
    together predict every word once."""
    new = np.ones(len(rows), bool)
    new[1:] = rows[1:] != rows[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return np.flatnonzero((np.arange(len(h)) - first + (h[first] % np.uint64(rounds)).astype(np.int64)) % rounds == round_)


def _train_part(shared, round_: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = shared.value
        net, seen = Network(len(vocabulary), start), 0
        context, target, held = [], [], 0
        around = np.array(_OFFSETS)

        def flush():
            c, t = np.concatenate(context), np.concatenate(target)
            order = np.random.default_rng(len(t)).permutation(len(t))
            for i in range(0, len(t), _BATCH):
                net.step(vocabulary, c[order[i:i + _BATCH]], t[order[i:i + _BATCH]])

        for chunk in chunks(batches):
            h, rows = _words(chunk.column("text"))
            if not len(h):
                continue
            ids = vocabulary.ids(h)
            line, place = _padded(ids, rows)
            pick = _targets(h, rows, round_, rounds)
            context.append(line[place[pick][:, None] + around])
            target.append(ids[pick])
            held += len(pick)
            seen += len(pick)
            if held >= 1 << 16:
                flush()
                context, target, held = [], [], 0
        if held:
            flush()
        if seen:
            yield sums.sliced(np.append(net.flat.astype(np.float64) * seen / 1e6, seen / 1e6), TaskContext.get().partitionId())
    return run


def train(docs: DataFrame, rounds: int = ROUNDS, counts: DataFrame | None = None) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary and the weights learned from all texts; ``counts`` are their word counts, if they are known."""
    vocabulary = corpus_vocabulary(docs, counts=counts)
    weights = Network(len(vocabulary)).flat
    for r in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))
        got = sums.total(docs.select("text").mapInArrow(_train_part(shared, r, rounds), sums.SCHEMA))
        if len(got):
            weights = (got[:-1] / got[-1]).astype(np.float32)
    return vocabulary, weights


def log_probs(vocabulary: Vocabulary, net: Network, tables: np.ndarray, h: np.ndarray, rows: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """The log-probability of every word, or of its bucket, given its neighbours on both sides."""
    ids = vocabulary.ids(h)
    line, place = _padded(ids, rows)
    around, out = np.array(_OFFSETS), np.empty(len(ids))
    for i in range(0, len(ids), block):
        hidden = net.hidden(tables, line[place[i:i + block][:, None] + around])
        some = ids[i:i + block]
        out[i:i + block] = net.class_log_prob(hidden, vocabulary.cls[some]) + net.word_log_probs(vocabulary, hidden, some)
    return out


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum over all words) and mean_log_prob of every row of ``doc_id, text``.

    Words are those of the contamination rule. Null and wordless texts have 0 tokens, sum 0 and a null mean.
    A word outside the network's vocabulary has the probability of its bucket times count(word) / count(bucket).
    Repeated rows are scored alike; other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = word_counts(base)
    shared = docs.sparkSession.sparkContext.broadcast(train(base, rounds, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        net = Network(len(vocabulary), weights)
        tables = net.tables()
        for chunk in chunks(batches):
            h, rows = _words(chunk.column("text"))
            n = np.bincount(rows, minlength=chunk.num_rows)
            ids = vocabulary.ids(h)
            rare = np.flatnonzero(vocabulary.rare(ids))
            s = np.bincount(rows, log_probs(vocabulary, net, tables, h, rows), chunk.num_rows)
            s -= np.bincount(rows[rare], vocabulary.bucket_log(ids[rare]), chunk.num_rows)
            at = np.searchsorted(rows[rare], np.arange(chunk.num_rows + 1))
            yield pa.RecordBatch.from_pydict({"doc_id": chunk.column("doc_id"), "n": pa.array(n, pa.int64()), "s": pa.array(s, pa.float64()),
                                              "rare": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h[rare].view(np.int64)))})

    scored = materialize(base.mapInArrow(run, "doc_id long, n long, s double, rare array<long>").withColumn("row", F.monotonically_increasing_id()))
    rare = (scored.select("row", F.explode("rare").alias("h")).join(counts, "h")
            .select("row", F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("n"), F.log(F.col("n").cast("double")).alias("s")))
    total = scored.drop("rare").select("row", "doc_id", "n", "s").unionByName(rare).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sum("s").alias("log_likelihood"))
    return total.orderBy("row").select("doc_id", "n_tokens", "log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_prob"))
