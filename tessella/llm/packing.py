"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. What the packing needs is only how many pieces have
each length, at most ``capacity`` numbers, so the plan is made from that histogram whatever the corpus size:
for each bin, subset sums over the available lengths are a bitset, the highest set bit is the fullest feasible
combination, and its lengths are taken out, as often as they all last (availability only shrinks, so the same
combination stays the fullest). Pieces then find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import chunks
from .tokens import WORD_BPE, encoder, with_end
from .workers import lean

CAPACITY = 2048


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """``(length, copies)`` of a fullest combination of the available lengths that fits; long pieces are preferred."""
    lengths = sorted(k for k, c in counts.items() if c > 0 and k <= capacity)
    keep = (1 << (capacity + 1)) - 1
    sums, before = 1, []
    for k in lengths:
        before.append(sums)
        left, step = min(counts[k], capacity // k), 1
        while left > 0:  # 1, 2, 4, ... copies, then the rest
            step = min(step, left)
            sums |= (sums << (k * step)) & keep
            left -= step
            step *= 2
        if sums >> capacity & 1 and len(before) == len(lengths):
            break
    rest, out = sums.bit_length() - 1, []
    for k, prior in zip(reversed(lengths), reversed(before), strict=True):
        for q in range(min(counts[k], rest // k), -1, -1):
            if prior >> (rest - q * k) & 1:
                break
        if q:
            out.append((k, q))
            rest -= q * k
    return out


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(bins, combination)`` until every piece has a bin; each step uses one combination as often as it lasts."""
    counts = {k: c for k, c in histogram.items() if k > 0 and c > 0}
    plan = []
    while counts:
        combo = fullest(counts, capacity)
        times = min(counts[k] // q for k, q in combo)
        plan.append((times, combo))
        for k, q in combo:
            counts[k] -= q * times
            if not counts[k]:
                del counts[k]
    return plan


def _slots(plan) -> list[tuple[int, int, int, int, int]]:
    """For each copy in each combination: length, ranks it serves from and to, first bin number, offset in the bin."""
    rows, used, first = [], {}, 0
    for times, combo in plan:
        offset = 0
        for k, q in combo:
            for _ in range(q):
                at = used.get(k, 0)
                rows.append((k, at, at + times, first, offset))
                used[k] = at + times
                offset += k
        first += times
    return rows


def _cut(tokenizer: str, end_id: int, capacity: int, release: bool):
    kind = pa.binary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        for chunk in chunks(batches):
            ids, counts = with_end(*enc.encode(chunk.column("text")), end_id)
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            order = np.argsort(length, kind="stable")
            run_start = np.searchsorted(length[order], length[order])
            nth = np.empty(len(doc), np.int64)
            nth[order] = np.arange(len(doc)) - run_start
            nth += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            first = (np.cumsum(counts) - counts)[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": chunk.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids": pa.array([bytes(raw[4 * a:4 * (a + m)]) for a, m in zip(first.tolist(), length.tolist(), strict=True)], kind),
                "part": pa.array(np.full(len(doc), part), pa.int32()), "nth": pa.array(nth, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from cut(batches)
        if release:
            encoder.cache_clear()
    return run


def cut_pieces(docs: DataFrame, tokenizer: str = WORD_BPE, capacity: int = CAPACITY, end_id: int = 0, release: bool = False) -> DataFrame:
    """``doc_id, text`` as pieces: doc_id, piece, start, length, ids (little-endian u32), and where it was cut: part, nth
    (its number among the pieces of its length in that task).

    Null text is empty; every document ends with ``end_id``, so none is without a piece. The rows must be
    written before they are read twice: ``part`` and ``nth`` are those of one run. ``release``: a Python worker gives up
    its encoder with the task, for jobs in which other stages need the memory.
    """
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(lean(_cut(tokenizer, end_id, capacity, release)),
                        "doc_id long, piece int, start long, length long, ids binary, part int, nth long"))


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A sequence for every written piece: part, length, nth of ``pieces``, then sequence_id and offset.

    Moves no ids. The histogram and the plan's slots are bounded by ``capacity``; counts per (part, length) are
    aggregated before they are shuffled, and one window per length runs over the parts.
    """
    spark = pieces.sparkSession
    key = pieces.select("part", "length", "nth")
    per_part = key.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in key.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots: dict[int, list] = {}
    for k, lo, hi, first, offset in _slots(plan_bins(totals, capacity)):
        slots.setdefault(k, []).append((lo, hi, first, offset))
    tables = {k: np.array(v, np.int64) for k, v in slots.items()}
    shared = spark.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            seq, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                rows = np.flatnonzero(length == k)
                t = shared.value[int(k)]
                at = np.searchsorted(t[:, 0], rank[rows], "right") - 1
                seq[rows] = t[at, 2] + rank[rows] - t[at, 0]
                offset[rows] = t[at, 3]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("part", "length", "nth")), pa.array(seq), pa.array(offset)],
                                             ["part", "length", "nth", "sequence_id", "offset"])

    ranked = key.join(base, ["part", "length"]).select("part", "length", "nth", (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(lean(run), "part int, length long, nth long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str = WORD_BPE, capacity: int = CAPACITY, carry=None, release: bool = False) -> DataFrame:
    """Every piece of ``docs`` with its ids, sequence_id and offset. Sequences have no gaps and no piece overlaps.

    ``carry`` maps the pieces to what must be kept beside doc_id, piece, start, length, part and nth (say, a digest
    instead of the ids) before they are joined with their places. Empty table: no rows. Repeated rows are
    pieces of their own; a null doc_id stays null; other columns are ignored.
    """
    pieces = materialize(cut_pieces(docs, tokenizer, capacity, release=release))
    places = place_pieces(pieces, capacity)
    rows = carry(pieces) if carry else pieces
    return rows.join(places, ["part", "length", "nth"]).drop("part", "nth")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence; at most ``capacity`` ids are gathered per group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
            .select("sequence_id", "n_tokens", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids")))
