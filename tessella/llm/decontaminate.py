"""Benchmark decontamination: one FM-index per shard of whole documents, searched for every benchmark window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .fm_index import FMIndex
from .text import ALNUM, LOWER, chunks, flat, hash_spans, row_slices, word_spans
from .workers import give_back, lean

WINDOW = 13
SHARD_BYTES = 1 << 22
BENCHMARK_BYTES = 32 << 20  # of item text held by a task at a time; more items take more passes
_LOCATE = 1 << 19
_FOUND = "n_words long, spans array<struct<word_start:long,word_end:long,byte_start:long,byte_end:long>>, items array<string>"


def words_of(col: pa.Array):
    """Hash, start byte, end byte and row of every word of a string column, and each row's slice of them."""
    buf, off = flat(col)
    buf = LOWER[buf]
    starts, ends, rows = word_spans(buf, off, ALNUM)
    return hash_spans(buf, starts, ends), starts - off[rows], ends - off[rows], rows, row_slices(rows, len(off) - 1)


def phrases(ids: list[str | None], texts: list[str | None], window: int):
    """The distinct windows of benchmark items as rows of vocabulary numbers from 1, and the items of each window."""
    h, _, _, _, at = words_of(pa.array(texts, pa.string()))
    vocabulary, word = np.unique(h, return_inverse=True)
    word = (word + 1).astype(np.int64)
    known: dict[bytes, int] = {}
    items: list[set[int]] = []
    rows = []
    for item, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        for k in range(a, max(a + 1, b - window + 1)) if b > a else ():
            w = word[k:min(b, k + window)]
            n = known.setdefault(w.tobytes(), len(rows))
            if n == len(rows):
                rows.append(w)
                items.append(set())
            items[n].add(item)
    lengths = np.array([len(w) for w in rows], np.int64)
    grid = np.zeros((len(rows), window), np.int64)
    for n, w in enumerate(rows):
        grid[n, :len(w)] = w
    owner = np.array([i for s in items for i in sorted(s)], np.int64)
    owner_at = np.cumsum([0, *map(len, items)])
    return vocabulary, grid, lengths, owner, owner_at, ids


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for chunk in chunks(batches):
        held.append(chunk)
        size += len(flat(chunk.column("text"))[0])
        if size >= SHARD_BYTES:
            shard, held, size = pa.Table.from_batches(held).combine_chunks(), [], 0
            yield shard
            del shard, chunk  # whoever reads on has let go of it
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def find_phrases(col: pa.Array, bench) -> tuple:
    """For a shard: its words, a mask of words inside any window, and the distinct (row, item) pairs found."""
    vocabulary, grid, lengths, owner, owner_at, _ = bench
    h, b0, b1, rows, at = words_of(col)
    hit = np.zeros(len(h) + 1, np.int32)
    pairs = np.zeros((0, 2), np.int64)
    if len(h) and len(vocabulary):
        place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        inside = vocabulary[place] == h
        # runs of known words inside a row; a run shorter than the shortest phrase cannot hold one
        link = inside[1:] & inside[:-1] & (rows[1:] == rows[:-1])
        begins = np.flatnonzero(inside & ~np.append(False, link))
        stops = np.flatnonzero(inside & ~np.append(link, False)) + 1
        long_enough = stops - begins >= lengths.min()
        begins, stops = begins[long_enough], stops[long_enough]
        if begins.size:
            n = stops - begins
            # each run, then a separator
            where = np.repeat(begins - np.cumsum(n + 1) + n + 1, n + 1) + np.arange(int((n + 1).sum()))
            text = place[np.minimum(where, len(h) - 1)] + 1
            text[np.cumsum(n + 1) - 1] = 0
            index = FMIndex(text, len(vocabulary))
            lo, hi = index.search(grid, lengths)
            found = np.flatnonzero(hi > lo)
            got = []
            while found.size:
                take = max(1, int(np.searchsorted(np.cumsum((hi - lo)[found]), _LOCATE, "right")))
                some, found = found[:take], found[take:]
                size = hi[some] - lo[some]
                suffix = np.repeat(lo[some] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                phrase = np.repeat(some, size)
                start = where[index.locate(suffix)]
                np.add.at(hit, start, 1)
                np.add.at(hit, start + lengths[phrase], -1)
                key = np.unique(rows[start] * len(lengths) + phrase)
                row, phrase = key // len(lengths), key % len(lengths)
                own = owner_at[phrase + 1] - owner_at[phrase]
                item = owner[np.repeat(owner_at[phrase] - np.cumsum(own) + own, own) + np.arange(int(own.sum()))]
                got.append(np.unique(np.stack([np.repeat(row, own), item], 1), axis=0))
            if got:
                pairs = np.unique(np.concatenate(got), axis=0)
    return (b0, b1, rows, at), np.cumsum(hit[:-1]) > 0, pairs


def merged_spans(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every maximal run of hit words within a row."""
    link = mask[1:] & mask[:-1] & (rows[1:] == rows[:-1])
    return np.flatnonzero(mask & ~np.append(False, link)), np.flatnonzero(mask & ~np.append(link, False)) + 1


def _scan(shared, merge: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = shared.value
        ids = bench[-1]
        for shard in _shards(batches):
            col = shard.column("text").combine_chunks()
            # rows of one text are searched once
            coded = col.dictionary_encode()
            (b0, b1, rows, at), mask, pairs = find_phrases(coded.dictionary, bench)
            n_texts = len(coded.dictionary)
            items = [[] for _ in range(n_texts)]
            for r, i in pairs.tolist():
                if ids[i] is not None:
                    items[r].append(ids[i])
            a, z = merged_spans(mask, rows)
            spans = [[] for _ in range(n_texts)]
            for r, i, j in zip(rows[a].tolist() if len(a) else [], a.tolist(), z.tolist(), strict=True):
                spans[r].append((int(i - at[r]), int(j - at[r]), int(b0[i]), int(b1[j - 1])))
            n_words = np.diff(at)
            code = [None if c is None else c for c in coded.indices.to_pylist()]
            out_spans = [spans[c] if c is not None else [] for c in code]
            out_items = [sorted(set(items[c])) if c is not None else [] for c in code]
            if merge:
                before = shard.column("spans").to_pylist(), shard.column("items").to_pylist()
                out_spans = [join_spans([*(tuple(s.values()) for s in old), *new]) for old, new in zip(before[0], out_spans, strict=True)]
                out_items = [sorted({*old, *new}) for old, new in zip(before[1], out_items, strict=True)]
            ends = ("word_start", "word_end", "byte_start", "byte_end")
            kind = pa.list_(pa.struct([(k, pa.int64()) for k in ends]))
            for chunk in pa.Table.from_pydict({
                    **{c: shard.column(c) for c in names}, "n_words": pa.array([0 if c is None else int(n_words[c]) for c in code], pa.int64()),
                    "spans": pa.array([[dict(zip(ends, s, strict=True)) for s in x] for x in out_spans], kind),
                    "items": pa.array(out_items, pa.list_(pa.string()))}).to_batches(max_chunksize=2000):
                yield chunk
            del shard, col, coded, b0, b1, rows, at, mask, pairs, chunk  # else they stand beside the next shard
            give_back()
    return run


def join_spans(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping or touching word spans as one."""
    out: list[tuple[int, int, int, int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            a, b, c, d = out[-1]
            out[-1] = (a, max(b, s[1]), c, max(d, s[3]))
        else:
            out.append(s)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row of ``docs`` (with a column ``text``) and its n_words, n_hit, spans to remove (words and bytes of the UTF-8 text,
    merged) and items found, in place of columns of these names.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII. An item's windows are its
    runs of ``window`` words, or all of it if it has fewer; items without words have none. Null or empty texts
    have no words. Items without id mark words but are not listed. Other columns pass through; an empty table on
    either side is fine. A pass holds at most ``BENCHMARK_BYTES`` of benchmark text; a larger benchmark takes
    several passes over what the pass before wrote.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // BENCHMARK_BYTES))
    names = [c for c in docs.columns if c.lower() not in ("n_words", "n_hit", "spans", "items")]
    out = docs.select(*names)
    schema = StructType([*out.schema.fields, *StructType.fromDDL(_FOUND).fields])
    for k in range(passes):
        part = bench if passes == 1 else bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        rows = part.collect()
        shared = spark.sparkContext.broadcast(phrases([r["item_id"] for r in rows], [r["text"] for r in rows], window))
        out = out.mapInArrow(lean(_scan(shared, k > 0, names)), schema)
        if k < passes - 1:
            out = materialize(out)
    return out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["word_end"] - s["word_start"]))


def is_contaminated() -> Column:
    """At least a twentieth of the words are inside benchmark windows."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
