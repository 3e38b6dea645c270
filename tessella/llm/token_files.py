"""Token-ID output: all ids of a corpus in document order, as patched frame-of-reference segments.

A segment is one self-contained binary file body (little-endian):

    "PFOR" | u16 version | u16 block size | u32 documents | u32 ids | u32 blocks
    documents x i64 doc_id | documents x u8 "doc_id is null" | documents x u32 ids of that document
    blocks x u32 start of the block, counted from the end of this index
    blocks: u32 minimum | u8 width | u16 exceptions | ids - minimum, packed at width | u16 positions | u32 high bits

A block's width covers ``percentile`` of its ids; the rest keep their low bits in place and their high bits in
the exception list. The last block is filled up with its minimum.

Spark's own file writer stores the segments (uncompressed, one row each, with the number of the range
partition and of the segment in it), so a lost task leaves nothing behind and every store Spark reaches works.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .text import chunks
from .tokens import BYTE_BPE, encoder, with_end

MAGIC, VERSION, BLOCK, PERCENTILE = b"PFOR", 1, 128, 0.9
_FIXED = struct.Struct("<4sHHIII")
_HEAD = 7  # bytes before a block's packed ids
_COLUMNS = "part int, seq int, n_docs long, n_ids long, payload binary"


def _le(values: np.ndarray, kind: str) -> np.ndarray:
    """Each value's little-endian bytes, one row per value."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)


def _width(x: np.ndarray) -> np.ndarray:
    """Bits needed for each number."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK,
                   percentile: float = PERCENTILE) -> bytes:
    """The segment of documents with the given numbers of ids, their ids one after another."""
    n_blocks = -(-len(ids) // block)
    padded = np.zeros(n_blocks * block, np.int64)
    padded[:len(ids)] = ids
    grid = padded.reshape(n_blocks, block)
    if n_blocks:
        last = len(ids) - (n_blocks - 1) * block
        grid[-1, last:] = grid[-1, :last].min()
    low = grid.min(1) if n_blocks else np.zeros(0, np.int64)
    delta = grid - low[:, None]
    width = _width(np.sort(delta, 1)[:, int(np.ceil(percentile * block)) - 1])
    high = delta >> width[:, None]
    over = high > 0
    n_over = over.sum(1)
    packed = (width * block + 7) // 8
    size = _HEAD + packed + 6 * n_over
    start = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    head = np.concatenate([_le(low, "<u4"), _le(width, "<u1"), _le(n_over, "<u2")], 1)
    body[start[:, None] + np.arange(_HEAD)] = head
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        bits = (delta[at][:, :, None] >> np.arange(w)) & 1
        body[start[at][:, None] + _HEAD + np.arange(packed[at[0]])] = np.packbits(
            bits.reshape(len(at), -1).astype(np.uint8), axis=1, bitorder="little")
    b, pos = np.nonzero(over)
    k = np.arange(len(b)) - (np.cumsum(n_over) - n_over)[b]
    base = start[b] + _HEAD + packed[b]
    body[(base + 2 * k)[:, None] + np.arange(2)] = _le(pos, "<u2")
    body[(base + 2 * n_over[b] + 4 * k)[:, None] + np.arange(4)] = _le(high[b, pos], "<u4")
    missing = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join([_FIXED.pack(MAGIC, VERSION, block, len(doc_ids), len(ids), n_blocks), known.tobytes(), missing.tobytes(),
                     np.asarray(lengths, "<u4").tobytes(), start.astype("<u4").tobytes(), body.tobytes()])


def _index(payload: bytes):
    magic, version, block, n_docs, n_ids, n_blocks = _FIXED.unpack_from(payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token segment of this version")
    at = _FIXED.size
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at)
    missing = np.frombuffer(payload, np.uint8, n_docs, at := at + 8 * n_docs)
    lengths = np.frombuffer(payload, "<u4", n_docs, at := at + n_docs).astype(np.int64)
    start = np.frombuffer(payload, "<u4", n_blocks, at := at + 4 * n_docs).astype(np.int64)
    return block, n_ids, doc_ids, missing, lengths, start, np.frombuffer(payload, np.uint8, offset=at + 4 * n_blocks)


def _blocks(body: np.ndarray, start: np.ndarray, block: int) -> np.ndarray:
    head = body[start[:, None] + np.arange(_HEAD)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0].astype(np.int64)
    width = head[:, 4].astype(np.int64)
    n_over = np.ascontiguousarray(head[:, 5:7]).view("<u2")[:, 0].astype(np.int64)
    packed = (width * block + 7) // 8
    out = np.zeros((len(start), block), np.int64)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        raw = body[start[at][:, None] + _HEAD + np.arange(packed[at[0]])]
        bits = np.unpackbits(raw, axis=1, count=int(w) * block, bitorder="little").reshape(len(at), block, w)
        out[at] = bits.astype(np.int64) @ (1 << np.arange(w, dtype=np.int64))
    b = np.repeat(np.arange(len(start)), n_over)
    k = np.arange(len(b)) - (np.cumsum(n_over) - n_over)[b]
    base = start[b] + _HEAD + packed[b]
    pos = np.ascontiguousarray(body[(base + 2 * k)[:, None] + np.arange(2)]).view("<u2")[:, 0]
    high = np.ascontiguousarray(body[(base + 2 * n_over[b] + 4 * k)[:, None] + np.arange(4)]).view("<u4")[:, 0].astype(np.int64)
    out[b, pos] += high << width[b]
    return out + low[:, None]


def decode_segment(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids (None for null), ids per document, and all ids of a segment."""
    block, n_ids, doc_ids, missing, lengths, start, body = _index(payload)
    ids = _blocks(body, start, block).reshape(-1)[:n_ids].astype(np.uint32)
    return [None if m else int(d) for d, m in zip(doc_ids, missing, strict=True)], lengths, ids


def read_ids(payload: bytes, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` of a segment, unpacking only the blocks that hold them."""
    block, n_ids, _, _, _, start, body = _index(payload)
    end = min(end, n_ids)
    if begin >= end:
        return np.zeros(0, np.uint32)
    first = begin // block
    ids = _blocks(body, start[first:-(-end // block)], block).reshape(-1)
    return ids[begin - first * block:end - first * block].astype(np.uint32)


def _write_part(tokenizer: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        docs, lens, ids, held = [], [], [], 0

        def segment():
            all_lens = np.concatenate(lens)
            payload = encode_segment(docs, all_lens, np.concatenate(ids))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": pa.array([len(docs)], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "payload": pa.array([payload], pa.binary())})

        for chunk in chunks(batches):
            got, counts = with_end(*enc.encode(chunk.column("text")), end_id)
            docs += chunk.column("doc_id").to_pylist()
            lens.append(counts)
            ids.append(got)
            held += len(got)
            if held >= segment_ids:
                yield segment()
                docs, lens, ids, held, seq = [], [], [], 0, seq + 1
        if docs:
            yield segment()
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = 0, segment_ids: int = 1 << 20) -> None:
    """Encode ``doc_id, text`` and write segments of about ``segment_ids`` ids under ``path``, in ascending doc_id order.

    Null text is empty and every document gets ``end_id``. Null doc_ids come first; rows with one doc_id follow
    each other by text. Other columns are ignored. An empty table gives no segment. Range partitioning spreads
    the rows evenly, even rows of one doc_id when their texts differ.
    """
    tie = F.xxhash64("text")
    (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), tie.alias("_tie"))
     .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
     .mapInArrow(_write_part(tokenizer, end_id, segment_ids), _COLUMNS)
     .write.option("compression", "none").parquet(path))


def _read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            docs, lens, ids = decode_segment(batch.column("payload")[row].as_py())
            begin = np.cumsum(lens) - lens
            raw = memoryview(ids.astype("<u4").tobytes())
            n = len(docs)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([batch.column("part")[row].as_py()] * n, pa.int32()),
                "seq": pa.array([batch.column("seq")[row].as_py()] * n, pa.int32()),
                "doc_id": pa.array(docs, pa.int64()), "begin": pa.array(begin, pa.int64()), "n_tokens": pa.array(lens, pa.int64()),
                "ids": pa.array([bytes(raw[4 * b:4 * (b + m)]) for b, m in zip(begin, lens, strict=True)], pa.binary())})


def read_token_files(spark: SparkSession, path: str, then=None, schema: str = "") -> DataFrame:
    """Every document of the segments under ``path``: doc_id, start (ids of all documents before it), n_tokens,
    ids (little-endian u32).

    ``then`` maps the record batches (with ``ids``) inside the reading task to columns of ``schema``, so that a
    digest need not carry the ids through Spark. Segment starts come from two prefix sums, within a partition
    and over the partitions' totals: the latter has one row per written partition.
    """
    files = spark.read.schema(_COLUMNS).parquet(path)
    per_part = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    in_part = files.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("seq_start"))
    rows = files.select("part", "seq", "payload").mapInArrow(
        (lambda batches: then(_read_part(batches))) if then else _read_part,
        "part int, seq int, doc_id long, begin long, n_tokens long, " + (schema or "ids binary"))
    kept = [c for c in rows.columns if c not in ("part", "seq", "begin", "doc_id", "n_tokens")]
    return (rows.join(in_part.join(before, "part"), ["part", "seq"])
            .select("doc_id", (F.col("part_start") + F.col("seq_start") + F.col("begin")).alias("start"), "n_tokens", *kept))


def write_and_read(docs: DataFrame, tokenizer: str = BYTE_BPE, then=None, schema: str = "") -> DataFrame:
    """Write the token files to a fresh folder of the shared scratch space and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark)
    write_token_files(docs, path, tokenizer)
    return read_token_files(spark, path, then, schema)
