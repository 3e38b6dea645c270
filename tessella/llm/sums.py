"""Sums of long vectors over tasks, in slices and two levels, so that no task or driver holds more than a few."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 14
SCHEMA = "slice int, part int, vec binary"


def sliced(vector: np.ndarray, part: int) -> pa.RecordBatch:
    """A float32 vector as rows of ``SCHEMA``."""
    cuts = [vector[i:i + SLICE].astype("<f4").tobytes() for i in range(0, len(vector), SLICE)]
    return pa.RecordBatch.from_pydict({"slice": pa.array(range(len(cuts)), pa.int32()), "part": pa.array([part] * len(cuts), pa.int32()),
                                       "vec": pa.array(cuts, pa.binary())})


def _add(t: pa.Table) -> pa.Table:
    total = None
    for x in t.column("vec"):
        v = np.frombuffer(x.as_buffer(), "<f4").astype(np.float64)
        total = v if total is None else total + v
    return pa.table({"slice": t.column("slice")[:1], "part": t.column("part")[:1], "vec": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def total(rows: DataFrame) -> np.ndarray:
    """The sum of all vectors emitted as ``sliced`` rows; empty if there are none."""
    first = rows.withColumn("part", F.col("part") % 32).groupBy("slice", "part").applyInArrow(_add, SCHEMA)
    got = first.groupBy("slice").applyInArrow(_add, SCHEMA).orderBy("slice").toArrow()
    parts = [np.frombuffer(x.as_buffer(), "<f4") for x in got.column("vec")]
    return np.concatenate(parts).astype(np.float64) if parts else np.zeros(0)
