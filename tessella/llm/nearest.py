"""Approximate nearest neighbours by randomly rotated one-bit codes inside coarse cells.

A vector's residual to its cell's centre is rotated at random and kept as one sign bit per dimension with two
numbers: its length and the inner product of the unit residual with its code. These give an unbiased estimate of
its inner product with any query and a bound of the error; only vectors whose upper bound reaches the k-th best
lower bound are measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

TRAIN_ROWS = 20_000  # the bound of the sample that the cells are fitted on
CELL_ROWS = 4000  # vectors a cell is meant for
MAX_CELLS = 1 << 12
PROBE_PAIRS = 1 << 16  # of a query and a cell that a task looks at a time
FIRST = 2  # cells that set the score to beat in all others
UNIT_VECTORS, UNIT_QUERIES = 4096, 1024  # what a task compares at a time
EPSILON = 2.2  # error bound in standard deviations of the estimate
_VEC = "vec long, cell int, embedding array<float>"


def _matrix(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def rotation(dim: int, seed: int = 13) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 17) -> np.ndarray:
    """Centres of ``cells`` cells by k-means on the sample."""
    rng = np.random.default_rng(seed)
    centre = sample[rng.choice(len(sample), cells, replace=False)]
    for _ in range(rounds):
        at = nearest_cell(sample, centre)
        n = np.bincount(at, minlength=cells)
        total = np.zeros_like(centre)
        np.add.at(total, at, sample)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def nearest_cell(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre * centre).sum(1)[None, :] - 2 * (x @ centre.T)).argmin(1)


class Codes:
    """Packed one-bit codes of vectors around a centre."""

    def __init__(self, x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        residual = (x - centre) @ turn
        self.dim = x.shape[1]
        self.length = np.linalg.norm(residual, axis=1)
        unit = residual / np.maximum(self.length, 1e-30)[:, None]
        self.bits = np.packbits(residual > 0, axis=1)
        self.fit = np.maximum((np.abs(unit).sum(1) / np.sqrt(self.dim)), 1e-12)  # <code, unit residual>

    def estimate(self, q: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of each query with each vector, and the bounds of their errors."""
        signs = np.unpackbits(self.bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        turned = (q @ turn).astype(np.float32)
        raw = (turned @ signs.T).astype(np.float64) / np.sqrt(self.dim)
        value = (q @ centre)[:, None] + raw * (self.length / self.fit)[None, :]
        spread = self.length * np.sqrt(np.maximum(1 - self.fit**2, 0)) / self.fit / np.sqrt(max(self.dim - 1, 1))
        return value, EPSILON * np.linalg.norm(q, axis=1)[:, None] * spread[None, :] + 1e-9


def search_unit(vec: np.ndarray, x: np.ndarray, q: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int, floor: np.ndarray | None = None):
    """Per query the ``k`` best of a unit's vectors that reach its ``floor``: query number, vector id, exact score."""
    floor = np.full(len(q), -np.inf) if floor is None else floor
    value, bound = Codes(x, centre, turn).estimate(q, centre, turn)
    out_q, out_v, out_s = [], [], []
    for i in range(len(q)):
        low = value[i] - bound[i]
        need = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
        rerank = np.flatnonzero(value[i] + bound[i] >= max(need, floor[i]))
        exact = x[rerank] @ q[i]
        rerank, exact = rerank[exact >= floor[i]], exact[exact >= floor[i]]
        order = np.lexsort((vec[rerank], -exact))[:k]
        out_q.append(np.full(len(order), i))
        out_v.append(vec[rerank][order])
        out_s.append(exact[order])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _search(shared, k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        centre, turn = shared.value
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "vec": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        c = centre[left.column("cell")[0].as_py()]
        floor = right.column("floor").fill_null(-np.inf).to_numpy()
        q, v, s = search_unit(left.column("vec").to_numpy(), _matrix(left.column("embedding")), _matrix(right.column("embedding")), c, turn, k, floor)
        return pa.table({"query": right.column("query").to_numpy()[q], "vec": v, "score": s})
    return run


def _assign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, _ = shared.value
        for b in batches:
            cell = nearest_cell(_matrix(b.column("embedding")), centre)
            yield pa.RecordBatch.from_arrays([b.column("vec"), pa.array(cell.astype(np.int32)), b.column("embedding")], ["vec", "cell", "embedding"])
    return run


def _probe(shared):
    """The ``FIRST`` cells of each query, or with a floor (null: none) all others that can hold a vector that reaches it:
    an inner product is at most the centre's plus the query's length times the radius of the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, radius = shared.value
        for batch in batches:
            step = max(1, PROBE_PAIRS // len(centre))
            for b in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                q = _matrix(b.column("embedding"))
                score = q @ centre.T
                near = np.argsort(-score, axis=1, kind="stable")[:, :FIRST]
                visit = np.zeros(score.shape, bool)
                np.put_along_axis(visit, near, True, 1)
                if radius is not None:
                    floor = b.column("floor").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                    length = np.linalg.norm(q, axis=1)[:, None]
                    slack = 1e-9 * length * (np.linalg.norm(centre, axis=1) + radius)[None, :]
                    visit = ~visit & (score + length * radius[None, :] + slack >= floor[:, None])
                row, cell = np.nonzero(visit)
                row = pa.array(row)
                floors = b.column("floor").take(row)
                yield pa.RecordBatch.from_arrays([b.column("query").take(row), pa.array(cell.astype(np.int32)), floors, b.column("embedding").take(row)],
                                                 ["query", "cell", "floor", "embedding"])
    return run


def _radius(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, _ = shared.value
        most = np.full(len(centre), -1.0)
        for b in batches:
            cell = b.column("cell").to_numpy()
            if len(cell):
                np.maximum.at(most, cell, np.linalg.norm(_matrix(b.column("embedding")) - centre[cell], axis=1))
        held = np.flatnonzero(most >= 0)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(held.astype(np.int32)), "radius": pa.array(most[held])})
    return run


def usable(embedding: str = "embedding") -> Column:
    """Neither null nor empty nor all zero, and every component finite."""
    return (F.col(embedding).isNotNull() & F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
            & F.exists(embedding, lambda v: v != 0))


def _first_rows(df: DataFrame, keys: list[str], order: list, n: int, salt: Column) -> DataFrame:
    """The first ``n`` rows of each key; a hot key is cut down in parts before its rows meet."""
    parts = df.withColumn("_salt", salt)
    for by in ([*keys, "_salt"], keys):
        parts = parts.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")
    return parts.drop("_salt")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` vectors of largest inner product found for every query row, its own row excepted.

    ``vectors`` has vec_id and embedding (floats of one length); other columns are ignored. Unusable vectors and
    rows without vec_id take no part; rows of one vec_id are one vector (the smallest), and only vectors of the most common length are compared. Equal vectors are searched
    once: of their ids only the ``k + 1`` smallest can rank. Scores are exact; ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col("vec_id").isNotNull()).where(usable()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("asks").alias("asks")))
    common = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common:
        rows = rows.where(F.size("embedding") == common["dim"])
    keyed = rows.withColumn("h", F.struct(F.xxhash64("embedding"), F.hash("embedding")))
    # each distinct vector stands under its smallest id
    distinct = materialize(keyed.groupBy("h").agg(F.min("vec_id").alias("vec"), F.min_by("embedding", "vec_id").alias("embedding"), F.max("asks").alias("asks")))
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cells = int(min(MAX_CELLS, max(1, n // CELL_ROWS)))
    drawn = F.shiftrightunsigned(F.xxhash64("vec", F.lit(5)), 11) / F.lit(float(1 << 53)) < F.lit(TRAIN_ROWS / n)
    sample = _matrix(distinct.where(drawn if n > TRAIN_ROWS else F.lit(True)).select("embedding").limit(2 * TRAIN_ROWS).toArrow().column(0))
    cells = min(cells, len(sample))
    shared = spark.sparkContext.broadcast((fit_cells(sample, cells), rotation(sample.shape[1])))

    placed = distinct.select("vec", "embedding").mapInArrow(_assign(shared), _VEC)
    placed = materialize(placed)
    # a cell without vectors has no radius and is never visited
    radius = np.full(cells, -np.inf)
    for r in placed.mapInArrow(_radius(shared), "cell int, radius double").groupBy("cell").agg(F.max("radius").alias("radius")).collect():
        radius[r["cell"]] = r["radius"]
    asked = distinct.where("asks").select(F.col("vec").alias("query"), "embedding")
    probed = "query long, cell int, floor double, embedding array<float>"
    ahead_of, others = (spark.sparkContext.broadcast((shared.value[0], x)) for x in (None, radius))
    cell_size = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_v"))

    def search(some: DataFrame) -> DataFrame:
        # at most MAX_CELLS rows; a unit is a block of a cell's vectors and a block of the queries that probe it
        size = (cell_size.join(some.groupBy("cell").agg(F.count(F.lit(1)).alias("n_q")), "cell")
                .select("cell", (F.expr(f"n_v DIV {UNIT_VECTORS}") + 1).cast("int").alias("bv"), (F.expr(f"n_q DIV {UNIT_QUERIES}") + 1).cast("int").alias("bq")))
        left = (placed.join(F.broadcast(size), "cell").withColumn("v_block", F.pmod(F.xxhash64("vec"), F.col("bv")).cast("int"))
                .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("bq") - 1))).select("cell", "v_block", "q_block", "vec", "embedding"))
        right = (some.join(F.broadcast(size), "cell").withColumn("q_block", F.pmod(F.xxhash64("query"), F.col("bq")).cast("int"))
                 .withColumn("v_block", F.explode(F.sequence(F.lit(0), F.col("bv") - 1))).select("cell", "v_block", "q_block", "query", "embedding", "floor"))
        unit = ["cell", "v_block", "q_block"]
        return left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(_search(shared, k + 1), "query long, vec long, score double")

    def top(found: DataFrame) -> DataFrame:
        return _first_rows(found, ["query"], [F.desc("score"), "vec"], k + 1, F.pmod(F.xxhash64("vec"), F.lit(8)))

    # the best of the nearest cells are what vectors of other cells have to beat; a cell is left out when none of its vectors can
    ahead = materialize(top(search(materialize(asked.withColumn("floor", F.lit(None).cast("double")).mapInArrow(_probe(ahead_of), probed)))))
    floor = ahead.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") > k).drop("n")
    best = top(ahead.unionByName(search(materialize(asked.join(floor, "query", "left").mapInArrow(_probe(others), probed)))))

    ids = keyed.join(distinct.select("h", "vec"), "h").select("vec", "vec_id", "asks")
    some = _first_rows(ids.select("vec", "vec_id"), ["vec"], ["vec_id"], k + 1, F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    # a list of at most (k + 1)^2 ids per distinct query, cut to its k + 1 first, then dealt to all its rows
    per_vector = _first_rows(best.join(some, "vec"), ["query"], [F.desc("score"), "vec_id"], k + 1, F.pmod(F.xxhash64("vec_id"), F.lit(1)))
    listed = per_vector.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v")))).alias("near"))
    each = ids.where("asks").select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query")).join(listed, "query")
    own = F.slice(F.filter("near", lambda x: x["v"] != F.col("query_id")), 1, k)
    return (each.select("query_id", F.posexplode(own).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.v").alias("vec_id"), (-F.col("x.s")).alias("score")))
