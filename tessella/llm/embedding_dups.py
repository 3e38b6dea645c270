"""Near-duplicate embeddings by tiled comparison along principal axes.

Unit vectors are turned to principal axes, so that leading dimensions carry most of every inner product. Vectors of
one label and length are cut into tiles that lie close together on these axes. Two tiles meet only if the boxes
around their leading dimensions, with the norms of the rest, leave a cosine at the threshold possible. Inside two
tiles products are accumulated dimension group by dimension group; a pair is given up when its sum plus the product of
both suffix norms stays below the threshold. What is left is measured on the original vectors in double precision.

Equal vectors of a label are compared once. A pair of tiles hands out counts and spanning links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_roots, min_roots
from ..session import materialize
from .nearest import usable

THRESHOLD = 0.93
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 1 << 25  # bounds of the sample the axes and the cuts are fitted on; any axes give the same links
LENGTHS = 8  # vector lengths with axes of their own; others keep their given axes
SPLIT_DIMS, SPLIT_LEVELS = 8, 12  # leading axes that tiles are cut along, and how often
TILE_BYTES, TILE_ROWS = 1 << 21, 1024  # of the original vectors in a tile
STRIP = 256  # rows of a tile that meet the other tile at a time
DENSE = 0.25  # share of open pairs above which the next dimensions are taken for all pairs
PAIRS = 1 << 15  # pairs measured at a time
_SLACK = 2e-7  # rounding of single precision per dimension


class Axes:
    """An orthogonal basis whose first axes carry most, and a binary tree of cuts: each at the mean of the leading axis that varies most."""

    def __init__(self, sample: np.ndarray):
        d = sample.shape[1]
        share, basis = np.linalg.eigh(sample.T @ sample)
        self.basis = basis[:, np.argsort(-share, kind="stable")]
        self.levels = int(min(SPLIT_LEVELS, max(0, np.log2(max(len(sample), 1) / 8))))
        lead = sample @ self.basis[:, :min(d, SPLIT_DIMS)]
        self.cuts, self.along = np.zeros((1 << self.levels) - 1), np.zeros((1 << self.levels) - 1, np.int64)
        at = np.zeros(len(sample), np.int64)
        for level in range(self.levels):
            for node in range((1 << level) - 1, (2 << level) - 1):
                inside = lead[at == node]
                if len(inside):
                    self.along[node] = k = np.argmax(inside.var(0))
                    self.cuts[node] = inside[:, k].mean()
            at = self._down(at, lead)

    def _down(self, at: np.ndarray, turned: np.ndarray) -> np.ndarray:
        return 2 * at + 1 + (turned[np.arange(len(turned)), self.along[at]] > self.cuts[at])

    def place(self, turned: np.ndarray) -> np.ndarray:
        """The leaf of each turned vector, as a path of ``levels`` bits."""
        at = np.zeros(len(turned), np.int64)
        for _ in range(self.levels):
            at = self._down(at, turned)
        return at - ((1 << self.levels) - 1)


def _rows(col: pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square leaves the range of doubles."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_axes(sample: DataFrame) -> dict[int, Axes]:
    """Axes of the most common vector lengths of a bounded sample (one column, embedding)."""
    held: dict[int, list] = {}
    for b in sample.toArrow().to_batches():
        for v in b.column(0).to_pylist():
            held.setdefault(len(v), []).append(v)
    common = sorted(held, key=lambda d: (-len(held[d]), d))[:LENGTHS]
    return {d: Axes(_unit(np.array(held[d], np.float64))) for d in common}


def _turn(shared):
    """Every distinct vector turned to the axes of its length, with its leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = shared.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                b = batch.filter(pa.array(dims == d))
                u = _unit(_rows(b.column("embedding"), d))
                own = axes.get(d)
                if own is not None:
                    u = u @ own.basis
                leaf = own.place(u) if own is not None else np.zeros(len(u), np.int64)
                cut = np.full(len(u), own.levels if own is not None else 0, np.int32)
                yield pa.RecordBatch.from_pydict({
                    "node": b.column("node"), "grp": b.column("grp"), "dim": b.column("dim"), "n": b.column("n"), "leaf": pa.array(leaf), "levels": pa.array(cut),
                    "turned": pa.array([r.tobytes() for r in u.astype(np.float32)], pa.binary()), "embedding": b.column("embedding")})
    return run


def _pack(t: pa.Table) -> pa.Table:
    """One tile as one row: its vectors, turned and as given, and the box around them."""
    dim = t.column("dim")[0].as_py()
    turned = np.frombuffer(b"".join(t.column("turned").to_pylist()), np.float32).reshape(-1, dim)
    lead = turned[:, :SPLIT_DIMS].astype(np.float64)
    rest = np.sqrt(np.maximum(1 - (lead * lead).sum(1), 0))[:, None]
    box = np.hstack([lead, rest])
    return pa.table({
        "grp": t.column("grp")[:1], "dim": t.column("dim")[:1], "tile": pa.array([t.column("node")[0].as_py()], pa.int64()),
        "nodes": pa.array([t.column("node").to_numpy().tobytes()], pa.binary()), "ns": pa.array([t.column("n").to_numpy().tobytes()], pa.binary()),
        "turned": pa.array([turned.tobytes()], pa.binary()),
        "given": pa.array([_rows(t.column("embedding"), dim).tobytes()], pa.binary()),
        "low": pa.array([box.min(0).tolist()], pa.list_(pa.float64())), "high": pa.array([box.max(0).tolist()], pa.list_(pa.float64()))})


def _groups_of_dims(dim: int) -> list[int]:
    """Ends of the dimension groups: a quarter, a half, all."""
    return sorted({max(1, dim // 4), max(1, dim // 2), dim})


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, upper: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two turned tiles whose cosine may reach the threshold, strip by strip; with ``upper`` only i < j."""
    dim = a.shape[1]
    ends = _groups_of_dims(dim)
    need = threshold - _SLACK * dim - 1e-6
    norms = [[np.sqrt((x[:, e:].astype(np.float64) ** 2).sum(1)).astype(np.float32) for e in ends] for x in (a, b)]
    for i0 in range(0, len(a), STRIP):
        strip = a[i0:i0 + STRIP]
        total, done, open_ = np.zeros((len(strip), len(b)), np.float32), 0, None
        for g, e in enumerate(ends):
            if open_ is None:
                total += strip[:, done:e] @ b[:, done:e].T
                alive = total + norms[0][g][i0:i0 + STRIP, None] * norms[1][g][None, :] >= need
                if upper:
                    alive &= np.arange(i0, i0 + len(strip))[:, None] < np.arange(len(b))[None, :]
                if e == dim or np.count_nonzero(alive) <= DENSE * alive.size:
                    open_ = np.nonzero(alive)
                    part = total[open_]
            else:
                i, j = open_
                more = np.concatenate([np.einsum("ij,ij->i", strip[i[k:k + PAIRS], done:e], b[j[k:k + PAIRS], done:e]) for k in range(0, len(i), PAIRS)] or [part])
                part = part + more
                alive = part + norms[0][g][i0 + i] * norms[1][g][j] >= need
                open_, part = (i[alive], j[alive]), part[alive]
            done = e
        yield open_[0] + i0, open_[1]


def _cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    for k in range(0, len(i), PAIRS):
        a, b = i[k:k + PAIRS], j[k:k + PAIRS]
        out[k:k + PAIRS] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b])
    return out


def _scaled(raw: bytes, dim: int, kind) -> np.ndarray:
    """The given vectors as doubles; only those whose squares would leave the range of doubles are scaled, by powers of two."""
    x = np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64)
    top = np.abs(x).max(1)
    far = (top > 1e150) | (top < 1e-150)
    if far.any():
        x[far] = np.ldexp(x[far], -np.frexp(top[far])[1][:, None])
    return x


def _compare(threshold: float, kind):
    """Per pair of tiles: how many vectors each vector is linked with, and a spanning link to the first of its group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                dim, same = get["dim"], get["tile_a"] == get["tile_b"]
                sides = []
                for s in "ab":
                    sides.append((np.frombuffer(get[f"turned_{s}"], np.float32).reshape(-1, dim), _scaled(get[f"given_{s}"], dim, kind),
                                  np.frombuffer(get[f"nodes_{s}"], np.int64), np.frombuffer(get[f"ns_{s}"], np.int64)))
                (ta, xa, na, ca), (tb, xb, nb, cb) = sides
                # positions in both tiles; for a tile with itself the two ranges are one
                shift = 0 if same else len(na)
                nodes, counts = (na, ca) if same else (np.concatenate([na, nb]), np.concatenate([ca, cb]))
                links, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
                for i, j in close_pairs(ta, tb, threshold, same):
                    near = _cosines(xa, xb, i, j) >= threshold if len(i) else np.zeros(0, bool)
                    i, j = i[near], j[near] + shift
                    if len(i):
                        np.add.at(links, i, counts[j])
                        np.add.at(links, j, counts[i])
                        root = min_roots(np.concatenate([np.arange(len(root)), i]), np.concatenate([root, j]), len(root))
                at = np.flatnonzero(links)
                if len(at):
                    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes[at]), "links": pa.array(links[at]), "root": pa.array(nodes[root[at]])})
    return run


def tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """Pairs of tiles of one group whose boxes allow the threshold: unit vectors with that cosine lie within sqrt(2 - 2 threshold)."""
    a, b = (tiles.select("grp", "dim", *[F.col(c).alias(f"{c}_{s}") for c in ("tile", "low", "high")]) for s in "ab")
    gap = "greatest(low_a[k] - high_b[k], low_b[k] - high_a[k], 0D)"
    apart = F.expr(f"aggregate(transform(sequence(0, size(low_a) - 1), k -> pow({gap}, 2)), 0D, (s, x) -> s + x)")
    return a.join(b, ["grp", "dim"]).where("tile_a <= tile_b").where(apart <= 2 - 2 * threshold + 1e-5).select("dim", "tile_a", "tile_b")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label).

    Rows are linked when their labels are equal and not null, their vectors have one length and a cosine of at least
    ``threshold``. Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Rows of
    one vec_id are vectors of their own. component_id is the smallest vec_id that links reach; a null vec_id takes part
    in links but names no component. kept: vec_id and component_id are the same, both null included. Other columns are
    ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    wide = vectors.schema["embedding"].dataType.elementType.typeName() != "float"
    kind, sql = (np.float64, "double") if wide else (np.float32, "float")
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(label).alias("grp"), F.col("embedding").cast(f"array<{sql}>").alias("embedding"))
    takes = F.coalesce(F.col("grp").isNotNull() & usable(), F.lit(False))
    rows = base.withColumn("key", F.when(takes, F.struct("grp", F.xxhash64("embedding").alias("h1"), F.hash(F.reverse("embedding")).alias("h2"))))
    classes = (rows.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"))
               .select("key", F.col("key.grp").alias("grp"), "n", "least", "embedding", F.size("embedding").alias("dim")))
    # numbered while being written, so that a number never changes afterwards
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()))
    total, longest = classes.agg(F.count(F.lit(1)), F.max("dim")).first()
    room = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * (longest or 1))))
    drawn = F.shiftrightunsigned(F.xxhash64("node", F.lit(5)), 11) / F.lit(float(1 << 53)) < F.lit(room / max(total, 1))
    axes = spark.sparkContext.broadcast(fit_axes(classes.where(drawn if total > room else F.lit(True)).select("embedding").limit(2 * room)))

    turned = classes.mapInArrow(_turn(axes), f"node long, grp {classes.schema['grp'].dataType.simpleString()}, dim int, n long, leaf long, levels int, "
                                             f"turned binary, embedding array<{sql}>")
    fit = F.least(F.lit(TILE_ROWS), F.greatest(F.lit(16), F.expr(f"{TILE_BYTES} DIV ({np.dtype(kind).itemsize} * dim)")))
    sizes = classes.groupBy("grp", "dim").agg(F.count(F.lit(1)).alias("m")).withColumn("room", fit)
    # as many cuts as a group needs; what still is too large for a tile is dealt by number
    depth = F.least("levels", F.greatest(F.lit(0), F.ceil(F.log2(F.col("m") / F.col("room"))).cast("int")))
    cell = turned.join(sizes, ["grp", "dim"]).withColumn("depth", depth)
    cell = materialize(cell.withColumn("cell", F.expr("shiftright(leaf, levels - depth)")).drop("leaf", "levels", "depth", "m"))
    filled = cell.groupBy("grp", "dim", "cell").agg(F.count(F.lit(1)).alias("c"))
    dealt = cell.join(filled, ["grp", "dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), F.expr("(c + room - 1) DIV room")))
    shape = (f"grp {classes.schema['grp'].dataType.simpleString()}, dim int, tile long, nodes binary, ns binary, turned binary, given binary, "
             "low array<double>, high array<double>")
    tiles = materialize(dealt.groupBy("grp", "dim", "cell", "part").applyInArrow(_pack, shape))

    pairs = tile_pairs(tiles, threshold)
    sides = [tiles.select(*[F.col(c).alias(f"{c}_{s}") for c in ("tile", "nodes", "ns", "turned", "given")]) for s in "ab"]
    met = pairs.join(sides[0], "tile_a").join(sides[1], "tile_b")
    found = materialize(met.mapInArrow(_compare(threshold, kind), "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_roots(found.where("node != root").select(F.lit(0).alias("_k"), F.col("node").alias("a"), F.col("root").alias("b")), "_k").select("node", "root")
    named = classes.select("key", "node", "n", "least").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(names, "root").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(of_class, "key", "left")
    component: Column = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
