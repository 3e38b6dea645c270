"""Overlapping tiles: the grid, mask-driven skipping, scoring, cropping, stitching and blending."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from .raster import PIXEL

Lost = tuple[int, int, int, int]  # left, right, top, bottom


NOTHING: Lost = (0, 0, 0, 0)


def _steps(tile: int, lost: Lost, interpolation: Lost, stride: int | None) -> tuple[Lost, int, int]:
    """What a tile loses in all at each border, and the steps between tiles along y and x."""
    total = tuple(a + b for a, b in zip(lost, interpolation, strict=True))
    left, right, top, bottom = total
    if tile - left - right <= 0 or tile - top - bottom <= 0:
        raise ValueError("the tile is smaller than what is lost at its borders")
    return total, stride or tile - top - bottom, stride or tile - left - right


def tile_grid(levels: DataFrame, tile: int, lost: Lost = NOTHING, stride: int | None = None, interpolation: Lost = NOTHING) -> DataFrame:
    """Tiles that cover each slide ``(slide_id, rows, cols)`` when a model loses ``lost`` pixels per border and the
    resampling of its output ``interpolation`` more.

    Positions run from what is lost in steps of the kept width (or ``stride``). Per tile: where to read
    (tile_y, tile_x, h, w), how to pad and crop, where the kept part goes (result_y, result_x), and its
    sequence number ``seq``, row by row. A tile that reaches the far border within what interpolation costs keeps that part.
    """
    (left, right, top, bottom), sy, sx = _steps(tile, lost, interpolation, stride)
    axis = lambda lo, size, step: F.filter(F.sequence(F.lit(-lo), F.col(size).cast("int") - 1, F.lit(step)), lambda v: v + lo <= F.col(size))
    g = levels.select("slide_id", "rows", "cols", axis(left, "cols", sx).alias("_xs"), axis(top, "rows", sy).alias("_ys"))
    g = g.select("slide_id", "rows", "cols", "_xs", F.posexplode("_ys").alias("_iy", "y"))
    g = g.select("slide_id", "rows", "cols", "_iy", "y", F.size("_xs").alias("_nx"), F.posexplode("_xs").alias("_ix", "x"))

    def along(p, size, lo, hi, model_hi):
        v, n = F.col(p), F.col(size).cast("int")
        before, over = v < 0, (v >= 0) & (v + tile >= n)
        result = v + lo
        pad_lo = F.when(before, -v).otherwise(0)
        pad_hi = F.when(over, v + tile - n).otherwise(0)
        crop_hi = F.when(over & (result + tile - lo - model_hi >= n), result + tile - lo - n).otherwise(hi)
        return F.greatest(v, F.lit(0)), result, pad_lo, pad_hi, crop_hi
    tx, rx, pl, pr, cr = along("x", "cols", left, right, lost[1])
    ty, ry, pt, pb, cb = along("y", "rows", top, bottom, lost[3])
    return g.select("slide_id", (F.col("_iy") * F.col("_nx") + F.col("_ix")).cast("bigint").alias("seq"),
                    ty.alias("tile_y"), tx.alias("tile_x"), (tile - pt - pb).alias("h"), (tile - pl - pr).alias("w"),
                    ry.alias("result_y"), rx.alias("result_x"), pt.alias("pad_top"), pb.alias("pad_bottom"), pl.alias("pad_left"),
                    pr.alias("pad_right"), F.lit(top).alias("crop_top"), cb.alias("crop_bottom"), F.lit(left).alias("crop_left"), cr.alias("crop_right"))


def tile_grid_half(levels: DataFrame, tile: int) -> DataFrame:
    """Half-overlapping tiles for blending."""
    return tile_grid(levels, tile, (0, 0, 0, 0), tile // 2)


def _tiles_of_pixel(index: str, tile: int, lo: int, step: int) -> Column:
    """Grid positions of the windows (tile long, at -lo + i * step) that contain a pixel."""
    first = F.greatest(F.ceil((F.col(index) - tile + 1 + lo) / step), F.lit(0))
    return F.explode(F.sequence(first.cast("int"), F.floor((F.col(index) + lo) / step).cast("int")))


def skip_tiles(grid: DataFrame, mask: DataFrame, mask_class: int, tile: int, lost: Lost = NOTHING, stride: int | None = None,
               interpolation: Lost = NOTHING) -> DataFrame:
    """Tiles whose kept (uncropped) area holds a mask pixel of the class.

    Each mask pixel names the few windows it falls into, the names are deduplicated map-side and the grid is
    semi-joined on them: image pixels of other tiles are never read.
    """
    (left, right, top, bottom), sy, sx = _steps(tile, lost, interpolation, stride)
    hit = mask.where(F.col("label") == mask_class).select("slide_id", "row", "col")
    hit = hit.withColumn("_iy", _tiles_of_pixel("row", tile, top, sy)).withColumn("_ix", _tiles_of_pixel("col", tile, left, sx))
    y, x = F.col("row") - (F.col("_iy") * sy - top), F.col("col") - (F.col("_ix") * sx - left)
    inside = hit.where((y >= top) & (y < tile - bottom) & (x >= left) & (x < tile - right))
    keys = inside.select("slide_id", (F.col("_iy") * sy).alias("result_y"), (F.col("_ix") * sx).alias("result_x")).distinct()
    return grid.join(keys, ["slide_id", "result_y", "result_x"], "left_semi").select(grid.columns)


def tiles_fully_covered(grid: DataFrame, mask: DataFrame, tile: int) -> DataFrame:
    """Tiles of an unpadded grid that the non-zero mask covers completely: a tile is kept when its count of
    mask pixels equals its area inside the slide."""
    n = (mask.where("label > 0").select("slide_id", (F.floor(F.col("row") / tile) * tile).cast("int").alias("tile_y"),
                                        (F.floor(F.col("col") / tile) * tile).cast("int").alias("tile_x"))
         .groupBy("slide_id", "tile_y", "tile_x").agg(F.count(F.lit(1)).alias("_n")))
    return grid.join(n, ["slide_id", "tile_y", "tile_x"]).where(F.col("_n") == F.col("h") * F.col("w")).select(grid.columns)


def _virtual(index: str, size: str, tile: int, lo: int) -> Column:
    """The places from -lo to the end of the last window where reflection shows the pixel."""
    n, period = F.col(size), F.greatest(2 * (F.col(size) - 1), F.lit(1))
    images = F.sequence(-F.ceil(F.lit(lo + 1) / period) - 1, F.ceil((n + tile) / period) + 1)
    places = F.flatten(F.transform(images, lambda k: F.array(k * period + F.col(index), k * period - F.col(index))))
    return F.array_distinct(F.filter(places, lambda v: (v >= -lo) & (v < n + tile)))


def _in_windows(px: DataFrame, tile: int, lo: tuple[int, int], step: tuple[int, int]) -> DataFrame:
    """Every pixel once per window that shows it, with its place there: ``_v0, _v1`` are its (virtual) row and column."""
    for k, (index, start, width) in enumerate(zip("yx", lo, step, strict=True)):
        px = px.withColumn(f"_i{index}", _tiles_of_pixel(f"_v{k}", tile, start, width))
        px = px.withColumn(f"_{index}", (F.col(f"_v{k}") + start - F.col(f"_i{index}") * width).cast("int"))
    return px.drop("_v0", "_v1")


_PLACE = ("seq", "result_y", "result_x", "crop_top", "crop_bottom", "crop_left", "crop_right", "_rows", "_cols")
_VALUE, _TILE, _MASK = 0, 1, 2


def map_windows(px: DataFrame, grid: DataFrame, levels: DataFrame, tile: int, values: list[str], kernel, schema: str, total: Lost, step: tuple[int, int],
                pad_mode: str = "constant", mask: DataFrame | None = None, batch_size: int = 32, later: list[tuple[int, int]] | None = None) -> DataFrame:
    """``kernel(slide_id, place, windows, masks) -> columns`` on up to ``batch_size`` neighbouring windows of a slide at a time.

    Pixels, mask pixels and tiles travel to their group as narrow rows; the windows are put together there, padded with 0 or by
    reflection. ``place`` has one array per column of ``_PLACE`` and, for each step in ``later``, whether that later tile exists.
    """
    if pad_mode not in ("constant", "reflect"):
        raise ValueError(f"unknown pad mode {pad_mode}")
    lo, later, masked = (total[2], total[0]), later or [], mask is not None
    size = levels.select("slide_id", F.col("rows").cast("int").alias("_rows"), F.col("cols").cast("int").alias("_cols"))
    at = [(F.col(f"result_{c}") / s).cast("int").alias(f"_i{c}") for c, s in zip("yx", step, strict=True)]
    tiles = grid.select("slide_id", *at, *[c for c in _PLACE if not c.startswith("_")]).join(size, "slide_id")
    for k, (dy, dx) in enumerate(later):
        there = tiles.select("slide_id", (F.col("_iy") - dy).alias("_iy"), (F.col("_ix") - dx).alias("_ix"), F.lit(True).alias(f"_later{k}"))
        tiles = tiles.join(there, ["slide_id", "_iy", "_ix"], "left")
    none = [F.lit(None).cast("double").alias(v) for v in values]
    flags = [f"_later{k}" for k in range(len(later))]
    own = [*[F.lit(None).cast("int").alias(c) for c in _PLACE], *[F.lit(None).cast("boolean").alias(c) for c in flags]]
    shown = px.select("slide_id", F.col("row").alias("_v0"), F.col("col").alias("_v1"), *[F.col(v).cast("double").alias(v) for v in values])
    if pad_mode == "reflect":
        shown = shown.join(size, "slide_id").withColumn("_v0", F.explode(_virtual("_v0", "_rows", tile, lo[0])))
        shown = shown.withColumn("_v1", F.explode(_virtual("_v1", "_cols", tile, lo[1]))).drop("_rows", "_cols")
    key = ["slide_id", "_iy", "_ix"]
    rows = _in_windows(shown, tile, lo, step)
    if mask is not None:
        on = mask.where("label > 0").select("slide_id", F.col("row").alias("_v0"), F.col("col").alias("_v1"), *none)
        rows = rows.withColumn("_kind", F.lit(_VALUE)).unionByName(_in_windows(on, tile, lo, step).withColumn("_kind", F.lit(_MASK)))
        rows = rows.join(tiles.select(*key), key, "left_semi")  # nothing of a skipped tile travels further
    else:
        rows = rows.withColumn("_kind", F.lit(_VALUE))
    rows = rows.select(*key, "_kind", "_y", "_x", *values, *own).unionByName(
        tiles.select(*key, F.lit(_TILE).alias("_kind"), F.lit(0).alias("_y"), F.lit(0).alias("_x"), *none, *_PLACE, *flags))

    def run(t: pa.Table) -> pa.Table:
        kind, ix = t.column("_kind").to_numpy(), t.column("_ix").to_numpy()
        head = np.flatnonzero(kind == _TILE)
        head = head[np.argsort(ix[head], kind="stable")]
        place = {c: t.column(c).take(pa.array(head)).fill_null(False if c in flags else 0).to_numpy() for c in (*_PLACE, *flags)}
        windows, masks = np.zeros((len(head), tile, tile, len(values))), np.zeros((len(head), tile, tile), bool)
        slot = np.searchsorted(ix[head], ix)
        known = (slot < len(head)) & (kind != _TILE)
        known[known] = ix[head][slot[known]] == ix[known]
        y, x = t.column("_y").to_numpy(), t.column("_x").to_numpy()
        for which in (_VALUE, _MASK):
            at = np.flatnonzero(known & (kind == which))
            if which == _MASK:
                masks[slot[at], y[at], x[at]] = True
            else:
                for c, v in enumerate(values):
                    windows[slot[at], y[at], x[at], c] = t.column(v).to_numpy()[at]
        return kernel(t.column("slide_id").slice(0, 1), place, windows, masks if masked else None)

    group = F.floor(F.col("_ix") / batch_size)
    return rows.withColumn("_g", group).groupBy("slide_id", "_iy", "_g").applyInArrow(run, schema)


def read_tiles(px: DataFrame, grid: DataFrame, levels: DataFrame, tile: int, values: list[str], pad_mode: str = "constant",
               lost: Lost = NOTHING, stride: int | None = None, interpolation: Lost = NOTHING) -> DataFrame:
    """Tile windows as ``tile`` x ``tile`` row-major arrays, one per channel, padded with 0 or by reflection.
    ``grid`` is that of ``tile_grid`` with the same lengths, or some of its tiles."""
    total, sy, sx = _steps(tile, lost, interpolation, stride)
    kind = grid.schema["slide_id"].dataType.simpleString()

    def pack(slide, place, windows, masks):
        k = len(windows)
        cells = [pa.ListArray.from_arrays(pa.array(np.arange(k + 1, dtype=np.int32) * tile * tile), pa.array(windows[..., c].reshape(-1))) for c in range(len(values))]
        return pa.table([slide.combine_chunks().take(pa.array(np.zeros(k, np.int64))), pa.array(place["seq"].astype(np.int64)), *cells], ["slide_id", "seq", *values])

    arrays = map_windows(px, grid, levels, tile, values, pack, f"slide_id {kind}, seq bigint, " + ", ".join(f"{v} array<double>" for v in values), total, (sy, sx), pad_mode)
    return arrays.join(grid, ["slide_id", "seq"])


# ---- processors ----
@dataclass
class Processor:
    """A model call on a batch (n, tile, tile, channels) -> (n, tile, tile, classes), with optional hooks."""
    predict: Callable[[np.ndarray], np.ndarray]
    preprocess: Callable[[np.ndarray], np.ndarray] | None = None
    postprocess: Callable[[np.ndarray], np.ndarray] | None = None


PROCESSORS: dict[str, Processor] = {}


def register_processor(name: str, predict, preprocess=None, postprocess=None) -> None:
    """Make a scorer available by name; it is shipped to the workers by value."""
    PROCESSORS[name] = Processor(predict, preprocess, postprocess)


def linear_softmax(weights, bias):
    """A small demonstration scorer: softmax of a linear map of the channels."""
    w, b = np.asarray(weights, dtype=float), np.asarray(bias, dtype=float)

    def predict(batch):
        z = batch @ w + b
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)
    return predict


def rescale(batch: np.ndarray, factor: tuple[float, float]) -> np.ndarray:
    """A batch (n, h, w, classes) at ``factor`` times its height and width, linear between centres, edges held."""
    for axis, f in zip((1, 2), factor, strict=True):
        n = batch.shape[axis]
        at = np.clip((np.arange(int(n * f)) + 0.5) / f - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        high = np.minimum(low + 1, n - 1)
        share = (at - low).reshape([-1 if k == axis else 1 for k in range(4)])
        batch = batch.take(low, axis) * (1 - share) + batch.take(high, axis) * share
    return batch


def score_windows(px: DataFrame, grid: DataFrame, levels: DataFrame, channels: list[str], processor: Processor | str, classes: int, tile: int,
                  lost: Lost = NOTHING, mask: DataFrame | None = None, pad_mode: str = "constant", batch_size: int = 32, interpolation: Lost = NOTHING,
                  downsample: tuple[float, float] = (1, 1), hard: bool = False) -> DataFrame:
    """``(slide_id, row, col, probs)`` of every pixel inside a slide that a tile of ``grid`` covers, each once.

    Windows are assembled, scored, resampled, cropped and masked in one task. A model may return its whole window or only
    what it does not lose, at 1 / ``downsample`` (rows, columns) of the resolution; ``hard`` keeps the number of the best
    class, from 1, in place of the scores. Where kept parts overlap (a border that interpolation need not give up), the
    pixel belongs to the tile with the highest ``seq``, which the grid tells without looking at other tiles' results.
    """
    proc = PROCESSORS[processor] if isinstance(processor, str) else processor
    total, sy, sx = _steps(tile, lost, interpolation, None)
    deep, wide = -(-interpolation[3] // sy), -(-interpolation[1] // sx)
    later = [(a, b) for a in range(deep + 1) for b in range(wide + 1) if a or b]
    kind, out_classes = grid.schema["slide_id"].dataType.simpleString(), 1 if hard else classes

    def fit(out: np.ndarray) -> np.ndarray:
        """The model's result at the resolution and place of its window."""
        out = np.argmax(out, -1)[..., None] + 1.0 if hard else out
        out = rescale(out, downsample) if tuple(downsample) != (1, 1) else out
        if out.shape[1:3] == (tile, tile):
            return out
        left, right, top, bottom = lost
        if out.shape[1:3] != (tile - top - bottom, tile - left - right):
            raise ValueError(f"the model returns {out.shape[1:3]} for a tile of {tile} that loses {lost}")
        return np.pad(out, ((0, 0), (top, bottom), (left, right), (0, 0)))

    def score(slide, place, windows, masks):
        parts = []
        batch = proc.preprocess(windows) if proc.preprocess else windows
        out = proc.predict(batch) if len(batch) else batch
        out = fit(proc.postprocess(out) if proc.postprocess else out)
        for k in range(len(windows)):
            top, bottom, left, right, y0, x0 = (int(place[c][k]) for c in ("crop_top", "crop_bottom", "crop_left", "crop_right", "result_y", "result_x"))
            kept = out[k, top:tile - bottom, left:tile - right]
            if masks is not None:
                kept = kept * masks[k, top:tile - bottom, left:tile - right, None]
            r, c = (np.arange(n) for n in kept.shape[:2])
            own = ((y0 + r < place["_rows"][k]) & (y0 + r >= 0))[:, None] & ((x0 + c < place["_cols"][k]) & (x0 + c >= 0))[None, :]
            for i, (a, b) in enumerate(later):
                if place[f"_later{i}"][k]:
                    own &= ~((r >= a * sy)[:, None] & (c >= b * sx)[None, :])
            r, c = np.nonzero(own)
            parts.append((r + y0, c + x0, kept[r, c]))
        rows, cols, probs = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0), np.zeros(0), np.zeros((0, out_classes)))
        at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * out_classes)
        return pa.table([slide.combine_chunks().take(pa.array(np.zeros(len(rows), np.int64))), pa.array(rows.astype(np.int32)), pa.array(cols.astype(np.int32)),
                         pa.ListArray.from_arrays(at, pa.array(probs.reshape(-1).astype(np.float64)))], ["slide_id", "row", "col", "probs"])

    return map_windows(px, grid, levels, tile, channels, score, f"slide_id {kind}, row int, col int, probs array<double>", total, (sy, sx), pad_mode, mask, batch_size, later)


def tta_gmean(df: DataFrame, side: int, keys: list[str]) -> DataFrame:
    """Geometric mean over the eight flips and rotations ``(keys, aug, probs)`` of a square patch. Variant
    4 * f + k was mirrored left-right when f = 1 and then rotated k times; it is turned back first. A zero in
    any variant gives 0."""
    df = df.withColumn("_k", F.pmod(-F.col("aug"), F.lit(4))).withColumn("_f", F.when(F.col("aug") >= 4, "horizontal").otherwise("none"))
    df = df.withColumn("_back", A.rot90("probs", side, F.col("_k"))).withColumn("_back", A.flip("_back", side, side, F.col("_f")))
    long = df.select(*keys, F.posexplode("_back").alias("i", "v"))
    g = long.groupBy(*keys, "i").agg(F.min("v").alias("_m"), F.exp(F.avg(F.when(F.col("v") > 0, F.log("v")))).alias("_g"))
    return g.select(*keys, "i", F.when(F.col("_m") <= 0, 0.0).otherwise(F.col("_g")).alias("prob"))


# ---- results ----
def blend_weight(y: Column, x: Column, tile: int) -> Column:
    """Ramp weight of half-overlapping tiles at (y, x): the four tiles over a pixel weigh 1 together."""
    half = tile // 2
    near = lambda v: F.when(v < half, v).otherwise(tile - 1 - v)
    a, b = near(y), near(x)
    a2, b2 = half - 1 - a, half - 1 - b
    z = F.least(a, b)
    return z / (z + F.least(a2, b) + F.least(a, b2) + F.least(a2, b2))


def blend_tiles(tiles: DataFrame, levels: DataFrame, tile: int, value: str = "values") -> DataFrame:
    """Half-overlapping tiles summed with ramp weights: 1 - sum((1 - v) * w) per pixel, so uncovered weight
    counts as 1."""
    cells = tiles.select("slide_id", "result_y", "result_x", F.posexplode(value).alias("_p", "_v"))
    y, x = F.floor(F.col("_p") / tile).cast("int"), (F.col("_p") % tile).cast("int")
    px = cells.select("slide_id", (F.col("result_y") + y).alias("row"), (F.col("result_x") + x).alias("col"),
                      ((1 - F.col("_v")) * blend_weight(y, x, tile)).alias("_d"))
    size = levels.select("slide_id", "rows", "cols")
    return (px.join(size, "slide_id").where("row < rows AND col < cols")
            .groupBy(*PIXEL).agg((1 - F.sum("_d")).alias("value")))


def classify_tiled(px: DataFrame, levels: DataFrame, channels: list[str], processor: Processor | str, classes: int, tile: int, lost: Lost = NOTHING,
                   mask: DataFrame | None = None, mask_class: int = 1, pad_mode: str = "constant", output_class: int | None = None, batch_size: int = 32,
                   interpolation: Lost = NOTHING, downsample: tuple[float, float] = (1, 1), hard: bool = False) -> DataFrame:
    """Grid, skip, read, score, crop and stitch in one plan with one shuffle of pixels: soft scores per pixel, one class
    of them, or with ``hard`` the best class."""
    grid = tile_grid(levels, tile, lost, interpolation=interpolation)
    if mask is not None:
        grid = skip_tiles(grid, mask, mask_class, tile, lost, interpolation=interpolation)
    out = score_windows(px, grid, levels, channels, processor, classes, tile, lost, mask, pad_mode, batch_size, interpolation, downsample, hard)
    return out if output_class is None else out.select(*PIXEL, F.col("probs")[output_class].alias("prob"))


def tta_processor(base: Processor) -> Processor:
    """The processor averaged (geometrically) over the eight flips and rotations of each tile."""
    def predict(batch):
        total = None
        for f in (False, True):
            for k in range(4):
                b = np.rot90(batch[:, :, ::-1] if f else batch, k, axes=(1, 2))
                out = np.rot90(base.predict(np.ascontiguousarray(b)), -k, axes=(1, 2))
                out = out[:, :, ::-1] if f else out
                with np.errstate(divide="ignore"):
                    total = np.log(out) if total is None else total + np.log(out)
        return np.exp(total / 8)
    return Processor(predict, base.preprocess, base.postprocess)
