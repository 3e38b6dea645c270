"""Dilation, erosion, margins and disc sums: tile kernels with a halo, independent of the tiling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .raster import PIXEL
from .tiles import map_tiles


def _grow(mask: np.ndarray, inside: np.ndarray, k: int) -> np.ndarray:
    for _ in range(k):
        nxt = mask.copy()
        nxt[1:] |= mask[:-1]
        nxt[:-1] |= mask[1:]
        nxt[:, 1:] |= mask[:, :-1]
        nxt[:, :-1] |= mask[:, 1:]
        mask = nxt & inside
    return mask


def iterations(distance: float, spacing: float) -> int:
    """Half-even rounded number of unit steps for a distance in micrometers."""
    if distance <= 0:
        raise ValueError("the dilation distance must be positive")
    return round(distance / spacing)


def dilate_steps(px: DataFrame, levels: DataFrame, k: int | str, tile: int = 512) -> DataFrame:
    """Pixels within city-block distance ``k`` (a number or a column of ``levels``) of a non-zero pixel, label 1."""
    fg = px.where("label != 0").select(*PIXEL, F.lit(1).alias("label"))
    if k == 0:
        return fg
    return map_tiles(fg, levels, lambda g, inside, steps: _grow(g != 0, inside, steps).astype(np.int64),
                     "label", "label", "int", tile, k)


def dilate(px: DataFrame, levels: DataFrame, distance: float, spacing: float | None = None, tile: int = 512) -> DataFrame:
    """Dilation by a distance; where it rounds to no step the raster is copied unchanged. Without ``spacing``
    each slide has its own, in the column ``spacing`` of ``levels``."""
    if spacing is not None:
        k = iterations(distance, spacing)
        return dilate_steps(px, levels, k, tile) if k else px.select(*PIXEL, "label")
    if distance <= 0:
        raise ValueError("the dilation distance must be positive")
    steps = levels.withColumn("_steps", F.rint(distance / F.col("spacing")).cast("int"))
    grown = dilate_steps(px, steps.where("_steps > 0"), "_steps", tile)
    return grown.unionByName(px.join(steps.where("_steps = 0").select("slide_id"), "slide_id", "left_semi").select(*PIXEL, "label"))


def erode_steps(px: DataFrame, levels: DataFrame, k: int, tile: int = 512) -> DataFrame:
    """Pixels whose whole city-block ball of radius ``k`` is non-zero; beyond the slide is background."""
    fg = px.where("label != 0").select(*PIXEL, F.lit(1).alias("label"))
    if k == 0:
        return fg

    def kernel(g, inside, _):
        everywhere = np.ones_like(inside)
        return (~_grow(~((g != 0) & inside), everywhere, k)).astype(np.int64)
    return map_tiles(fg, levels, kernel, "label", "label", "int", tile, k)


def region_margins(px: DataFrame, levels: DataFrame, source: int, internal: int, external: int, size: int,
                   tile: int = 512) -> DataFrame:
    """Relabel the inner ring of the source label to ``internal`` and the ring around it to ``external``.
    Other stored pixels stay unless the outer ring covers them."""
    region = px.where(F.col("label") == source).select(*PIXEL, F.lit(1).alias("label"))
    grown = dilate_steps(region, levels, size, tile).select(*PIXEL, F.lit(1).alias("_g"))
    core = erode_steps(region, levels, size, tile).select(*PIXEL, F.lit(1).alias("_c"))
    out = (px.select(*PIXEL, "label").join(grown, PIXEL, "full_outer").join(core, PIXEL, "left"))
    is_source = F.coalesce(F.col("label") == source, F.lit(False))
    value = (F.when(is_source & F.col("_c").isNull(), F.lit(internal))
             .when(~is_source & F.col("_g").isNotNull(), F.lit(external)).otherwise(F.col("label")))
    return out.select(*PIXEL, value.cast("int").alias("label"))


def circle_diameter_px(diameter_mm: float, spacing: float) -> int:
    return int(1000.0 * diameter_mm / spacing)


def disc_spans(radius: float) -> tuple[list[tuple[int, int]], int]:
    """Rows of a disc as (row offset, half width) for the offsets closer than ``radius``, and its reach."""
    reach = int(np.ceil(radius))
    spans = []
    for dr in range(-reach, reach + 1):
        cols = [dc for dc in range(reach + 1) if np.hypot(dr, dc) < radius]
        if cols:
            spans.append((dr, max(cols)))
    return spans, reach


def _span_sums(g: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    side = g.shape[0]
    run = np.zeros((side, side + 1), dtype=np.int64 if g.dtype == bool else g.dtype)
    np.cumsum(g, axis=1, out=run[:, 1:])
    total = np.zeros((side, side), dtype=run.dtype)
    at = np.arange(side)
    for dr, half in spans:
        line = run[:, np.minimum(at + half + 1, side)] - run[:, np.maximum(at - half, 0)]
        total[max(0, -dr):side + min(0, -dr)] += line[max(0, dr):side + min(0, dr)]
    return total


def disc_close(mask: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Dilation followed by erosion with the disc; outside the window counts as unset."""
    grown = _span_sums(mask, spans) > 0
    return ~(_span_sums(~grown, spans) > 0)


def disc_sum(px: DataFrame, levels: DataFrame, diameter: int, value: str = "label", tile: int = 512) -> DataFrame:
    """Sum of ``value`` over the pixels closer than the radius, the floor of half the diameter, from running sums along the rows."""
    spans, reach = disc_spans(diameter // 2)

    def kernel(g, inside, _):
        return _span_sums(np.where(inside, g, 0), spans)
    kind = "double" if px.schema[value].dataType.simpleString() in ("double", "float") else "bigint"
    return map_tiles(px.where(F.col(value) != 0), levels, kernel, value, "total", kind, tile, reach)


def disc_share(px: DataFrame, levels: DataFrame, wanted: list[int], among: list[int], diameter: int,
               tile: int = 512) -> DataFrame:
    """Share of the ``wanted`` labels among the ``among`` labels within a disc around every pixel that has
    any of them in reach. Both counts come from one pass: wanted + 2^32 * among."""
    code = (F.col("label").isin(wanted).cast("bigint") + F.col("label").isin(among).cast("bigint") * F.lit(1 << 32))
    s = disc_sum(px.select(*PIXEL, code.alias("code")), levels, diameter, "code", tile)
    part, whole = F.col("total") % F.lit(1 << 32), F.shiftright("total", 32)
    return s.where(whole > 0).select(*PIXEL, part.alias("wanted"), whole.alias("among"), (part / whole).alias("share"))
