"""Connected components of label rasters and the region operators built on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Table, materialize
from .graph import connected_roots, min_roots
from .raster import PIXEL

# A pixel is coded row * 2^32 + col, so the smallest code of a region is its first pixel in row-major order.
_CODE = "shiftleft(cast(row as bigint), 32) + col"
SQUARE = 512  # pixels a side that one call may look at
_FORWARD = {4: [(0, 1), (1, 0)], 8: [(0, 1), (1, -1), (1, 0), (1, 1)]}


def _tile_labels(label: np.ndarray, row: np.ndarray, col: np.ndarray, connectivity: int, tile: int | None = None) -> np.ndarray:
    """Region number of each listed pixel: the position of its first pixel in the window. With ``tile`` the window holds
    many tiles and no region leaves its tile."""
    r, c = row - row.min() + 1, col - col.min() + 1
    grid = np.full((r.max() + 2, c.max() + 2), -1, dtype=np.int64)
    width = grid.shape[1]
    grid[r, c] = label
    flat = grid.ravel()
    at = r * width + c
    stored = np.zeros(flat.size, dtype=bool)
    stored[at] = True
    pairs = []
    for dr, dc in _FORWARD[connectivity]:
        other = at + dr * width + dc
        same = stored[other] & (flat[at] == flat[other])
        if tile is not None:
            same &= ((row + dr) // tile == row // tile) & ((col + dc) // tile == col // tile)
        pairs.append(np.stack([at[same], other[same]]))
    a, b = np.concatenate(pairs, axis=1)
    return min_roots(a, b, flat.size)[at]


def label_components(px: DataFrame, connectivity: int = 4, tile: int = 512) -> DataFrame:
    """Adds ``comp`` to foreground pixels ``(slide_id, row, col, label, ...)``: equal labels that touch
    (4- or 8-connected) share it. ``comp`` is the code of the region's first pixel.

    Regions are found inside each tile first; only regions that cross a tile border enter the distributed component
    search. A call looks at a square of whole tiles at once, as it costs more than a small tile's work; a group holds
    at most tile^2 or SQUARE^2 pixels.
    """
    side = tile * max(1, SQUARE // tile)
    here = [F.floor(F.col("row") / side).cast("int").alias("_tr"), F.floor(F.col("col") / side).cast("int").alias("_tc")]
    columns = px.columns

    def run(table):
        row, col = table["row"].to_numpy().astype("int64"), table["col"].to_numpy().astype("int64")
        part = _tile_labels(table["label"].to_numpy().astype("int64"), row, col, connectivity, tile)
        code = (row << 32) + col
        order = np.lexsort((code, part))
        first = np.r_[True, part[order][1:] != part[order][:-1]]
        lead = np.empty(len(part), dtype=np.int64)
        lead[order] = code[order][first][np.cumsum(first) - 1]
        return table.select(columns).append_column("part", pa.array(lead, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in px.schema) + ", part bigint"
    local = materialize(px.select("*", *here).groupBy("slide_id", "_tr", "_tc").applyInArrow(run, schema))

    rim = local.where(f"row % {tile} IN (0, {tile - 1}) OR col % {tile} IN (0, {tile - 1})").select(
        *PIXEL, "label", "part")
    steps = F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"))
                                for dr, dc in _FORWARD[connectivity]])).alias("s")
    out = (rim.select("slide_id", "row", "col", "label", F.col("part").alias("a"), steps)
           .where(f"floor((row + s.dr) / {tile}) != floor(row / {tile})"
                  f" OR floor((col + s.dc) / {tile}) != floor(col / {tile})")
           .select("slide_id", (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"),
                   "label", "a"))
    edges = out.join(rim.withColumnRenamed("part", "b").hint("merge"), [*PIXEL, "label"]).select("slide_id", "a", "b")
    roots = connected_roots(edges)
    return (local.join(roots.withColumnRenamed("node", "part").hint("merge"), ["slide_id", "part"], "left")
            .select(*columns, F.coalesce("root", "part").alias("comp")))


def component_stats(labelled: DataFrame, *aggs) -> DataFrame:
    """Per region: pixel count and bounding box ``[y0, y1) x [x0, x1)``."""
    return labelled.groupBy("slide_id", "label", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("y0"), F.min("col").alias("x0"),
        (F.max("row") + 1).alias("y1"), (F.max("col") + 1).alias("x1"), *aggs)


def _small_regions(comps: DataFrame, diagonal: float, spacings: DataFrame | None) -> DataFrame:
    """``(slide_id, comp)`` of regions whose bounding-box diagonal is not above the threshold. With ``spacings``
    (slide_id, spacing) it is in micrometers and each slide has its own; a slide without spacing has no small region."""
    h, w = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    stats, limit = component_stats(comps), F.lit(float(diagonal))
    if spacings is not None:
        stats = stats.join(spacings.select("slide_id", "spacing").hint("merge"), "slide_id")
        limit = diagonal / F.col("spacing")
    return stats.where(F.sqrt((h * h + w * w).cast("double")) <= limit).select("slide_id", "comp")


def filter_regions(px: DataFrame, diagonal: float, connectivity: int = 4, foreground: list[int] | None = None,
                   background: int = 0, tile: int = 512, spacings: DataFrame | None = None) -> DataFrame:
    """Overwrite regions whose bounding-box diagonal is not above the threshold with ``background``.
    The foreground is the listed labels together, or every non-zero label. The threshold is in pixels, or with
    ``spacings`` (slide_id, spacing) in micrometers."""
    fg = F.col("label").isin(foreground) if foreground is not None else F.col("label") != 0
    base = px.select(*PIXEL, "label")
    comps = label_components(base.where(fg).withColumn("own", F.col("label")).withColumn("label", F.lit(1)),
                             connectivity, tile)
    small = _small_regions(comps, diagonal, spacings).withColumn("_small", F.lit(1))
    kept = (comps.join(small.hint("merge"), ["slide_id", "comp"], "left")
            .select(*PIXEL, F.when(F.col("_small").isNull(), F.col("own")).otherwise(F.lit(background))
                    .cast("int").alias("label")))
    return kept.unionByName(base.where(~fg))


def _hole_parts(connectivity: int, tile: int):
    """The background of one tile that holds foreground, as parts: box, whether it is too large to be filled, its pixels as runs if it is
    not, and its pixels next to other tiles. A tile without background gives one row without part."""
    run_type = pa.struct([("row", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])

    def lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), values)

    def run(t: pa.Table) -> pa.Table:
        tr, tc, rows, cols, limit = (t[c][0].as_py() for c in ("_tr", "_tc", "_rows", "_cols", "_limit"))
        top, west = tr * tile, tc * tile
        h, w = min(tile, rows - top), min(tile, cols - west)
        free = np.ones((h, w), dtype=bool)
        free[t["row"].to_numpy() - top, t["col"].to_numpy() - west] = False
        r, c = np.nonzero(free)
        if not len(r):
            out = {"part": pa.nulls(1, pa.int64()), "big": pa.array([True]), **{k: pa.array([0], pa.int32()) for k in ("y0", "x0", "y1", "x1")},
                   "runs": pa.nulls(1, pa.list_(run_type)), "rim": pa.nulls(1, pa.list_(pa.int64()))}
            n = 1
        else:
            part = _tile_labels(np.zeros(len(r), np.int64), r, c, connectivity)
            order = np.argsort(part, kind="stable")  # row-major inside a part
            r, c, part = r[order] + top, c[order] + west, part[order]
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            n, at = len(cut), np.cumsum(np.r_[False, part[1:] != part[:-1]])
            box = {"y0": r[cut], "x0": np.minimum.reduceat(c, cut), "y1": np.maximum.reduceat(r, cut) + 1, "x1": np.maximum.reduceat(c, cut) + 1}
            reach = np.sqrt(((box["y1"] - box["y0"]) ** 2 + (box["x1"] - box["x0"]) ** 2).astype(float))
            big = ~(reach <= (np.nan if limit is None else limit))
            begin = np.r_[True, (at[1:] != at[:-1]) | (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1)]
            first = np.flatnonzero(begin)
            last = np.r_[first[1:], len(r)] - 1
            fits = ~big[at[first]]
            first, last = first[fits], last[fits]
            runs = pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in (r[first], c[first], c[last])], fields=list(run_type))
            edge = ((r == top) & (top > 0)) | ((r == top + h - 1) & (top + h < rows)) | ((c == west) & (west > 0)) | ((c == west + w - 1) & (west + w < cols))
            code = (r.astype(np.int64) << 32) + c
            out = {"part": pa.array(code[cut]), "big": pa.array(big), **{k: pa.array(v, pa.int32()) for k, v in box.items()},
                   "runs": lists(runs, at[first], n), "rim": lists(pa.array(code[edge]), at[edge], n)}
        keys = {k: t[k].take(pa.array(np.zeros(n, np.int64))) for k in ("slide_id", "_tr", "_tc", "_limit")}
        return pa.table({**keys, **out})
    return run


def _steps(offsets: list[tuple[int, int]]):
    return F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in offsets])).alias("s")


def fill_holes(px: DataFrame, levels: DataFrame, diagonal: float, connectivity: int = 4,
               foreground: list[int] | None = None, fill_value: int = 1, tile: int = 512,
               spacings: DataFrame | None = None) -> DataFrame:
    """Give small background regions the fill value; one that touches the slide border counts as well.
    Returns the stored pixels plus the filled ones. The threshold is as in ``filter_regions``.

    The background is never laid out. A tile with foreground yields its background parts, a tile without is one part. Parts that are
    too large alone can't belong to a small region: they only mark their neighbours, and no chain of parts is followed through them.
    Regions are put together from the small parts that reach another tile; pixels are written for what is filled.
    Joins are hinted as merge joins: the planner sizes laid out rims and runs as the compressed parts they come from, and pixels
    below the slides they lie in, and would broadcast them.
    """
    fg = F.col("label").isin(foreground) if foreground is not None else F.col("label") != 0
    fg = F.coalesce(fg, F.lit(False))
    base = px.select(*PIXEL, "label")
    size = levels.select("slide_id", F.col("rows").cast("int").alias("_rows"), F.col("cols").cast("int").alias("_cols"))
    if spacings is None:
        size = size.withColumn("_limit", F.lit(float(diagonal)))
    else:
        size = size.join(spacings.select("slide_id", (diagonal / F.col("spacing")).cast("double").alias("_limit")), "slide_id", "left")
    here = [F.floor(F.col(c) / tile).cast("int").alias(f"_t{c[0]}") for c in ("row", "col")]
    inside = base.where(fg).join(size.hint("merge"), "slide_id").where("row >= 0 AND col >= 0 AND row < _rows AND col < _cols").select(
        "slide_id", "row", "col", "_rows", "_cols", "_limit", *here)
    shape = (f"slide_id {px.schema['slide_id'].dataType.simpleString()}, _tr int, _tc int, _limit double, part bigint, big boolean, y0 int, x0 int, y1 int, x1 int, "
             "runs array<struct<row: int, first: int, last: int>>, rim array<bigint>")
    parts = materialize(inside.groupBy("slide_id", "_tr", "_tc").applyInArrow(_hole_parts(connectivity, tile), shape))

    at = ["slide_id", "_tr", "_tc"]
    grid = (size.withColumn("_tr", F.explode(F.expr(f"sequence(0, cast(ceil(_rows / {tile}) as int) - 1)")))
            .withColumn("_tc", F.explode(F.expr(f"sequence(0, cast(ceil(_cols / {tile}) as int) - 1)"))).where("_rows > 0 AND _cols > 0"))
    y0, x0 = F.col("_tr") * tile, F.col("_tc") * tile
    empty = grid.join(parts.select(*at).distinct().hint("merge"), at, "left_anti").select(
        *at, "_limit", y0.alias("y0"), x0.alias("x0"), F.least(y0 + tile, "_rows").alias("y1"), F.least(x0 + tile, "_cols").alias("x1"))
    reach = F.expr("sqrt(cast((y1 - y0) * (y1 - y0) + (x1 - x0) * (x1 - x0) as double))")
    empty = empty.withColumn("part", F.expr("shiftleft(cast(y0 as bigint), 32) + x0")).withColumn("big", ~F.coalesce(reach <= F.col("_limit"), F.lit(False)))

    forward = _FORWARD[connectivity]
    rim = parts.select(*at, "part", "big", F.explode("rim").alias("_c")).select(
        *at, "part", "big", F.shiftright("_c", 32).cast("int").alias("row"), F.col("_c").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("col"))
    moved = rim.select("*", _steps(forward + [(-dr, -dc) for dr, dc in forward])).select(
        "slide_id", F.col("part").alias("a"), F.col("big").alias("a_big"), (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"),
        F.col("_tr").alias("_r"), F.col("_tc").alias("_c"), F.expr(f"array_contains(array({', '.join(f'{dr * 3 + dc}' for dr, dc in forward)}), s.dr * 3 + s.dc)").alias("_on")
    ).select("*", *here).where("_tr != _r OR _tc != _c")
    other = [F.col("part").alias("b"), F.col("big").alias("b_big")]
    pixel_pairs = moved.where("_on").join(rim.select(*PIXEL, *other).hint("merge"), PIXEL)
    beside_empty = moved.select(*at, "a", "a_big").distinct().join(empty.select(*at, *other).hint("merge"), at)
    empty_pairs = (empty.select("slide_id", F.col("part").alias("a"), F.col("big").alias("a_big"), "_tr", "_tc", _steps(forward))
                   .withColumn("_tr", F.col("_tr") + F.col("s.dr")).withColumn("_tc", F.col("_tc") + F.col("s.dc")).join(empty.select(*at, *other).hint("merge"), at))
    link = ["slide_id", "a", "a_big", "b", "b_big"]
    links = materialize(pixel_pairs.select(*link).union(beside_empty.select(*link)).union(empty_pairs.select(*link)).where("NOT (a_big AND b_big)").distinct())
    marked = links.where("a_big != b_big").select("slide_id", F.when(F.col("a_big"), F.col("b")).otherwise(F.col("a")).alias("part"), F.lit(True).alias("_open")).distinct()
    roots = connected_roots(links.where("NOT a_big AND NOT b_big").select("slide_id", "a", "b")).withColumnRenamed("node", "part")

    whole = F.expr("transform(sequence(y0, y1 - 1), r -> struct(r as row, x0 as first, x1 - 1 as last))")
    keep = ["slide_id", "part", "_limit", "y0", "x0", "y1", "x1", "runs"]
    fits = parts.where("NOT big")
    crossing = fits.where("size(rim) > 0").select(*keep).unionByName(empty.where("NOT big").withColumn("runs", whole).select(*keep))
    crossing = (crossing.join(roots.hint("merge"), ["slide_id", "part"], "left").join(marked.hint("merge"), ["slide_id", "part"], "left").withColumn("root", F.coalesce("root", "part")))
    small = (crossing.groupBy("slide_id", "root").agg(F.min("y0").alias("y0"), F.min("x0").alias("x0"), F.max("y1").alias("y1"), F.max("x1").alias("x1"),
                                                      F.max("_limit").alias("_limit"), F.max("_open").alias("_open"))
             .where(F.col("_open").isNull() & (reach <= F.col("_limit"))).select("slide_id", "root"))
    runs = fits.where("size(rim) = 0").select("slide_id", "runs").unionByName(
        crossing.join(small.hint("merge"), ["slide_id", "root"], "left_semi").select("slide_id", "runs"))
    filled = (runs.select("slide_id", F.inline("runs")).select("slide_id", "row", F.explode(F.sequence("first", "last")).alias("col"))
              .select("slide_id", *[F.col(c).cast(px.schema[c].dataType).alias(c) for c in ("row", "col")], F.lit(fill_value).alias("label")))
    rest = base.where(~fg).join(filled.select(*PIXEL).hint("merge"), PIXEL, "left_anti")
    return base.where(fg).unionByName(rest).unionByName(filled)


def remove_small_objects(px: DataFrame, min_size: int) -> DataFrame:
    """Drop every label value of a slide that has fewer than ``min_size`` pixels in total."""
    big = px.where("label != 0").groupBy("slide_id", "label").count().where(F.col("count") >= min_size)
    return px.where("label != 0").join(big.select("slide_id", "label"), ["slide_id", "label"], "left_semi")


def relabel_majority(px: DataFrame, levels: DataFrame, size_limits: dict[int, float], spacing: float | None = None,
                     tile: int = 512) -> DataFrame:
    """Replace small regions by the label around them, on a dense raster.

    For each limited label, a region whose larger box side is below limit / spacing gives all pixels of that
    label inside its box the most frequent other label of the box (lowest label on a tie). A box without
    another label grows by 10 pixels on each side until it finds one. Regions are judged on the input.
    Without ``spacing`` each slide has its own, in the column ``spacing`` of ``levels``.
    """
    limit = F.create_map(*[F.lit(x) for k, v in size_limits.items() for x in (k, float(v))])[F.col("label")]
    per = F.lit(float(spacing)) if spacing is not None else F.col("spacing")
    base = px.select(*PIXEL, "label")
    comps = label_components(base.where(F.col("label").isin(list(size_limits))), 4, tile)
    size = levels.select("slide_id", F.col("rows").cast("int").alias("rows"), F.col("cols").cast("int").alias("cols"), per.alias("_per"))
    boxes = Table(component_stats(comps).join(size, "slide_id").where(F.greatest(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")) < F.floor(limit / F.col("_per")))
                  .select("slide_id", "label", "comp", "y0", "y1", "x0", "x1", "rows", "cols"),
                  n=F.count(F.lit(1)), reach=F.max(F.greatest("rows", "cols")))
    todo, n, delta, found = boxes.df, boxes.metrics["n"], 0, []
    while n and delta <= (boxes.metrics["reach"] or 0) + 10:
        r = F.explode(F.sequence(F.greatest(F.col("y0") - delta, F.lit(0)),
                                 F.least(F.col("y1") + delta, F.col("rows")) - 1))
        c = F.explode(F.sequence(F.greatest(F.col("x0") - delta, F.lit(0)),
                                 F.least(F.col("x1") + delta, F.col("cols")) - 1))
        around = (todo.select("slide_id", "comp", F.col("label").alias("_own"), "y0", "x0", "x1", "y1", "rows", "cols", r.alias("row"))
                  .select("slide_id", "comp", "_own", "row", c.alias("col")).join(base, PIXEL)
                  .where("label != _own").groupBy("slide_id", "comp", "label").count())
        best = Table(around.groupBy("slide_id", "comp").agg(
            F.max_by("label", F.struct(F.col("count"), -F.col("label"))).alias("new")))
        found.append(todo.join(best.df, ["slide_id", "comp"]))
        rest = Table(todo.join(best.df, ["slide_id", "comp"], "left_anti"), n=F.count(F.lit(1)))
        todo, n, delta = rest.df, rest.metrics["n"], delta + 10
    if not found:
        return base
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionByName(f)
    inner_r = F.explode(F.sequence(F.col("y0"), F.col("y1") - 1)).alias("row")
    inner_c = F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("col")
    new = (hits.select("slide_id", "comp", "label", "new", "x0", "x1", inner_r)
           .select("slide_id", "comp", "label", "new", "row", inner_c)
           .groupBy(*PIXEL, "label").agg(F.max_by("new", "comp").alias("new")))
    return (base.join(new, [*PIXEL, "label"], "left")
            .select(*PIXEL, F.coalesce("new", "label").alias("label")))
