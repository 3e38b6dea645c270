"""Bounding boxes and detections: overlap joins, merging, suppression, padding and score filters.

Boxes are half-open: ``(slide_id, box_id, y, x, h, w)`` covers [y, y + h) x [x, x + w).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Table, materialize
from .components import component_stats, label_components
from .graph import min_roots


def _cells(df: DataFrame, a: str, b: str, out: str, cell: int) -> DataFrame:
    last = F.greatest(F.ceil(F.col(b) / cell) - 1, F.floor(F.col(a) / cell))
    return df.withColumn(out, F.explode(F.sequence(F.floor(F.col(a) / cell), last)))


def bbox_overlap_join(left: DataFrame, right: DataFrame, cell: int = 512, keep: list[str] = ()) -> DataFrame:
    """Pairs whose open interiors overlap in both axes, from ``(slide_id, id, y0, x0, y1, x1)`` on both sides; the right
    one's columns ``keep`` go along.

    Both sides are cut along grid cells and joined on the cell key; a pair is reported only in the cell that
    holds the corner of its intersection, so no duplicates arise. Choose ``cell`` near the usual box size.
    """
    names = ("id", "y0", "x0", "y1", "x1")
    l = left.select("slide_id", *[F.col(c).alias(f"l_{c}") for c in names])  # noqa: E741
    r = right.select("slide_id", *[F.col(c).alias(f"r_{c}") for c in (*names, *keep)])
    l = _cells(_cells(l, "l_y0", "l_y1", "_cy", cell), "l_x0", "l_x1", "_cx", cell)  # noqa: E741
    r = _cells(_cells(r, "r_y0", "r_y1", "_cy", cell), "r_x0", "r_x1", "_cx", cell)
    top, low = F.greatest("l_y0", "r_y0"), F.least("l_y1", "r_y1")
    west, east = F.greatest("l_x0", "r_x0"), F.least("l_x1", "r_x1")
    return (l.join(r, ["slide_id", "_cy", "_cx"]).where((top < low) & (west < east))
            .where((F.floor(top / cell) == F.col("_cy")) & (F.floor(west / cell) == F.col("_cx"))).drop("_cy", "_cx"))


def patch_boxes(boxes: DataFrame, patches: DataFrame, cell: int = 512) -> DataFrame:
    """Class boxes overlapping a patch window around ``(patch_id, center_row, center_col, h, w)``, moved to
    the window's origin."""
    half = lambda c: F.floor(F.col(c) / 2)
    win = patches.select("slide_id", F.col("patch_id").alias("id"), (F.col("center_row") - half("h")).alias("y0"),
                         (F.col("center_col") - half("w")).alias("x0"), (F.col("center_row") + half("h")).alias("y1"),
                         (F.col("center_col") + half("w")).alias("x1"))
    j = bbox_overlap_join(win, boxes.withColumnRenamed("box_id", "id"), cell, ["cls"])
    return j.select(
        "slide_id", F.col("l_id").alias("patch_id"), F.col("r_id").alias("box_id"), F.col("r_cls").alias("cls"), (F.col("r_y0") - F.col("l_y0")).alias("y0"),
        (F.col("r_x0") - F.col("l_x0")).alias("x0"), (F.col("r_y1") - F.col("l_y0")).alias("y1"), (F.col("r_x1") - F.col("l_x0")).alias("x1"))


_BOX = ("y", "x", "h", "w")
PAIRS = 1 << 20  # candidate pairs that a task looks at a time


def _log2(c: str) -> Column:
    return F.length(F.bin(c)) - 1


def _on_grid(boxes: DataFrame, levels: list[int]) -> DataFrame:
    """A row per cell that a box touches on each of ``levels`` whose cells are not smaller than the box: at most four a level."""
    fits = F.filter(F.array(*[F.lit(v) for v in levels]), lambda v: v >= F.col("level"))
    df = boxes.withColumn("lv", F.explode(fits))
    for c, a, n in (("cy", "y", "h"), ("cx", "x", "w")):
        df = df.withColumn(c, F.explode(F.expr(f"sequence(shiftright({a}, lv), shiftright({a} + {n} - 1, lv))")))
    return df


def _neighbours(asks: DataFrame, targets: DataFrame, levels: list[int]) -> DataFrame:
    """For every overlapping pair, a row of either box with the rank of the other. A box is entered on the level of its size and looks
    itself up there and on coarser ones, so the larger box of a pair is always found."""
    t = _on_grid(targets, levels).where("lv = level").select("slide_id", "lv", "cy", "cx", *[F.col(c).alias(f"t_{c}") for c in (*_BOX, "id", "rank")])
    pairs = _on_grid(asks, levels).join(t, ["slide_id", "lv", "cy", "cx"]).where(
        "y < t_y + t_h AND t_y < y + h AND x < t_x + t_w AND t_x < x + w AND NOT (y = t_y AND x = t_x AND h = t_h AND w = t_w)")
    one = F.struct(*_BOX, "id", F.col("t_rank").alias("rank"))
    other = F.struct(*[F.col(f"t_{c}").alias(c) for c in (*_BOX, "id")], "rank")
    return pairs.select("slide_id", F.inline(F.array(one, other)))


def _union(df: DataFrame, keys: list, *more: Column) -> DataFrame:
    """The common bounding box of every group, with its smallest id."""
    top, west = F.min("y"), F.min("x")
    return df.groupBy("slide_id", *keys).agg(top.alias("y"), west.alias("x"), (F.max(F.col("y") + F.col("h")) - top).alias("h"),
                                             (F.max(F.col("x") + F.col("w")) - west).alias("w"), F.min("id").alias("id"), *more)


def _collapse(boxes: DataFrame) -> DataFrame:
    """Merge boxes whose sides agree to a power of two and whose corners lie closer than that: they overlap for sure. What is left is
    at most one box per cell, so that no place keeps many boxes of one shape."""
    cell = [F.expr(f"shiftright({a}, length(bin({n})) - 1)").alias(f"_{a}") for a, n in (("y", "h"), ("x", "w"))]
    merged = _union(boxes, [_log2("h").alias("_h"), _log2("w").alias("_w"), *cell], F.max("fresh").alias("fresh"), F.count(F.lit(1)).alias("_n"))
    return merged.select("slide_id", *_BOX, "id", (F.col("fresh") | (F.col("_n") > 1)).alias("fresh"))


def merge_corners(y: np.ndarray, x: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """For each box the smallest number of a box it ends up merged with; half-open integer boxes, merged until none overlap."""
    group = np.arange(len(y))
    while True:
        order = np.argsort(y, kind="stable")
        last = np.searchsorted(y[order], y[order] + h[order])  # boxes that begin before this one ends
        later = last - np.arange(len(order)) - 1
        done = np.concatenate([[0], np.cumsum(later)])
        a, b, i = [], [], 0
        while i < len(order):
            j = max(i + 1, int(np.searchsorted(done, done[i] + PAIRS, "right")) - 1)
            p = np.repeat(np.arange(i, j), later[i:j])
            q = np.arange(len(p)) - np.repeat(done[i:j] - done[i], later[i:j]) + p + 1
            p, q = order[p], order[q]
            near = (x[p] < x[q] + w[q]) & (x[q] < x[p] + w[p])
            a.append(p[near])
            b.append(q[near])
            i = j
        if not len(order) or not sum(map(len, a)):
            return group
        root = min_roots(np.concatenate(a), np.concatenate(b), len(y))
        kept, at = np.unique(root, return_inverse=True)
        low_y, low_x = (np.full(len(kept), np.iinfo(np.int64).max) for _ in "yx")
        top_y, top_x = (np.full(len(kept), np.iinfo(np.int64).min) for _ in "yx")
        np.minimum.at(low_y, at, y)
        np.minimum.at(low_x, at, x)
        np.maximum.at(top_y, at, y + h)
        np.maximum.at(top_x, at, x + w)
        group = at[group]
        y, x, h, w = low_y, low_x, top_y - low_y, top_x - low_x


def _merge_tile(t: pa.Table) -> pa.Table:
    """Boxes with their corners in one tile; after ``_collapse`` these are no more than its pixels."""
    y, x, h, w = (t.column(c).to_numpy() for c in _BOX)
    _, at, n = np.unique(merge_corners(y, x, h, w), return_inverse=True, return_counts=True)
    first = np.argsort(at, kind="stable")
    cut = np.cumsum(n) - n
    top, west = np.minimum.reduceat(y[first], cut), np.minimum.reduceat(x[first], cut)
    low, east = np.maximum.reduceat((y + h)[first], cut), np.maximum.reduceat((x + w)[first], cut)
    ids = t.column("id").take(pa.array(first))
    least = ids.to_numpy() if not ids.null_count and pa.types.is_integer(ids.type) else np.array(ids.to_pylist(), object)
    fresh = np.maximum.reduceat(t.column("fresh").to_numpy()[first], cut) | (n > 1)
    return pa.table({"slide_id": t.column("slide_id").take(pa.array(np.zeros(len(n), np.int64))), "y": top, "x": west, "h": low - top, "w": east - west,
                     "id": pa.array(np.minimum.reduceat(least, cut), ids.type), "fresh": fresh})


def merge_boxes(boxes: DataFrame, tile: int = 1024) -> DataFrame:
    """Replace overlapping integer boxes by their common bounding box until no two boxes of a slide overlap.
    ``box_id`` of a merged box is the smallest one in it; boxes without extent and without slide vanish.

    Each round is one job. Boxes with their corners in one tile are merged in a task; tiles shift from round to round. Across tiles
    a box meets the boxes it overlaps on a grid of as many levels as there are sizes, and joins the group of the lowest rank among
    them and itself. Ranks are hashes that change from round to round, so a chain of boxes breaks into groups everywhere at once.
    Boxes that met nothing are looked at again only next to boxes that did.
    """
    kinds = {c: boxes.schema[c].dataType.simpleString() for c in ("slide_id", "box_id", *_BOX)}
    start = boxes.where("h > 0 AND w > 0 AND slide_id IS NOT NULL").select("slide_id", F.col("box_id").alias("id"), *[F.col(c).cast("bigint").alias(c) for c in _BOX],
                                                                           F.lit(True).alias("fresh"))
    level = F.length(F.bin(F.greatest("h", "w") - 1)) * (F.greatest("h", "w") > 1).cast("int")
    bit = F.expr("shiftleft(1L, level)")
    seen = {"all": F.bit_or(bit), "new": F.bit_or(F.when(F.col("fresh"), bit)), "old": F.count_if(~F.col("fresh"))}

    def write(df: DataFrame, turn: int) -> Table:
        df = _collapse(df)
        shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        corner = [F.floor((F.col(c) + turn * (tile // 2)) / tile).alias(f"_{c}") for c in ("y", "x")]
        return Table(df.groupBy("slide_id", *corner).applyInArrow(_merge_tile, shape).withColumn("level", level), **seen)

    cur, turn = write(start, 0), 0
    while cur.metrics["new"]:
        bits = {k: [v for v in range(63) if (cur.metrics[k] or 0) >> v & 1] for k in ("all", "new")}
        ranked = cur.df.withColumn("rank", F.xxhash64(*_BOX, F.lit(turn)))
        fresh = ranked.where("fresh")
        met = _neighbours(fresh, ranked, bits["all"])
        if cur.metrics["old"]:
            met = met.unionByName(_neighbours(ranked.where("NOT fresh"), fresh, bits["new"]))
        led = (ranked.select("slide_id", *_BOX, "id", "rank").unionByName(met).groupBy("slide_id", *_BOX)
               .agg(F.min("id").alias("id"), F.min("rank").alias("rank"), (F.count(F.lit(1)) > 1).alias("fresh")))
        nxt = write(_union(led, ["rank"], F.max("fresh").alias("fresh")), turn + 1)
        cur.drop()
        cur, turn = nxt, turn + 1
    return cur.df.select("slide_id", F.col("id").cast(kinds["box_id"]).alias("box_id"), *[F.col(c).cast(kinds[c]).alias(c) for c in _BOX])


def gt_boxes(gt: DataFrame, spacing: float, overview_spacing: float = 8.0, tile: int = 512, padding: int = 1) -> DataFrame:
    """Merged boxes of the 4-connected regions of a ground truth given at the overview spacing, padded and
    scaled to ``spacing``."""
    comps = label_components(gt.where("label > 0").select("slide_id", "row", "col", F.lit(1).alias("label")), 4, tile)
    ratio = overview_spacing / spacing
    trunc = lambda c: (c * F.lit(ratio)).cast("int")
    b = component_stats(comps).select(
        "slide_id", F.col("comp").alias("box_id"), trunc(F.col("y0") - padding).alias("y"), trunc(F.col("x0") - padding).alias("x"),
        trunc(F.col("y1") - F.col("y0") + 2 * padding).alias("h"), trunc(F.col("x1") - F.col("x0") + 2 * padding).alias("w"))
    return merge_boxes(b)


# ---- detections ----
def inside_padding_filter(detections: DataFrame, mask: DataFrame, lost: tuple[int, int, int, int], tile: int) -> DataFrame:
    """Detections outside the lost border (left, right, top, bottom; its edges count as inside) whose
    truncated position has mask value 1."""
    left, right, top, bottom = lost
    inner = detections.where(~((F.col("x") < left) | (F.col("y") < top) | (F.col("x") > tile - right) | (F.col("y") > tile - bottom)))
    return point_in_mask(inner, mask).where("mask_label = 1").drop("mask_label")


def point_in_mask(detections: DataFrame, mask: DataFrame) -> DataFrame:
    """Mask label at the truncated (x, y) of each detection, 0 where nothing is stored."""
    m = mask.select("slide_id", F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("label").alias("_m"))
    return (detections.withColumn("_r", F.col("y").cast("int")).withColumn("_c", F.col("x").cast("int"))
            .join(m, ["slide_id", "_r", "_c"], "left").withColumn("mask_label", F.coalesce("_m", F.lit(0))).drop("_r", "_c", "_m"))


def detections_global(detections: DataFrame, lost: tuple[int, int, int, int]) -> DataFrame:
    """Tile-local detections in slide coordinates: (x, y, class)."""
    left, _, top, _ = lost
    return detections.select("slide_id", (F.col("x") + F.col("tile_x") - left).alias("x"),
                             (F.col("y") + F.col("tile_y") - top).alias("y"), "cls")


def score_threshold(detections: DataFrame, height: int, width: int, min_score: float = 0.6, half: int = 12) -> DataFrame:
    """Paint the class scores of accepted detections as boxes of 2 * half pixels around their integer centre;
    the detection with the highest index wins where boxes overlap. Unpainted pixels are not stored."""
    cy = F.floor((F.col("y0") + F.col("y1")) / 2).cast("int")
    cx = F.floor((F.col("x0") + F.col("x1")) / 2).cast("int")
    span = lambda c, end: F.sequence(F.greatest(F.col(c) - half, F.lit(0)), F.least(F.col(c) + half, F.lit(end)) - 1)
    d = (detections.where(F.col("score") >= min_score).withColumn("_cy", cy).withColumn("_cx", cx)
         .where(f"_cy + {half} > 0 AND _cy - {half} < {height} AND _cx + {half} > 0 AND _cx - {half} < {width}"))
    px = (d.withColumn("row", F.explode(span("_cy", height))).withColumn("col", F.explode(span("_cx", width))))
    return px.groupBy("slide_id", "row", "col").agg(F.max_by("scores", "idx").alias("scores"), F.max("idx").alias("idx"))


def _iou(box: np.ndarray, others: np.ndarray) -> np.ndarray:
    h = np.minimum(box[2], others[:, 2]) - np.maximum(box[0], others[:, 0])
    w = np.minimum(box[3], others[:, 3]) - np.maximum(box[1], others[:, 1])
    inter = np.clip(h, 0, None) * np.clip(w, 0, None)
    area = lambda b: (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1])
    return inter / (area(box) + area(others) - inter)


_CORNERS = ("y0", "x0", "y1", "x1")
WIDE = 16  # sides of its largest box that a cell of suppression spans


def _side(level: str, size: int) -> Column:
    return F.lit(float(size)) * F.pow(F.lit(2.0), F.col(level) + 1)


def _home(df: DataFrame, size: int, shift: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """The one cell of a box: on the level of its larger side, by its first corner."""
    out = df.withColumn("_at", F.col("_lv"))
    for c, a, s in (("_cy", "y0", shift[0]), ("_cx", "x0", shift[1])):
        out = out.withColumn(c, F.floor(F.col(a) / _side("_lv", size) + s))
    return out


def _reaching(df: DataFrame, iou: float, span: tuple[int, int], size: int, shift: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """A row per cell that may be home to a box overlapping this one by more than ``iou``. Such boxes have sides of at least ``iou`` times
    the other's, so levels are near, and first corners at most the rest of a side apart. ``_y``, ``_x`` hold the reach in each direction."""
    apart = int(np.ceil(np.log2(1 / iou) + 1e-9)) if iou > 0 else span[1] - span[0]
    out = df.drop("_at", "_cy", "_cx").withColumn(
        "_at", F.explode(F.sequence(F.greatest(F.col("_lv") - apart, F.lit(span[0])), F.least(F.col("_lv") + apart, F.lit(span[1])))))
    for c, r, s in (("_cy", "_y", shift[0]), ("_cx", "_x", shift[1])):
        side = _side("_at", size)
        low = F.floor((F.col(f"{r}.low") - _slack(iou) * _side("_at", 1)) / side + s)
        out = out.withColumn(c, F.explode(F.sequence(low, F.floor(F.col(f"{r}.high") / side + s))))
    return out


def _slack(iou: float) -> Column:
    return F.lit(1 - iou + 1e-6)


def _own_reach(iou: float) -> dict[str, Column]:
    return {r: F.struct(F.col(a).alias("low"), (F.col(a) + _slack(iou) * (F.col(b) - F.col(a))).alias("high")) for r, a, b in (("_y", "y0", "y1"), ("_x", "x0", "x1"))}


def _best_first():
    return [F.desc("conf"), F.asc_nulls_last("det_id"), F.asc("_row")]


def _begins(t: pa.Table, columns: list[str]) -> np.ndarray:
    """Where rows begin that differ from the one before in any of ``columns``; null equals null."""
    new = np.zeros(len(t), dtype=bool)
    new[:1] = True
    for c in columns:
        a, b = t[c].slice(1), t[c].slice(0, max(len(t) - 1, 0))
        new[1:] |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b))).to_numpy()
    return np.flatnonzero(new)


def _sure_in_cell(box: np.ndarray, own: np.ndarray, iou: float) -> list[int]:
    """Detections of a cell, best first, that surely stay. Boxes of other cells may or may not stay: what they overlap waits, unless a kept
    box overlaps it."""
    alive, sure, kept = np.ones(len(own), dtype=bool), own.copy(), []
    for i in range(int(np.flatnonzero(own)[-1]) + 1 if own.any() else 0):
        if not alive[i]:
            continue
        rest = np.flatnonzero(alive[i + 1:]) + i + 1
        over = rest[_iou(box[i], box[rest]) > iou]
        if sure[i]:
            kept.append(i)
            alive[over] = False
        else:
            sure[over] = False
    return kept


def _greedy_cells(cell: list[str], iou: float):
    """Works on rows sorted by cell, best first, and holds one cell at a time. Behind the first mark of a cell other boxes may be hidden,
    so nothing is decided there."""
    def decide(t: pa.Table, begin: np.ndarray) -> pa.Table:
        own, mark = t["_own"].to_numpy(), t["_mark"].to_numpy()
        box = np.stack([t[c].to_numpy() for c in _CORNERS], axis=1)
        end = np.r_[begin[1:], len(own)]
        kept = [int(i) for i in begin[end - begin == 1] if own[i]]
        for i, j in zip(begin, end):
            if j - i > 1:
                if mark[i:j].any():
                    j = i + int(mark[i:j].argmax())
                kept += [i + k for k in _sure_in_cell(box[i:j], own[i:j], iou)]
        return t.take(pa.array(kept, pa.int64())).drop_columns(["_own", "_mark"])

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            begin = _begins(t, cell)
            if len(begin) > 1:
                yield from decide(t.slice(0, begin[-1]), begin[:-1]).to_batches()
            held = t.slice(begin[-1]) if len(begin) else None
        if held is not None:
            yield from decide(held, np.array([0])).to_batches()
    return run


def nms(detections: DataFrame, keys: list[str], conf: float = 0.25, iou: float = 0.45, max_det: int = 1000,
        chunk: int = 2048) -> DataFrame:
    """Greedy non-maximum suppression per class: by falling confidence a detection ``(keys, det_id, cls, conf,
    y0, x0, y1, x1)`` stays unless it overlaps a kept one of its class by more than ``iou``; the ``max_det``
    best of a group stay. Of equal confidences the smaller ``det_id`` goes first, null last, then any order of equal rows. Null keys and
    null classes are groups of their own; a null or NaN confidence takes no part; a box without area or with a null or non-finite corner
    overlaps nothing.

    Rounds over all groups at once. A cell decides its ``chunk`` best open detections in one task, next to those of other cells that may
    overlap them; the grid moves from round to round, so that chains over borders come apart. What newly kept ones overlap then leaves,
    and so does all behind the ``max_det``-th kept one of its group. Neither a crowded place nor equal scores put more than ``chunk``
    detections of a cell into a task, and kept ones can't crowd. A very low ``iou`` costs copies over more levels of size.
    """
    if iou < 0:
        raise ValueError("iou must not be negative")
    group = list(dict.fromkeys([*keys, "cls"]))
    base = materialize(detections.where((F.col("conf") > conf) & ~F.isnan(F.col("conf").cast("double"))).withColumn("_row", F.monotonically_increasing_id()))
    names = list(dict.fromkeys([*group, "det_id", "conf", "_row"]))
    boxes = base.select(*names, *[F.col(c).cast("double").alias(c) for c in _CORNERS])
    finite = " AND ".join(f"coalesce(abs({c}) < double('infinity'), false)" for c in _CORNERS)
    plain = F.expr(f"{finite} AND y1 > y0 AND x1 > x0") & F.lit(iou < 1)
    longest = F.greatest(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    seen = {"n": F.count(F.lit(1)), "low": F.min("_lv"), "high": F.max("_lv")}
    open_ = Table(boxes.where(plain).withColumn("_lv", F.floor(F.log2(longest)).cast("int")), **seen)
    kept, total, turn = [boxes.where(~plain).select(*names)], 0, 0
    task_cols = [*names, *_CORNERS, "_lv", "_own", "_mark", "_at", "_cy", "_cx"]
    while open_.metrics["n"]:
        span = (open_.metrics["low"], open_.metrics["high"])
        shift = (turn % 2 * 0.5, turn // 2 % 2 * 0.5)
        cell = [*group, "_at", "_cy", "_cx"]
        head = (_home(open_.df, WIDE, shift).withColumn("_n", F.row_number().over(Window.partitionBy(*cell).orderBy(*_best_first())))
                .where(F.col("_n") <= chunk + 1).withColumn("_mark", F.col("_n") > chunk)
                .withColumn("_home", F.struct("_at", "_cy", "_cx")))
        for (r, own), c, s in zip(_own_reach(iou).items(), ("_cy", "_cx"), shift):
            low = (F.col(c) - s) * _side("_lv", WIDE)  # a mark stands for any box of its cell
            hidden = F.struct(low.alias("low"), (low + _side("_lv", WIDE) + _side("_lv", 1)).alias("high"))
            head = head.withColumn(r, F.when(F.col("_mark"), hidden).otherwise(own))
        seen_by = _reaching(head, iou, span, WIDE, shift).withColumn("_own", ~F.col("_mark") & (F.col("_home") == F.struct("_at", "_cy", "_cx"))).select(*task_cols)
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in seen_by.schema if f.name not in ("_own", "_mark"))
        by_cell = seen_by.repartition(*cell).sortWithinPartitions(*cell, *_best_first())
        new = Table(by_cell.mapInArrow(_greedy_cells(cell, iou), shape), n=F.count(F.lit(1)))
        kept.append(new.df.select(*names))
        total += new.metrics["n"]

        fine = _reaching(new.df.withColumns(_own_reach(iou)), iou, span, 1).select(*[F.col(c).alias(f"k_{c}") for c in (*cell, *_CORNERS)])
        h, w = (F.greatest(F.least(b, f"k_{b}") - F.greatest(a, f"k_{a}"), F.lit(0.0)) for a, b in (("y0", "y1"), ("x0", "x1")))
        area = F.expr("(y1 - y0) * (x1 - x0) + (k_y1 - k_y0) * (k_x1 - k_x0)")
        over = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in group] + [F.col(c) == F.col(f"k_{c}") for c in ("_at", "_cy", "_cx")])
        left = _home(open_.df, 1).join(fine, over & (h * w / (area - h * w) > iou), "left_anti").select(*open_.df.columns)
        if total >= max_det:  # a group may be complete
            done = _best(reduce(DataFrame.unionByName, kept), keys, max_det).where(F.col("_n") == max_det).select(
                *[F.col(k).alias(f"k_{k}") for k in keys], F.col("conf").alias("k_conf"))
            behind = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys], F.col("conf") < F.col("k_conf"))
            left = left.join(done, behind, "left_anti")
        nxt = Table(left, **seen)
        open_.drop()
        open_, turn = nxt, turn + 1
    best = _best(reduce(DataFrame.unionByName, kept), keys, max_det).select("_row")
    return base.join(best, "_row", "left_semi").select(*detections.columns)


def _best(kept: DataFrame, keys: list[str], max_det: int) -> DataFrame:
    return kept.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*_best_first()))).where(F.col("_n") <= max_det)
