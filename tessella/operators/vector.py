"""Polygon annotations: rasterising, outlining, simplification and editing.

Annotations are ``(slide_id, ann_id, name, type, grp, coords array<struct<y, x>>)``; groups are
``(slide_id, grp, parent)``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import prefix_scan
from ..session import Table, materialize
from .components import label_components
from .morphology import disc_spans, disc_close
from .raster import PIXEL, literal_map
from .tiles import map_tiles

# Least and largest number of coordinates per annotation type.
ARITY = {"dot": (1, 1), "polygon": (3, None), "spline": (3, None), "points": (1, None), "measurement": (2, 2),
         "rectangle": (4, 4)}
_POINT = "struct<y: double, x: double>"


# ---- small column operators ----
def shift_annotations(annotations: DataFrame, vertical: float, horizontal: float) -> DataFrame:
    return annotations.withColumn("coords", F.transform("coords", lambda c: F.struct(
        (c["y"] + vertical).alias("y"), (c["x"] + horizontal).alias("x"))))


def rescale_levels(annotations: DataFrame, input_level: int, offset: int, output_level: int) -> DataFrame:
    """Coordinates times 2^(input level + offset - output level)."""
    f = float(2.0 ** (input_level + offset - output_level))
    return annotations.withColumn("coords", F.transform("coords", lambda c: F.struct((c["y"] * f).alias("y"), (c["x"] * f).alias("x"))))


def annotation_counts(annotations: DataFrame) -> DataFrame:
    """Annotations per group; the null group is the root."""
    return annotations.groupBy("slide_id", "grp").agg(F.count(F.lit(1)).alias("n"))


def annotation_bboxes(annotations: DataFrame, factor: int) -> DataFrame:
    """[ymin, xmin, ymax, xmax] of the truncated coordinates, floor-divided by ``factor``."""
    edge = lambda fn, k: F.floor(fn(F.transform("coords", lambda c: c[k].cast("bigint"))) / factor).alias(
        f"{k}{'min' if fn is F.array_min else 'max'}")
    return annotations.select("slide_id", "ann_id", "grp", edge(F.array_min, "y"), edge(F.array_min, "x"),
                              edge(F.array_max, "y"), edge(F.array_max, "x"))


def unknown_groups(annotations: DataFrame, mapped: list[str]) -> DataFrame:
    return annotations.where("grp IS NOT NULL").select("slide_id", "grp").distinct().where(~F.col("grp").isin(mapped))


def strict_check(annotations: DataFrame, groups: DataFrame, mapped: list[str] | None, strict: bool,
                 accept_empty: bool = False) -> DataFrame:
    """Problems per slide: 'empty' when no annotation falls in the mapped groups, 'unknown' with the group
    when strict mode meets a group outside the map."""
    known = F.lit(True) if mapped is None else F.coalesce(F.col("grp").isin(mapped), F.lit(False))
    n = annotations.groupBy("slide_id").agg(F.count_if(known).alias("_n"))
    slides = annotations.select("slide_id").union(groups.select("slide_id")).distinct()
    empty = slides.join(n, "slide_id", "left").where(F.coalesce("_n", F.lit(0)) == 0).select(
        "slide_id", F.lit("empty").alias("problem"), F.lit(None).cast("string").alias("grp"))
    out = empty.where(F.lit(not accept_empty))
    if strict and mapped is not None:
        out = out.unionByName(groups.where(~F.col("grp").isin(mapped)).select("slide_id", F.lit("unknown").alias("problem"), "grp"))
    return out


def validate_annotations(annotations: DataFrame, groups: DataFrame) -> DataFrame:
    """Violations: unknown type, wrong coordinate count for the type, group that the slide does not define."""
    n, t = F.size("coords"), F.col("type")
    least = literal_map({k: v[0] for k, v in ARITY.items()})[t]
    most = literal_map({k: v[1] if v[1] is not None else (1 << 31) - 1 for k, v in ARITY.items()})[t]
    known = groups.select("slide_id", "grp", F.lit(True).alias("_known")).distinct()
    a = annotations.join(known, ["slide_id", "grp"], "left")
    problem = (F.when(least.isNull(), "unknown type").when((n < least) | (n > most), "coordinate count")
               .when(F.col("grp").isNotNull() & F.col("_known").isNull(), "unknown group"))
    return a.select("slide_id", "ann_id", problem.alias("problem")).where("problem IS NOT NULL")


# ---- editing ----
def add_annotations(annotations: DataFrame, groups: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append rows; an unnamed one is called 'Annotation {n}' by its position in the slide, and a group that
    the slide lacks is created at the root."""
    have = annotations.groupBy("slide_id").agg(F.count(F.lit(1)).alias("_have"))
    r = prefix_scan(new, ["slide_id"], ["ann_id"], F.floor(F.col("ann_id") / 100_000), "_rn")
    at = F.coalesce("_have", F.lit(0)) + F.col("_rn") - 1
    named = r.join(have, "slide_id", "left").withColumn(
        "name", F.coalesce("name", F.concat(F.lit("Annotation "), at.cast("string")))).select(annotations.columns)
    fresh = new.where("grp IS NOT NULL").select("slide_id", "grp").distinct().join(groups, ["slide_id", "grp"], "left_anti")
    return (annotations.unionByName(named),
            groups.unionByName(fresh.withColumn("parent", F.lit(None).cast("string"))))


def prune_groups(annotations: DataFrame, groups: DataFrame, candidates: DataFrame) -> DataFrame:
    """Remove the candidate groups ``(slide_id, grp)`` that hold no annotation and no group, then test their
    parents, level by level."""
    used = annotations.where("grp IS NOT NULL").select("slide_id", "grp").distinct()
    left, todo = materialize(groups), candidates
    while True:
        parents = left.where("parent IS NOT NULL").select("slide_id", F.col("parent").alias("grp")).distinct()
        empty = Table(left.join(todo.distinct(), ["slide_id", "grp"], "left_semi")
                      .join(used, ["slide_id", "grp"], "left_anti").join(parents, ["slide_id", "grp"], "left_anti"),
                      n=F.count(F.lit(1)))
        if not empty.metrics["n"]:
            return left
        left = materialize(left.join(empty.df.select("slide_id", "grp"), ["slide_id", "grp"], "left_anti"))
        todo = empty.df.where("parent IS NOT NULL").select("slide_id", F.col("parent").alias("grp"))


def join_group(annotations: DataFrame, groups: DataFrame, moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move annotations ``(slide_id, ann_id, to_grp)``: missing target groups are created, groups left empty
    are pruned upward."""
    j = annotations.join(moves.withColumn("_m", F.lit(True)), ["slide_id", "ann_id"], "left")
    moved = j.withColumn("grp", F.when(F.col("_m"), F.col("to_grp")).otherwise(F.col("grp"))).select(annotations.columns)
    old = annotations.join(moves, ["slide_id", "ann_id"], "left_semi").where("grp IS NOT NULL").select("slide_id", "grp")
    fresh = moves.where("to_grp IS NOT NULL").select("slide_id", F.col("to_grp").alias("grp")).distinct().join(
        groups, ["slide_id", "grp"], "left_anti")
    grown = groups.unionByName(fresh.withColumn("parent", F.lit(None).cast("string")))
    return moved, prune_groups(moved, grown, old)


def remove_annotations(annotations: DataFrame, groups: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop annotations ``(slide_id, ann_id)`` and prune groups left empty."""
    kept = annotations.join(gone, ["slide_id", "ann_id"], "left_anti")
    old = annotations.join(gone, ["slide_id", "ann_id"], "left_semi").where("grp IS NOT NULL").select("slide_id", "grp")
    return kept, prune_groups(kept, groups, old)


def group_descendants(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """The listed groups ``(slide_id, grp)`` and everything below them."""
    frontier = Table(groups.join(roots, ["slide_id", "grp"], "left_semi").select("slide_id", "grp"), n=F.count(F.lit(1)))
    found = [frontier.df]
    while frontier.metrics["n"]:
        up = found[-1].withColumnRenamed("grp", "parent")
        seen = reduce(DataFrame.unionByName, found)
        frontier = Table(groups.join(up, ["slide_id", "parent"], "left_semi").select("slide_id", "grp")
                         .join(seen, ["slide_id", "grp"], "left_anti"), n=F.count(F.lit(1)))
        found.append(frontier.df)
    return reduce(DataFrame.unionByName, found)


def remove_groups(annotations: DataFrame, groups: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop groups with their sub-groups and annotations; parents left empty are pruned."""
    all_gone = materialize(group_descendants(groups, gone))
    kept = annotations.join(all_gone, ["slide_id", "grp"], "left_anti")
    rest = groups.join(all_gone, ["slide_id", "grp"], "left_anti")
    parents = groups.join(all_gone, ["slide_id", "grp"], "left_semi").where("parent IS NOT NULL").select(
        "slide_id", F.col("parent").alias("grp"))
    return kept, prune_groups(kept, rest, parents)


# ---- polygons to labels ----
def rasterize(annotations: DataFrame, levels: DataFrame, spacing: float | None = None,
              label_map: dict[str, int] | None = None, order: list[str] | None = None) -> DataFrame:
    """Labels of the pixels whose centre (row + 0.5, col + 0.5) lies inside a polygon (even-odd rule).

    Without a map every group gets label 1; groups later in ``order`` overwrite earlier ones. Each edge is
    expanded to the rows it crosses, crossings are paired along the row and the spans filled, so the work is
    spread by (annotation, row).
    """
    if label_map is not None and order is not None and set(label_map) != set(order):
        raise ValueError("label map and conversion order name different groups")
    if label_map is not None:
        ranks = {g: i for i, g in enumerate(order or label_map)}
        a = (annotations.where(F.col("grp").isin(list(label_map)))
             .withColumn("label", literal_map(label_map)[F.col("grp")]).withColumn("_rank", literal_map(ranks)[F.col("grp")]))
    else:
        a = annotations.where("grp IS NOT NULL").withColumn("label", F.lit(1)).withColumn("_rank", F.lit(0))
    s = spacing or 1.0
    ring = (a.where(F.size("coords") >= 3)
            .select("slide_id", "ann_id", "label", "_rank", "coords", F.posexplode("coords").alias("_i", "p"))
            .withColumn("q", F.expr("coords[(_i + 1) % size(coords)]")).drop("coords"))
    y1, y2, x1, x2 = F.col("p.y") / s, F.col("q.y") / s, F.col("p.x") / s, F.col("q.x") / s
    size = levels.select("slide_id", F.col("rows").cast("int").alias("rows"), F.col("cols").cast("int").alias("cols"))
    edges = (ring.select("slide_id", "ann_id", "label", "_rank", y1.alias("y1"), y2.alias("y2"), x1.alias("x1"), x2.alias("x2"))
             .where("y1 != y2").join(size, "slide_id")
             .withColumn("_a", F.greatest(F.ceil(F.least("y1", "y2") - 0.5), F.lit(0)).cast("int"))
             .withColumn("_b", F.least(F.ceil(F.greatest("y1", "y2") - 0.5) - 1, F.col("rows") - 1).cast("int"))
             .where("_a <= _b"))
    hits = (edges.withColumn("row", F.explode(F.sequence("_a", "_b")))
            .withColumn("_x", F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))))
    w = Window.partitionBy("slide_id", "ann_id", "row").orderBy("_x")
    spans = (hits.withColumn("_n", F.row_number().over(w)).withColumn("_end", F.lead("_x").over(w)).where("_n % 2 = 1")
             .withColumn("_a", F.greatest(F.ceil(F.col("_x") - 0.5), F.lit(0)).cast("int"))
             .withColumn("_b", F.least(F.ceil(F.col("_end") - 0.5) - 1, F.col("cols") - 1).cast("int")).where("_a <= _b"))
    return (spans.select("slide_id", "row", "label", "_rank", F.explode(F.sequence("_a", "_b")).alias("col"))
            .groupBy(*PIXEL).agg(F.max_by("label", "_rank").alias("label")))


# ---- labels to polygons ----
def _cell_segments() -> dict[int, list[tuple[tuple[int, int], tuple[int, int]]]]:
    """Directed boundary steps in a cell of 2 x 2 pixels, by which pixels are set (bit 0 top left, 1 top
    right, 2 bottom left, 3 bottom right). Points are cell-side midpoints in half pixels from the top left
    pixel; the set side always lies on the same hand. Diagonal pairs count as connected."""
    corner = [(0, 0), (0, 2), (2, 0), (2, 2)]
    side = {(0, 1): (0, 1), (0, 2): (1, 0), (1, 3): (1, 2), (2, 3): (2, 1)}
    out = {}
    for code in range(1, 15):
        on = [bool(code >> k & 1) for k in range(4)]
        if code in (6, 9):  # two set pixels on a diagonal: cut off each unset corner
            lone = [k for k in range(4) if not on[k]]
            cuts = [([m for e, m in side.items() if k in e], k, False) for k in lone]
        else:
            cuts = [([m for (i, j), m in side.items() if on[i] != on[j]], on.index(True), True)]
        segs = []
        for (p, q), k, is_set in cuts:
            cross = (q[0] - p[0]) * (corner[k][1] - p[1]) - (q[1] - p[1]) * (corner[k][0] - p[0])
            segs.append((p, q) if (cross > 0) == is_set else (q, p))
        out[code] = segs
    return out


def _segments_literal():
    entries = []
    for code, segs in _cell_segments().items():
        arr = F.array(*[F.struct(F.lit(p[0]).alias("y"), F.lit(p[1]).alias("x"), F.lit(q[0]).alias("ny"), F.lit(q[1]).alias("nx")) for p, q in segs])
        entries += [F.lit(code), arr]
    return F.create_map(*entries)


def boundary_segments(comps: DataFrame) -> DataFrame:
    """Directed contour steps ``(slide_id, comp, node, next)`` of each region. A node codes its position in
    half pixels, shifted by 2, as y * 2^32 + x; every node has one successor."""
    cell = F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(bit).alias("bit"))
                               for dr, dc, bit in ((0, 0, 1), (0, -1, 2), (-1, 0, 4), (-1, -1, 8))]))
    cells = (comps.select("slide_id", "comp", "row", "col", cell.alias("k"))
             .groupBy("slide_id", "comp", (F.col("row") + F.col("k.dr")).alias("r"), (F.col("col") + F.col("k.dc")).alias("c"))
             .agg(F.bit_or("k.bit").alias("code")).where("code < 15"))
    s = cells.select("slide_id", "comp", "r", "c", F.explode(_segments_literal()[F.col("code")]).alias("s"))
    node = lambda y, x: (F.shiftleft((F.col("r") * 2 + F.col(y) + 2).cast("bigint"), 32) + F.col("c") * 2 + F.col(x) + 2)
    return s.select("slide_id", "comp", node("s.y", "s.x").alias("node"), node("s.ny", "s.nx").alias("next"))


def _xy(code):
    return (code >> 32) / 2.0 - 1.0, (code & 0xFFFFFFFF) / 2.0 - 1.0


def _line_distance(y, x, y0, x0, y1, x1):
    dy, dx = y1 - y0, x1 - x0
    length = np.hypot(dy, dx)
    if length == 0:
        return np.hypot(y - y0, x - x0)
    return np.abs(dy * (x - x0) - dx * (y - y0)) / length


def rdp_mask(y: np.ndarray, x: np.ndarray, epsilon: float) -> np.ndarray:
    """Which points of a line stay: split at the farthest point while it lies more than epsilon away."""
    keep = np.zeros(len(y), dtype=bool)
    if len(y) == 0:
        return keep
    keep[0] = keep[-1] = True
    todo = [(0, len(y) - 1)]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        d = _line_distance(y[lo + 1:hi], x[lo + 1:hi], y[lo], x[lo], y[hi], x[hi])
        k = int(np.argmax(d))
        if d[k] > epsilon:
            keep[lo + 1 + k] = True
            todo += [(lo, lo + 1 + k), (lo + 1 + k, hi)]
    return keep


def rdp_simplify(annotations: DataFrame, epsilon: float) -> DataFrame:
    """Simplify every coordinate list, in Arrow batches; a missing list becomes empty."""
    @F.arrow_udf("array<struct<y: double, x: double>>")
    def run(coords: pa.Array) -> pa.Array:
        points, size = coords.flatten(), coords.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        y, x = (points.field(c).to_numpy(zero_copy_only=False) for c in ("y", "x"))
        end = np.concatenate([[0], np.cumsum(size)])
        keep = np.zeros(len(y), dtype=bool)
        for lo, hi in zip(end[:-1], end[1:]):
            keep[lo:hi] = rdp_mask(y[lo:hi], x[lo:hi], epsilon)
        at = np.concatenate([[0], np.cumsum(keep)])[end]
        kept = pa.StructArray.from_arrays([pa.array(y[keep]), pa.array(x[keep])], ["y", "x"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), kept)
    return annotations.withColumn("coords", run("coords"))


def _trace_small(segments: DataFrame, epsilon: float) -> DataFrame:
    """Outer ring of each region, followed from its first node and simplified, one region per group."""
    kind = segments.schema["slide_id"].dataType.simpleString()

    def run(key, pdf):
        node = pdf["node"].to_numpy()
        order = np.argsort(node)
        node, nxt = node[order], pdf["next"].to_numpy()[order]
        succ = np.searchsorted(node, nxt)
        ring, at = [0], succ[0]
        while at != 0:
            ring.append(at)
            at = succ[at]
        ring.append(0)
        y, x = _xy(node[np.array(ring)])
        m = rdp_mask(y, x, epsilon)
        return pd.DataFrame({"slide_id": key[0], "comp": key[1], "pos": np.nonzero(m)[0], "y": y[m], "x": x[m]})
    return segments.groupBy("slide_id", "comp").applyInPandas(run, f"slide_id {kind}, comp bigint, pos bigint, y double, x double")


def _rank_rings(segments: DataFrame) -> DataFrame:
    """Position along the outer ring by pointer jumping: distances to the ring's end double every round."""
    ring = ["slide_id", "comp"]
    first = segments.groupBy(*ring).agg(F.min("node").alias("start"), F.count(F.lit(1)).alias("size"))
    cur = Table(segments.join(first, ring).select(
        *ring, "node", "size", F.when(F.col("next") != F.col("start"), F.col("next")).alias("next"), F.lit(1).cast("bigint").alias("dist")),
        longest=F.max("size"))
    rounds = int(cur.metrics["longest"] or 1).bit_length() + 1
    for _ in range(rounds):
        ahead = cur.df.select(*ring, F.col("node").alias("next"), F.col("next").alias("_next"), F.col("dist").alias("_dist"))
        nxt = Table(cur.df.join(ahead.hint("merge"), [*ring, "next"], "left").select(
            *ring, "node", "size", F.col("_next").alias("next"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist")))
        cur.drop()
        cur = nxt
    done = cur.df.where("next IS NULL")  # steps of inner rings never reach the end
    total = done.groupBy(*ring).agg(F.max("dist").alias("n"))
    pts = done.join(total, ring)
    y, x = F.shiftright("node", 32) / 2.0 - 1.0, F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)) / 2.0 - 1.0
    pts = pts.select(*ring, (F.col("n") - F.col("dist")).alias("pos"), "n", y.alias("y"), x.alias("x"))
    closing = pts.where("pos = 0").select(*ring, F.col("n").alias("pos"), "n", "y", "x")
    return pts.unionByName(closing)


def _simplify_rounds(points: DataFrame, epsilon: float) -> DataFrame:
    """Line simplification over all rings at once: each round finds the farthest point of every open interval
    with a map-side aggregate and splits there. Intervals within epsilon close."""
    ring = ["slide_id", "comp"]
    base = materialize(points)
    kept = [base.where("pos = 0 OR pos = n").select(*ring, "pos", "y", "x")]
    ends = base.where("pos = 0").select(*ring, F.lit(0).cast("bigint").alias("lo"), F.col("n").alias("hi"),
                                        F.col("y").alias("y0"), F.col("x").alias("x0"), F.col("y").alias("y1"), F.col("x").alias("x1"))
    cur = Table(base.where("pos > 0 AND pos < n").join(ends, ring).select(*ring, "pos", "y", "x", "lo", "hi", "y0", "x0", "y1", "x1"), n=F.count(F.lit(1)))
    while cur.metrics["n"]:
        dy, dx = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
        length = F.sqrt(dy * dy + dx * dx)
        py, px = F.col("y") - F.col("y0"), F.col("x") - F.col("x0")
        d = F.when(length == 0, F.sqrt(py * py + px * px)).otherwise(F.abs(dy * px - dx * py) / F.greatest(length, F.lit(1e-300)))
        far = (cur.df.groupBy(*ring, "lo").agg(F.max(F.struct(d.alias("d"), (-F.col("pos")).alias("k"), "y", "x")).alias("f"))
               .where(F.col("f.d") > epsilon).select(*ring, "lo", (-F.col("f.k")).alias("k"), F.col("f.y").alias("ky"), F.col("f.x").alias("kx")))
        split = Table(far)
        kept.append(split.df.select(*ring, F.col("k").alias("pos"), F.col("ky").alias("y"), F.col("kx").alias("x")))
        left = F.col("pos") < F.col("k")
        pick = lambda a, b, n: F.when(left, F.col(a)).otherwise(F.col(b)).alias(n)
        nxt = Table(cur.df.join(split.df.hint("merge"), [*ring, "lo"]).where("pos != k").select(
            *ring, "pos", "y", "x", pick("lo", "k", "lo"), pick("k", "hi", "hi"), pick("y0", "ky", "y0"), pick("x0", "kx", "x0"),
            pick("ky", "y1", "y1"), pick("kx", "x1", "x1")), n=F.count(F.lit(1)))
        cur.drop()
        cur = nxt
    return reduce(DataFrame.unionByName, kept)


def outline_points(comps: DataFrame, epsilon: float = 1.0, local_points: int = 50_000) -> DataFrame:
    """Simplified outer contour ``(slide_id, comp, pos, y, x)`` of every region; the first point is repeated
    at the end. Regions whose contours have at most ``local_points`` steps are traced inside tasks, larger
    ones by list ranking and round-wise simplification over the cluster."""
    segs = materialize(boundary_segments(comps))
    size = materialize(segs.groupBy("slide_id", "comp").agg(F.count(F.lit(1)).alias("n")))
    big = Table(size.where(F.col("n") > local_points).select("slide_id", "comp"), n=F.count(F.lit(1)))
    if not big.metrics["n"]:
        return _trace_small(segs, epsilon)
    small = _trace_small(segs.join(big.df, ["slide_id", "comp"], "left_anti"), epsilon)
    return small.unionByName(_simplify_rounds(_rank_rings(segs.join(big.df, ["slide_id", "comp"], "left_semi")), epsilon))


def outline(px: DataFrame, spacing: float | None = 1.0, label_map: dict[str, list[int]] | None = None,
            single_points: bool = False, epsilon: float = 1.0, tile: int = 512, local_points: int = 50_000,
            spacings: DataFrame | None = None) -> DataFrame:
    """Regions as annotations: per group the 4-connected regions of its labels become polygons; a contour of
    fewer than three points becomes a dot at their mean, kept only with ``single_points``. Without a map all
    non-zero labels form one group without name. Coordinates are multiplied by ``spacing``, or without it by the
    spacing of each slide in ``spacings`` (slide_id, spacing)."""
    if spacing is None and spacings is None:
        raise ValueError("give one spacing or one per slide")
    parts = []
    for name, labels in (label_map or {None: None}).items():
        fg = F.col("label").isin(labels) if labels is not None else F.col("label") != 0
        comps = label_components(px.where(fg).select(*PIXEL, F.lit(1).alias("label")), 4, tile)
        pts = outline_points(comps, epsilon, local_points)
        poly = pts.groupBy("slide_id", "comp").agg(F.sort_array(F.collect_list(F.struct("pos", "y", "x"))).alias("_p"))
        if spacing is None:
            poly = poly.join(spacings.select("slide_id", F.col("spacing").alias("_s")), "slide_id", "left")
        else:
            poly = poly.withColumn("_s", F.lit(float(spacing)))
        mean = lambda k: F.aggregate("_p", F.lit(0.0), lambda acc, p: acc + p[k]) / F.size("_p") * F.col("_s")
        dot = F.array(F.struct(mean("y").alias("y"), mean("x").alias("x")))
        full = F.transform("_p", lambda p: F.struct((p["y"] * F.col("_s")).alias("y"), (p["x"] * F.col("_s")).alias("x")))
        is_dot = F.size("_p") < 3
        out = poly.select("slide_id", "comp", F.lit(name).cast("string").alias("grp"),
                          F.when(is_dot, "dot").otherwise("polygon").alias("type"),
                          F.when(is_dot, dot).otherwise(full).alias("coords"))
        parts.append(out if single_points else out.where("type = 'polygon'"))
    return reduce(DataFrame.unionByName, parts)


def hull_outline(px: DataFrame, levels: DataFrame, label: int, alpha: float, min_size: int, input_level: int = 0,
                 output_level: int = 0, level_offset: int = 0, epsilon: float = 1.0, tile: int = 512) -> DataFrame:
    """Concave outline of the pixels of one label. The alpha shape of lattice points is approximated by a
    closing with a disc of radius 1 / alpha, whose regions are outlined and rescaled to the output level."""
    from .components import remove_small_objects
    cleaned = remove_small_objects(px, min_size).where(F.col("label") == label)
    spans, reach = disc_spans(1.0 / alpha)
    closed = map_tiles(cleaned.withColumn("label", F.lit(1)), levels, lambda g, inside, _: disc_close(g != 0, spans).astype(np.int64),
                       "label", "label", "int", tile, 2 * reach)
    return rescale_levels(outline(closed, 1.0, None, False, epsilon, tile), input_level, level_offset, output_level)
