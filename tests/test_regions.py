"""Components, morphology, boxes and outlines against brute force on small rasters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import boxes as B
from tessella.operators import components as C
from tessella.operators import graph, morphology as M
from tessella.operators import vector as V
from tessella.plans import reports as P

RNG = np.random.default_rng(5)
GRID = (RNG.random((2, 24, 30)) < 0.62).astype(int) * (1 + (RNG.random((2, 24, 30)) < 0.3))


def to_df(spark, grids):
    rows = [(s, int(r), int(c), int(g[r, c])) for s, g in enumerate(grids) for r in range(g.shape[0]) for c in range(g.shape[1])]
    return spark.createDataFrame(rows, "slide_id int, row int, col int, label int")


def frame(spark, grids):
    return spark.createDataFrame([(s, *map(int, g.shape)) for s, g in enumerate(grids)], "slide_id int, rows long, cols long")


def flood(grid, diag):
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diag else [])
    comp = {}
    for r, c in zip(*np.nonzero(grid)):
        if (r, c) in comp:
            continue
        todo, root = [(r, c)], (r << 32) + c
        comp[r, c] = root
        while todo:
            y, x = todo.pop()
            for dy, dx in steps:
                q = (y + dy, x + dx)
                if 0 <= q[0] < grid.shape[0] and 0 <= q[1] < grid.shape[1] and q not in comp and grid[q] == grid[r, c]:
                    comp[q] = root
                    todo.append(q)
    return comp


@pytest.mark.parametrize("connectivity,tile", [(4, 8), (8, 8), (4, 64), (8, 5)])
def test_components_match_flood_fill(spark, connectivity, tile):
    got = C.label_components(to_df(spark, GRID).where("label != 0"), connectivity, tile).collect()
    want = {(s, r, c): k for s, g in enumerate(GRID) for (r, c), k in flood(g, connectivity == 8).items()}
    assert {(x.slide_id, x.row, x.col): x.comp for x in got} == {k: int(v) for k, v in want.items()}


def test_distributed_contraction_equals_local(spark):
    n = 400
    edges = spark.createDataFrame([(0, int(a), int(b)) for a, b in RNG.integers(0, n, (330, 2))] + [(1, i, i + 1) for i in range(60)]
                                  + [(2, 0, i) for i in range(1, 50)], "slide_id int, a long, b long")
    a = {tuple(r) for r in graph.connected_roots(edges).collect()}
    b = {tuple(r) for r in graph.connected_roots(edges).collect()}
    assert a == b and (1, 60, 0) in b and (2, 49, 0) in b


def brute_dilate(g, k):
    out = np.zeros_like(g)
    for r, c in zip(*np.nonzero(g)):
        for y in range(g.shape[0]):
            for x in range(g.shape[1]):
                if abs(y - r) + abs(x - c) <= k:
                    out[y, x] = 1
    return out


def test_morphology_is_independent_of_tiles(spark):
    g = [(RNG.random((20, 17)) < 0.08).astype(int), (RNG.random((9, 21)) < 0.8).astype(int)]
    px, lv = to_df(spark, g), frame(spark, g)
    res = {}
    for tile in (4, 7, 64):
        res[tile] = [sorted(map(tuple, op(px, lv, 2, tile).select("slide_id", "row", "col").collect())) for op in (M.dilate_steps, M.erode_steps)]
    assert res[4] == res[7] == res[64]
    want = sorted((s, int(r), int(c)) for s, a in enumerate(g) for r, c in zip(*np.nonzero(brute_dilate(a, 2))))
    assert res[7][0] == want
    with pytest.raises(ValueError):
        M.iterations(0, 0.5)


def test_slides_keep_their_own_spacing(spark):
    g = np.zeros((13, 13), int)
    g[6, 6] = 1
    lv = frame(spark, [g, g, g]).withColumn("spacing", F.element_at(F.array(F.lit(0.5), F.lit(1.0), F.lit(8.0)), F.col("slide_id") + 1))
    n = {r.slide_id: r["count"] for r in M.dilate(to_df(spark, [g] * 3).where("label != 0"), lv, 2.0, tile=5).groupBy("slide_id").count().collect()}
    assert n == {0: 41, 1: 13, 2: 1}
    h = np.zeros((16, 16), int)
    h[1:4, 1:4] = 1
    h[6:14, 6:14] = 1
    h[9:11, 9:11] = 0
    grids, steps = [h, h], dict(min_diagonal=2.5, dilation=0.5, fill_diagonal=1.5, tile=5)
    px = to_df(spark, grids).select("slide_id", "row", "col", F.array(F.col("label") * 0.9).alias("probs"))
    lv = frame(spark, grids).withColumn("spacing", F.when(F.col("slide_id") == 0, 0.5).otherwise(1.0))
    for eps in (None, 1.0):
        key = lambda df: sorted(map(str, df.collect()))
        both = key(P.postprocess_chain(px, lv, 0, outline_epsilon=eps, **steps))
        alone = [key(P.postprocess_chain(px.where(f"slide_id = {s}"), lv.where(f"slide_id = {s}"), 0, outline_epsilon=eps, **steps)) for s in (0, 1)]
        assert both == sorted(alone[0] + alone[1]) and len(alone[0]) != len(alone[1])


def test_relabel_limits_follow_each_slide(spark):
    g = np.full((8, 8), 2)
    g[3:6, 3:6] = 1
    lv = frame(spark, [g, g]).withColumn("spacing", F.when(F.col("slide_id") == 0, 0.5).otherwise(1.0))
    out = C.relabel_majority(to_df(spark, [g, g]), lv, {1: 3.0}, tile=4).where("label = 1").groupBy("slide_id").count().collect()
    assert [tuple(r) for r in out] == [(1, 9)]


@pytest.mark.parametrize("diameter", [4, 5, 7])
def test_disc_sum_floors_the_radius(spark, diameter):
    g = (RNG.random((11, 14)) < 0.3).astype(int)
    got = {(r.row, r.col): r.total for r in M.disc_sum(to_df(spark, [g]).where("label != 0"), frame(spark, [g]), diameter, tile=6).collect()}
    want = {}
    for r in range(11):
        for c in range(14):
            n = sum(int(g[y, x]) for y in range(11) for x in range(14) if np.hypot(y - r, x - c) < diameter // 2)
            if n:
                want[r, c] = n
    assert got == want


def test_fill_holes_counts_border_holes(spark):
    g = np.ones((8, 8), int)
    g[0, 0] = g[3, 3] = 0
    g[5:8, 5:8] = 0
    out = C.fill_holes(to_df(spark, [g]).where("label != 0"), frame(spark, [g]), 2.0, fill_value=4, tile=3)
    filled = {(r.row, r.col) for r in out.where("label = 4").collect()}
    assert filled == {(0, 0), (3, 3)}


def test_relabel_majority_uses_neighbours(spark):
    g = np.full((10, 10), 2)
    g[4:6, 4:6] = 1
    g[0, :] = 3
    out = C.relabel_majority(to_df(spark, [g]), frame(spark, [g]), {1: 4.0}, 1.0, tile=4)
    got = {(r.row, r.col): r.label for r in out.collect()}
    assert all(got[r, c] == (3 if r == 0 else 2) for r in range(10) for c in range(10))


def brute_merge(boxes):
    boxes = [list(b) for b in boxes]
    while True:
        for i in range(len(boxes)):
            for j in range(i + 1, len(boxes)):
                a, b = boxes[i], boxes[j]
                if max(a[0], b[0]) < min(a[0] + a[2], b[0] + b[2]) and max(a[1], b[1]) < min(a[1] + a[3], b[1] + b[3]):
                    y, x = min(a[0], b[0]), min(a[1], b[1])
                    boxes[i] = [y, x, max(a[0] + a[2], b[0] + b[2]) - y, max(a[1] + a[3], b[1] + b[3]) - x]
                    del boxes[j]
                    break
            else:
                continue
            break
        else:
            return {tuple(b) for b in boxes}


@pytest.mark.parametrize("kind", ["small", "mixed", "chain", "lines"])
def test_merge_boxes(spark, kind):
    rng = np.random.default_rng(len(kind))
    if kind == "small":
        raw = [(*rng.integers(0, 90, 2), *rng.integers(1, 12, 2)) for _ in range(70)] + [(3, 3, 2, 2), (3, 3, 2, 2), (3, 5, 2, 2)]
    elif kind == "mixed":  # sizes of many levels, negative places, a box 100,000 pixels high
        raw = [(*rng.integers(-3000, 3000, 2), *(2 ** rng.integers(0, 9, 2) + rng.integers(0, 3, 2))) for _ in range(150)] + [(-50_000, 4000, 100_000, 3), (20_000, 3999, 5, 2)]
    elif kind == "chain":  # each box meets the next one only
        raw = [(3 * i, 3 * i, 4, 4) for i in range(120)] + [(5000 + 4 * i, 0, 4, 4) for i in range(20)]
    else:  # thin boxes that cross
        raw = [(10 * i, 0, 1, 300) for i in range(20)] + [(500 + 7 * i, 0, 1, 300) for i in range(20)] + [(400, 10 * i, 300, 1) for i in range(20)]
    raw = [tuple(map(int, b)) for b in raw]
    df = spark.createDataFrame([(0, i, *b) for i, b in enumerate(raw)] + [(1, 7, 0, 0, 5, 5), (1, 8, 0, 0, 0, 5), (None, 9, 0, 0, 5, 5)],
                               "slide_id int, box_id long, y int, x int, h int, w int")
    found = B.merge_boxes(df)
    assert found.schema.simpleString() == df.schema.simpleString()
    rows = found.collect()
    assert {(r.y, r.x, r.h, r.w) for r in rows if r.slide_id == 0} == brute_merge(raw)
    for r in rows:
        inside = [i for i, b in enumerate(raw) if b[0] >= r.y and b[1] >= r.x and b[0] + b[2] <= r.y + r.h and b[1] + b[3] <= r.x + r.w]
        assert r.box_id == (min(inside) if r.slide_id == 0 else 7)
    assert B.merge_boxes(df.where("false")).count() == 0


def brute_fill(g, limit, diag):
    comp, out = flood((g == 0).astype(int), diag), g.copy()
    for root in set(comp.values()):
        at = np.array([p for p, k in comp.items() if k == root])
        h, w = at.max(0) - at.min(0) + 1
        if np.hypot(h, w) <= limit:
            out[tuple(at.T)] = 5
    return out


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("limit,tile", [(2.5, 6), (7.0, 3), (14.0, 5), (100.0, 4)])
def test_fill_holes_brute(spark, limit, tile, connectivity):
    rng = np.random.default_rng(3)
    dense = (rng.random((23, 31)) < 0.6).astype(int)
    ring = np.zeros((17, 19), int)  # empty tiles inside and outside of a ring, closed but for a diagonal step
    ring[1, 2:16] = ring[14, 2:16] = ring[2:14, 1] = ring[2:14, 16] = 2
    full, nothing = np.ones((9, 9), int), np.zeros((9, 8), int)
    grids = [dense, ring, full, nothing]
    px = to_df(spark, grids).where("label != 0")
    want = [brute_fill(g, limit, connectivity == 8) for g in grids]
    got = [np.zeros_like(g) for g in grids]
    rows = C.fill_holes(px, frame(spark, grids), limit, connectivity, fill_value=5, tile=tile).collect()
    for r in rows:
        got[r.slide_id][r.row, r.col] = r.label
    assert len(rows) == sum(int((g != 0).sum()) for g in want)
    assert all((a == b).all() for a, b in zip(got, want))


def test_fill_holes_spacing_and_stored_background(spark):
    g = np.ones((6, 6), int)
    g[2:4, 2] = 0
    g[5, 5] = 3
    px = to_df(spark, [g, g, g]).withColumn("label", F.when(F.col("slide_id") * 100 + F.col("row") * 10 + F.col("col") == 45, None).otherwise(F.col("label")))
    spacings = spark.createDataFrame([(0, 1.0), (1, 4.0)], "slide_id int, spacing double")  # the third slide has none
    out = C.fill_holes(px, frame(spark, [g, g, g]), 3.0, foreground=[1], fill_value=9, tile=4, spacings=spacings)
    rows = {(r.slide_id, r.row, r.col): r.label for r in out.collect()}
    assert len(rows) == out.count() == 108
    assert {k for k, v in rows.items() if v == 9} == {(0, 2, 2), (0, 3, 2), (0, 5, 5), (0, 4, 5)}
    assert rows[1, 2, 2] == 0 and rows[2, 2, 2] == 0 and rows[1, 5, 5] == 3


def brute_nms(rows, conf, iou, top):
    kept = []
    for d in sorted((r for r in rows if r[3] > conf), key=lambda r: (-r[3], r[1])):
        def over(k):
            h, w = min(k[6], d[6]) - max(k[4], d[4]), min(k[7], d[7]) - max(k[5], d[5])
            inter = max(h, 0) * max(w, 0)
            area = lambda b: (b[6] - b[4]) * (b[7] - b[5])
            return k[2] == d[2] and inter / (area(k) + area(d) - inter) > iou
        if not any(over(k) for k in kept):
            kept.append(d)
    return {k[1] for k in kept[:top]}


@pytest.mark.parametrize("chunk,top", [(20_000, 1000), (25, 1000), (25, 12)])
def test_nms(spark, chunk, top):
    rows = []
    for i in range(140):
        y, x, s = (float(v) for v in RNG.integers(0, 40, 3))
        rows.append((0, i, "ab"[i % 2], float(RNG.random()), y, x, y + 6 + s / 10, x + 6 + s / 10))
    df = spark.createDataFrame(rows, "slide_id int, det_id long, cls string, conf double, y0 double, x0 double, y1 double, x1 double")
    got = {r.det_id for r in B.nms(df, ["slide_id"], 0.25, 0.45, top, chunk).collect()}
    assert got == brute_nms(rows, 0.25, 0.45, top)


@pytest.mark.parametrize("chunk,top", [(2048, 1000), (40, 1000), (40, 30)])
def test_nms_crowds_sizes_and_ties(spark, chunk, top):
    rng, rows = np.random.default_rng(8), []
    for i in range(700):  # a third in one place, a chain over many cells, sizes from 1 to 300, many equal scores
        y, x = map(float, rng.integers(0, 4, 2) if i % 3 == 0 else rng.integers(0, 900, 2))
        s = float(2.0 ** rng.integers(0, 9) * (1 + rng.random() / 5))
        if i % 3 == 1:
            y, x, s = 40.0, 3.0 * i, 10.0
        rows.append((int(i % 2), i, None if i % 5 == 0 else "b", round(0.2 + 0.8 * float(rng.random()), 1) if i % 3 != 1 else 0.9 - i / 1000, y, x, y + s, x + s))
    df = spark.createDataFrame(rows, "slide_id int, det_id long, cls string, conf double, y0 double, x0 double, y1 double, x1 double")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(batch)
    spark.conf.set(batch, "7")  # cells lie across batches
    got = {r.det_id for r in B.nms(df, ["slide_id"], 0.25, 0.45, top, chunk).collect()}
    spark.conf.set(batch, usual)
    assert got == {i for s in (0, 1) for i in brute_nms([r for r in rows if r[0] == s], 0.25, 0.45, top)}


def test_nms_odd_rows(spark):
    box = (0.0, 0.0, 4.0, 4.0)
    rows = [(None, 1, 0, 0.9, *box), (None, 1, 0, 0.9, *box), (None, 2, 0, 0.8, *box), (0, 3, None, 0.8, *box), (0, 4, None, 0.8, *box), (0, None, None, 0.8, *box),
            (0, 5, 1, None, *box), (0, 6, 1, float("nan"), *box), (0, 7, 1, 0.9, 0.0, 0.0, 0.0, 9.0), (0, 8, 1, 0.9, None, 0.0, 9.0, 9.0),
            (0, 9, 1, 0.9, 0.0, 0.0, float("inf"), 9.0), (0, 10, 1, 0.2, *box)]
    df = spark.createDataFrame(rows, "slide_id int, det_id long, cls int, conf double, y0 double, x0 double, y1 double, x1 double").selectExpr("*", "det_id AS rank", "1 AS _x")
    out = B.nms(df, ["slide_id"])
    assert out.columns == df.columns
    assert sorted((r.slide_id is None, r.det_id) for r in out.collect()) == [(False, 3), (False, 7), (False, 8), (False, 9), (True, 1)]
    assert {r.det_id for r in B.nms(df, ["slide_id"], iou=1.0).collect()} == {1, 2, 3, 4, None, 7, 8, 9}
    assert B.nms(df.where("false"), ["slide_id"]).count() == 0


def test_outline_paths_agree_and_dots(spark):
    g = np.zeros((12, 12), int)
    g[2:9, 3:8] = 1
    g[4, 5] = 0          # a hole does not show in the outline
    g[11, 11] = 1        # a single pixel becomes a dot
    px = to_df(spark, [g])
    small = V.outline(px, 0.5, None, True, 1.0, 5).collect()
    large = V.outline(px, 0.5, None, True, 1.0, 5, local_points=0).collect()
    key = lambda rows: {(r.comp, r.type, tuple((p.y, p.x) for p in r.coords)) for r in rows}
    assert key(small) == key(large)
    kinds = {r.type: r for r in small}
    assert set(kinds) == {"dot", "polygon"} and abs(kinds["dot"].coords[0].y - 5.5) < 0.6
    assert V.outline(px, 0.5, None, False, 1.0, 5).count() == 1


def test_outline_round_trip_on_noise(spark):
    g = (RNG.random((15, 15)) < 0.55).astype(int)
    o = V.outline(to_df(spark, [g]), 1.0, {"g": [1]}, True, 0.0, 6)
    back = V.rasterize(V.shift_annotations(o.withColumn("ann_id", F.col("comp")), 0.5, 0.5), frame(spark, [g]))
    got = np.zeros_like(g)
    for r in back.collect():
        got[r.row, r.col] = 1
    want = np.zeros_like(g)
    comps = flood(g, False)
    for root in set(comps.values()):  # each region alone, with what it encloses
        one = np.zeros_like(g)
        for at, k in comps.items():
            one[at] = k == root
        outside = flood(np.pad(1 - one, 1, constant_values=1), False)
        want |= np.array([[outside.get((r + 1, c + 1)) != outside[0, 0] for c in range(15)] for r in range(15)]).astype(int)
    assert (got == want).all()
