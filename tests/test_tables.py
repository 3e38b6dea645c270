"""Scans, splits, levels, metrics and paths on small tables."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.functions import arrays as A
from tessella.functions import colour
from tessella.functions import paths as P
from tessella.functions.ranking import prefix_scan, shuffled_rank
from tessella.operators import augment as G
from tessella.operators import levels as L
from tessella.operators import metrics as M
from tessella.operators import raster as R
from tessella.operators import splits as S
from tessella.operators import tiling as T


def test_prefix_scan_equals_plain_window(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("k"), (F.col("id") * 37 % 101).alias("v"))
    got = prefix_scan(df, ["k"], ["id"], F.floor(F.col("id") / 64), "rn", {"s": ("sum", "v"), "m": ("min", "v", "before"), "l": ("last", "v", "before")})
    w = Window.partitionBy("k").orderBy("id")
    up, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("id", "k", "v", F.row_number().over(w).cast("long").alias("rn"), F.sum("v").over(up).alias("s"),
                     F.min("v").over(before).alias("m"), F.lag("v").over(w).alias("l"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_shuffled_rank_does_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("k"))
    a = shuffled_rank(df.repartition(3), ["k"], ["id"], 7).collect()
    b = shuffled_rank(df.repartition(11), ["k"], ["id"], 7).collect()
    assert {tuple(r) for r in a} == {tuple(r) for r in b}
    assert sorted(r.rn for r in a if r.k == 0) == list(range(1, 251))


def test_distribute_population_rules(spark):
    def bins(rows):
        return spark.createDataFrame(rows, "g int, bin int, ratio double, lo long, hi long, population long")
    out = S.distribute_population(bins([(0, 0, 0.5, 0, 10, 10), (0, 1, 0.5, 0, 2, 10), (1, 0, 0.9, 0, 7, 7), (1, 1, 0.05, 1, 7, 7), (1, 2, 0.05, 1, 7, 7)]), ["g"], 3).collect()
    n = {(r.g, r.bin): r.n for r in out}
    assert n[0, 0] == 8 and n[0, 1] == 2 and sum(n[1, i] for i in range(3)) == 7 and n[1, 1] >= 1 and n[1, 2] >= 1
    for bad in ([(0, 0, 0.6, 0, 9, 5), (0, 1, 0.6, 0, 9, 5)], [(0, 0, 0.5, 4, 9, 5), (0, 1, 0.5, 4, 9, 5)], [(0, 0, 0.5, 0, 1, 5), (0, 1, 0.5, 0, 1, 5)]):
        with pytest.raises(Exception, match="ratios|minimums|maximums"):
            S.distribute_population(bins(bad), ["g"], 3).collect()


def test_level_tolerance_edges(spark):
    lv = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "slide_id int, level int, spacing double")
    req = spark.createDataFrame([(0, 1.25), (0, 1.3), (0, 1.5), (0, 2.5)], "slide_id int, req_spacing double")
    got = {r.req_spacing: r.level for r in L.resolve_level(req, lv, 0.25).collect()}
    assert got == {1.25: 0, 1.3: None, 1.5: 1, 2.5: 1}


def test_lut_above_top_is_an_error(spark):
    px = spark.createDataFrame([(0, 0, 0, 9)], "slide_id int, row int, col int, label int")
    with pytest.raises(Exception, match="label above"):
        R.map_labels_lut(px, {1: 1}).collect()
    with pytest.raises(ValueError):
        R.raster_arithmetic(px, px, "/")


def test_dice_of_absent_labels_is_null(spark):
    px = spark.createDataFrame([(0, 0, 0, 1)], "slide_id int, row int, col int, label int")
    row = M.dice_jaccard(px, px, 5, 5).first()
    assert row.dice is None and row.jaccard is None


def test_paths(spark):
    rows = [("/a//b/./c/../d.tar.gz",), ("x/../../y",), ("/..",), (".hidden",)]
    df = spark.createDataFrame(rows, "p string")
    got = [tuple(r) for r in df.select(P.norm_path(F.col("p")), P.extension(F.col("p")), P.stem(F.col("p"))).collect()]
    assert got == [("/a/b/d.tar.gz", ".gz", "d.tar"), ("../y", "", "y"), ("/", "", ".."), (".hidden", "", ".hidden")]
    with pytest.raises(Exception, match="unknown path tag"):
        df.select(P.fill_template(F.lit("{root}/x"), {"images": "i"})).collect()


def test_rotations_and_flips_match_numpy(spark):
    a = np.arange(2 * 4 * 4).reshape(4, 4, 2)
    df = spark.createDataFrame([(0, a.ravel().tolist())], "patch_id int, px array<int>")
    for k in range(4):
        assert df.select(A.rot90("px", 4, k, 2)).first()[0] == np.rot90(a, k).ravel().tolist()
    assert df.select(A.flip("px", 4, 4, "both", 2)).first()[0] == a[::-1, ::-1].ravel().tolist()
    assert df.select(A.to_channels_first("px", 4, 4, 2)).first()[0] == a.transpose(2, 0, 1).ravel().tolist()


def test_augmentation_is_stable_and_identity_holds(spark):
    px = np.random.default_rng(1).random((6, 48)).tolist()
    df = spark.createDataFrame([(i, p, [j % 3 for j in range(16)]) for i, p in enumerate(px)], "patch_id int, px array<double>, labels array<int>")
    pool = [{"random_order": True, "augmenters": [("noise", {"sigma": (0.01, 0.1)}, 0.7), ("hsb", {"sigma": [(-0.2, 0.2)] * 3}, 0.7), ("elastic", {"alpha": (1.0, 2.0), "sigma": (1.0, 1.0), "map_count": 3}, 0.5)]}]
    runs = [sorted((r.patch_id, tuple(r.px)) for r in G.augment_pool(df.repartition(n), (4, 4, 3), pool, 9).collect()) for n in (1, 4)]
    assert runs[0] == runs[1]
    same = G.augment(df, (4, 4, 3), "scale", {"factor": (1.0, 1.0)}, 1).orderBy("patch_id").collect()
    assert all(np.allclose(r.px, p) for r, p in zip(same, px))
    img = np.random.default_rng(2).random((3, 5, 3))
    assert np.allclose(colour.hsv_to_rgb(colour.rgb_to_hsv(img)), img)
    assert np.allclose(colour.HED_FROM_RGB @ colour.RGB_FROM_HED, np.eye(3))


def test_grid_needs_room(spark):
    lv = spark.createDataFrame([(0, 20, 30)], "slide_id int, rows long, cols long")
    with pytest.raises(ValueError):
        T.tile_grid(lv, 8, (4, 4, 0, 0))


def test_stitching_covers_every_pixel_once_cropped(spark):
    lv = spark.createDataFrame([(0, 23, 31)], "slide_id int, rows long, cols long")
    px = spark.createDataFrame([(0, r, c, r * 100 + c) for r in range(23) for c in range(31)], "slide_id int, row int, col int, v int")
    out = T.classify_tiled(px, lv, ["v"], T.Processor(lambda b: b), 1, 9, (2, 1, 1, 3), output_class=0).collect()
    assert {(r.row, r.col, int(r.prob)) for r in out} == {(r, c, r * 100 + c) for r in range(23) for c in range(31)}


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 3, None if i % 5 == 0 else i) for i in range(200)], "id long, k int, v long")
    got = prefix_scan(df, ["k"], ["v", "id"], F.floor(F.col("v") / 16), "rn", {"s": ("sum", "v")})
    w = Window.partitionBy("k").orderBy("v", "id")
    want = df.select("id", "k", "v", F.row_number().over(w).cast("long").alias("rn"), F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    items = spark.createDataFrame([(i, None if i % 4 == 0 else "abc"[i % 3]) for i in range(40)], "item_id long, category string")
    out = S.split_purposes(items, {"training": 0.7, "validation": 0.3}, 3).collect()
    assert len(out) == 40 and {r.purpose for r in out if r.category is None} == {"training", "validation"}


def test_evaluate_with_boxes_keeps_slides_without_boxes(spark):
    from tessella.plans.reports import evaluate
    px = spark.createDataFrame([(s, r, 0, 1 + r % 2) for s in (1, 2) for r in range(4)], "slide_id int, row int, col int, label int")
    boxes = spark.createDataFrame([(1, 0, 0, 0, 2, 2)], "slide_id int, box_id long, y int, x int, h int, w int")
    got = evaluate(px, px, {1: 1, 2: 2}, [1, 2], boxes=boxes).collect()
    assert {(r.slide_id, r.label) for r in got} == {(s, k) for s in (1, 2, None) for k in (1, 2)}
    assert {r.slide_id: r.f1 for r in got} == {1: 1.0, 2: 0.0, None: 1.0}


def test_annotations_without_names_spread_and_lone_groups_stay(spark, tmp_path):
    from tessella.sources import annotations as A
    rows = [(1, None, "polygon", None, "#000000", [(float(i), 0.0)]) for i in range(40)]
    ann = spark.createDataFrame(rows, "slide_id int, name string, type string, grp string, colour string, coords array<struct<y:double,x:double>>")
    groups = spark.createDataFrame([(1, "g", None, "#111111"), (2, "h", None, "#222222")], "slide_id int, grp string, parent string, colour string")
    path = str(tmp_path / "xml")
    A.write_annotations(ann, groups, path, part_rows=10)
    back = A.read_annotations(spark, path)
    assert back.count() == 40 and back.select(F.explode("coords.y").alias("y")).distinct().count() == 40
    assert {(r.slide_id, r.grp) for r in A.read_annotation_groups(spark, path).collect()} == {(1, "g"), (2, "h")}
    assert spark.read.text(path).select("part").where("slide_id = 1").distinct().count() > 1


def paste_tiles(image, tile, lost, interp, model, mode, mask, mask_class, hard, factor):
    """Tile by tile in order, each kept part over what earlier tiles left there."""
    rows, cols, n_ch = image.shape
    total = [a + b for a, b in zip(lost, interp)]
    sy, sx = tile - total[2] - total[3], tile - total[0] - total[1]
    wide = np.pad(image, ((tile, 2 * tile), (tile, 2 * tile), (0, 0)), **({"mode": "reflect"} if mode == "reflect" else {}))
    out = None
    for y in range(-total[2], rows, sy):
        for x in range(-total[0], cols, sx):
            ry, rx = y + total[2], x + total[0]
            if ry > rows or rx > cols:
                continue
            if mask is not None and not (mask[ry:ry + sy, rx:rx + sx] == mask_class).any():
                continue
            bottom, right = total[3], total[1]
            if y >= 0 and y + tile >= rows and ry + tile - total[2] - lost[3] >= rows:
                bottom = ry + tile - total[2] - rows
            if x >= 0 and x + tile >= cols and rx + tile - total[0] - lost[1] >= cols:
                right = rx + tile - total[0] - cols
            res = model(wide[None, y + tile:y + 2 * tile, x + tile:x + 2 * tile])
            res = res.argmax(-1)[..., None] + 1.0 if hard else res
            res = T.rescale(res, factor)[0]
            if res.shape[0] != tile:
                res = np.pad(res, ((lost[2], lost[3]), (lost[0], lost[1]), (0, 0)))
            kept = res[total[2]:tile - bottom, total[0]:tile - right]
            out = np.full((rows, cols, res.shape[-1]), np.nan) if out is None else out
            kept = kept[:max(0, rows - ry), :max(0, cols - rx)]
            out[ry:ry + kept.shape[0], rx:rx + kept.shape[1]] = kept
    return out if mask is None else out * (mask > 0)[..., None]


@pytest.mark.parametrize(("mode", "interp", "factor", "masked", "hard"), [
    ("constant", (0, 0, 0, 0), 1, False, False), ("constant", (1, 2, 2, 1), 1, False, False), ("reflect", (2, 1, 1, 3), 1, False, True),
    ("constant", (1, 2, 1, 2), 2, False, False), ("reflect", (1, 1, 1, 1), 2, True, False), ("constant", (0, 3, 0, 4), 1, True, False)])
def test_tiled_scoring_equals_pasting_tile_by_tile(spark, mode, interp, factor, masked, hard):
    rng = np.random.default_rng(len(mode) + sum(interp) + factor)
    tile, lost = 14, (2, 2, 1, 1)
    image = rng.integers(1, 200, (23, 31, 2)).astype(float)
    mask = (rng.random((23, 31)) < 0.1).astype(int) * 2 if masked else None
    if masked:
        mask[:, 20:] = 0
        mask[3, 4] = 1
        mask[15:, :9] = 1

    def model(b):
        b = np.concatenate([b, b.sum(-1, keepdims=True) / 3], -1)
        if factor == 1:
            return b
        valid = b[:, lost[2]:tile - lost[3], lost[0]:tile - lost[1]]
        n, h, w, c = valid.shape
        return valid.reshape(n, h // 2, 2, w // 2, 2, c).mean((2, 4))

    want = paste_tiles(image, tile, lost, interp, model, mode, mask, 1, hard, (factor, factor))
    px = spark.createDataFrame([(s, r, c, *map(float, image[r, c])) for s in (0, 1) for r in range(23) for c in range(31)], "slide_id int, row int, col int, a double, b double")
    lv = spark.createDataFrame([(0, 23, 31), (1, 23, 31)], "slide_id int, rows int, cols int")
    m = spark.createDataFrame([(s, r, c, int(mask[r, c])) for s in (0, 1) for r in range(23) for c in range(31)], "slide_id int, row int, col int, label int") if masked else None
    got = T.classify_tiled(px, lv, ["a", "b"], T.Processor(model), 3, tile, lost, m, 1, mode, None, 3, interp, (factor, factor), hard).collect()
    seen = {(r.slide_id, r.row, r.col): r.probs for r in got}
    assert len(seen) == len(got)
    for s in (0, 1):
        for r in range(23):
            for c in range(31):
                if np.isnan(want[r, c]).any():
                    assert (s, r, c) not in seen
                else:
                    assert np.allclose(seen[s, r, c], want[r, c])


def test_tiled_scoring_shuffles_pixels_once(spark):
    px = spark.createDataFrame([(0, 1, 1, 1.0)], "slide_id int, row int, col int, v double")
    lv = spark.createDataFrame([(0, 9, 9)], "slide_id int, rows int, cols int")
    plan = T.classify_tiled(px, lv, ["v"], T.Processor(lambda b: b), 1, 8, (1, 1, 1, 1))._jdf.queryExecution().executedPlan().toString()
    after = plan[:plan.index("FlatMapGroupsInArrow")]
    assert "Exchange" not in after and "collect_list" not in plan
