"""Tiled scoring, stitching, streaming."""

import math

import numpy as np
from pyspark.sql import functions as F

from ..fixtures import levels, patches, table, view, with_views
from ..functions import arrays as A
from ..operators import history as H
from ..operators import splits as S
from ..operators import tiling as T
from ..registry import query
from ..session import scratch_path
from ..streaming import stitch as ST

TILE = 16
LOST = (2, 3, 1, 2)


def level0(spark, d):
    return levels(spark, d).where("level = 0")


def label(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", "label")


def _grid_sql(tile=TILE, lost=LOST, stride=None):
    left, right, top, bottom = lost
    sx, sy = stride or tile - left - right, stride or tile - top - bottom

    def axis(v, lo, hi):
        return f"""greatest({v}, 0) AS tile_{v}, {v} + {lo} AS result_{v}, CASE WHEN {v} < 0 THEN -{v} ELSE 0 END AS lo_{v},
 CASE WHEN {v} >= 0 AND {v} + {tile} >= 50 THEN {v} + {tile} - 50 ELSE 0 END AS hi_{v},
 CASE WHEN {v} >= 0 AND {v} + {tile} >= 50 AND {v} + {tile} - {hi} >= 50 THEN {v} + {tile} - 50 ELSE {hi} END AS crop_{v}"""
    nx = len([v for v in range(-left, 50, sx) if v + left <= 50])
    return f"""grid AS (SELECT slide_id, CAST(iy * {nx} + ix AS BIGINT) AS seq, CAST(tile_y AS INT) AS tile_y, CAST(tile_x AS INT) AS tile_x,
 CAST({tile} - lo_y - hi_y AS INT) AS h, CAST({tile} - lo_x - hi_x AS INT) AS w, CAST(result_y AS INT) AS result_y, CAST(result_x AS INT) AS result_x,
 CAST(lo_y AS INT) AS pad_top, CAST(hi_y AS INT) AS pad_bottom, CAST(lo_x AS INT) AS pad_left, CAST(hi_x AS INT) AS pad_right,
 {top} AS crop_top, CAST(crop_y AS INT) AS crop_bottom, {left} AS crop_left, CAST(crop_x AS INT) AS crop_right FROM
 (SELECT slide_id, iy, ix, {axis('y', top, bottom)}, {axis('x', left, right)} FROM slides,
  (SELECT row_number() OVER (ORDER BY y) - 1 AS iy, y FROM (SELECT unnest(range(-{top}, 50, {sy})) AS y) WHERE y + {top} <= 50),
  (SELECT row_number() OVER (ORDER BY x) - 1 AS ix, x FROM (SELECT unnest(range(-{left}, 50, {sx})) AS x) WHERE x + {left} <= 50)))"""


SL = with_views("slides").rstrip() + ",\n"


@query("tile_grid", SL + _grid_sql() + " SELECT * FROM grid")
def _(spark, d):
    return T.tile_grid(level0(spark, d), TILE, LOST)


@query("tile_grid_half", SL + _grid_sql(TILE, (0, 0, 0, 0), TILE // 2) + " SELECT * FROM grid")
def _(spark, d):
    return T.tile_grid_half(level0(spark, d), TILE)


@query("skip_tiles_semi", with_views("slides", "px").rstrip() + ",\n" + _grid_sql() + f""" SELECT slide_id, seq, result_y, result_x FROM grid g WHERE EXISTS
 (SELECT 1 FROM px WHERE px.slide_id = g.slide_id AND label = 1 AND px.row >= g.result_y AND px.row < g.result_y + {TILE - LOST[2] - LOST[3]}
  AND px.col >= g.result_x AND px.col < g.result_x + {TILE - LOST[0] - LOST[1]})""")
def _(spark, d):
    return T.skip_tiles(T.tile_grid(level0(spark, d), TILE, LOST), label(spark, d), 1, TILE, LOST).select("slide_id", "seq", "result_y", "result_x")


@query("tiles_fully_covered", with_views("px", "slides") + """SELECT slide_id, CAST(4 * r AS INT) AS tile_y, CAST(4 * c AS INT) AS tile_x FROM
 (SELECT slide_id, row // 4 AS r, col // 4 AS c, count_if(label > 0) AS n FROM px GROUP BY ALL)
 WHERE n = CASE WHEN r = 12 THEN 2 ELSE 4 END * CASE WHEN c = 12 THEN 2 ELSE 4 END""")
def _(spark, d):
    return T.tiles_fully_covered(T.tile_grid(level0(spark, d), 4), label(spark, d), 4).select("slide_id", "tile_y", "tile_x")


W = np.array([[0.02, -0.01, 0.005], [0.01, 0.015, -0.02], [-0.02, 0.01, 0.01]])
BIAS = np.array([0.1, -0.2, 0.3])
_z = [" + ".join(f"({W[i, k]}::DOUBLE) * {c}" for i, c in enumerate("rgb")) + f" + ({BIAS[k]}::DOUBLE)" for k in range(3)]
_soft = f"""z AS (SELECT slide_id, row, col, exp({_z[0]}) AS e0, exp({_z[1]}) AS e1, exp({_z[2]}) AS e2 FROM rgb)"""


def scorer():
    return T.Processor(T.linear_softmax(W, BIAS))


def rgb(spark, d):
    return view(spark, d, "rgb")


@query("score_tiles", with_views("rgb").rstrip() + f",\n{_soft} SELECT slide_id, row, col, round(e0 / (e0 + e1 + e2), 6) AS p0, round(e2 / (e0 + e1 + e2), 6) AS p2 FROM z")
def _(spark, d):
    out = T.classify_tiled(rgb(spark, d), level0(spark, d), ["r", "g", "b"], scorer(), 3, TILE, LOST)
    px = rgb(spark, d).select("slide_id", "row", "col")
    out = out.join(px, ["slide_id", "row", "col"], "left_semi")  # the last slide may be cut short
    return out.select("slide_id", "row", "col", F.round(F.col("probs")[0], 6).alias("p0"), F.round(F.col("probs")[2], 6).alias("p2"))


@query("crop_and_mask", with_views("rgb", "px").rstrip() + f",\n{_soft} SELECT slide_id, row, col, round(CASE WHEN label = 1 THEN e1 / (e0 + e1 + e2) ELSE 0 END, 6)::DOUBLE AS prob FROM z JOIN px USING (slide_id, row, col) WHERE label = 1")
def _(spark, d):
    mask = label(spark, d).where("label = 1")
    out = T.classify_tiled(rgb(spark, d), level0(spark, d), ["r", "g", "b"], scorer(), 3, TILE, LOST, mask, 1, output_class=1)
    return out.where("prob > 0").withColumn("prob", F.round("prob", 6))


@query("stitch_tiles", with_views("rgb") + "SELECT slide_id, row, col, r::DOUBLE AS r, g::DOUBLE AS g FROM rgb")
def _(spark, d):
    """Tiling and stitching with a scorer that returns its input gives the raster back."""
    out = T.classify_tiled(rgb(spark, d), level0(spark, d), ["r", "g"], T.Processor(lambda b: b), 2, TILE, (1, 1, 1, 1))
    out = out.join(rgb(spark, d).select("slide_id", "row", "col"), ["slide_id", "row", "col"], "left_semi")
    return out.select("slide_id", "row", "col", F.col("probs")[0].alias("r"), F.col("probs")[1].alias("g"))


@query("classify_tiled", with_views("rgb").rstrip() + f",\n{_soft} SELECT slide_id, row, col, round(e1 / (e0 + e1 + e2), 6) AS prob FROM z")
def _(spark, d):
    """Reflect padding and eight-fold augmentation; a scorer that looks at single pixels is unaffected by both."""
    out = T.classify_tiled(rgb(spark, d), level0(spark, d), ["r", "g", "b"], T.tta_processor(scorer()), 3, TILE, LOST, pad_mode="reflect", output_class=1)
    out = out.join(rgb(spark, d).select("slide_id", "row", "col"), ["slide_id", "row", "col"], "left_semi")
    return out.withColumn("prob", F.round("prob", 6))


@query("plugin_surface", with_views("rgb") + "SELECT slide_id, row, col, round((r / 255.0::DOUBLE) * 0.5 + 0.25, 6) AS v FROM rgb")
def _(spark, d):
    T.register_processor("half", lambda b: b * 0.5, preprocess=lambda b: b / 255.0, postprocess=lambda b: b + 0.25)
    out = T.classify_tiled(rgb(spark, d), level0(spark, d), ["r"], "half", 1, TILE)
    out = out.join(rgb(spark, d).select("slide_id", "row", "col"), ["slide_id", "row", "col"], "left_semi")
    return out.select("slide_id", "row", "col", F.round(F.col("probs")[0], 6).alias("v"))


def _bw(i):
    return f"(CASE WHEN {i} < 8 THEN {i} ELSE 15 - {i} END)"


_a, _b = _bw("(row - ty)"), _bw("(col - tx)")
_w = f"least({_a}, {_b}) / (least({_a}, {_b}) + least(7 - {_a}, {_b}) + least({_a}, 7 - {_b}) + least(7 - {_a}, 7 - {_b}))::DOUBLE"


@query("blend_tiles", with_views("rgb") + f"""SELECT slide_id, row, col, round(1 - sum((1 - r / 255.0::DOUBLE) * ({_w})), 6) AS value FROM
 (SELECT *, (row // 8 - dy) * 8 AS ty, (col // 8 - dx) * 8 AS tx FROM rgb, (SELECT unnest([0, 1]) AS dy), (SELECT unnest([0, 1]) AS dx)) WHERE ty >= 0 AND tx >= 0 GROUP BY ALL""")
def _(spark, d):
    lv = level0(spark, d)
    t = T.read_tiles(rgb(spark, d), T.tile_grid_half(lv, 16), lv, 16, ["r"], stride=8).withColumn("values", A.squash("r"))
    out = T.blend_tiles(t, lv, 16)
    out = out.join(rgb(spark, d).select("slide_id", "row", "col"), ["slide_id", "row", "col"], "left_semi")
    return out.withColumn("value", F.round("value", 6))


_G = math.exp(sum(math.log((k + 1) / 8) for k in range(8)) / 8)


@query("tta_gmean", with_views("patches") + f"SELECT patch_id, CAST(i AS INT) AS i, round((px[i + 1] + 1) / 256.0::DOUBLE * {_G}::DOUBLE, 6) AS prob FROM patches, (SELECT unnest(range(64)) AS i)")
def _(spark, d):
    """Eight flipped and rotated variants of each patch, scaled by 1/8 .. 8/8, come back to one mean."""
    p = patches(spark, d).withColumn("p", F.transform("px", lambda v: (v + 1) / F.lit(256.0)))
    p = p.select("patch_id", "p", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("aug"))
    p = p.withColumn("f", A.flip("p", 8, 8, F.when(F.col("aug") >= 4, "horizontal").otherwise("none")))
    p = p.withColumn("probs", A.rot90("f", 8, F.col("aug") % 4)).withColumn("probs", F.transform("probs", lambda v: v * (F.col("aug") + 1) / 8))
    return T.tta_gmean(p.select("patch_id", "aug", "probs"), 8, ["patch_id"]).withColumn("prob", F.round("prob", 6))


@query("tile_batches", SL + _grid_sql() + " SELECT slide_id, seq, seq // 6 AS batch, seq % 6 AS slot FROM grid")
def _(spark, d):
    return S.tile_batches(T.tile_grid(level0(spark, d), TILE, LOST), 6).select("slide_id", "seq", "batch", "slot")


@query("reorder_stream", with_views("stream") + """, a AS (SELECT * FROM stream WHERE arrival < 9000)
SELECT slide_id, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY seq) - 1 AS p FROM a) WHERE seq = p""")
def _(spark, d):
    return S.reorder_stream(view(spark, d, "stream").where("arrival < 9000")).select("slide_id", "seq", "value")


# ---- streaming ----
def stream_source(spark, d, parts=4):
    """The tile messages as files in arrival order, with one closing message per slide, read as a stream."""
    s = view(spark, d, "stream").select("slide_id", "seq", "value", "arrival")
    ends = s.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n_final"))
    none = lambda t: F.lit(None).cast(t)
    rows = s.select("slide_id", "seq", "value", none("bigint").alias("n_final"), F.floor(F.col("arrival") * parts / 10007).alias("part")).unionByName(
        ends.select("slide_id", none("bigint").alias("seq"), none("double").alias("value"), "n_final", F.lit(parts // 2).cast("bigint").alias("part")))
    path = scratch_path(spark)
    rows.repartition("part").write.partitionBy("part").parquet(path)
    return (spark.readStream.schema("slide_id bigint, seq bigint, value double, n_final bigint, part int")
            .option("maxFilesPerTrigger", 1).parquet(path).drop("part"))


ORDERED = with_views("stream") + "SELECT slide_id, seq, value FROM stream"


@query("ordered_stitch_stream", ORDERED)
def _(spark, d):
    out = scratch_path(spark)
    ST.run_to_parquet(ST.ordered_stitch_stream(stream_source(spark, d)), out, scratch_path(spark))
    return spark.read.schema(ST.OUTPUT).parquet(out).select("slide_id", "seq", "value")


@query("multi_slide_stream", with_views("stream") + "SELECT slide_id, count(*) AS n, round(sum(value), 4)::DOUBLE AS total, 1 AS closed FROM stream GROUP BY slide_id")
def _(spark, d):
    """Many slides interleaved: each one is complete and was closed exactly once."""
    out = scratch_path(spark)
    ST.run_to_parquet(ST.ordered_stitch_stream(stream_source(spark, d)), out, scratch_path(spark))
    r = spark.read.schema(ST.OUTPUT).parquet(out)
    return r.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max(F.col("closed").cast("int")).alias("closed"))


@query("epoch_stats_stream", with_views("epochs") + """SELECT run, epoch, validation_loss, min(validation_loss) OVER (PARTITION BY run ORDER BY epoch) AS best_loss FROM epochs""")
def _(spark, d):
    src, out, rep = scratch_path(spark), scratch_path(spark), scratch_path(spark)
    e = view(spark, d, "epochs")
    e.repartition(3, "epoch").write.parquet(src)
    rows = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    ST.epoch_stats_stream(rows, out, scratch_path(spark), lambda t: H.early_stopping(t, 1 << 30), rep)
    return spark.read.parquet(rep).select("run", "epoch", "validation_loss", "best_loss")
