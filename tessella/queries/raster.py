"""Raster algebra queries."""

from pyspark.sql import functions as F

from ..fixtures import levels, view, with_views
from ..operators import levels as L
from ..operators import raster as R
from ..registry import query

PX = with_views("px")
Q = "CAST(SUM(v) AS BIGINT)"


def label(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", "label")


def pred(spark, d, low=2):
    """The prediction as a sparse raster: values below ``low`` are not stored."""
    return view(spark, d, "px").where(F.col("pred") >= low).select("slide_id", "row", "col", F.col("pred").alias("label"))


def level0(spark, d):
    return levels(spark, d).where("level = 0")


@query("pixel_align", PX + """SELECT slide_id, row, col, label AS l, CASE WHEN pred >= 2 THEN pred ELSE 0 END AS r
FROM px WHERE label <> 0 OR pred >= 2""")
def _(spark, d):
    return R.pixel_align(label(spark, d).where("label <> 0"), pred(spark, d))


@query("raster_arithmetic", PX + """SELECT slide_id, row, col, CAST(((label - CASE WHEN pred >= 2 THEN pred ELSE 0 END)
 % 256 + 256) % 256 AS INT) AS label FROM px""")
def _(spark, d):
    return R.raster_arithmetic(label(spark, d), pred(spark, d), "-")


@query("raster_arithmetic_singles", PX + """SELECT slide_id, row, col,
 CAST(CASE WHEN slide_id % 2 = 0 THEN label * pred ELSE label END AS INT) AS label FROM px""")
def _(spark, d):
    right = view(spark, d, "px").select("slide_id", "row", "col", F.col("pred").alias("label"))
    return R.raster_arithmetic(label(spark, d), right.where("slide_id % 2 = 0"), "*", accept_singles=True)


@query("threshold", PX + "SELECT slide_id, row, col, CAST(label >= 2 AS INT) AS label FROM px")
def _(spark, d):
    return R.threshold(label(spark, d), 2)


@query("map_labels", PX + """SELECT slide_id, row, col,
 CASE label WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE label END AS label FROM px""")
def _(spark, d):
    return R.map_labels(label(spark, d), {1: 2, 2: 3})


@query("map_labels_lut", PX + """SELECT slide_id, row, col,
 CASE label WHEN 1 THEN 5 WHEN 3 THEN 6 ELSE 0 END AS label FROM px""")
def _(spark, d):
    return R.map_labels_lut(label(spark, d), {1: 5, 3: 6})


@query("label_map_with_valid", PX + """SELECT slide_id, row, col, CASE label WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 0 END
 AS label, CAST(label IN (1, 2) AS INT) AS valid FROM px""")
def _(spark, d):
    return R.map_labels_valid(label(spark, d), {1: 0, 2: 1})


CLASSES = """SELECT slide_id, cls, CAST(min(det_id) AS BIGINT) AS cls_order FROM det GROUP BY slide_id, cls"""


@query("map_classes", with_views("det") + f"""SELECT slide_id, cls_order, cls FROM (
 SELECT slide_id, cls_order, m IS NULL AS keep, coalesce(m, cls) AS cls,
  row_number() OVER (PARTITION BY slide_id, coalesce(m, cls) ORDER BY cls_order) AS r
 FROM (SELECT *, CASE cls WHEN 'click' THEN 'use' WHEN 'view' THEN 'use' END AS m FROM ({CLASSES}))
) WHERE r = 1 OR keep""")
def _(spark, d):
    c = view(spark, d, "det").groupBy("slide_id", "cls").agg(F.min("det_id").alias("cls_order"))
    return R.map_classes(c, {"click": "use", "view": "use"}, ["slide_id"])


SC = with_views("scores")


def probs(spark, d):
    s = view(spark, d, "scores")
    return s.select("slide_id", "row", "col", F.expr(
        "transform(array(s0, s1, s2, s3), v -> v / cast(s0 + s1 + s2 + s3 as double))").alias("probs"))


@query("argmax_label", SC + """SELECT slide_id, row, col, CASE WHEN s0 = m THEN 1 WHEN s1 = m THEN 2 WHEN s2 = m THEN 3
 ELSE 4 END AS label FROM (SELECT *, greatest(s0, s1, s2, s3) AS m FROM scores)""")
def _(spark, d):
    return R.argmax_label(probs(spark, d))


@query("quantize", SC + """SELECT slide_id, row, col,
 CAST(floor(least(greatest((s0 / 100.0::DOUBLE - 0.1) / 0.8::DOUBLE * 255, 0), 255)) AS INT) AS q FROM scores""")
def _(spark, d):
    s = view(spark, d, "scores")
    v = F.col("s0") / F.lit(100.0)
    scaled = R.quantize(v, 0.1, 0.9)
    return s.select("slide_id", "row", "col", scaled.alias("q"))


@query("output_channels", SC + "SELECT slide_id, row, col, s2 AS c0, s0 AS c1 FROM scores")
def _(spark, d):
    s = view(spark, d, "scores").select("slide_id", "row", "col", F.array("s0", "s1", "s2", "s3").alias("px"))
    return R.select_channels(s, [2, 0]).select("slide_id", "row", "col", F.col("px")[0].alias("c0"),
                                               F.col("px")[1].alias("c1"))


@query("select_channels", with_views("rgb") + "SELECT slide_id, row, col, b AS c0, r AS c1 FROM rgb")
def _(spark, d):
    s = view(spark, d, "rgb").select("slide_id", "row", "col", F.array("r", "g", "b").alias("px"))
    return R.select_channels(s, [2, 0]).select("slide_id", "row", "col", F.col("px")[0].alias("c0"),
                                               F.col("px")[1].alias("c1"))


@query("mask_filter", PX + "SELECT slide_id, row, col, CASE WHEN label = 2 THEN pred ELSE 0 END AS pred FROM px")
def _(spark, d):
    p = view(spark, d, "px").select("slide_id", "row", "col", "pred")
    return R.mask_filter(p, label(spark, d), 2, "pred")


@query("blank_by_label", with_views("px", "rgb") + """SELECT slide_id, row, col, CASE WHEN label = 2 THEN 0 ELSE r END AS r,
 CASE WHEN label = 2 THEN 0 ELSE g END AS g, CASE WHEN label = 2 THEN 0 ELSE b END AS b,
 CAST(label = 1 AS INT) AS kept FROM rgb JOIN px USING (slide_id, row, col)""")
def _(spark, d):
    return R.blank_by_label(view(spark, d, "rgb"), label(spark, d), 2, keep_mask=1)


PAL = {c: "[" + ",".join(str(p[i]) + "::DOUBLE" for p in R.PALETTE) + "]" for i, c in enumerate("rgb")}
_g = "(r / 255.0::DOUBLE * 0.2125::DOUBLE + g / 255.0::DOUBLE * 0.7154::DOUBLE + b / 255.0::DOUBLE * 0.0721::DOUBLE)"


@query("overlay_preview", with_views("px", "rgb") + "SELECT slide_id, row, col, " + ", ".join(
    f"CASE WHEN label = 0 THEN {c} ELSE CAST(floor(({_g} * (1.0::DOUBLE - 0.4::DOUBLE) "
    f"+ {PAL[c]}[label + 1] * 0.4::DOUBLE) * 255) AS INT) END AS {c}" for c in "rgb")
    + " FROM rgb JOIN px USING (slide_id, row, col)")
def _(spark, d):
    return R.overlay_preview(view(spark, d, "rgb"), label(spark, d), 0.4)


@query("multi_scale_constant_scale", PX + "SELECT slide_id, row, col, label * 50 AS label FROM px")
def _(spark, d):
    return label(spark, d).withColumn("label", F.col("label") * 50)


@query("lut_join", with_views("rgb") + """SELECT slide_id, row, col,
 CASE WHEN slide_id >= 0 THEN CASE WHEN n IS NULL THEN 0 ELSE 255 - r END END AS r, CASE WHEN n IS NULL THEN 0 ELSE g END AS g,
 CASE WHEN n IS NULL THEN 0 ELSE b END AS b FROM rgb LEFT JOIN (SELECT r * 65536 + g * 256 + b AS k, count(*) AS n FROM rgb
 WHERE r < 200 GROUP BY 1) ON k = r * 65536 + g * 256 + b""")
def _(spark, d):
    rgb = view(spark, d, "rgb")
    lut = (rgb.where("r < 200").select("r", "g", "b").distinct()
           .select((F.col("r") * 65536 + F.col("g") * 256 + F.col("b")).alias("rgb"), (255 - F.col("r")).alias("r"), "g", "b"))
    return R.apply_colour_lut(rgb, lut)


@query("cross_level_align", PX + """SELECT a.slide_id, a.row, a.col, a.label, coalesce(m.mask_label, 0) AS mask_label FROM
 (SELECT slide_id, row, col, label FROM px) a LEFT JOIN
 (SELECT slide_id, row // 4 AS r, col // 4 AS c, pred AS mask_label FROM px WHERE row % 4 = 0 AND col % 4 = 0) m
 ON a.slide_id = m.slide_id AND a.row // 4 = m.r AND a.col // 4 = m.c""")
def _(spark, d):
    coarse = (view(spark, d, "px").where("row % 4 = 0 AND col % 4 = 0")
              .select("slide_id", (F.col("row") / 4).cast("int").alias("row"), (F.col("col") / 4).cast("int").alias("col"),
                      F.col("pred").alias("label")))
    return R.cross_level_align(label(spark, d), coarse, 4)


_pos = "t{i} * ((50 - 1) / greatest({n} - 1, 1)::DOUBLE)"


@query("zoom_raster", PX + f"""SELECT f.slide_id, f.t0 AS row, f.t1 AS col, coalesce(px.label, 0) AS label FROM
 (SELECT s.slide_id, CAST(a.t0 AS INT) AS t0, CAST(b.t1 AS INT) AS t1 FROM (SELECT DISTINCT slide_id FROM px) s,
  (SELECT unnest(range(75)) AS t0) a, (SELECT unnest(range(75)) AS t1) b) f
 LEFT JOIN px ON px.slide_id = f.slide_id AND px.row = floor({_pos.format(i=0, n=75)} + 0.5)
  AND px.col = floor({_pos.format(i=1, n=75)} + 0.5)""")
def _(spark, d):
    return R.zoom_raster(label(spark, d), level0(spark, d), 1.5)


@query("zoom_raster_linear", PX + f"""SELECT slide_id, row, col, round(sum(w * label), 6) AS value FROM (
 SELECT f.slide_id, f.t0 AS row, f.t1 AS col, coalesce(px.label, 0) AS label,
  (CASE dy WHEN 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END)
  * (CASE dx WHEN 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS w FROM
 (SELECT s.slide_id, CAST(a.t0 AS INT) AS t0, CAST(b.t1 AS INT) AS t1, dy, dx,
   {_pos.format(i=0, n=25)} AS y, {_pos.format(i=1, n=25)} AS x
  FROM (SELECT DISTINCT slide_id FROM px) s, (SELECT unnest(range(25)) AS t0) a, (SELECT unnest(range(25)) AS t1) b,
   (SELECT unnest([0, 1]) AS dy) p, (SELECT unnest([0, 1]) AS dx) q) f
 LEFT JOIN px ON px.slide_id = f.slide_id AND px.row = floor(y) + dy AND px.col = floor(x) + dx) GROUP BY ALL HAVING sum(w) > 0""")
def _(spark, d):
    out = R.zoom_raster(label(spark, d), level0(spark, d), 0.5, order=1)
    return out.withColumn("value", F.round("value", 6))


@query("zoom_to_template", with_views("levels") + """SELECT slide_id, CASE WHEN slide_id % 2 = 0 THEN 25 ELSE 26 END::BIGINT AS t_rows,
 25::BIGINT AS t_cols, CASE WHEN slide_id % 2 = 0 THEN 25 ELSE 26 END / 50.0::DOUBLE AS factor,
 CAST(slide_id % 2 = 0 AS INT) AS symmetric FROM slides""")
def _(spark, d):
    t = level0(spark, d).select("slide_id", F.when(F.col("slide_id") % 2 == 0, 25).otherwise(26).cast("bigint").alias("rows"),
                                F.lit(25).cast("bigint").alias("cols"))
    return R.zoom_to_template(level0(spark, d), t)


# ---- levels ----
LV = with_views("levels")
REQ = "req AS (SELECT slide_id, unnest([0.5, 0.6, 1.1, 1.4, 3.0, 9.0])::DOUBLE AS req_spacing FROM slides)"
LVR = LV.rstrip() + ",\n" + REQ + "\n"
_in = "req_spacing BETWEEN spacing * (1 - 0.25::DOUBLE) AND spacing * (1 + 0.25::DOUBLE)"


def requests(spark, d):
    return view(spark, d, "slides").select("slide_id", F.explode(F.array(
        *[F.lit(float(x)) for x in (0.5, 0.6, 1.1, 1.4, 3.0, 9.0)])).alias("req_spacing"))


@query("resolve_level", LVR + f"""SELECT slide_id, req_spacing, min(CASE WHEN {_in} THEN level END) AS level
 FROM req JOIN levels USING (slide_id) GROUP BY ALL""")
def _(spark, d):
    return L.resolve_level(requests(spark, d), levels(spark, d))


@query("test_spacing", LVR + f"""SELECT slide_id, req_spacing, CAST(count(CASE WHEN {_in} THEN 1 END) > 0 AS INT) AS present
 FROM req JOIN levels USING (slide_id) GROUP BY ALL""")
def _(spark, d):
    return L.test_spacing(requests(spark, d), levels(spark, d))


@query("refine_spacing", LVR + f"""SELECT slide_id, req_spacing, min(spacing) AS spacing
 FROM req JOIN levels USING (slide_id) WHERE {_in} GROUP BY ALL""")
def _(spark, d):
    return L.refine_spacing(requests(spark, d), levels(spark, d))


@query("find_mask_level", LVR + f"""SELECT slide_id, req_spacing, CASE WHEN slide_id % 3 = 1 THEN -1 ELSE
 coalesce(min(CASE WHEN {_in} THEN level END),
          greatest(min(CASE WHEN req_spacing < spacing THEN level END) - 1, 0), 0) END AS level
 FROM req JOIN levels USING (slide_id) GROUP BY slide_id, req_spacing""")
def _(spark, d):
    masks = levels(spark, d).where("slide_id % 3 <> 1")
    return L.find_mask_level(requests(spark, d), masks)


@query("match_equal_shape_level", LV + """SELECT a.slide_id, a.level, min(b.level) AS mask_level FROM levels a LEFT JOIN
 (SELECT slide_id, level, rows, cols FROM levels WHERE level > 0) b
 ON a.slide_id = b.slide_id AND a.rows = b.rows AND a.cols = b.cols GROUP BY ALL""")
def _(spark, d):
    lv = levels(spark, d)
    return L.match_equal_shape_level(lv, lv.where("level > 0"))


@query("slide_info", LV + "SELECT slide_id, level, rows, cols, spacing, downsampling FROM levels")
def _(spark, d):
    return L.slide_info(levels(spark, d))


@query("set_spacing", LV + """SELECT slide_id, level, rows, cols, downsampling, 0.25 * downsampling / 2 AS spacing
 FROM levels""")
def _(spark, d):
    return L.set_spacing(levels(spark, d), 0.25, level=1)


@query("level_alignment", LV + """SELECT slide_id, level, 2 AS stats_level, 4 / downsampling AS stats_downsampling,
 CAST(greatest(0, floor(floor(4 / downsampling) / 2) - 1) AS INT) AS stats_shift FROM levels""")
def _(spark, d):
    lv = levels(spark, d)
    return L.level_alignment(lv, lv.where("level = 2"))
