"""Annotation, box and detection queries."""

from pyspark.sql import functions as F

from ..fixtures import SIDE, annotations, levels, table, view, with_views
from ..operators import boxes as B
from ..operators import vector as V
from ..registry import query
from .regions import components_sql

TILE = 16
AN = with_views("ann")


def frame(spark, d):
    """A 50 x 50 shape for every slide that has annotations."""
    return view(spark, d, "ann").select("slide_id").distinct().withColumn("rows", F.lit(SIDE)).withColumn("cols", F.lit(SIDE))


GROUPS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#22"]
MAP = {g: i + 1 for i, g in enumerate(GROUPS)}
VALS = "(VALUES " + ", ".join(f"('{g}', {i + 1})" for i, g in enumerate(GROUPS)) + ") m(g, label)"


@query("rasterize", AN + f"""SELECT slide_id, CAST(y AS INT) AS row, CAST(x AS INT) AS col, CAST(min(label) AS INT) AS label FROM ann JOIN {VALS} ON grp = g,
 (SELECT unnest(range(50)) AS y), (SELECT unnest(range(50)) AS x) WHERE y >= y0 AND y < y0 + h AND x >= x0 AND x < x0 + w GROUP BY ALL""")
def _(spark, d):
    return V.rasterize(annotations(spark, d), frame(spark, d), 1.0, MAP, list(reversed(GROUPS)))


@query("rasterize_triangles", AN + """SELECT slide_id, CAST(y AS INT) AS row, CAST(x AS INT) AS col, 1 AS label FROM ann, (SELECT unnest(range(50)) AS y), (SELECT unnest(range(50)) AS x)
 WHERE y >= y0 AND y < y0 + h AND x >= x0 AND x + 0.5 < x0 + (y0 + h - y - 0.5) * w / h GROUP BY ALL""")
def _(spark, d):
    tri = annotations(spark, d).withColumn("coords", F.array(F.col("coords")[0], F.col("coords")[1], F.col("coords")[3]))
    return V.rasterize(tri, frame(spark, d))


@query("shift_annotations", AN + "SELECT ann_id, (y0 + 1.5)::DOUBLE AS y, (x0 + w - 2)::DOUBLE AS x FROM ann")
def _(spark, d):
    s = V.shift_annotations(annotations(spark, d), 1.5, -2.0)
    return s.select("ann_id", F.col("coords")[0]["y"].alias("y"), F.col("coords")[1]["x"].alias("x"))


@query("level_rescale", AN + "SELECT ann_id, (y0 * 8)::DOUBLE AS y, ((x0 + w) * 8)::DOUBLE AS x FROM ann")
def _(spark, d):
    s = V.rescale_levels(annotations(spark, d), 4, 1, 2)
    return s.select("ann_id", F.col("coords")[0]["y"].alias("y"), F.col("coords")[1]["x"].alias("x"))


@query("annotation_counts", AN + "SELECT slide_id, CASE WHEN grp LIKE '%1' THEN NULL ELSE grp END AS grp, count(*) AS n FROM ann GROUP BY ALL")
def _(spark, d):
    a = annotations(spark, d).withColumn("grp", F.when(~F.col("grp").like("%1"), F.col("grp")))
    return V.annotation_counts(a)


@query("annotation_bboxes", AN + "SELECT slide_id, ann_id, grp, y0 // 4 AS ymin, x0 // 4 AS xmin, (y0 + h) // 4 AS ymax, (x0 + w) // 4 AS xmax FROM (SELECT ann_id, slide_id, grp, y0::BIGINT AS y0, x0::BIGINT AS x0, h, w FROM ann)")
def _(spark, d):
    return V.annotation_bboxes(V.shift_annotations(annotations(spark, d), 0.75, 0.5), 4)


def group_table(spark, d):
    """Brand groups: every brand hangs below the brand family of its last digit, families below 'all'."""
    a = view(spark, d, "ann").select("slide_id", "grp").distinct()
    fam = F.concat(F.lit("family "), F.right("grp", F.lit(1)))
    return (a.select("slide_id", "grp", fam.alias("parent"))
            .unionByName(a.select("slide_id", fam.alias("grp"), F.lit("all").alias("parent")).distinct())
            .unionByName(a.select("slide_id").distinct().select("slide_id", F.lit("all").alias("grp"), F.lit(None).cast("string").alias("parent"))))


@query("annotation_strict_check", AN + f"""SELECT DISTINCT slide_id, 'unknown' AS problem, grp FROM ann WHERE grp NOT IN ({', '.join(repr(g) for g in GROUPS)})
 UNION ALL SELECT slide_id, 'empty', NULL FROM ann GROUP BY slide_id HAVING count_if(grp IN ({', '.join(repr(g) for g in GROUPS)})) = 0""")
def _(spark, d):
    a = annotations(spark, d)
    return V.strict_check(a, a.select("slide_id", "grp").distinct(), GROUPS, True)


@query("validate_annotations", AN + """SELECT slide_id, ann_id, CASE WHEN ann_id % 7 = 0 THEN 'unknown type' WHEN ann_id % 5 = 0 OR ann_id % 3 = 0 THEN 'coordinate count'
 WHEN grp LIKE '%9' THEN 'unknown group' END AS problem FROM ann WHERE ann_id % 7 = 0 OR ann_id % 5 = 0 OR ann_id % 3 = 0 OR grp LIKE '%9'""")
def _(spark, d):
    k = F.col("ann_id")
    a = annotations(spark, d).withColumn("type", F.when(k % 7 == 0, "circle").when(k % 5 == 0, "dot").when(k % 3 == 0, "measurement").otherwise("rectangle"))
    g = a.where(~F.col("grp").like("%9")).select("slide_id", "grp").distinct()
    return V.validate_annotations(a, g)


@query("annotation_edit", AN + """, fam AS (SELECT *, concat('family ', right(grp, 1)) AS f FROM ann),
kept AS (SELECT * FROM fam WHERE right(grp, 1) NOT IN ('3', '4') AND grp <> 'Brand#1')
SELECT slide_id, grp FROM kept UNION SELECT slide_id, f FROM kept UNION SELECT slide_id, 'all' FROM kept
 UNION SELECT slide_id, grp FROM fam WHERE grp <> 'Brand#1' AND right(grp, 1) NOT IN ('3', '4')""")
def _(spark, d):
    a, g = annotations(spark, d), group_table(spark, d)
    gone = g.where("grp IN ('family 3', 'family 4')").select("slide_id", "grp")
    a, g = V.remove_groups(a, g, gone)
    a, g = V.remove_annotations(a, g, a.where("grp = 'Brand#1'").select("slide_id", "ann_id"))
    return g.select("slide_id", "grp")


@query("annotation_join_group", AN + """SELECT ann_id, name, CASE WHEN ann_id % 4 = 0 THEN 'moved' ELSE grp END AS grp FROM ann UNION ALL
 SELECT ann_id + 1000000000, concat('Annotation ', n + row_number() OVER (PARTITION BY slide_id ORDER BY ann_id) - 1), 'fresh'
 FROM (SELECT *, count(*) OVER (PARTITION BY slide_id) AS n FROM ann) WHERE ann_id % 10 = 0""")
def _(spark, d):
    a = annotations(spark, d)
    g = group_table(spark, d)
    moves = a.where("ann_id % 4 = 0").select("slide_id", "ann_id", F.lit("moved").alias("to_grp"))
    moved, g2 = V.join_group(a, g, moves)
    new = a.where("ann_id % 10 = 0").withColumn("ann_id", F.col("ann_id") + 1000000000).withColumn("grp", F.lit("fresh")).withColumn("name", F.lit(None).cast("string"))
    out, _ = V.add_annotations(moved, g2, new)
    return out.select("ann_id", "name", "grp")


@query("rdp_simplify")
def _(spark, d):
    """The 64 values of each embedding as a polyline."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("ann_id"), F.expr(
        "transform(embedding, (v, i) -> named_struct('y', cast(v as double) * 10, 'x', cast(i as double)))").alias("coords"))
    return V.rdp_simplify(e, 1.0).select("ann_id", F.size("coords").alias("n"), F.col("coords")[1]["x"].alias("second"))


def blocks(spark, d):
    return view(spark, d, "blocks").select("slide_id", "row", "col", "label")


@query("outline")
def _(spark, d):
    o = V.outline(blocks(spark, d), 0.5, {"one": [1], "two": [2]}, True, 1.0, TILE)
    return o.select("slide_id", "grp", "comp", "type", F.size("coords").alias("n"))


@query("outline_round_trip", with_views("blocks") + "SELECT slide_id, row, col, 1 AS label FROM blocks WHERE label = 2")
def _(spark, d):
    """Outlining and rasterising again gives the pixels back (label 2 has no holes)."""
    o = V.outline(blocks(spark, d), 1.0, {"two": [2]}, True, 0.0, TILE)
    a = V.shift_annotations(o.withColumn("ann_id", F.col("comp")), 0.5, 0.5)
    lv = levels(spark, d).where("level = 0")
    return V.rasterize(a, lv)


@query("hull_outline")
def _(spark, d):
    lv = levels(spark, d).where("level = 0")
    px = view(spark, d, "px").select("slide_id", "row", "col", "label")
    o = V.hull_outline(px, lv, 3, 0.4, 50, 4, 0, 1, tile=TILE)
    return o.select("slide_id", "comp", "type", F.size("coords").alias("n"))


# ---- boxes ----
BOX = """SELECT o_orderkey AS box_id, CAST(floor(o_orderkey / 500) AS INT) AS slide_id, CAST(o_orderkey * 37 % 1000 AS INT) AS y, CAST(o_custkey * 13 % 1000 AS INT) AS x,
 CAST(5 + o_orderkey % 23 AS INT) AS h, CAST(5 + o_custkey % 19 AS INT) AS w FROM orders"""


def box_view(spark, d):
    return spark.sql(BOX.replace("FROM orders", "FROM {orders}"), orders=table(spark, d, "orders"))


def corners(b):
    return b.select("slide_id", F.col("box_id").alias("id"), F.col("y").alias("y0"), F.col("x").alias("x0"),
                    (F.col("y") + F.col("h")).alias("y1"), (F.col("x") + F.col("w")).alias("x1"))


@query("bbox_overlap_join", f"""WITH b AS ({BOX}) SELECT p.slide_id, p.box_id AS a, q.box_id AS b FROM b p JOIN b q ON p.slide_id = q.slide_id AND p.box_id < q.box_id
 AND greatest(p.y, q.y) < least(p.y + p.h, q.y + q.h) AND greatest(p.x, q.x) < least(p.x + p.w, q.x + q.w)""")
def _(spark, d):
    c = corners(box_view(spark, d))
    return B.bbox_overlap_join(c, c, 32).where("l_id < r_id").select("slide_id", F.col("l_id").alias("a"), F.col("r_id").alias("b"))


WIN = """SELECT l_orderkey * 8 + l_linenumber AS patch_id, CAST(floor(l_orderkey / 500) AS INT) AS slide_id, CAST(l_partkey * 7 % 1000 AS INT) AS cy, CAST(l_suppkey * 311 % 1000 AS INT) AS cx FROM lineitem"""


@query("patch_boxes", f"""WITH b AS ({BOX}), p AS ({WIN}) SELECT p.slide_id, patch_id, box_id, CAST(box_id % 3 AS INT) AS cls, CAST(y - (cy - 16) AS BIGINT) AS y0, CAST(x - (cx - 16) AS BIGINT) AS x0,
 CAST(y + h - (cy - 16) AS BIGINT) AS y1, CAST(x + w - (cx - 16) AS BIGINT) AS x1 FROM p JOIN b USING (slide_id)
 WHERE greatest(y, cy - 16) < least(y + h, cy + 16) AND greatest(x, cx - 16) < least(x + w, cx + 16)""")
def _(spark, d):
    p = spark.sql(WIN.replace("FROM lineitem", "FROM {li}"), li=table(spark, d, "lineitem")).select(
        "patch_id", "slide_id", F.col("cy").alias("center_row"), F.col("cx").alias("center_col"), F.lit(32).alias("h"), F.lit(32).alias("w"))
    b = corners(box_view(spark, d)).withColumnRenamed("id", "box_id").withColumn("cls", (F.col("box_id") % 3).cast("int"))
    return B.patch_boxes(b, p, 64)


def merged_sql(source: str) -> str:
    """Every box of ``source`` (slide_id, box_id, y, x, h, w) grows to the bounding box of all boxes it overlaps until none changes;
    boxes that overlap are equal then. Ends a WITH RECURSIVE list and selects the merged boxes."""
    return f"""
grown AS (
 SELECT 0 AS turn, slide_id, box_id, y::BIGINT AS y0, x::BIGINT AS x0, (y + h)::BIGINT AS y1, (x + w)::BIGINT AS x1, true AS moved FROM ({source})
 UNION ALL
 SELECT a.turn + 1, a.slide_id, a.box_id, min(b.y0), min(b.x0), max(b.y1), max(b.x1),
  min(b.y0) <> a.y0 OR min(b.x0) <> a.x0 OR max(b.y1) <> a.y1 OR max(b.x1) <> a.x1
 FROM grown a JOIN grown b ON a.slide_id = b.slide_id AND a.y0 < b.y1 AND b.y0 < a.y1 AND a.x0 < b.x1 AND b.x0 < a.x1
 WHERE (SELECT bool_or(moved) FROM grown) GROUP BY a.turn, a.slide_id, a.box_id, a.y0, a.x0, a.y1, a.x1),
merged AS (SELECT slide_id, min(box_id) AS box_id, y0::INT AS y, x0::INT AS x, (y1 - y0)::INT AS h, (x1 - x0)::INT AS w
 FROM grown WHERE turn = (SELECT max(turn) FROM grown) GROUP BY slide_id, y0, x0, y1, x1)
"""


@query("merge_boxes", f"WITH RECURSIVE b AS ({BOX})," + merged_sql("SELECT * FROM b") + "SELECT * FROM merged")
def _(spark, d):
    return B.merge_boxes(box_view(spark, d))


GT = """SELECT slide_id, comp AS box_id, trunc((min(row) - 1) * 8)::INT AS y, trunc((min(col) - 1) * 8)::INT AS x,
 trunc((max(row) + 1 - min(row) + 2) * 8)::INT AS h, trunc((max(col) + 1 - min(col) + 2) * 8)::INT AS w FROM comps GROUP BY slide_id, comp"""


@query("gt_boxes", with_views("blocks").rstrip() + "," + components_sql("SELECT slide_id, row, col, 1 AS label FROM blocks WHERE label = 1") + "," + merged_sql(GT)
       + "SELECT * FROM merged")
def _(spark, d):
    return B.gt_boxes(blocks(spark, d).where("label = 1"), 1.0, 8.0, TILE)


DET = with_views("det")


@query("inside_padding_filter", with_views("det", "px") + """SELECT det.slide_id, det_id, cls FROM det JOIN px ON px.slide_id = det.slide_id AND row = CAST(floor(y + 0.25) AS INT) AND col = CAST(floor(x + 0.5) AS INT)
 WHERE NOT (x + 0.5 < 3 OR y + 0.25 < 4 OR x + 0.5 > 50 - 5 OR y + 0.25 > 50 - 6) AND (label = 1)""")
def _(spark, d):
    dt = view(spark, d, "det").withColumn("x", F.col("x") + 0.5).withColumn("y", F.col("y") + 0.25)
    m = view(spark, d, "px").select("slide_id", "row", "col", "label")
    return B.inside_padding_filter(dt, m, (3, 5, 4, 6), 50).select("slide_id", "det_id", "cls")


@query("point_in_mask", with_views("det", "px") + "SELECT det_id, coalesce(label, 0) AS mask_label FROM det LEFT JOIN px ON px.slide_id = det.slide_id AND row = y AND col = x")
def _(spark, d):
    m = view(spark, d, "px").select("slide_id", "row", "col", "label")
    return B.point_in_mask(view(spark, d, "det"), m).select("det_id", "mask_label")


@query("detections_global", DET + "SELECT slide_id, x + CAST(det_id % 7 * 44 AS INT) - 3 AS x, y + CAST(det_id % 5 * 40 AS INT) - 4 AS y, cls FROM det")
def _(spark, d):
    k = F.col("det_id")
    dt = view(spark, d, "det").withColumn("tile_x", (k % 7 * 44).cast("int")).withColumn("tile_y", (k % 5 * 40).cast("int"))
    return B.detections_global(dt, (3, 3, 4, 4))


@query("score_threshold", DET + """SELECT slide_id, CAST(r AS INT) AS row, CAST(c AS INT) AS col, max(det_id) AS idx FROM det, (SELECT unnest(range(100)) AS r), (SELECT unnest(range(100)) AS c)
 WHERE conf >= 0.6 AND r >= (2 * y + side) // 2 - 12 AND r < (2 * y + side) // 2 + 12 AND c >= (2 * x + side) // 2 - 12 AND c < (2 * x + side) // 2 + 12 GROUP BY ALL""")
def _(spark, d):
    dt = view(spark, d, "det").select("slide_id", F.col("det_id").alias("idx"), F.col("conf").alias("score"), F.col("y").alias("y0"), F.col("x").alias("x0"),
                                      (F.col("y") + F.col("side")).alias("y1"), (F.col("x") + F.col("side")).alias("x1"), F.array("conf", 1 - F.col("conf")).alias("scores"))
    return B.score_threshold(dt, 100, 100).select("slide_id", "row", "col", "idx")


@query("nms", DET + """, ranked AS (SELECT slide_id, cls, list(struct_pack(det_id := det_id, conf := conf, y := y::DOUBLE, x := x::DOUBLE, s := side::DOUBLE) ORDER BY conf DESC, det_id) AS ds
  FROM det WHERE conf > 0.25 GROUP BY slide_id, cls),
folded AS (SELECT slide_id, cls, unnest(list_reduce(list_transform(ds, lambda d: [d]), lambda kept, d: CASE WHEN len(list_filter(kept, lambda k:
   greatest(least(k.y + k.s, d[1].y + d[1].s) - greatest(k.y, d[1].y), 0) * greatest(least(k.x + k.s, d[1].x + d[1].s) - greatest(k.x, d[1].x), 0)
   > 0.45 * (k.s * k.s + d[1].s * d[1].s - greatest(least(k.y + k.s, d[1].y + d[1].s) - greatest(k.y, d[1].y), 0) * greatest(least(k.x + k.s, d[1].x + d[1].s) - greatest(k.x, d[1].x), 0)))) > 0
   THEN kept ELSE list_concat(kept, d) END)) AS d FROM ranked)
SELECT slide_id, d.det_id AS det_id, cls, d.conf AS conf FROM folded QUALIFY row_number() OVER (PARTITION BY slide_id ORDER BY d.conf DESC, d.det_id) <= 1000""")
def _(spark, d):
    dt = view(spark, d, "det").select("slide_id", "det_id", "cls", "conf", F.col("y").cast("double").alias("y0"), F.col("x").cast("double").alias("x0"),
                                      (F.col("y") + F.col("side")).cast("double").alias("y1"), (F.col("x") + F.col("side")).cast("double").alias("x1"))
    return B.nms(dt, ["slide_id"]).select("slide_id", "det_id", "cls", "conf")
