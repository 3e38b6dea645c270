"""Composed reports."""

from pyspark.sql import functions as F

from ..fixtures import levels, view, with_views
from ..operators import boxes as B
from ..operators import tilestats as T
from ..plans import reports as P
from ..registry import query
from ..sources.rasters import build_pyramid
from .metrics import CM, MAPPING

TILE = 16
PX = with_views("px")


def label(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", "label")


def pred(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", F.col("pred").alias("label"))


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("evaluate", CM.rstrip() + """,
f AS (SELECT slide_id, k AS label, CAST(sum(CASE WHEN y_true = k AND y_pred = k THEN n ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN y_true = k AND y_pred <> k THEN n ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y_true <> k AND y_pred = k THEN n ELSE 0 END) AS BIGINT) AS fp FROM cm, (SELECT unnest([1, 2]) AS k) GROUP BY ALL),
o AS (SELECT slide_id, 1.0 * sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) / nullif(sum(n), 0) AS v FROM cm GROUP BY slide_id)
SELECT f.slide_id, label, tp, fn, fp, round(coalesce(2.0 * tp / nullif(2 * tp + fn + fp, 0), 0), 6)::DOUBLE AS f1,
 round(coalesce(1.0 * tp / nullif(tp + fn + fp, 0), 0), 6)::DOUBLE AS jaccard, round(v, 6)::DOUBLE AS overall_f1
FROM f JOIN o ON f.slide_id IS NOT DISTINCT FROM o.slide_id""")
def _(spark, d):
    return rounded(P.evaluate(label(spark, d), pred(spark, d), MAPPING, [1, 2]))


@query("evaluate_boxes")
def _(spark, d):
    """Only pixels in the merged boxes of the ground truth regions found at an eight times coarser level."""
    gt = view(spark, d, "blocks").select("slide_id", "row", "col", F.when(F.col("label") == 1, 1).otherwise(0).alias("label"))
    overview = build_pyramid(gt, 3).where("level = 3")
    boxes = B.gt_boxes(overview, 0.5, 4.0, TILE)
    return rounded(P.evaluate(label(spark, d), pred(spark, d), MAPPING, [1, 2], boxes=boxes))


@query("confusion_by_box", with_views("px", "ann") + """SELECT b.slide_id, b.ann_id AS box_id, CASE WHEN px.label = 1 THEN 1 ELSE 2 END AS y_true, px.pred AS y_pred, count(*) AS n
 FROM ann b JOIN px ON px.slide_id = b.slide_id AND px.row >= y0 AND px.row < y0 + h AND px.col >= x0 AND px.col < x0 + w
 WHERE px.label <> 0 AND px.pred IN (1, 2) GROUP BY ALL""")
def _(spark, d):
    from ..operators.metrics import confusion_by_box
    b = view(spark, d, "ann").select("slide_id", F.col("ann_id").alias("box_id"), F.col("y0").alias("y"), F.col("x0").alias("x"), "h", "w")
    return confusion_by_box(label(spark, d), pred(spark, d), b, MAPPING, [1, 2], 16)


@query("tsr_report", PX + """SELECT CAST(slide_id AS VARCHAR) AS case_id,
 round(count_if(label = 1 AND b) / nullif(count_if(label IN (1, 2) AND b), 0), 6)::DOUBLE AS tsr_ratio
 FROM (SELECT *, CASE WHEN slide_id % 2 = 0 THEN pred >= 3 ELSE pred >= 2 END AS b FROM px) GROUP BY slide_id""")
def _(spark, d):
    p = view(spark, d, "px")
    bulk = lambda low: p.select("slide_id", "row", "col", (F.col("pred") >= low).cast("int").alias("label"))
    return rounded(P.tsr_report(label(spark, d), bulk(3).where("slide_id % 2 = 0"), bulk(2), 2, 1))


@query("check_dataset", with_views("px", "slides") + """SELECT s.slide_id, CASE WHEN f.found <> '0,1,2,3' OR s.slide_id % 7 = 6 THEN
  concat('Labels mismatch: ', f.found, ' != ', CASE WHEN s.slide_id % 7 = 6 THEN '1,2' ELSE '1,2,3' END)
 WHEN s.slide_id % 5 = 1 THEN 'Missing spacing from image' WHEN s.slide_id % 5 = 2 THEN 'Missing spacing from mask'
 WHEN s.slide_id % 5 = 3 THEN 'No matching level in mask' END AS problem
 FROM slides s JOIN (SELECT slide_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS found FROM px GROUP BY slide_id) f USING (slide_id)""")
def _(spark, d):
    lv = levels(spark, d)
    items = view(spark, d, "slides").withColumn("labels", F.when(F.col("slide_id") % 7 == 6, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3))))
    image = lv.where("slide_id % 5 <> 1 OR level <> 1")
    mask = lv.where("slide_id % 5 <> 2 OR level <> 1").withColumn("rows", F.when(F.col("slide_id") % 5 == 3, F.col("rows") + 1).otherwise(F.col("rows")))
    return P.check_dataset(items, T.labels_in_mask(label(spark, d)), image, mask, 1.0)


@query("create_data_config", with_views("images", "masks", "stats", "items") + """SELECT concat('{root}/{images}/', d.lang, '/doc_', d.doc_id, '.tif') AS image, concat('{root}/{masks}/doc_', d.doc_id, '_mask.tif') AS mask,
 CASE WHEN i.quality = 1 THEN concat('{root}/{stats}/doc_', d.doc_id, '.stat') END AS stat, concat(1 + i.quality, ',', 3 + i.toxic) AS labels, 1 AS has_purpose
 FROM documents d JOIN masks m USING (doc_id) JOIN items i ON i.item_id = d.doc_id""")
def _(spark, d):
    found = view(spark, d, "masks").join(view(spark, d, "items").withColumnRenamed("item_id", "doc_id"), "doc_id").select(
        "path", F.array(1 + F.col("quality"), 3 + F.col("toxic")).alias("labels"))
    out = P.create_data_config(view(spark, d, "images").select("path"), view(spark, d, "masks").select("path"), view(spark, d, "stats").select("path"),
                               found, ("/data/images", "/data/masks", "/data/stats"), "{image}_mask.tif", "{image}.stat",
                               {"training": 8, "validation": 2}, 7)
    return out.select("image", "mask", "stat", F.array_join("labels", ",").alias("labels"), F.col("purpose").isin("training", "validation").cast("int").alias("has_purpose"))


@query("preprocess_masks", PX + f"""SELECT slide_id, tile_row, tile_col, label, n, CAST(sum(n) OVER (PARTITION BY slide_id, label, tile_row ORDER BY tile_col) AS BIGINT) AS cum_in_row,
 CASE WHEN slide_id % 2 = 0 THEN concat('/stats/s', slide_id, '.stat') ELSE concat('/masks/m', slide_id, '.stat') END AS stat_path
 FROM (SELECT slide_id, row // {TILE} AS tile_row, col // {TILE} AS tile_col, label, count(*) AS n FROM px WHERE label IN (1, 2) GROUP BY ALL)""")
def _(spark, d):
    k = F.col("slide_id").cast("string")
    items = view(spark, d, "slides").select("slide_id", F.concat(F.lit("/masks/m"), k, F.lit(".tif")).alias("mask"),
                                            F.when(F.col("slide_id") % 2 == 0, F.concat(F.lit("/stats/s"), k, F.lit(".stat"))).otherwise("").alias("stat"))
    return P.preprocess_masks(items, label(spark, d), TILE, [1, 2]).drop("cum_rows")


@query("postprocess_chain")
def _(spark, d):
    s = view(spark, d, "blocks").select("slide_id", "row", "col", F.array(F.when(F.col("label") == 1, 0.9).otherwise(0.1)).alias("probs"))
    out = P.postprocess_chain(s, levels(spark, d).where("level = 0"), 0, None, 0.5, 2.0, 0.5, 1.5, 1.0, TILE)
    return out.select("slide_id", "comp", "type", F.size("coords").alias("n"))
