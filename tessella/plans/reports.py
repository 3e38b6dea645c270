"""Whole reports composed from the operators: evaluation, tumour-stroma ratios, dataset checks, mask
preprocessing, configuration building and the prediction post-processing chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import common_depth, norm_path, stem, tag_path, without_extension
from ..functions.ranking import shuffled_rank
from ..operators import catalog as K
from ..operators import components as C
from ..operators import metrics as M
from ..operators import morphology as MO
from ..operators import raster as R
from ..operators import tilestats as T
from ..operators import vector as V
from ..operators.levels import resolve_level
from ..operators.splits import split_purposes
from ..session import materialize


def evaluate(gt: DataFrame, pred: DataFrame, mapping: dict[int, int] | None, labels: list[int],
             classes: list[int] | None = None, boxes: DataFrame | None = None) -> DataFrame:
    """F1 and Jaccard per label, per slide and over all slides (slide_id NULL), with the overall F1 of the
    selected classes on every row. With boxes only pixels inside them count;
    slides and labels without any stay, with zero cells."""
    if boxes is None:
        cm = M.confusion_matrix(gt, pred, mapping, labels)
    else:
        cells = (M.confusion_by_box(gt, pred, boxes, mapping, labels).select("slide_id", "y_true", "y_pred", "n")
                 .unionByName(M.zero_cells(gt.select("slide_id").distinct(), ["slide_id"], labels)))
        cm = (cells.rollup("y_true", "y_pred", "slide_id").agg(F.sum("n").alias("n"))
              .where("y_pred IS NOT NULL").select("slide_id", "y_true", "y_pred", "n"))
    # the window runs over the cells of a slide, which are as few as the label pairs; pixels are read once
    w = Window.partitionBy("slide_id")
    chosen = F.col("y_true").isin(classes or labels) & F.col("y_pred").isin(classes or labels)
    right = F.sum(F.when(chosen & (F.col("y_true") == F.col("y_pred")), F.col("n")).otherwise(0)).over(w)
    overall = F.try_divide(1.0 * right, F.sum(F.when(chosen, F.col("n")).otherwise(0)).over(w))
    return M.cm_scores(cm.withColumn("overall_f1", overall), ["slide_id"], ["overall_f1"])


def tsr_report(classes: DataFrame, bulk_first: DataFrame, bulk_second: DataFrame, tumour: int = 8, stroma: int = 1) -> DataFrame:
    """Ratio per case; a case without a mask in the first bulk table uses the second one."""
    have = bulk_first.select("slide_id").distinct()
    rest = bulk_second.join(have, "slide_id", "left_anti")
    out = M.tsr(classes, bulk_first.unionByName(rest), tumour, stroma)
    return out.select(F.col("slide_id").cast("string").alias("case_id"), "tsr_ratio")


def check_dataset(items: DataFrame, found: DataFrame, image_levels: DataFrame, mask_levels: DataFrame, match_spacing: float,
                  tol: float = 0.25) -> DataFrame:
    """First problem per item ``(slide_id, labels)``: wrong label set, spacing missing from the image or the
    mask, or different shapes at that spacing; null when the item is fine."""
    ask = items.select("slide_id").withColumn("req_spacing", F.lit(match_spacing))

    def shape(levels, prefix):
        r = resolve_level(ask, levels, tol).join(levels.select("slide_id", "level", "rows", "cols"), ["slide_id", "level"], "left")
        return r.select("slide_id", F.col("level").alias(f"{prefix}_level"), F.col("rows").alias(f"{prefix}_rows"), F.col("cols").alias(f"{prefix}_cols"))
    j = (items.join(found.select("slide_id", F.col("labels").alias("_have")), "slide_id", "left")
         .join(shape(image_levels, "i"), "slide_id", "left").join(shape(mask_levels, "m"), "slide_id", "left"))
    want = F.array_sort(F.array_union("labels", F.array(F.lit(0))))
    problem = (F.when(F.coalesce(F.array_sort("_have"), F.array().cast("array<int>")) != want,
                      F.concat(F.lit("Labels mismatch: "), F.array_join(F.array_sort("_have"), ","), F.lit(" != "), F.array_join("labels", ",")))
               .when(F.col("i_level").isNull(), "Missing spacing from image").when(F.col("m_level").isNull(), "Missing spacing from mask")
               .when((F.col("i_rows") != F.col("m_rows")) | (F.col("i_cols") != F.col("m_cols")), "No matching level in mask"))
    return j.select("slide_id", problem.alias("problem"))


def stat_path(mask: str, stat: str, target: str | None, target_is_folder: bool = False):
    """Where the statistics of a mask go: the folder or ``{mask}`` template if given, else the configured
    path, else next to the mask."""
    if target and target_is_folder:
        return F.concat(F.lit(target.rstrip("/") + "/"), stem(F.col(mask)), F.lit(".stat"))
    if target:
        return F.replace(F.lit(target), F.lit("{mask}"), stem(F.col(mask)))
    return F.when(F.coalesce(F.col(stat), F.lit("")) != "", F.col(stat)).otherwise(F.concat(without_extension(F.col(mask)), F.lit(".stat")))


def preprocess_masks(items: DataFrame, masks: DataFrame, tile: int, labels: list[int], target: str | None = None,
                     target_is_folder: bool = False) -> DataFrame:
    """Tile statistics of all items' masks at once, tagged with the path each belongs to. ``items`` is
    ``(slide_id, mask, stat)``."""
    stats = T.cumulative_tile_counts(T.tile_label_counts(masks, tile, labels))
    paths = items.select("slide_id", stat_path("mask", "stat", target, target_is_folder).alias("stat_path"))
    return stats.join(paths, "slide_id")


def create_data_config(images: DataFrame, masks: DataFrame, stats: DataFrame, labels: DataFrame, folders: tuple[str, str, str],
                       mask_name: str, stat_name: str, ratios: dict[str, float] | None, seed: int) -> DataFrame:
    """Items matched from three listings with tagged paths, measured labels and a purpose. ``labels`` is
    ``(path, labels)`` per mask."""
    m = K.match_image_mask_stat(images, masks, stats, mask_name, stat_name).where("kept")
    depth = common_depth(*folders)
    tags = ("images", "masks", "stats")
    out = m.join(labels.select(F.col("path").alias("mask"), "labels"), "mask", "left")
    for c, folder, tag in zip(("image", "mask", "stat"), folders, tags):
        out = out.withColumn(c, F.when(F.col(c).isNotNull(), tag_path(norm_path(F.col(c)), depth, len(folder.split("/")) - depth, "root", tag)))
    out = out.withColumn("item_id", F.xxhash64("image")).withColumn("category", F.lit("default"))
    if not ratios:
        return out.withColumn("purpose", F.lit(None).cast("string"))
    return split_purposes(out, ratios, seed)


def item_order(items: DataFrame, randomize: bool, seed: int) -> DataFrame:
    """Items with a position, random or by path."""
    if randomize:
        return shuffled_rank(items, [], ["image"], seed, "position")
    return items.orderBy("image", "mask", "stat")


def postprocess_chain(probs: DataFrame, levels: DataFrame, output_class: int, zoom: float | None = None, low: float | None = 0.5,
                      min_diagonal: float | None = None, dilation: float | None = None, fill_diagonal: float | None = None,
                      outline_epsilon: float | None = None, tile: int = 512) -> DataFrame:
    """Soft scores to a cleaned mask (or its outlines): pick a class, zoom, threshold, drop small regions,
    dilate, fill small holes, outline. Every step is optional; lengths are in micrometers of each slide's own
    spacing, a column of ``levels``."""
    px = probs.select(*R.PIXEL, F.col("probs")[output_class].alias("label"))
    if zoom:
        px = R.zoom_raster(px, levels, zoom, order=1, tile=tile).withColumnRenamed("value", "label")
        levels = R.zoom_shape(levels, zoom)
    if low is not None:
        px = R.threshold(px, low).where("label = 1")
    if min_diagonal:
        px = C.filter_regions(px, min_diagonal, tile=tile, spacings=levels).where("label != 0")
    if dilation:
        px = MO.dilate(px, levels, dilation, tile=tile)
    if fill_diagonal:
        px = materialize(px)  # the holes, the kept and the other pixels are each read from it
        px = C.fill_holes(px, levels, fill_diagonal, tile=tile, spacings=levels)
    if outline_epsilon is not None:
        return V.outline(px, None, None, True, outline_epsilon, tile, spacings=levels)
    return px
