"""Catalogue joins and set logic over file listings and data items.

Listings are ``(path)`` tables; items are ``(item_id, category, purpose, image, mask, stat, labels)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import basename, extension, fill_template, norm_path, stem


def match_images_masks(images: DataFrame, masks: DataFrame | None, template: str = "{image}",
                       require_mask: bool = True) -> DataFrame:
    """Image and mask paths joined on the base name, where the mask is called ``template``. With
    ``require_mask`` unmatched images are dropped, else their mask is null."""
    i = images.select(F.col("path").alias("image"), stem(F.col("path")).alias("_base"))
    i = i.withColumn("_key", fill_template(F.lit(template if "{image}" in template else "{image}"), {"image": F.col("_base")}))
    if masks is None:
        return i.select("image", F.lit(None).cast("string").alias("mask"))
    m = masks.select(F.col("path").alias("mask"), stem(F.col("path")).alias("_key"))
    return i.join(m, "_key", "inner" if require_mask else "left").select("image", "mask")


def match_image_mask_stat(images: DataFrame, masks: DataFrame, stats: DataFrame, mask_name: str,
                          stat_name: str) -> DataFrame:
    """Images with their mask and statistics by file name; ``kept`` is false when both are missing."""
    i = images.select(F.col("path").alias("image"), stem(F.col("path")).alias("_b"))
    i = i.withColumn("_m", fill_template(F.lit(mask_name), {"image": F.col("_b")})).withColumn(
        "_s", fill_template(F.lit(stat_name), {"image": F.col("_b")}))
    m = masks.select(F.col("path").alias("mask"), basename(F.col("path")).alias("_m"))
    s = stats.select(F.col("path").alias("stat"), basename(F.col("path")).alias("_s"))
    out = i.join(m, "_m", "left").join(s, "_s", "left")
    return out.select("image", "mask", "stat", (F.col("mask").isNotNull() | F.col("stat").isNotNull()).alias("kept"))


def match_left_right(left: DataFrame, right: DataFrame, left_name: str, right_name: str, result: str,
                     collect_singles: bool = False) -> DataFrame:
    """Pairs by the part of the left file name that stands at ``{base}``; ``result`` is the output path.
    With ``collect_singles`` a left file without partner is kept."""
    head, tail = left_name.split("{base}")
    pattern = "^" + re.escape(head) + "(.*)" + re.escape(tail)
    base = F.regexp_extract(basename(F.col("path")), pattern, 1)
    a = (left.where(basename(F.col("path")).rlike(pattern)).select(F.col("path").alias("left"), base.alias("_base"))
         .withColumn("_key", fill_template(F.lit(right_name), {"base": F.col("_base")})))
    b = right.select(F.col("path").alias("right"), basename(F.col("path")).alias("_key"))
    return (a.join(b, "_key", "left" if collect_singles else "inner")
            .select("left", "right", fill_template(F.lit(result), {"base": F.col("_base")}).alias("result")))


def match_with_target(first: DataFrame, second: DataFrame, second_name: str, target: str,
                      names: tuple[str, str, str] = ("image", "annotation", "mask")) -> DataFrame:
    """Two listings joined on the base name, where the second file is called ``second_name``; ``target`` may
    use the tags named after both inputs."""
    n1, n2, n3 = names
    a = first.select(F.col("path").alias(n1), stem(F.col("path")).alias("_b")).withColumn(
        "_k", fill_template(F.lit(second_name), {n1: F.col("_b")}))
    b = second.select(F.col("path").alias(n2), stem(F.col("path")).alias("_k"))
    return a.join(b, "_k").select(n1, n2, fill_template(F.lit(target), {n1: F.col("_b"), n2: F.col("_k")}).alias(n3))


def match_triplets(pairs: DataFrame, third: DataFrame, key: str, third_name: str, name: str,
                   required: bool = False) -> DataFrame:
    """Attach a third listing to matched pairs by the base name of column ``key``."""
    p = pairs.withColumn("_k", fill_template(F.lit(third_name), {key: stem(F.col(key))}))
    t = third.select(F.col("path").alias(name), stem(F.col("path")).alias("_k"))
    return p.join(t, "_k", "inner" if required else "left").drop("_k")


def match_prediction_gt(predictions: DataFrame, truths: DataFrame, template: str) -> DataFrame:
    """Each prediction with its ground truth (called ``template`` with ``{image}``); null when missing."""
    p = predictions.select(F.col("path").alias("prediction"), stem(F.col("path")).alias("_b")).withColumn(
        "_k", fill_template(F.lit(template), {"image": F.col("_b")}))
    t = truths.select(F.col("path").alias("truth"), stem(F.col("path")).alias("_k"))
    return p.join(t, "_k", "left").select("prediction", "truth")


def test_set_filter(masks: DataFrame, items: DataFrame, purpose: str = "testing") -> DataFrame:
    """Masks whose base name belongs to an image of the purpose."""
    t = items.where(F.col("purpose") == purpose).select(stem(F.col("image")).alias("_b"))
    return masks.withColumn("_b", stem(F.col("path"))).join(t, "_b", "left_semi").drop("_b")


def skip_existing(jobs: DataFrame, outputs: DataFrame, overwrite: bool = False) -> DataFrame:
    """Jobs ``(..., output)`` whose output is not in the listing yet."""
    if overwrite:
        return jobs
    return jobs.join(outputs.select(F.col("path").alias("output")), "output", "left_anti")


def rename_join(annotations: DataFrame, renames: DataFrame) -> DataFrame:
    """Rename annotation groups per slide; ``changed`` tells which rows were renamed."""
    r = renames.where("slide_id IS NOT NULL AND old_name IS NOT NULL AND new_name IS NOT NULL").select(
        "slide_id", F.col("old_name").alias("grp"), F.col("new_name").alias("_new"))
    j = annotations.join(r, ["slide_id", "grp"], "left")
    return j.withColumn("changed", F.col("_new").isNotNull().cast("int")).withColumn(
        "grp", F.coalesce("_new", "grp")).drop("_new")


def rename_report(annotations: DataFrame, renames: DataFrame) -> DataFrame:
    """Per slide of the rename sheet: number of changes and whether the slide has annotations at all."""
    n = rename_join(annotations, renames).groupBy("slide_id").agg(F.sum("changed").alias("n"))
    return (renames.select("slide_id").distinct().join(n, "slide_id", "left")
            .select("slide_id", F.coalesce("n", F.lit(0)).alias("n_changed"), F.col("n").isNull().cast("int").alias("missing")))


def filter_items(items: DataFrame, purposes: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """Items of any listed purpose and any listed category; unknown names match nothing."""
    if purposes is not None:
        items = items.where(F.col("purpose").isin(purposes))
    if categories is not None:
        items = items.where(F.col("category").isin(categories))
    return items


def purpose_counts(items: DataFrame) -> DataFrame:
    """Item counts per purpose and category with their totals (null = all)."""
    return (items.cube("purpose", "category").agg(F.count(F.lit(1)).alias("n"), F.grouping("purpose").cast("int").alias("all_purposes"),
                                                  F.grouping("category").cast("int").alias("all_categories")))


def label_index(items: DataFrame) -> DataFrame:
    """(label, item) pairs: which items hold a label. Kept long, so a common label stays distributed."""
    return items.select(F.explode(F.array_distinct("labels")).alias("label"), "item_id")


def labels_equal_check(found: DataFrame, items: DataFrame) -> DataFrame:
    """Items whose found labels are not the configured labels plus 0 (``missing`` / ``extra``)."""
    j = items.select("item_id", F.array_union("labels", F.array(F.lit(0))).alias("_want")).join(
        found.select("item_id", F.col("labels").alias("_have")), "item_id")
    return (j.select("item_id", F.array_sort(F.array_except("_want", "_have")).alias("missing"),
                     F.array_sort(F.array_except("_have", "_want")).alias("extra"))
            .where("size(missing) > 0 OR size(extra) > 0"))


def label_subset_check(found: DataFrame, items: DataFrame) -> DataFrame:
    """Items that configure a label which the statistics lack."""
    j = items.select("item_id", F.col("labels").alias("_want")).join(found.select("item_id", F.col("labels").alias("_have")), "item_id")
    return j.select("item_id", F.array_sort(F.array_except("_want", "_have")).alias("missing")).where("size(missing) > 0")


def fold_union(items: DataFrame, folds: int) -> DataFrame:
    """Every item once per fold: 'validation' in its own fold (column ``fold``), 'training' elsewhere."""
    return (items.withColumnRenamed("fold", "_own")
            .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
            .withColumn("purpose", F.when(F.col("_own") == F.col("fold"), "validation").otherwise("training")).drop("_own"))


def sampler_delta(before: DataFrame, after: DataFrame, key: str = "item_id") -> DataFrame:
    """Items as 'kept', 'removed' or 'added' between two selections."""
    a = before.select(key).distinct().withColumn("_a", F.lit(True))
    b = after.select(key).distinct().withColumn("_b", F.lit(True))
    state = F.when(F.col("_b").isNull(), "removed").when(F.col("_a").isNull(), "added").otherwise("kept")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def push_items(items: DataFrame, new_items: DataFrame, purpose: str | None) -> tuple[DataFrame, DataFrame]:
    """The union with the new items under the purpose, and the purpose ratios as item counts."""
    allitems = items.unionByName(new_items.withColumn("purpose", F.lit(purpose)))
    return allitems, allitems.groupBy("purpose").agg(F.count(F.lit(1)).alias("ratio"))


def validate_distribution(items: DataFrame, ratios: dict[str, float], configured: dict[str, float]) -> DataFrame:
    """Per purpose of the items: normalised given and configured ratio and whether they agree to 1e-9."""
    total, ctotal = sum(ratios.values()), sum(configured.get(p, 0.0) for p in ratios)
    pairs = [x for p, r in ratios.items() for x in (F.lit(p), F.struct(F.lit(r / total).alias("a"), F.lit(
        configured[p] / ctotal if p in configured else None).cast("double").alias("b")))]
    v = F.create_map(*pairs)[F.col("purpose")]
    close = F.abs(v["a"] - v["b"]) <= F.lit(1e-9) * F.greatest(F.abs(v["a"]), F.abs(v["b"]))
    return (items.where(F.col("purpose").isin(list(ratios))).groupBy("purpose").agg(F.count(F.lit(1)).alias("n"))
            .select("purpose", "n", F.coalesce(close, F.lit(False)).cast("int").alias("valid")))


def item_paths(items: DataFrame, path_vars: dict[str, str]) -> DataFrame:
    """Items with tags replaced and paths normalised; a missing mask or stat stays null."""
    for c in ("image", "mask", "stat"):
        if c in items.columns:
            items = items.withColumn(c, F.when(F.coalesce(F.col(c), F.lit("")) != "",
                                               norm_path(fill_template(F.col(c), path_vars))))
    return items


def check_counts(items: DataFrame, listing: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Files of the items (image, mask, stat) that exist and that are missing; an MRXS file also needs its
    companion folder."""
    files = items.select(F.explode(F.array("image", "mask", "stat")).alias("path")).where("path IS NOT NULL").distinct()
    have = listing.select("path").distinct()
    folders = listing.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("_dir")).distinct()
    f = files.join(have.withColumn("_ok", F.lit(True)), "path", "left")
    base = F.left(F.col("path"), F.length("path") - F.length(extension(F.col("path"))))
    f = f.withColumn("_dir", base).join(folders.withColumn("_folder", F.lit(True)), "_dir", "left")
    ok = F.col("_ok").isNotNull() & ((F.lower(extension(F.col("path"))) != ".mrxs") | F.col("_folder").isNotNull())
    return f.agg(F.count_if(ok | F.lit(allow_missing)).alias("n_ok"), F.count_if(~ok & F.lit(not allow_missing)).alias("n_missing"))


def rename_plan(items: DataFrame, source_vars: dict[str, str], target_vars: dict[str, str],
                companions: DataFrame | None = None) -> DataFrame:
    """(source, target) file pairs for moving items between roots; files in the companion folder of an MRXS
    image follow it. ``companions`` is a listing of candidate files."""
    raw = items.select(F.explode(F.array("image", "mask", "stat")).alias("_p")).where("_p IS NOT NULL")
    plan = raw.select(norm_path(fill_template(F.col("_p"), source_vars)).alias("source"),
                      norm_path(fill_template(F.col("_p"), target_vars)).alias("target")).distinct()
    if companions is None:
        return plan
    cut = lambda c: F.left(F.col(c), F.length(c) - F.length(extension(F.col(c))))
    mrxs = plan.where(F.lower(extension(F.col("source"))) == ".mrxs").select(cut("source").alias("_dir"), cut("target").alias("_to"))
    inside = companions.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("_dir")).join(mrxs, "_dir")
    return plan.unionByName(inside.select(F.col("path").alias("source"),
                                          F.concat("_to", F.lit("/"), basename(F.col("path"))).alias("target")))


def job_outcomes(jobs: DataFrame, error: Column) -> DataFrame:
    """Adds ``status``: 'failed' where the error expression is not null, else 'done'."""
    return jobs.withColumn("error", error).withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise("done"))
