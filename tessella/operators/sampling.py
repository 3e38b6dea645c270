"""Class-balanced sampling: sources, patch counts, pixels and patches."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import shuffled_rank, uniform
from ..session import materialize, row_count
from ..sources.rasters import read_patches
from .boxes import patch_boxes
from .raster import literal_map
from .splits import distribute_population
from .tilestats import nth_labelled_pixel, slide_label_counts, tile_label_counts


def _bins(groups: DataFrame, keys: list[str], ratios: dict, by_minimum: bool = True) -> DataFrame:
    """One bin per ratio entry; each positive ratio gets at least one when the population allows it."""
    entries = F.explode(F.array(*[F.struct(F.lit(k).alias("bin"), F.lit(float(r)).alias("ratio")) for k, r in ratios.items()]))
    lo = F.when((F.col("population") >= len(ratios)) & (F.col("ratio") > 0), 1).otherwise(0) if by_minimum else F.lit(0)
    return groups.select(*keys, "population", entries.alias("s")).select(
        *keys, "population", "s.*").select("*", lo.alias("lo"), F.col("population").alias("hi"))


def sample_sources(items: DataFrame, category_ratios: dict[str, float], label_ratios: dict[int, float], count: int,
                   seed: int) -> DataFrame:
    """Choose ``count`` items ``(item_id, category, labels)``: counts per category, then per label; labels in
    random order take unused items that hold them; gaps are filled from the category, then from any item with
    a wanted label. Each label is one step over the remaining items."""
    pool = materialize(items.where(F.col("category").isin(list(category_ratios))).select("item_id", "category", "labels"))
    total = pool.agg(F.least(F.count(F.lit(1)), F.lit(count)).alias("population"))
    per_cat = distribute_population(_bins(total, [], category_ratios), [], seed).select(
        F.col("bin").alias("category"), F.col("n").alias("population")).where("population > 0")
    per_cat = materialize(per_cat)
    per_label = materialize(distribute_population(_bins(per_cat, ["category"], label_ratios), ["category"], seed + 1)
                            .select("category", F.col("bin").alias("_label"), "n"))
    order = list(label_ratios)
    random.Random(seed).shuffle(order)
    picks = []

    def unused():
        if not picks:
            return pool
        return pool.join(reduce(DataFrame.unionByName, picks).select("item_id"), "item_id", "left_anti")

    for i, label in enumerate(order):
        want = per_label.where(F.col("_label") == label).select("category", "n")
        have = unused().where(F.array_contains("labels", label))
        r = shuffled_rank(have, ["category"], ["item_id"], seed + 10 + i, "_rn").join(want, "category")
        picks.append(materialize(r.where(F.col("_rn") <= F.col("n")).select("item_id", "category", "labels")))
    chosen = reduce(DataFrame.unionByName, picks)
    got = chosen.groupBy("category").agg(F.count(F.lit(1)).alias("_got"))
    need = per_cat.join(got, "category", "left").select("category", (F.col("population") - F.coalesce("_got", F.lit(0))).alias("n"))
    r = shuffled_rank(unused(), ["category"], ["item_id"], seed + 2, "_rn").join(need, "category")
    picks.append(materialize(r.where(F.col("_rn") <= F.col("n")).select("item_id", "category", "labels")))
    chosen = reduce(DataFrame.unionByName, picks)
    missing = total.select("population", F.lit(1).alias("_k")).join(
        chosen.agg(F.count(F.lit(1)).alias("_got")).withColumn("_k", F.lit(1)), "_k").select("_k", (F.col("population") - F.col("_got")).alias("n"))
    wanted = unused().where(F.arrays_overlap("labels", F.array(*[F.lit(x) for x in label_ratios])))
    r = shuffled_rank(wanted, [], ["item_id"], seed + 3, "_rn").withColumn("_k", F.lit(1)).join(missing, "_k")
    picks.append(r.where(F.col("_rn") <= F.col("n")).select("item_id", "category", "labels"))
    return reduce(DataFrame.unionByName, picks)


def missing_labels(selection: DataFrame, label_ratios: dict[int, float]) -> DataFrame:
    """Labels with a positive ratio that no selected item holds (strict selection needs this empty)."""
    wanted = [k for k, r in label_ratios.items() if r > 0]
    # the wanted labels are a small literal; they become rows next to the one-row global aggregate
    have = selection.select(F.explode("labels").alias("label")).agg(F.collect_set("label").alias("_have"))
    return have.select(F.explode(F.array_except(F.array(*[F.lit(w) for w in wanted]), "_have")).alias("label"))


def patch_distribution(sources: DataFrame, label_ratios: dict[int, float], count: int, seed: int,
                       strict: bool = False) -> DataFrame:
    """Patches per source and label ``(item_id, label, n)``: the count over the labels that the sources hold
    (over all labels when strict), then evenly over the holders of each label."""
    held = sources.select("item_id", F.explode(F.array_distinct("labels")).alias("label")).where(
        F.col("label").isin(list(label_ratios)))
    holders = materialize(held.groupBy("label").agg(F.count(F.lit(1)).alias("k")))
    ratio = literal_map({k: float(v) for k, v in label_ratios.items()})[F.col("label")]
    avail = holders.select("label", ratio.alias("_w"))
    norm = avail.agg(F.sum("_w").alias("_t")).withColumn("_k", F.lit(1))
    if strict:
        norm = norm.withColumn("_t", F.lit(float(sum(label_ratios.values()))))
    bins = (avail.withColumn("_k", F.lit(1)).join(norm, "_k")
            .select(F.col("label").alias("bin"), (F.col("_w") / F.col("_t")).alias("ratio"), F.lit(0).alias("lo"),
                    F.lit(count).alias("hi"), F.lit(count).alias("population")))
    per_label = distribute_population(bins, [], seed).select(F.col("bin").alias("label"), F.col("n").alias("population")).where("population > 0")
    inner = (held.join(per_label, "label").join(holders, "label")
             .select("label", F.col("item_id").alias("bin"), (1.0 / F.col("k")).alias("ratio"), F.lit(0).alias("lo"),
                     F.col("population").alias("hi"), "population"))
    out = distribute_population(inner, ["label"], seed + 1)
    return out.where("n > 0").select(F.col("bin").alias("item_id"), "label", "n")


def epoch_sample_list(distribution: DataFrame, seed: int) -> DataFrame:
    """One row per patch to draw, in random order: ``(position, item_id, label, draw)``."""
    rows = distribution.select("item_id", "label", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("draw"))
    return shuffled_rank(rows, [], ["item_id", "label", "draw"], seed, "position")


def random_pixel_index(draws: DataFrame, counts: DataFrame, seed: int) -> DataFrame:
    """A uniform pixel index in [0, count) per draw ``(draw_id, slide_id, label)``, with replacement. Draws of
    a label the slide lacks are dropped."""
    c = counts.select("slide_id", "label", F.col("n").alias("_c"))
    return draws.join(c, ["slide_id", "label"]).withColumn(
        "n", F.floor(uniform(seed, "draw_id") * F.col("_c")).cast("bigint")).drop("_c")


def patch_windows(centres: DataFrame, alignment: DataFrame, shapes: dict[int, tuple[int, int]]) -> DataFrame:
    """Window per centre and image level: centre * downsampling (truncated) + shift - (shape - 1) // 2."""
    shape = F.create_map(*[x for lv, (h, w) in shapes.items() for x in (F.lit(lv), F.struct(F.lit(h).alias("h"), F.lit(w).alias("w")))])
    a = alignment.where(F.col("level").isin(list(shapes))).select("slide_id", "level", "stats_downsampling", "stats_shift")
    at = lambda c: ((F.col(c) * F.col("stats_downsampling")).cast("int") + F.col("stats_shift"))
    j = centres.join(a, "slide_id").withColumn("_s", shape[F.col("level")])
    return j.select("draw_id", "slide_id", "label", "level", at("row").alias("center_row"), at("col").alias("center_col"),
                    (at("row") - F.floor((F.col("_s.h") - 1) / 2).cast("int")).alias("row0"),
                    (at("col") - F.floor((F.col("_s.w") - 1) / 2).cast("int")).alias("col0"), F.col("_s.h").alias("h"), F.col("_s.w").alias("w"))


def sample_patches(images: DataFrame, mask: DataFrame, draws: DataFrame, alignment: DataFrame,
                   shapes: dict[int, tuple[int, int]], seed: int, values: list[str], tile: int = 512,
                   label_mode: str = "central") -> DataFrame:
    """Patches around random pixels of the drawn labels, one row per draw and level with row-major value
    arrays (one per channel). ``images`` is ``(slide_id, level, row, col, values)``.

    'central' keeps the drawn label; 'load' adds the label patch from the mask (statistics level only).
    """
    counts = slide_label_counts(tile_label_counts(mask, tile))
    idx = random_pixel_index(draws, counts, seed)
    centres = nth_labelled_pixel(mask, idx, tile)
    # the windows are read by several joins; writing them once also keeps the plan small
    win = materialize(patch_windows(centres, alignment, shapes))
    out = None
    for level in shapes:
        w = win.where(F.col("level") == level).withColumnRenamed("draw_id", "req_id")
        px = images.where(F.col("level") == level)
        load = mask if label_mode == "load" else None
        lv = read_patches(px, w, values, load).select(
            F.col("req_id").alias("patch_id"), "slide_id", "label", F.lit(level).alias("level"), "center_row", "center_col",
            *values, *([] if load is None else ["labels"]))
        out = lv if out is None else out.unionByName(lv)
    return out


def sample_box_patches(boxes: DataFrame, draws: DataFrame, shape: tuple[int, int], seed: int, cell: int = 512) -> tuple[DataFrame, DataFrame]:
    """For each draw ``(draw_id, slide_id, cls)``: a random box of the class, a random point in it (borders
    included) and the window around it; second, the boxes inside each window moved to its origin."""
    counts = boxes.groupBy("slide_id", "cls").agg(F.count(F.lit(1)).alias("_c"))
    numbered = shuffled_rank(boxes, ["slide_id", "cls"], ["box_id"], seed, "_rn")
    d = draws.join(counts, ["slide_id", "cls"]).withColumn("_rn", (F.floor(uniform(seed + 1, "draw_id") * F.col("_c")) + 1).cast("bigint"))
    j = d.join(numbered, ["slide_id", "cls", "_rn"])
    pick = lambda k, a, b: (F.floor(uniform(seed + k, "draw_id") * (F.col(b) - F.col(a) + 1)) + F.col(a)).cast("int")
    patches = j.select(F.col("draw_id").alias("patch_id"), "slide_id", "cls", "box_id", pick(2, "y0", "y1").alias("center_row"),
                       pick(3, "x0", "x1").alias("center_col"), F.lit(shape[0]).alias("h"), F.lit(shape[1]).alias("w"))
    patches = materialize(patches)
    return patches, patch_boxes(boxes, patches, cell)


def patch_weights(px: DataFrame, label_ratios: dict[int, float], ignore: int = -100) -> DataFrame:
    """Weight 1 for labels of the distribution, else 0 with the target set to the ignored value."""
    w = F.col("label").isin(list(label_ratios)).cast("int")
    return px.withColumn("weight", w).withColumn("target", F.when(w == 0, F.lit(ignore)).otherwise(F.col("label")))


def extract_patches(items: DataFrame, masks: DataFrame, images: DataFrame, alignment: DataFrame, category_ratios: dict,
                    label_ratios: dict[int, float], sources: int, count: int, shapes: dict[int, tuple[int, int]], seed: int,
                    values: list[str], tile: int = 512) -> DataFrame:
    """Sources, counts, pixels and patches in one go; an item's id is its slide."""
    chosen = materialize(sample_sources(items, category_ratios, label_ratios, sources, seed))
    dist = materialize(patch_distribution(chosen, label_ratios, count, seed + 100))
    plan = epoch_sample_list(dist, seed + 200).select(F.col("position").alias("draw_id"), F.col("item_id").alias("slide_id"), "label")
    plan, _ = row_count(plan)
    return sample_patches(images, masks, plan, alignment, shapes, seed + 300, values, tile)
