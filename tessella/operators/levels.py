"""Resolution levels: which level answers a requested spacing, and how spacings are repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _within(tol: float):
    return ((F.col("req_spacing") >= F.col("spacing") * (1.0 - tol))
            & (F.col("req_spacing") <= F.col("spacing") * (1.0 + tol)))


def resolve_level(requests: DataFrame, levels: DataFrame, tol: float = 0.25) -> DataFrame:
    """First level whose [s(1-tol), s(1+tol)] holds the requested spacing; ``level`` is null if none does."""
    hits = (requests.join(levels.select("slide_id", "level", "spacing"), "slide_id").where(_within(tol))
            .groupBy("slide_id", "req_spacing").agg(F.min("level").alias("level")))
    return requests.select("slide_id", "req_spacing").distinct().join(hits, ["slide_id", "req_spacing"], "left")


def test_spacing(requests: DataFrame, levels: DataFrame, tol: float = 0.25) -> DataFrame:
    r = resolve_level(requests, levels, tol)
    return r.select("slide_id", "req_spacing", F.col("level").isNotNull().cast("int").alias("present"))


def refine_spacing(requests: DataFrame, levels: DataFrame, tol: float = 0.25) -> DataFrame:
    """The spacing of the resolved level."""
    return (resolve_level(requests, levels, tol).where("level IS NOT NULL")
            .join(levels.select("slide_id", "level", "spacing"), ["slide_id", "level"])
            .select("slide_id", "req_spacing", "spacing"))


def find_mask_level(requests: DataFrame, mask_levels: DataFrame, tol: float = 0.25) -> DataFrame:
    """Level of the mask for an input spacing: a tolerance match, else one finer than the first coarser
    level (0 when none is coarser); -1 when the slide has no mask."""
    j = requests.join(mask_levels.select("slide_id", "level", "spacing"), "slide_id", "left")
    agg = j.groupBy("slide_id", "req_spacing").agg(
        F.min(F.when(_within(tol), F.col("level"))).alias("exact"),
        F.min(F.when(F.col("req_spacing") < F.col("spacing"), F.col("level"))).alias("coarser"),
        F.count("level").alias("n"))
    level = F.when(F.col("n") == 0, F.lit(-1)).otherwise(
        F.coalesce("exact", F.greatest(F.col("coarser") - 1, F.lit(0)), F.lit(0)))
    return agg.select("slide_id", "req_spacing", level.cast("int").alias("level"))


def match_equal_shape_level(image_levels: DataFrame, mask_levels: DataFrame) -> DataFrame:
    """First mask level with the same shape as each image level."""
    m = mask_levels.select("slide_id", "rows", "cols", F.col("level").alias("mask_level"))
    return (image_levels.join(m, ["slide_id", "rows", "cols"], "left")
            .groupBy("slide_id", "level").agg(F.min("mask_level").alias("mask_level")))


def set_spacing(levels: DataFrame, spacing: float, level: int = 0) -> DataFrame:
    """Give ``level`` the spacing and scale every other level by its downsampling ratio."""
    ref = levels.where(F.col("level") == level).select("slide_id", F.col("downsampling").alias("_ref"))
    return (levels.join(ref, "slide_id")
            .withColumn("spacing", F.lit(spacing) * F.col("downsampling") / F.col("_ref")).drop("_ref"))


def slide_info(levels: DataFrame) -> DataFrame:
    return levels.select("slide_id", "level", "rows", "cols", "spacing", "downsampling")


def level_alignment(image_levels: DataFrame, stat_levels: DataFrame, tol: float = 0.25) -> DataFrame:
    """Per image level: the level the statistics belong to, the downsampling from it and the centre shift.

    ``stat_levels`` has one row per slide (shape and spacing of the statistics).
    """
    s = stat_levels.select("slide_id", F.col("rows").alias("s_rows"), F.col("cols").alias("s_cols"),
                           F.col("spacing").alias("s_spacing"))
    match = (image_levels.join(s, "slide_id")
             .where((F.col("rows") == F.col("s_rows")) & (F.col("cols") == F.col("s_cols"))
                    & (F.abs(F.col("spacing") - F.col("s_spacing")) < tol))
             .groupBy("slide_id").agg(F.min_by(F.struct("level", "downsampling"), "level").alias("m"))
             .select("slide_id", F.col("m.level").alias("stats_level"), F.col("m.downsampling").alias("_d")))
    d = F.col("_d") / F.col("downsampling")
    return (image_levels.join(match, "slide_id")
            .select("slide_id", "level", "stats_level", d.alias("stats_downsampling"),
                    F.greatest(F.lit(0), F.floor(F.floor(d) / 2).cast("int") - 1).alias("stats_shift")))
