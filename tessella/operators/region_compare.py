"""Region-wise comparison of a reference raster with a template raster of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import label_components
from .raster import PIXEL


def _classify(base: DataFrame, other: DataFrame, threshold: float, connectivity: int, tile: int) -> DataFrame:
    """Pixels of ``base`` with their region, whether ``other`` covers them and whether more than the
    threshold share of the region is covered."""
    comps = label_components(base.select(*PIXEL, F.lit(1).alias("label")), connectivity, tile)
    hit = comps.join(other.select(*PIXEL, F.lit(1).alias("_o")), PIXEL, "left").select(
        *PIXEL, "comp", F.col("_o").isNotNull().alias("covered"))
    share = hit.groupBy("slide_id", "comp").agg(
        (F.count_if("covered") / F.count(F.lit(1)) > threshold).alias("found"))
    return hit.join(share, ["slide_id", "comp"])


def region_detection_stats(reference: DataFrame, template: DataFrame, threshold: float, connectivity: int = 4,
                           tile: int = 512, false_threshold: float | None = None) -> DataFrame:
    """Per slide: detected (tp) and missed (fn) reference regions, and template regions that the reference
    does not confirm (fp)."""
    false_threshold = threshold if false_threshold is None else false_threshold
    a = (_classify(reference, template, threshold, connectivity, tile).select("slide_id", "comp", "found").distinct()
         .select("slide_id", F.col("found").cast("int").alias("tp"), (~F.col("found")).cast("int").alias("fn"),
                 F.lit(0).alias("fp")))
    b = (_classify(template, reference, false_threshold, connectivity, tile).select("slide_id", "comp", "found").distinct()
         .select("slide_id", F.lit(0).alias("tp"), F.lit(0).alias("fn"), (~F.col("found")).cast("int").alias("fp")))
    return a.unionByName(b).groupBy("slide_id").agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp")])


def region_comparison_map(reference: DataFrame, template: DataFrame, threshold: float, connectivity: int = 4,
                          tile: int = 512, false_threshold: float | None = None,
                          labels: tuple[int, int, int, int, int, int] = (1, 2, 3, 4, 5, 6)) -> DataFrame:
    """Pixel classes: detected covered / uncovered, missed covered / uncovered, then template pixels outside
    the reference in confirmed and unconfirmed regions. The reference classes win where both apply."""
    dp, dn, mp, mn, fp, fn = labels
    false_threshold = threshold if false_threshold is None else false_threshold
    a = _classify(reference, template, threshold, connectivity, tile)
    first = a.select(*PIXEL, F.when(F.col("found"), F.when(F.col("covered"), dp).otherwise(dn))
                     .otherwise(F.when(F.col("covered"), mp).otherwise(mn)).alias("label"))
    b = _classify(template, reference, false_threshold, connectivity, tile)
    second = b.where("NOT covered").select(*PIXEL, F.when(F.col("found"), fp).otherwise(fn).alias("label"))
    return first.unionByName(second)
