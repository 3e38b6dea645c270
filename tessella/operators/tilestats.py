"""Per-tile label statistics and what is answered from them without touching the pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def at_tile(df: DataFrame, tile: int) -> DataFrame:
    return (df.withColumn("tile_row", F.floor(F.col("row") / tile).cast("int"))
            .withColumn("tile_col", F.floor(F.col("col") / tile).cast("int")))


def tile_label_counts(mask: DataFrame, tile: int = 512, labels: list[int] | None = None) -> DataFrame:
    """Pixels per (tile, label) for the listed labels; labels a tile lacks are not stored."""
    m = mask if labels is None else mask.where(F.col("label").isin(labels))
    return (at_tile(m, tile).groupBy("slide_id", "tile_row", "tile_col", "label")
            .agg(F.count(F.lit(1)).alias("n")))


def tile_grid(levels: DataFrame, tile: int) -> DataFrame:
    return (levels.select("slide_id", "cols", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("rows") - 1) / tile).cast("int"))).alias("tile_row"))
        .select("slide_id", "tile_row", F.explode(F.sequence(
            F.lit(0), F.floor((F.col("cols") - 1) / tile).cast("int"))).alias("tile_col")))


def tile_fill(counts: DataFrame, levels: DataFrame, tile: int = 512) -> DataFrame:
    """Per tile of the grid: -1 when no counted label occurs, the label when it fills the whole tile,
    null when the tile is mixed."""
    per_tile = counts.groupBy("slide_id", "tile_row", "tile_col").agg(
        F.max("n").alias("top"), F.max_by("label", "n").alias("label"))
    fill = F.when(F.col("top").isNull(), F.lit(-1)).when(F.col("top") == tile * tile, F.col("label"))
    return (tile_grid(levels, tile).join(per_tile, ["slide_id", "tile_row", "tile_col"], "left")
            .select("slide_id", "tile_row", "tile_col", fill.cast("int").alias("fill_label")))


def slide_label_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("slide_id", "label").agg(F.sum("n").alias("n"))


def labels_in_mask(mask: DataFrame, allowed: list[int] | None = None) -> DataFrame:
    """Sorted label set of each slide (bounded by the label range), restricted to the allowed labels."""
    found = F.collect_set("label")
    if allowed is not None:
        found = F.array_intersect(found, F.array(*[F.lit(x) for x in allowed]))
    return mask.groupBy("slide_id").agg(F.array_sort(found).alias("labels"))


def cumulative_tile_counts(counts: DataFrame) -> DataFrame:
    """Adds running sums: along the tile columns of a row and over whole tile rows up to this one.
    The windows are as long as the tile grid is wide or high."""
    w = Window.partitionBy("slide_id", "label", "tile_row").orderBy("tile_col").rowsBetween(
        Window.unboundedPreceding, 0)
    rows = counts.groupBy("slide_id", "label", "tile_row").agg(F.sum("n").alias("_row"))
    up = Window.partitionBy("slide_id", "label").orderBy("tile_row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("slide_id", "label", "tile_row", F.sum("_row").over(up).alias("cum_rows"))
    return (counts.withColumn("cum_in_row", F.sum("n").over(w))
            .join(rows, ["slide_id", "label", "tile_row"]))


def nth_labelled_pixel(mask: DataFrame, draws: DataFrame, tile: int = 512) -> DataFrame:
    """Position of the n-th (from 0) pixel of a label, counted tile row by tile row, tile by tile and
    row-major inside a tile. ``draws`` has ``slide_id, label, n`` and any key columns.

    The sorted running counts of the tile rows (then of the row's tiles) travel as arrays no longer than
    the tile grid, so a draw finds its tile by counting array entries; only the pixels of drawn tiles are
    ranked, one tile per group.
    """
    wanted = draws.select("slide_id", "label").distinct()
    counts = tile_label_counts(mask.join(wanted, ["slide_id", "label"], "left_semi"), tile)
    # one pass over the mask; the tile counts are small and read three times below
    cum = materialize(cumulative_tile_counts(counts))
    row_index = cum.groupBy("slide_id", "label").agg(
        F.sort_array(F.collect_set(F.struct("cum_rows", "tile_row"))).alias("_rows"))
    col_index = cum.groupBy("slide_id", "label", "tile_row").agg(
        F.sort_array(F.collect_list(F.struct("cum_in_row", "tile_col"))).alias("_cols"))

    def locate(arr, field, n):
        # 0-based position of the first entry whose running count exceeds n
        return F.size(F.filter(arr, lambda e: e[field] <= F.col(n)))
    d = materialize(draws.join(row_index, ["slide_id", "label"])
         .withColumn("_i", locate("_rows", "cum_rows", "n")).where(F.col("_i") < F.size("_rows"))
         .withColumn("tile_row", F.expr("get(_rows, _i).tile_row"))
         .withColumn("_k", F.col("n") - F.expr("coalesce(get(_rows, _i - 1).cum_rows, 0)"))
         .drop("_rows", "_i")
         .join(col_index, ["slide_id", "label", "tile_row"])
         .withColumn("_i", locate("_cols", "cum_in_row", "_k"))
         .withColumn("tile_col", F.expr("get(_cols, _i).tile_col"))
         .withColumn("_k", F.col("_k") - F.expr("coalesce(get(_cols, _i - 1).cum_in_row, 0)"))
         .drop("_cols", "_i"))
    keys = ["slide_id", "label", "tile_row", "tile_col"]
    pixels = at_tile(mask.select("slide_id", "row", "col", "label"), tile).join(
        d.select(*keys).distinct(), keys, "left_semi")
    w = Window.partitionBy(*keys).orderBy("row", "col")
    ranked = pixels.withColumn("_k", (F.row_number().over(w) - 1).cast("bigint"))
    return d.join(ranked, [*keys, "_k"]).select(*draws.columns, "row", "col")


def construct_labels(windows: DataFrame, fill: DataFrame, mask: DataFrame, tile: int = 512) -> DataFrame:
    """Label windows ``(win_id, slide_id, row0, col0, h, w)`` rebuilt from the tile fill: empty or outside
    tiles give 0, homogeneous tiles their label; stored pixels are read for mixed tiles only."""
    r = F.explode(F.sequence(F.col("row0"), F.col("row0") + F.col("h") - 1)).alias("row")
    c = F.explode(F.sequence(F.col("col0"), F.col("col0") + F.col("w") - 1)).alias("col")
    frame = (windows.select("win_id", "slide_id", "row0", "col0", "w", r)
             .select("win_id", "slide_id", "row0", "col0", "row", c))
    keys = ["slide_id", "tile_row", "tile_col"]
    known = at_tile(frame, tile).join(fill.withColumn("_known", F.lit(True)), keys, "left")
    mixed = at_tile(mask.select("slide_id", "row", "col", "label"), tile).join(
        fill.where("fill_label IS NULL").select(*keys), keys, "left_semi").drop("tile_row", "tile_col")
    label = (F.when(F.col("_known").isNull(), F.lit(0)).when(F.col("fill_label") < 0, F.lit(0))
             .otherwise(F.coalesce("fill_label", "label", F.lit(0))))
    return (known.join(mixed, ["slide_id", "row", "col"], "left")
            .select("win_id", (F.col("row") - F.col("row0")).alias("y"), (F.col("col") - F.col("col0")).alias("x"),
                    label.alias("label")))
