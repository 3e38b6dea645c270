"""Pixel algebra on long raster tables ``(slide_id, row, col, label)``.

A missing pixel has the empty value 0, so rasters may be sparse. Label maps come from the caller and are
bounded by the label range; they become a literal map, never a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIXEL = ["slide_id", "row", "col"]

# Preview colours per label, 0 is the background.
PALETTE = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0), (1.0, 0.5, 0.0), (1.0, 0.0, 0.5),
           (0.5, 0.0, 1.0), (1.0, 1.0, 0.0), (1.0, 0.5, 1.0), (0.0, 1.0, 1.0), (0.5, 0.0, 0.0)]
# Luma weights of red, green and blue.
LUMA = (0.2125, 0.7154, 0.0721)


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def pixel_align(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both rasters on the union of their stored pixels: ``l`` and ``r``, 0 where one has none."""
    a = left.select(*PIXEL, F.col("label").alias("l"))
    b = right.select(*PIXEL, F.col("label").alias("r"))
    return (a.join(b, PIXEL, "full_outer")
            .select(*PIXEL, F.coalesce("l", F.lit(0)).alias("l"), F.coalesce("r", F.lit(0)).alias("r")))


def shape_mismatches(left_levels: DataFrame, right_levels: DataFrame) -> DataFrame:
    """Slides whose two rasters differ in shape and therefore cannot be aligned."""
    a = left_levels.select("slide_id", F.col("rows").alias("l_rows"), F.col("cols").alias("l_cols"))
    b = right_levels.select("slide_id", F.col("rows").alias("r_rows"), F.col("cols").alias("r_cols"))
    return a.join(b, "slide_id").where("l_rows != r_rows OR l_cols != r_cols")


def raster_arithmetic(left: DataFrame, right: DataFrame, operand: str, accept_singles: bool = False,
                      modulus: int = 256) -> DataFrame:
    """``left operand right`` per pixel with unsigned wrap-around. A slide that only one side has is
    copied when ``accept_singles`` is set and left out otherwise."""
    ops = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b}
    if operand not in ops:
        raise ValueError(f"unknown operand {operand!r}")
    sides = (left.select("slide_id").distinct().withColumn("in_l", F.lit(True))
             .join(right.select("slide_id").distinct().withColumn("in_r", F.lit(True)), "slide_id", "full_outer"))
    both = F.col("in_l").isNotNull() & F.col("in_r").isNotNull()
    value = F.when(both, F.pmod(ops[operand](F.col("l"), F.col("r")), F.lit(modulus))).otherwise(
        F.when(F.col("in_l").isNotNull(), F.col("l")).otherwise(F.col("r")))
    joined = pixel_align(left, right).join(sides if accept_singles else sides.where(both), "slide_id")
    return joined.select(*PIXEL, value.cast("int").alias("label"))


def threshold(df: DataFrame, low: float) -> DataFrame:
    return df.withColumn("label", (F.col("label") >= low).cast("int"))


def map_labels(df: DataFrame, mapping: dict[int, int]) -> DataFrame:
    """All labels at once; a label without an entry stays."""
    return df.withColumn("label", F.coalesce(literal_map(mapping)[F.col("label")], "label"))


def map_labels_lut(df: DataFrame, mapping: dict[int, int]) -> DataFrame:
    """A label without an entry becomes 0; a label above the largest key is an error."""
    top = max(mapping)
    ok = F.when(F.col("label") > top, F.raise_error(F.lit(f"label above {top}"))).otherwise(
        F.coalesce(literal_map(mapping)[F.col("label")], F.lit(0)))
    return df.withColumn("label", ok)


def map_labels_valid(df: DataFrame, mapping: dict[int, int]) -> DataFrame:
    """Mapped label plus ``valid``; an unmapped label is replaced by the one that maps to 0."""
    hit = literal_map(mapping)[F.col("label")]
    return df.withColumn("valid", hit.isNotNull().cast("int")).withColumn("label", F.coalesce(hit, F.lit(0)))


def map_classes(classes: DataFrame, mapping: dict[str, str], keys: list[str]) -> DataFrame:
    """Rename ``cls`` through the mapping inside each dictionary (``keys``). When several classes get the
    same mapped name only the first (lowest ``cls_order``) stays; classes outside the mapping are kept."""
    hit = classes.withColumn("_m", literal_map(mapping)[F.col("cls")])
    new = hit.withColumn("cls", F.coalesce("_m", "cls"))
    rank = F.row_number().over(Window.partitionBy(*keys, "cls").orderBy("cls_order"))
    return new.withColumn("_r", rank).where((F.col("_r") == 1) | F.col("_m").isNull()).drop("_r", "_m")


def argmax_label(df: DataFrame, probs: str = "probs") -> DataFrame:
    """Hard label: 1-based position of the first maximum."""
    return df.withColumn("label", F.array_position(probs, F.array_max(probs)).cast("int")).drop(probs)


def quantize(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Clip to [low, high], scale to 0..255 and truncate."""
    scaled = (value - F.lit(low)) / F.lit(high - low) * F.lit(255.0)
    return F.floor(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(255.0))).cast("int")


def select_channels(df: DataFrame, channels: list[int], column: str = "px") -> DataFrame:
    """Keep the listed channels of an array column; an index outside it is an error."""
    checked = F.when(F.size(column) <= max(channels), F.raise_error(F.lit("channel index out of range")))
    return df.withColumn(column, F.coalesce(checked.cast(df.schema[column].dataType),
                                            F.array(*[F.col(column)[i] for i in channels])))


def mask_filter(df: DataFrame, mask: DataFrame, mask_class: int | None = None, value: str = "label") -> DataFrame:
    """Keep ``value`` where the mask has the class (any non-zero label when None), 0 elsewhere."""
    hit = (F.col("label") == mask_class) if mask_class is not None else (F.col("label") > 0)
    m = mask.where(hit).select(*PIXEL, F.lit(True).alias("_in"))
    return (df.join(m, PIXEL, "left")
            .withColumn(value, F.when(F.col("_in"), F.col(value)).otherwise(F.lit(0)).cast(df.schema[value].dataType))
            .drop("_in"))


def blank_by_label(rgb: DataFrame, mask: DataFrame, blank: int = 2, channels=("r", "g", "b"),
                   keep_mask: int | None = None) -> DataFrame:
    """Zero every channel where the mask has ``blank``; ``keep_mask`` also returns (label == keep_mask)."""
    m = mask.select(*PIXEL, "label")
    out = rgb.join(m, PIXEL, "left")
    on = F.coalesce(F.col("label") == blank, F.lit(False))
    cols = [F.when(on, F.lit(0)).otherwise(F.col(c)).alias(c) for c in channels]
    if keep_mask is not None:
        cols.append(F.coalesce(F.col("label") == keep_mask, F.lit(False)).cast("int").alias("kept"))
    return out.select(*PIXEL, *cols)


def overlay_preview(rgb: DataFrame, mask: DataFrame, alpha: float, palette=None) -> DataFrame:
    """Blend the label colour over the grey image where label != 0; keep the colours elsewhere."""
    palette = palette or PALETTE
    grey = (F.col("r") / 255.0 * LUMA[0] + F.col("g") / 255.0 * LUMA[1] + F.col("b") / 255.0 * LUMA[2])
    out = rgb.join(mask.where("label != 0").select(*PIXEL, "label"), PIXEL, "left")

    def channel(name, k):
        colour = F.array(*[F.lit(float(p[k])) for p in palette])[F.col("label")]
        blended = F.floor((grey * F.lit(1.0 - alpha) + colour * F.lit(alpha)) * 255.0).cast("int")
        return F.when(F.col("label").isNotNull(), blended).otherwise(F.col(name)).alias(name)
    return out.select(*PIXEL, channel("r", 0), channel("g", 1), channel("b", 2))


def apply_colour_lut(rgb: DataFrame, lut: DataFrame) -> DataFrame:
    """Replace colours through a table ``(rgb, r, g, b)`` keyed by r*65536 + g*256 + b; a colour that the
    table lacks becomes 0. Catalyst picks the join: a LUT may hold up to 2^24 rows."""
    key = F.col("r") * 65536 + F.col("g") * 256 + F.col("b")
    t = lut.select(F.col("rgb").alias("_k"), *[F.col(c).alias(f"_{c}") for c in "rgb"])
    return (rgb.withColumn("_k", key).join(t, "_k", "left")
            .select(*PIXEL, *[F.coalesce(f"_{c}", F.lit(0)).cast("int").alias(c) for c in "rgb"]))


def cross_level_align(df: DataFrame, coarse: DataFrame, scale: int) -> DataFrame:
    """Attach the label of a coarser mask by nearest index: row // scale, col // scale."""
    m = coarse.select("slide_id", F.col("row").alias("_r"), F.col("col").alias("_c"),
                      F.col("label").alias("mask_label"))
    return (df.withColumn("_r", F.floor(F.col("row") / scale).cast("int"))
            .withColumn("_c", F.floor(F.col("col") / scale).cast("int"))
            .join(m, ["slide_id", "_r", "_c"], "left")
            .withColumn("mask_label", F.coalesce("mask_label", F.lit(0))).drop("_r", "_c"))


def pixel_frame(levels: DataFrame, tile: int = 512, keep: list[str] = ()) -> DataFrame:
    """Every (slide_id, row, col) of the given one-row-per-slide shapes, with the columns ``keep`` of its slide.

    The tile grid is laid out and spread first, so that a huge slide expands in many tasks. What a pixel needs of its
    slide goes along: the size of exploded rows is not known to the planner, which would broadcast them to a join.
    """
    tiles = (levels.select("slide_id", *dict.fromkeys(["rows", "cols", *keep]),
                           F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / tile).cast("int"))).alias("_tr"))
             .withColumn("_tc", F.explode(F.sequence(F.lit(0), F.floor((F.col("cols") - 1) / tile).cast("int"))))
             .repartition("slide_id", "_tr", "_tc"))
    end_r = F.least(F.col("_tr") * tile + tile, F.col("rows").cast("int")) - 1
    end_c = F.least(F.col("_tc") * tile + tile, F.col("cols").cast("int")) - 1
    return (tiles.withColumn("row", F.explode(F.sequence(F.col("_tr") * tile, end_r)))
            .withColumn("col", F.explode(F.sequence(F.col("_tc") * tile, end_c))).select(*PIXEL, *keep))


def densify(df: DataFrame, levels: DataFrame, tile: int = 512) -> DataFrame:
    """The raster with its zero pixels made explicit."""
    return (pixel_frame(levels, tile).join(df, PIXEL, "left")
            .withColumn("label", F.coalesce("label", F.lit(0))))


def zoom_shape(levels: DataFrame, factor: float, round_shape: bool = True) -> DataFrame:
    """Target shape and spacing of a zoom by ``factor``: half-even rounded or truncated."""
    f = (lambda c: F.bround(c, 0)) if round_shape else (lambda c: F.floor(c))
    return levels.select("slide_id", f(F.col("rows") * factor).cast("bigint").alias("rows"),
                         f(F.col("cols") * factor).cast("bigint").alias("cols"),
                         (F.col("spacing") / factor).alias("spacing"))


def zoom_to_template(levels: DataFrame, template: DataFrame) -> DataFrame:
    """Zoom factor that brings each slide to the template's shape; rows and columns must agree to 1%."""
    t = template.select("slide_id", F.col("rows").alias("t_rows"), F.col("cols").alias("t_cols"))
    fr, fc = F.col("t_rows") / F.col("rows"), F.col("t_cols") / F.col("cols")
    ok = F.abs(fr - fc) <= 0.01 * F.greatest(F.abs(fr), F.abs(fc))
    return levels.join(t, "slide_id").select("slide_id", "t_rows", "t_cols", fr.alias("factor"),
                                             ok.cast("int").alias("symmetric"))


def _grid_position(i: str, n_src: str, n_dst: str) -> Column:
    # first and last samples of source and target coincide
    return F.when(F.col(n_dst) <= 1, F.lit(0.0)).otherwise(
        F.col(i) * ((F.col(n_src) - 1) / F.greatest(F.col(n_dst) - 1, F.lit(1))))


def zoom_raster(df: DataFrame, levels: DataFrame, factor: float, order: int = 0, round_shape: bool = True,
                tile: int = 512) -> DataFrame:
    """Resample each raster by ``factor``. Target sample i lies at i * (n_src - 1) / (n_dst - 1).

    Order 0 takes the nearest source pixel, order 1 weights the four neighbours; each is an equi join.
    """
    if order not in (0, 1):
        raise ValueError("only orders 0 and 1 are offered")
    shape = zoom_shape(levels, factor, round_shape).select("slide_id", "rows", "cols")
    src = levels.select("slide_id", F.col("rows").alias("_sr"), F.col("cols").alias("_sc"))
    frame = (pixel_frame(shape.join(src, "slide_id"), tile, ["rows", "cols", "_sr", "_sc"])
             .withColumn("_y", _grid_position("row", "_sr", "rows"))
             .withColumn("_x", _grid_position("col", "_sc", "cols")))
    px = df.select("slide_id", F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("label").alias("_v"))
    if order == 0:
        near = (frame.withColumn("_r", F.floor(F.col("_y") + 0.5).cast("int"))
                .withColumn("_c", F.floor(F.col("_x") + 0.5).cast("int")))
        return (near.join(px, ["slide_id", "_r", "_c"], "left")
                .select(*PIXEL, F.coalesce("_v", F.lit(0)).alias("label")))
    fy, fx = F.col("_y") - F.floor("_y"), F.col("_x") - F.floor("_x")
    corner = F.explode(F.expr("array(named_struct('dy',0,'dx',0), named_struct('dy',0,'dx',1),"
                              "named_struct('dy',1,'dx',0), named_struct('dy',1,'dx',1))"))
    parts = (frame.withColumn("_fy", fy).withColumn("_fx", fx).withColumn("_k", corner)
             .withColumn("_w", F.when(F.col("_k.dy") == 1, F.col("_fy")).otherwise(1 - F.col("_fy"))
                         * F.when(F.col("_k.dx") == 1, F.col("_fx")).otherwise(1 - F.col("_fx")))
             .where("_w > 0")
             .withColumn("_r", (F.floor("_y") + F.col("_k.dy")).cast("int"))
             .withColumn("_c", (F.floor("_x") + F.col("_k.dx")).cast("int")))
    return (parts.join(px, ["slide_id", "_r", "_c"], "left")
            .groupBy(*PIXEL).agg(F.sum(F.col("_w") * F.coalesce("_v", F.lit(0))).alias("value")))


def union_rasters(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)
