"""Segmentation quality: overlaps, confusion matrices, ratios, weights and losses.

Every score is one pass of conditional counts over aligned pixels followed by arithmetic on the small
result; 0 / 0 is NULL unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.ranking import prefix_scan
from .raster import PIXEL, map_labels_lut, pixel_align


def _count(cond: Column) -> Column:
    return F.count_if(cond)


def dice_jaccard(left: DataFrame, right: DataFrame, left_label: int, right_label: int) -> DataFrame:
    """Per slide: region sizes, union, intersection, Dice 2I/(A+B) and Jaccard I/U."""
    a, b = F.col("l") == left_label, F.col("r") == right_label
    s = pixel_align(left, right).groupBy("slide_id").agg(
        _count(a).alias("size_l"), _count(b).alias("size_r"), _count(a | b).alias("n_union"),
        _count(a & b).alias("n_inter"))
    return s.select("*", F.try_divide(2.0 * F.col("n_inter"), F.col("size_l") + F.col("size_r")).alias("dice"),
                    F.try_divide(F.col("n_inter").cast("double"), F.col("n_union")).alias("jaccard"))


def _scored_pairs(gt: DataFrame, pred: DataFrame, mapping: dict[int, int] | None) -> DataFrame:
    """Pixels that count: the mapped ground truth and the prediction are both non-zero."""
    mapped = map_labels_lut(gt, mapping) if mapping else gt
    a = mapped.where("label != 0").select(*PIXEL, F.col("label").alias("y_true"))
    b = pred.where("label != 0").select(*PIXEL, F.col("label").alias("y_pred"))
    return a.join(b, PIXEL)


def zero_cells(slides: DataFrame, keys: list[str], labels: list[int]) -> DataFrame:
    ls = F.array(*[F.lit(x) for x in sorted(labels)])
    return (slides.withColumn("y_true", F.explode(ls)).withColumn("y_pred", F.explode(ls))
            .select(*keys, "y_true", "y_pred", F.lit(0).cast("bigint").alias("n")))


def confusion_matrix(gt: DataFrame, pred: DataFrame, mapping: dict[int, int] | None, labels: list[int]) -> DataFrame:
    """Cells ``(slide_id, y_true, y_pred, n)`` over the labels, zero cells included; the rows with slide_id
    NULL are the total over all slides."""
    pairs = _scored_pairs(gt, pred, mapping).where(F.col("y_true").isin(labels) & F.col("y_pred").isin(labels))
    cells = pairs.groupBy("slide_id", "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))
    zero = zero_cells(gt.select("slide_id").distinct(), ["slide_id"], labels)
    full = cells.unionByName(zero)
    return (full.rollup("y_true", "y_pred", "slide_id").agg(F.sum("n").alias("n"))
            .where("y_pred IS NOT NULL").select("slide_id", "y_true", "y_pred", "n"))


def confusion_by_box(gt: DataFrame, pred: DataFrame, boxes: DataFrame, mapping: dict[int, int] | None,
                     labels: list[int], cell: int = 512) -> DataFrame:
    """As ``confusion_matrix`` per box ``(slide_id, box_id, y, x, h, w)``; only pixels inside boxes count.
    Boxes and pixels meet on grid cells; merged boxes are disjoint, so a pixel meets few of them."""
    span = lambda a, n: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor((F.col(a) + F.col(n) - 1) / cell)))
    b = (boxes.where("h > 0 AND w > 0").withColumn("_cy", span("y", "h")).withColumn("_cx", span("x", "w")))
    p = (_scored_pairs(gt, pred, mapping).where(F.col("y_true").isin(labels) & F.col("y_pred").isin(labels))
         .withColumn("_cy", F.floor(F.col("row") / cell)).withColumn("_cx", F.floor(F.col("col") / cell)))
    inside = p.join(b, ["slide_id", "_cy", "_cx"]).where("row >= y AND row < y + h AND col >= x AND col < x + w")
    return inside.groupBy("slide_id", "box_id", "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def cm_scores(cm: DataFrame, keys: list[str], carry: list[str] = ()) -> DataFrame:
    """Per class from long cells: tp, fn, fp, f1 = 2tp / (2tp + fn + fp) (0 for 0/0) and Jaccard. A cell feeds
    its true and its predicted class in one pass; ``carry`` columns are constant per key."""
    hit, n, none = F.col("y_true") == F.col("y_pred"), F.col("n"), F.lit(0).cast("bigint")
    true = F.struct(F.col("y_true").alias("label"), F.when(hit, n).otherwise(none).alias("tp"),
                    F.when(hit, none).otherwise(n).alias("fn"), none.alias("fp"))
    pred = F.struct(F.col("y_pred").alias("label"), none.alias("tp"), none.alias("fn"), F.when(hit, none).otherwise(n).alias("fp"))
    s = (cm.select(*keys, *carry, F.explode(F.array(true, pred)).alias("c")).select(*keys, *carry, "c.*")
         .groupBy(*keys, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp")], *[F.max(c).alias(c) for c in carry]))
    wrong = F.col("fn") + F.col("fp")
    return s.select(*keys, "label", "tp", "fn", "fp",
                    F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + wrong), F.lit(0.0)).alias("f1"),
                    F.coalesce(F.try_divide(1.0 * F.col("tp"), F.col("tp") + wrong), F.lit(0.0)).alias("jaccard"), *carry)


def overall_f1(cm: DataFrame, classes: list[int], keys: list[str]) -> DataFrame:
    """Diagonal share over the selected classes: tp / (tp + off-diagonal)."""
    sel = cm.where(F.col("y_true").isin(classes) & F.col("y_pred").isin(classes))
    s = sel.groupBy(*keys).agg(F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("tp"),
                               F.sum("n").alias("n"))
    return s.select(*keys, "tp", "n", F.try_divide(1.0 * F.col("tp"), F.col("n")).alias("f1"))


def normalized_cm(cm: DataFrame, keys: list[str]) -> DataFrame:
    """Each cell divided by its row total (NULL for an empty row)."""
    total = cm.groupBy(*keys, "y_true").agg(F.sum("n").alias("_t"))
    names = [*keys, "y_true"]
    total = total.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)], "_t")
    on = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(names)]
    return cm.join(total, on).select(*names, "y_pred", F.try_divide(1.0 * F.col("n"), F.col("_t")).alias("share"))


def tsr(classes: DataFrame, bulk: DataFrame, tumour: int = 8, stroma: int = 1, scale: int = 1) -> DataFrame:
    """Tumour-stroma ratio inside the bulk mask: stroma / (stroma + tumour). A bulk mask that is ``scale``
    times coarser is read by nearest index."""
    b = bulk.where("label != 0").select("slide_id", F.col("row").alias("_r"), F.col("col").alias("_c"),
                                        F.col("label").alias("_b"))
    px = (classes.where(F.col("label").isin(tumour, stroma))
          .withColumn("_r", F.floor(F.col("row") / scale).cast("int")).withColumn("_c", F.floor(F.col("col") / scale).cast("int")))
    inside = px.join(b, ["slide_id", "_r", "_c"])
    s = inside.groupBy("slide_id").agg(F.sum(F.when(F.col("label") == stroma, F.col("_b")).otherwise(0)).alias("stroma"),
                                       F.sum(F.when(F.col("label") == tumour, F.col("_b")).otherwise(0)).alias("tumour"))
    out = classes.select("slide_id").distinct().join(s, "slide_id", "left").fillna(0, ["stroma", "tumour"])
    return out.select("slide_id", "stroma", "tumour",
                      F.try_divide(1.0 * F.col("stroma"), F.col("stroma") + F.col("tumour")).alias("tsr_ratio"))


def seg_stats(px: DataFrame, classes: int, ignore: int = -100) -> DataFrame:
    """tp, fp, fn, tn per image and class from ``(image_id, pred, target)`` without ignored pixels.
    Counts per label pair come first, so each pixel is shuffled at most once as part of a count."""
    valid = px.where(F.col("target") != ignore).groupBy("image_id", "pred", "target").agg(F.count(F.lit(1)).alias("n"))
    k = valid.withColumn("cls", F.explode(F.sequence(F.lit(0), F.lit(classes - 1))))
    p, t = F.col("pred") == F.col("cls"), F.col("target") == F.col("cls")
    part = lambda c, name: F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name)
    return k.groupBy("image_id", "cls").agg(part(p & t, "tp"), part(p & ~t, "fp"), part(~p & t, "fn"), part(~p & ~t, "tn"))


def seg_metrics(px: DataFrame, classes: int, ignore: int = -100) -> DataFrame:
    """One row: micro IoU, F1 and F2, macro accuracy, image-wise micro recall."""
    s = seg_stats(px, classes, ignore)
    micro = s.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).select(
        F.lit(1).alias("_k"), (F.col("tp") / (F.col("tp") + F.col("fp") + F.col("fn"))).alias("iou_score"),
        (2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("f1_score"),
        (5 * F.col("tp") / (5 * F.col("tp") + 4 * F.col("fn") + F.col("fp"))).alias("f2_score"))
    macro = (s.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
             .agg(F.avg((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
                  .alias("accuracy")).withColumn("_k", F.lit(1)))
    image = (s.groupBy("image_id").agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn"))
             .agg(F.avg(F.try_divide(1.0 * F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall"))
             .withColumn("_k", F.lit(1)))
    return micro.join(macro, "_k").join(image, "_k").drop("_k")


def log_softmax(column: str) -> Column:
    """x - max - log(sum(exp(x - max))) over an array of class scores."""
    def shifted(b):
        norm = F.log(F.aggregate(b["x"], F.lit(0.0), lambda acc, x: acc + F.exp(x - b["m"])))
        return let(norm + b["m"], lambda n: F.transform(b["x"], lambda x: x - n))
    return let(F.struct(F.col(column).alias("x"), F.array_max(column).alias("m")), shifted)


def ensemble_mean(outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the models' scores ``(keys, model, cls, score)`` per class, as ``prob``; and the log-softmax
    of the means as ``logprob``."""
    mean = outputs.groupBy(*keys, "cls").agg(F.avg("score").alias("prob"))
    packed = mean.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("cls", "prob"))).alias("_a"))
    arr = packed.withColumn("_p", F.col("_a.prob")).withColumn("_l", log_softmax("_p"))
    return (arr.select(*keys, F.explode(F.arrays_zip(F.col("_a.cls").alias("cls"), F.col("_p").alias("prob"),
                                                     F.col("_l").alias("logprob"))).alias("z"))
            .select(*keys, "z.*"))


def label_weights(px: DataFrame, keys: list[str], low: float, high: float, normalize: bool = False) -> DataFrame:
    """Balancing weight per ``(keys, label, valid)`` pixel: (valid pixels / present labels) / label count,
    clipped to [low, high], 0 where invalid, scaled so that the weights of a group sum to its valid count
    (to its size with ``normalize``). Group by patch or by batch through ``keys``."""
    c = px.groupBy(*keys, "label").agg(F.sum("valid").alias("n"), F.count(F.lit(1)).alias("size"))
    g = c.groupBy(*keys).agg(F.sum("n").alias("_valid"), F.sum(F.least(F.greatest("n", F.lit(0)), F.lit(1))).alias("_present"),
                             F.sum("size").alias("_size"))
    raw = F.when(F.col("n") > 0, F.col("_valid") / F.col("_present") / F.col("n")).otherwise(F.lit(0.0))
    w = c.join(g, keys).withColumn("_raw", F.least(F.greatest(raw, F.lit(low)), F.lit(high)))
    s = w.groupBy(*keys).agg(F.sum(F.col("_raw") * F.col("n")).alias("_sum"))
    goal = F.col("_size") if normalize else F.col("_valid")
    w = w.join(s, keys).select(*keys, "label", F.coalesce(F.try_divide(F.col("_raw") * goal, F.col("_sum")), F.lit(0.0)).alias("_w"))
    return px.join(w, [*keys, "label"]).select(*px.columns, F.when(F.col("valid") > 0, F.col("_w")).otherwise(0.0).alias("weight"))


def error_histogram(errors: DataFrame, bins: int, keys: list[str] = ()) -> DataFrame:
    """Counts per equal bin of [0, 1]; the last bin is closed. ``edge`` is the right edge."""
    b = F.least(F.floor(F.col("error") * bins).cast("int"), F.lit(bins - 1))
    return (errors.where("error >= 0 AND error <= 1").groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("edge", (F.col("bin") + 1) / F.lit(float(bins))))


def tile_ssim(pairs: DataFrame, keys: list[str], peak: float = 255.0) -> DataFrame:
    """Structural similarity of the two values ``a`` and ``b`` over each group, from global moments."""
    c1, c2 = (0.01 * peak) ** 2, (0.03 * peak) ** 2
    m = pairs.groupBy(*keys).agg(F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.var_pop("a").alias("va"),
                                 F.var_pop("b").alias("vb"), F.covar_pop("a", "b").alias("cab"))
    num = (2 * F.col("ma") * F.col("mb") + c1) * (2 * F.col("cab") + c2)
    den = (F.col("ma") * F.col("ma") + F.col("mb") * F.col("mb") + c1) * (F.col("va") + F.col("vb") + c2)
    return m.select(*keys, (num / den).alias("ssim"))


def weighted_dice(px: DataFrame, keys: list[str], smooth: float = 1e-10) -> DataFrame:
    """Smoothed agreement of ``pred`` and ``target`` under pixel ``weight``."""
    hit = F.sum(F.when(F.col("pred") == F.col("target"), F.col("weight")).otherwise(0.0))
    return px.groupBy(*keys).agg(((2.0 * hit + smooth) / (F.sum("weight") * 2 + smooth)).alias("dice"))


def binary_dice(px: DataFrame, keys: list[str], smooth: float = 1e-10) -> DataFrame:
    """Smoothed Dice of ``output`` and ``target`` binarised at 0.5."""
    o, t = F.col("output") > 0.5, F.col("target") > 0.5
    return px.groupBy(*keys).agg(((2.0 * _count(o & t) + smooth) / (_count(o) + _count(t) + smooth)).alias("dice"))


def lovasz_loss(px: DataFrame, eps: float = 1e-5, present_only: bool = True) -> DataFrame:
    """Lovasz-softmax loss per class, from ``(cls, fg, prob)``; ``mean_lovasz`` is their mean.

    Pixels of a class are ordered by error |fg - prob|, largest first. Equal errors contribute
    error * (Jaccard after - Jaccard before), so they are merged first; running counts then go over error
    buckets, which keeps one large class parallel.
    """
    e = px.withColumn("error", F.abs(F.col("fg") - F.col("prob")))
    ties = e.groupBy("cls", "error").agg(F.sum("fg").alias("fg"), F.count(F.lit(1)).alias("n")).withColumn("_o", -F.col("error"))
    total = ties.groupBy("cls").agg(F.sum("fg").alias("_g"))
    run = prefix_scan(ties, ["cls"], ["_o"], F.floor(F.col("_o") * 65536), rank=None,
                      running={"_f": ("sum", "fg"), "_n": ("sum", "n")})

    def jaccard(f, n):
        return 1.0 - (F.col("_g") - f) / (F.col("_g") + (n - f) + eps)
    after = jaccard(F.col("_f"), F.col("_n"))
    f0, n0 = F.col("_f") - F.col("fg"), F.col("_n") - F.col("n")
    before = F.when(n0 == 0, F.lit(0.0)).otherwise(jaccard(f0, n0))
    per = (run.join(total, "cls").groupBy("cls")
           .agg(F.sum(F.col("error") * (after - before)).alias("loss"), F.max("_g").alias("fg_pixels")))
    return per.where("fg_pixels > 0") if present_only else per


def mean_lovasz(per_class: DataFrame) -> DataFrame:
    """One row: the mean loss over the classes of ``lovasz_loss``, 0 without any."""
    return per_class.agg(F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"), F.count(F.lit(1)).alias("classes"))
