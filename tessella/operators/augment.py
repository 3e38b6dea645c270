"""Patch augmentation and adaptation over ``(patch_id, px array<double>[, labels array<int>])`` tables.

Parameters of a patch are drawn from a generator seeded by the hash of its id, so they do not depend on the
partitioning. Flips, rotations, contrast and value ranges are plain column expressions; filters that need
neighbourhoods or colour spaces run in Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import colour as C
from ..functions.ranking import uniform


def required_shape(shape: tuple[int, int], min_scale: float) -> tuple[int, int]:
    """Input shape that still covers ``shape`` after scaling by the smallest factor."""
    return math.ceil(shape[0] / min_scale), math.ceil(shape[1] / min_scale)


# ---- column augmenters ----
def _choice(options: list, seed: int) -> Column:
    i = F.floor(uniform(seed, "patch_id") * len(options)).cast("int")
    return F.array(*[F.lit(o) for o in options])[i]


def aug_flip(df: DataFrame, shape: tuple[int, int, int], modes: list[str], seed: int) -> DataFrame:
    h, w, c = shape
    mode = _choice(modes, seed)
    df = df.withColumn("mode", mode).withColumn("px", A.flip("px", h, w, F.col("mode"), c))
    return df.withColumn("labels", A.flip("labels", h, w, F.col("mode"))) if "labels" in df.columns else df


def aug_rot90(df: DataFrame, shape: tuple[int, int, int], turns: list[int], seed: int) -> DataFrame:
    h, _, c = shape
    df = df.withColumn("turns", _choice(turns, seed)).withColumn("px", A.rot90("px", h, F.col("turns"), c))
    return df.withColumn("labels", A.rot90("labels", h, F.col("turns"))) if "labels" in df.columns else df


def aug_contrast(df: DataFrame, shape: tuple[int, int, int], sigma: tuple[float, float], seed: int, peak: float = 1.0) -> DataFrame:
    """Contrast around the mean grey value by a factor drawn from the interval."""
    grey = A.mean("px")
    if shape[2] == 3:
        n = shape[0] * shape[1]
        luma = F.array(F.lit(0.2125), F.lit(0.7154), F.lit(0.0721))
        grey = F.aggregate(F.transform("px", lambda v, i: v * luma[F.pmod(i, F.lit(3))]), F.lit(0.0), lambda a, v: a + v) / n
    s = uniform(seed, "patch_id") * (sigma[1] - sigma[0]) + sigma[0]
    return df.withColumn("px", A.contrast("px", s, peak, grey))


def channel_mean_cutoff(df: DataFrame, low: float, high: float, peak: float = 255.0) -> DataFrame:
    """Adds whether the patch mean (of values scaled to [0, 1]) lies in the closed cutoff range."""
    m = A.mean("px") / peak
    return df.withColumn("mean", m).withColumn("inside", ((m >= low) & (m <= high)).cast("int"))


# ---- Arrow kernels: (patch, label, parameters, generator) -> (patch, label) ----
def _draw(rng, interval):
    lo, hi = interval
    return lo if lo == hi else rng.uniform(lo, hi)


def _flip(p, y, o, rng):
    mode = o["modes"][rng.integers(len(o["modes"]))]
    axes = {"none": (), "vertical": (0,), "horizontal": (1,), "both": (0, 1)}[mode]
    return np.flip(p, axes), None if y is None else np.flip(y, axes)


def _rot90(p, y, o, rng):
    k = int(o["turns"][rng.integers(len(o["turns"]))])
    return np.rot90(p, k), None if y is None else np.rot90(y, k)


def _scale(p, y, o, rng):
    f = _draw(rng, o["factor"])
    return C.scale_patch(p, f, o.get("order", 1)), None if y is None else C.scale_patch(y, f, 0)


def _elastic(p, y, o, rng):
    # one of ``map_count`` deformations shared by all patches, each fixed by its number
    own = np.random.default_rng([o.get("seed", 0), int(rng.integers(o["map_count"]))])
    r, c = C.deformation(p.shape[:2], _draw(own, o["alpha"]), _draw(own, o["sigma"]), own)
    return C.resample(p, r, c, o.get("order", 1)), None if y is None else C.resample(y, r, c, 0)


def _hed(p, y, o, rng):
    if not o["cutoff"][0] <= p.mean() <= o["cutoff"][1]:
        return p, y
    s = np.array([_draw(rng, v) for v in o["sigma"]])
    b = np.array([_draw(rng, v) for v in o["bias"]])
    return C.hed_to_rgb(C.rgb_to_hed(p) * (1 + s) + b), y


def _hsb(p, y, o, rng):
    hue, sat, bri = (_draw(rng, v) for v in o["sigma"])
    hsv = C.rgb_to_hsv(p)
    hsv[..., 0] = (hsv[..., 0] + hue % 1.0) % 1.0
    s, v = hsv[..., 1], hsv[..., 2]
    hsv[..., 1] = s * (1 + sat) if sat < 0 else s * (1 + (1 - s) * sat)
    hsv[..., 2] = v * (1 + bri) if bri < 0 else v + (1 - v) * bri
    return C.hsv_to_rgb(np.clip(hsv, 0, 1)), y


def _contrast(p, y, o, rng):
    s = _draw(rng, o["sigma"])
    c = (p @ np.array([0.2125, 0.7154, 0.0721])).mean() if p.shape[-1] == 3 else p.mean()
    lo, hi = s * c, 1 - s * (1 - c)
    return (np.clip(p, lo, hi) - lo) / (hi - lo), y


def _noise(p, y, o, rng):
    return np.clip(p + rng.normal(0, _draw(rng, o["sigma"]), p.shape), 0, 1), y


def _blur(p, y, o, rng):
    return C.gaussian_blur(p, _draw(rng, o["sigma"])), y


KERNELS = {"flip": _flip, "rot90": _rot90, "scale": _scale, "elastic": _elastic, "hed": _hed, "hsb": _hsb,
           "contrast": _contrast, "noise": _noise, "blur": _blur}
SPATIAL = {"flip", "rot90", "scale", "elastic"}


def augment_pool(df: DataFrame, shape: tuple[int, int, int], groups: list[dict], seed: int,
                 crop: tuple[int, int] | None = None) -> DataFrame:
    """Run groups of augmenters in order over patches with values in [0, 1]; all in one Arrow pass.

    A group is ``{"random_order": bool, "augmenters": [(name, options, probability), ...]}``. Labels follow
    the spatial ones only. With ``crop`` the centre of that shape is kept; a patch smaller than the crop is
    an error.
    """
    names = {n for g in groups for n, _, _ in g["augmenters"]}
    if names - set(KERNELS):
        raise ValueError(f"unknown augmenters {sorted(names - set(KERNELS))}")
    h, w, c = shape
    if crop and (crop[0] > h or crop[1] > w):
        raise ValueError("the crop is larger than the patch")
    has_labels = "labels" in df.columns
    schema = df.schema
    columns = df.columns

    def one(px, labels, seed_value):
        rng = np.random.default_rng(seed_value & 0xFFFFFFFFFFFFFFFF)
        p = np.asarray(px, dtype=float).reshape(h, w, c)
        y = None if labels is None else np.asarray(labels, dtype=np.int64).reshape(h, w)
        for g in groups:
            order = rng.permutation(len(g["augmenters"])) if g.get("random_order") else range(len(g["augmenters"]))
            for i in order:
                name, options, probability = g["augmenters"][i]
                if probability >= 1 or rng.random() < probability:
                    p, y = KERNELS[name](p, y, options, rng)
        if crop:
            t, left = (h - crop[0]) // 2, (w - crop[1]) // 2
            p = p[t:t + crop[0], left:left + crop[1]]
            y = None if y is None else y[t:t + crop[0], left:left + crop[1]]
        return p.ravel(), None if y is None else y.ravel().astype("int32")

    def run(batches):
        for pdf in batches:
            labels = pdf["labels"] if has_labels else [None] * len(pdf)
            done = [one(p, y, s) for p, y, s in zip(pdf["px"], labels, pdf["_seed"])]
            pdf = pdf.assign(px=pd.Series([d[0] for d in done], index=pdf.index))
            if has_labels:
                pdf = pdf.assign(labels=pd.Series([d[1] for d in done], index=pdf.index))
            yield pdf[columns]
    return df.withColumn("_seed", F.xxhash64("patch_id", F.lit(seed))).mapInPandas(run, schema)


def augment(df: DataFrame, shape: tuple[int, int, int], name: str, options: dict, seed: int) -> DataFrame:
    """A single augmenter on every patch."""
    return augment_pool(df, shape, [{"augmenters": [(name, options, 1.0)]}], seed)


def aug_blackout(df: DataFrame, channels: int, blackout_class: int, seed: int, blank: int = 2, min_pixels: int = 100,
                 signatures: int = 10, probability: float = 0.9) -> DataFrame:
    """Blank the label-``blank`` areas; most patches without the blackout class also get the blank shape of
    one of ``signatures`` donor patches (those with the class and more than ``min_pixels`` blank pixels)."""
    n_blank = F.size(F.filter("labels", lambda v: v == blank))
    has = F.array_contains("labels", blackout_class)
    donors = (df.where(has & (n_blank > min_pixels)).select(F.xxhash64("patch_id", F.lit(seed)).alias("_h"), F.col("labels").alias("_sig"))
              .orderBy("_h").limit(signatures))
    pack = donors.agg(F.sort_array(F.collect_list(F.struct("_h", "_sig"))).alias("_sigs")).withColumn("_k", F.lit(1))
    j = df.withColumn("_k", F.lit(1)).join(pack, "_k")
    use = ~has & (uniform(seed + 1, "patch_id") < probability) & (F.size("_sigs") > 0)
    which = F.floor(uniform(seed + 2, "patch_id") * F.size("_sigs")).cast("int")
    j = j.withColumn("_s", F.when(use, F.get("_sigs", which)["_sig"]))
    off = F.transform("labels", lambda v, i: (v == blank) | F.coalesce(F.get("_s", i) == blank, F.lit(False)))
    blanked = A.let(F.struct(off.alias("off"), F.col("px").alias("px"), F.col("labels").alias("y")), lambda b: F.struct(
        F.transform(b["px"], lambda v, i: F.when(F.get(b["off"], F.floor(i / channels).cast("int")), F.lit(0)).otherwise(v)).alias("px"),
        F.transform(b["y"], lambda v, i: F.when(F.get(b["off"], i), F.lit(0)).otherwise(v)).alias("labels")))
    j = j.withColumn("_b", blanked)
    return j.withColumn("px", F.col("_b.px")).withColumn("labels", F.col("_b.labels")).select(df.columns)


# ---- adapting ----
def patch_weight_arrays(df: DataFrame, classes: int, low: float, high: float, normalize: bool = False) -> DataFrame:
    """Balancing weights of each patch's own labels as an array, without a shuffle (see ``label_weights``)."""
    zero = F.array_repeat(F.lit(0), classes)

    def weigh(b):
        # b.n: valid pixels per label
        v = F.aggregate(b["n"], F.lit(0), lambda a, x: a + x)
        k = F.greatest(F.size(F.filter(b["n"], lambda x: x > 0)), F.lit(1))
        raw = A.let(v / k, lambda even: F.transform(b["n"], lambda n: F.least(F.greatest(
            F.coalesce(F.try_divide(even, n), F.lit(0.0)), F.lit(low)), F.lit(high))))

        def scale(r):
            total = F.aggregate(F.zip_with(r, b["n"], lambda x, n: x * n), F.lit(0.0), lambda a, x: a + x)
            goal = (F.size(b["y"]) if normalize else v).cast("double")
            return A.let(F.coalesce(F.try_divide(goal, total), F.lit(0.0)), lambda f: F.zip_with(
                b["y"], b["ok"], lambda y, ok: F.when(ok > 0, F.get(r, y) * f).otherwise(F.lit(0.0))))
        return A.let(raw, scale)
    counts = F.aggregate(F.filter(F.arrays_zip(F.col("labels").alias("y"), F.col("valid").alias("ok")), lambda z: z["ok"] > 0), zero,
                         lambda acc, z: F.transform(acc, lambda n, i: n + (i == z["y"]).cast("int")))
    return df.withColumn("weights", A.let(F.struct(counts.alias("n"), F.col("labels").alias("y"), F.col("valid").alias("ok")), weigh))


def adapt_patches(df: DataFrame, shape: tuple[int, int, int], groups: list[dict], seed: int, value_range: tuple[float, float] | None,
                  label_map: dict[int, int], classes: int, clip: tuple[float, float], one_hot: bool) -> DataFrame:
    """Byte patches to network input: squash to [0, 1], augment, shift the range, map the labels with their
    validity, weigh, one-hot encode."""
    df = df.withColumn("px", A.squash("px"))
    if groups:
        df = augment_pool(df, shape, groups, seed)
    if value_range:
        df = df.withColumn("px", A.additional_range("px", value_range))
    m = F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv])
    df = df.withColumn("valid", F.transform("labels", lambda v: m[v].isNotNull().cast("int"))).withColumn(
        "labels", F.transform("labels", lambda v: F.coalesce(m[v], F.lit(0))))
    df = patch_weight_arrays(df, classes, *clip)
    if one_hot:
        df = df.withColumn("labels", F.transform("labels", lambda v: A.one_hot(v, classes)))
    return df


def adjust_batch(df: DataFrame, value_range: tuple[float, float], classes: int, clip: tuple[float, float]) -> DataFrame:
    """Late steps on adapted patches that carry a ``batch`` number: range, then weights balanced over each
    batch (label counts are summed per batch, only those sums are shuffled), then one-hot."""
    df = df.withColumn("px", A.additional_range("px", value_range))
    pairs = df.select("batch", F.explode(F.arrays_zip("labels", "valid")).alias("z")).select("batch", F.col("z.labels").alias("label"), F.col("z.valid").alias("valid"))
    n = pairs.groupBy("batch", "label").agg(F.sum("valid").alias("n"))
    tot = n.groupBy("batch").agg(F.sum("n").alias("v"), F.count_if(F.col("n") > 0).alias("k"))
    raw = n.join(tot, "batch").withColumn("r", F.least(F.greatest(F.coalesce(F.try_divide(F.col("v") / F.greatest("k", F.lit(1)), F.col("n")), F.lit(0.0)),
                                                                    F.lit(clip[0])), F.lit(clip[1])))
    s = raw.groupBy("batch").agg(F.sum(F.col("r") * F.col("n")).alias("_s"), F.max("v").alias("_v"),
                                 F.map_from_entries(F.collect_list(F.struct("label", "r"))).alias("_r"))
    j = df.join(s, "batch")
    scale = F.coalesce(F.try_divide(F.col("_v").cast("double"), F.col("_s")), F.lit(0.0))
    j = j.withColumn("_f", scale).withColumn("weights", F.zip_with("labels", "valid", lambda y, v: F.when(v > 0, F.col("_r")[y] * F.col("_f")).otherwise(F.lit(0.0))))
    return j.withColumn("labels", F.transform("labels", lambda v: A.one_hot(v, classes))).drop("_s", "_v", "_r", "_f")
