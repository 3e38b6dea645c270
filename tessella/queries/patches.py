"""Patch range, layout and augmentation queries over the embeddings read as 8 x 8 byte patches."""

from pyspark.sql import functions as F

from ..fixtures import patches, view, with_views
from ..functions import arrays as A
from ..operators import augment as G
from ..registry import query

PT = with_views("patches")
SHAPE = (8, 8, 1)


def long(df, column="px", digits=6):
    """Whole arrays as (patch_id, i, v) rows."""
    v = F.round("v", digits) if digits is not None else F.col("v")
    return df.select("patch_id", F.posexplode(column).alias("i", "v")).select("patch_id", "i", v.alias("v"))


def cells(expr):
    return PT + f"SELECT patch_id, CAST(i AS INT) AS i, {expr} AS v FROM patches, (SELECT unnest(range(64)) AS i)"


@query("rgb_range", cells("round(px[i + 1] * (2.0::DOUBLE / 255) - 1, 6)"))
def _(spark, d):
    return long(patches(spark, d).withColumn("px", A.rgb_range("px", -1.0, 1.0)))


@query("general_range", cells("round((px[i + 1] - 10) * (4.0::DOUBLE / 200) + 1, 6)"))
def _(spark, d):
    return long(patches(spark, d).withColumn("px", A.general_range("px", (10.0, 210.0), (1.0, 5.0))))


@query("additional_range", cells("round(px[i + 1] / 255.0::DOUBLE * 3 - 1, 6)"))
def _(spark, d):
    p = patches(spark, d).withColumn("px", A.squash("px"))
    return long(p.withColumn("px", A.additional_range("px", (-1.0, 2.0))))


@query("squash_range", cells("round(px[i + 1] / 255.0::DOUBLE, 6)"))
def _(spark, d):
    return long(patches(spark, d).withColumn("px", A.squash("px")))


@query("gan_range", cells("round(least(greatest((px[i + 1] / 127.5::DOUBLE - 1 + 1) / 2, 0), 1), 6)::DOUBLE"))
def _(spark, d):
    p = patches(spark, d).withColumn("px", A.gan_in("px"))
    return long(p.withColumn("px", A.gan_out("px")))


@query("one_hot", PT + "SELECT patch_id, CAST(i AS INT) AS i, CAST(label = i AS INT) AS v FROM patches, (SELECT unnest(range(10)) AS i)")
def _(spark, d):
    return long(patches(spark, d).withColumn("px", A.one_hot(F.col("label"), 10)), digits=None)


@query("dimension_order", cells("px[(i % 16) * 4 + i // 16 + 1]"))
def _(spark, d):
    """An 8 x 8 patch read as 4 x 4 pixels of 4 channels, moved to channels first and back and first again."""
    p = patches(spark, d).withColumn("px", A.to_channels_first("px", 4, 4, 4))
    p = p.withColumn("px", A.to_channels_last("px", 4, 4, 4))
    return long(p.withColumn("px", A.to_channels_first("px", 4, 4, 4)), digits=None)


@query("label_resize_nearest", PT + "SELECT patch_id, CAST(i AS INT) AS i, px[((i // 12) * 8 // 12) * 8 + (i % 12) * 8 // 12 + 1] AS v FROM patches, (SELECT unnest(range(144)) AS i)")
def _(spark, d):
    return long(patches(spark, d).withColumn("px", A.resize_nearest("px", 8, 8, 12, 12)), digits=None)


_y, _x = "(i // 8)", "(i % 8)"


@query("aug_flip", cells(f"""px[CASE patch_id % 4 WHEN 0 THEN i WHEN 1 THEN (7 - {_y}) * 8 + {_x} WHEN 2 THEN {_y} * 8 + 7 - {_x} ELSE (7 - {_y}) * 8 + 7 - {_x} END + 1]"""))
def _(spark, d):
    mode = F.array(*[F.lit(m) for m in ("none", "vertical", "horizontal", "both")])[(F.col("patch_id") % 4).cast("int")]
    return long(patches(spark, d).withColumn("px", A.flip("px", 8, 8, mode)), digits=None)


@query("aug_rot90", cells(f"""px[CASE patch_id % 4 WHEN 0 THEN i WHEN 1 THEN {_x} * 8 + 7 - {_y} WHEN 2 THEN (7 - {_y}) * 8 + 7 - {_x} ELSE (7 - {_x}) * 8 + {_y} END + 1]"""))
def _(spark, d):
    return long(patches(spark, d).withColumn("px", A.rot90("px", 8, (F.col("patch_id") % 4).cast("int"))), digits=None)


@query("aug_contrast", PT + """, m AS (SELECT *, list_sum(px) / 64.0::DOUBLE AS c FROM patches), r AS (SELECT *, 0.5 * c AS lo, 255 - 0.5 * (255 - c) AS hi FROM m)
SELECT patch_id, CAST(i AS INT) AS i, CAST(floor((least(greatest(px[i + 1], lo), hi) - lo) / (hi - lo) * 255 + 1e-9) AS INT) AS v FROM r, (SELECT unnest(range(64)) AS i)""")
def _(spark, d):
    return long(G.aug_contrast(patches(spark, d), SHAPE, (0.5, 0.5), 3, 255.0), digits=None)


@query("channel_mean_cutoff", PT + """SELECT patch_id, round(list_sum(px) / 64.0::DOUBLE / 255, 6) AS mean, CAST(list_sum(px) / 64.0::DOUBLE / 255 BETWEEN 0.49 AND 0.501 AS INT) AS inside FROM patches""")
def _(spark, d):
    return G.channel_mean_cutoff(patches(spark, d), 0.49, 0.501).select("patch_id", F.round("mean", 6).alias("mean"), "inside")


def labelled(spark, d):
    """Patches with values in [0, 1] and a label per pixel: 0..3 from the byte value."""
    return patches(spark, d).withColumn("labels", F.transform("px", lambda v: (v % 4).cast("int"))).withColumn("px", A.squash("px"))


def rgb_patches(spark, d):
    """Raster tiles of 10 x 10 pixels as colour patches, padded with black; the id is unique over the slides."""
    r = view(spark, d, "rgb")
    key = F.col("slide_id").cast("bigint") * 100 + F.floor(F.col("row") / 10) * 10 + F.floor(F.col("col") / 10)
    at = ((F.col("row") % 10) * 10 + F.col("col") % 10).alias("at")
    g = r.select(key.alias("patch_id"), at, F.array("r", "g", "b").alias("v")).groupBy("patch_id").agg(
        F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("a"))
    black = F.array(F.lit(0), F.lit(0), F.lit(0))
    whole = F.transform(F.sequence(F.lit(0), F.lit(99)), lambda k: F.coalesce(F.try_element_at("a", k), black))
    return g.select("patch_id", F.transform(F.flatten(whole), lambda v: v / F.lit(255.0)).alias("px"))


def summary(df):
    """Size, mean and range of each resulting patch."""
    return df.select("patch_id", F.size("px").alias("n"), F.round(A.mean("px"), 4).alias("mean"),
                     F.round(F.array_min("px"), 4).alias("low"), F.round(F.array_max("px"), 4).alias("high"))


@query("aug_scale")
def _(spark, d):
    return summary(G.augment(labelled(spark, d), SHAPE, "scale", {"factor": (0.7, 1.3), "order": 1}, 11))


@query("aug_elastic")
def _(spark, d):
    return summary(G.augment(labelled(spark, d), SHAPE, "elastic", {"alpha": (4.0, 8.0), "sigma": (1.5, 2.5), "map_count": 16}, 12))


@query("aug_hed")
def _(spark, d):
    opts = {"sigma": [(-0.1, 0.1)] * 3, "bias": [(-0.02, 0.02)] * 3, "cutoff": (0.15, 0.85)}
    return summary(G.augment(rgb_patches(spark, d), (10, 10, 3), "hed", opts, 13))


@query("aug_hsb")
def _(spark, d):
    return summary(G.augment(rgb_patches(spark, d), (10, 10, 3), "hsb", {"sigma": [(-0.1, 0.1), (-0.2, 0.2), (-0.2, 0.2)]}, 14))


@query("rgb_hsv_hed_gray", with_views("rgb") + """, k AS (SELECT slide_id::BIGINT * 100 + row // 10 * 10 + col // 10 AS patch_id, r, g, b FROM rgb)
SELECT patch_id, 300 AS n, 1 AS same FROM k GROUP BY patch_id""")
def _(spark, d):
    """A colour-space round trip without change (hue, saturation and brightness by zero) keeps every value."""
    p = rgb_patches(spark, d)
    out = G.augment(p, (10, 10, 3), "hsb", {"sigma": [(0.0, 0.0)] * 3}, 15).withColumnRenamed("px", "back")
    j = p.join(out, "patch_id")
    gap = F.array_max(F.zip_with("px", "back", lambda a, b: F.abs(a - b)))
    return j.select("patch_id", F.size("back").alias("n"), (gap < 1e-9).cast("int").alias("same"))


@query("aug_noise")
def _(spark, d):
    return summary(G.augment(labelled(spark, d), SHAPE, "noise", {"sigma": (0.0, 0.1)}, 16))


@query("aug_blur")
def _(spark, d):
    return summary(G.augment(labelled(spark, d), SHAPE, "blur", {"sigma": (0.3, 1.2)}, 17))


@query("aug_blackout", PT + """SELECT patch_id, CAST(i AS INT) AS i, CASE WHEN px[i + 1] % 4 = 2 THEN 0 ELSE px[i + 1] END AS v FROM patches, (SELECT unnest(range(64)) AS i)""")
def _(spark, d):
    """No patch has more than 100 blank pixels here, so only the fixed part of the step acts."""
    p = patches(spark, d).withColumn("labels", F.transform("px", lambda v: (v % 4).cast("int")))
    return long(G.aug_blackout(p, 1, 3, 18), digits=None)


POOL = [{"random_order": False, "augmenters": [("flip", {"modes": ["none", "vertical", "horizontal", "both"]}, 1.0), ("rot90", {"turns": [0, 1, 2, 3]}, 1.0)]},
        {"random_order": True, "augmenters": [("contrast", {"sigma": (0.1, 0.3)}, 0.5), ("noise", {"sigma": (0.0, 0.05)}, 0.5), ("blur", {"sigma": (0.3, 0.8)}, 0.5)]}]


@query("augment_pool", PT + """SELECT patch_id, 36 AS n, 36 AS n_labels FROM patches""")
def _(spark, d):
    out = G.augment_pool(labelled(spark, d), SHAPE, POOL, 19, (6, 6))
    return out.select("patch_id", F.size("px").alias("n"), F.size("labels").alias("n_labels"))


@query("blank_augment_spatial", PT + "SELECT patch_id, CAST(v AS INT) AS v, count(*) AS n FROM (SELECT patch_id, unnest(px) AS v FROM patches) GROUP BY ALL")
def _(spark, d):
    """Flips and rotations by hash keep the multiset of values, and labels follow their pixels."""
    p = patches(spark, d).withColumn("labels", F.col("px"))
    out = G.aug_rot90(G.aug_flip(p, SHAPE, ["none", "vertical", "horizontal", "both"], 20), SHAPE, [0, 1, 2, 3], 21)
    z = out.select("patch_id", F.explode(F.arrays_zip("px", "labels")).alias("z")).where("z.px = z.labels")
    return z.groupBy("patch_id", F.col("z.px").alias("v")).agg(F.count(F.lit(1)).alias("n"))


@query("adapt_patches", PT + """, l AS (SELECT patch_id, i, px[i + 1] AS p, CASE px[i + 1] % 4 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE NULL END AS y FROM patches, (SELECT unnest(range(64)) AS i)),
n AS (SELECT patch_id, y, count(*) AS n FROM l WHERE y IS NOT NULL GROUP BY ALL),
w AS (SELECT patch_id, y, n, least(greatest(sum(n) OVER v / count(*) OVER v / n, 0.2), 1.5)::DOUBLE AS raw, sum(n) OVER v AS total FROM n WINDOW v AS (PARTITION BY patch_id)),
f AS (SELECT patch_id, y, raw * total / sum(raw * n) OVER (PARTITION BY patch_id) AS weight FROM w)
SELECT l.patch_id, CAST(i AS INT) AS i, round(p / 255.0::DOUBLE * 2 - 1, 6) AS v, CAST(coalesce(l.y, 0) = 0 AS INT) AS y0, CAST(coalesce(l.y, 0) = 1 AS INT) AS y1,
 round(coalesce(f.weight, 0), 6)::DOUBLE AS weight FROM l LEFT JOIN f ON f.patch_id = l.patch_id AND f.y = l.y""")
def _(spark, d):
    p = patches(spark, d).withColumn("labels", F.transform("px", lambda v: (v % 4).cast("int")))
    out = G.adapt_patches(p, SHAPE, [], 22, (-1.0, 1.0), {1: 0, 2: 1}, 2, (0.2, 1.5), True)
    z = out.select("patch_id", F.posexplode(F.arrays_zip("px", "labels", "weights")).alias("i", "z"))
    return z.select("patch_id", "i", F.round("z.px", 6).alias("v"), F.col("z.labels")[0].alias("y0"), F.col("z.labels")[1].alias("y1"), F.round("z.weights", 6).alias("weight"))


@query("adjust_batch", PT + """, l AS (SELECT patch_id, patch_id // 16 AS batch, i, px[i + 1] AS p, px[i + 1] % 2 AS y, CAST(px[i + 1] % 5 <> 0 AS INT) AS ok FROM patches, (SELECT unnest(range(64)) AS i)),
n AS (SELECT batch, y, sum(ok) AS n FROM l GROUP BY ALL),
w AS (SELECT batch, y, n, least(greatest(sum(n) OVER v / count(*) FILTER (n > 0) OVER v / n, 0.2), 3)::DOUBLE AS raw, sum(n) OVER v AS total FROM n WINDOW v AS (PARTITION BY batch)),
f AS (SELECT batch, y, raw * total / sum(raw * n) OVER (PARTITION BY batch) AS weight FROM w)
SELECT patch_id, CAST(i AS INT) AS i, round(p / 255.0::DOUBLE * 2 - 1, 6) AS v, CAST(l.y AS INT) AS y1, round(ok * weight, 6)::DOUBLE AS weight FROM l JOIN f ON f.batch = l.batch AND f.y = l.y""")
def _(spark, d):
    p = patches(spark, d).withColumn("labels", F.transform("px", lambda v: (v % 2).cast("int"))).withColumn(
        "valid", F.transform("px", lambda v: (v % 5 != 0).cast("int"))).withColumn("px", A.squash("px")).withColumn("batch", F.floor(F.col("patch_id") / 16))
    out = G.adjust_batch(p, (-1.0, 1.0), 2, (0.2, 3.0))
    z = out.select("patch_id", F.posexplode(F.arrays_zip("px", "labels", "weights")).alias("i", "z"))
    return z.select("patch_id", "i", F.round("z.px", 6).alias("v"), F.col("z.labels")[1].alias("y1"), F.round("z.weights", 6).alias("weight"))
