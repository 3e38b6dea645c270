"""Splits, folds and class-balanced sampling. Random choices are checked through what must hold for any of
them: totals, bounds, disjointness and that every drawn pixel has its label."""

from pyspark.sql import functions as F

from ..fixtures import levels, table, view, with_views
from ..operators import levels as L
from ..operators import sampling as P
from ..operators import splits as S
from ..operators import tilestats as T
from ..registry import query
from .catalog import DUCK_ITEMS, items
from .raster import PX

TILE = 16


def label(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", "label")


@query("distribute_population", """SELECT o_custkey AS category, count(*) AS total, 1 AS in_bounds, 1 AS near_share FROM orders GROUP BY o_custkey HAVING count(*) >= 4""")
def _(spark, d):
    """The orders of each customer distributed over four bins with a minimum of one."""
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("category")).agg(F.count(F.lit(1)).alias("population")).where("population >= 4")
    bins = n.select("category", "population", F.explode(F.array(*[F.struct(F.lit(b).alias("bin"), F.lit(r).alias("ratio")) for b, r in
                    (("a", 0.45), ("b", 0.35), ("c", 0.15), ("d", 0.05))])).alias("s")).select("category", "population", "s.*", F.lit(1).alias("lo"), F.col("population").alias("hi"))
    out = S.distribute_population(bins, ["category"], 5)
    return out.groupBy("category").agg(F.sum("n").alias("total"), F.min(((F.col("n") >= 1) & (F.col("n") <= F.col("population"))).cast("int")).alias("in_bounds"),
                                       F.min((F.abs(F.col("n") - F.greatest(F.col("ratio") * F.col("population"), F.lit(1.0))) <= 4).cast("int")).alias("near_share"))


RATIOS = {"training": 0.6, "validation": 0.2, "testing": 0.2}


@query("split_purposes", DUCK_ITEMS + """SELECT category, count(*) AS n_items, 3 AS n_purposes, 1 AS near_share FROM it GROUP BY category""")
def _(spark, d):
    s = S.split_purposes(items(spark, d).drop("purpose"), RATIOS, 7)
    c = s.groupBy("category", "purpose").agg(F.count_distinct("item_id").alias("n"))
    ratio = F.when(F.col("purpose") == "training", 0.6).otherwise(0.2)
    t = c.groupBy("category").agg(F.sum("n").alias("total"))
    return (c.join(t, "category").groupBy("category").agg(
        F.max("total").alias("n_items"), F.count(F.lit(1)).cast("int").alias("n_purposes"),
        F.min((F.abs(F.col("n") - ratio * F.col("total")) <= 1.5).cast("int")).alias("near_share")))


@query("kfold", DUCK_ITEMS + "SELECT item_id, CAST(1 AS BIGINT) AS n_validation, CAST(3 AS BIGINT) AS n_training FROM it")
def _(spark, d):
    k = S.kfold(items(spark, d).drop("purpose"), 4, 8)
    return k.groupBy("item_id").agg(F.count_if(F.col("purpose") == "validation").alias("n_validation"), F.count_if(F.col("purpose") == "training").alias("n_training"))


CATS = {"en": 0.5, "fr": 0.3, "de": 0.2}
LABS = {1: 0.2, 2: 0.3, 3: 0.3, 4: 0.2}


@query("sample_sources", DUCK_ITEMS + """SELECT 60 AS n, 60 AS n_distinct, 1 AS has_labels, 1 AS known_categories""")
def _(spark, d):
    s = P.sample_sources(items(spark, d), CATS, LABS, 60, 9)
    return s.agg(F.count(F.lit(1)).cast("int").alias("n"), F.count_distinct("item_id").cast("int").alias("n_distinct"),
                 F.max((F.size("labels") > 0).cast("int")).alias("has_labels"), F.min(F.col("category").isin(list(CATS)).cast("int")).alias("known_categories"))


def sources(spark, d):
    return items(spark, d).where(F.size("labels") > 0).select("item_id", "labels")


@query("patch_distribution", DUCK_ITEMS + """SELECT CAST(l AS INT) AS label, CAST(c AS BIGINT) AS n, 1 AS held, 1 AS even FROM (VALUES (1, 400), (2, 600), (3, 600), (4, 400)) v(l, c)""")
def _(spark, d):
    out = P.patch_distribution(sources(spark, d), LABS, 2000, 10)
    j = out.join(sources(spark, d), "item_id")
    return j.groupBy("label").agg(F.sum("n").alias("n"), F.min(F.array_contains("labels", F.col("label")).cast("int")).alias("held"),
                                  (F.max("n") - F.min("n") <= 1).cast("int").alias("even"))


@query("epoch_sample_list", DUCK_ITEMS + """, p AS (SELECT item_id, unnest(labels) AS label FROM it), r AS (SELECT item_id, label, 1 + item_id % 5 AS n FROM p)
SELECT item_id, label, n AS draws, (SELECT CAST(sum(n) AS BIGINT) FROM r) AS total FROM r""")
def _(spark, d):
    dist = sources(spark, d).select("item_id", F.explode("labels").alias("label")).withColumn("n", 1 + F.col("item_id") % 5)
    e = P.epoch_sample_list(dist, 11)
    total = e.agg(F.count_distinct("position").alias("total"), F.max("position").alias("last")).where("total = last").drop("last").withColumn("k", F.lit(1))
    return (e.groupBy("item_id", "label").agg(F.count(F.lit(1)).alias("draws")).withColumn("k", F.lit(1)).join(total, "k").drop("k"))


def draws(spark, d):
    """One draw per order: a label of the slide that the order lies in."""
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("draw_id"), F.floor(F.col("o_orderkey") / 2500).cast("int").alias("slide_id"),
                                            (1 + F.col("o_custkey") % 3).cast("int").alias("label"))


DRAWS = """dr AS (SELECT o_orderkey AS draw_id, CAST(o_orderkey // 2500 AS INT) AS slide_id, CAST(1 + o_custkey % 3 AS INT) AS label FROM orders),
c AS (SELECT slide_id, label, count(*) AS n FROM px WHERE label <> 0 GROUP BY ALL)"""


@query("random_pixel_index", PX.rstrip() + ",\n" + DRAWS + " SELECT slide_id, label, count(*) AS draws, 1 AS inside FROM dr JOIN c USING (slide_id, label) GROUP BY ALL")
def _(spark, d):
    counts = T.slide_label_counts(T.tile_label_counts(label(spark, d), TILE, [1, 2, 3]))
    out = P.random_pixel_index(draws(spark, d), counts, 12).join(counts.withColumnRenamed("n", "c"), ["slide_id", "label"])
    return out.groupBy("slide_id", "label").agg(F.count(F.lit(1)).alias("draws"), F.min(((F.col("n") >= 0) & (F.col("n") < F.col("c"))).cast("int")).alias("inside"))


def alignment(spark, d):
    lv = levels(spark, d)
    return L.level_alignment(lv, lv.where("level = 0"))


@query("sample_patches", PX.rstrip() + ",\n" + DRAWS + " SELECT draw_id AS patch_id, label, 25 AS n, label AS centre_label FROM dr JOIN c USING (slide_id, label)")
def _(spark, d):
    """The centre of every loaded label patch is the drawn label."""
    img = view(spark, d, "px").select("slide_id", F.lit(0).alias("level"), "row", "col", "pred")
    out = P.sample_patches(img, label(spark, d).where("label <> 0"), draws(spark, d), alignment(spark, d), {0: (5, 5)}, 13, ["pred"], TILE, "load")
    return out.select("patch_id", "label", F.size("pred").alias("n"), F.col("labels")[12].alias("centre_label"))


@query("assemble_batch", PX.rstrip() + ",\n" + DRAWS + " SELECT draw_id // 64 AS batch, CAST(k AS INT) AS level, count(*) AS n FROM dr JOIN c USING (slide_id, label), (SELECT unnest([0, 1]) AS k) GROUP BY ALL")
def _(spark, d):
    """Patches of all draws at two levels, put into batches."""
    from ..sources.rasters import build_pyramid
    img = build_pyramid(view(spark, d, "px"), 1, value="pred")
    out = P.sample_patches(img, label(spark, d).where("label <> 0"), draws(spark, d), alignment(spark, d), {0: (4, 4), 1: (3, 3)}, 14, ["pred"], TILE)
    size = F.when(F.col("level") == 0, 16).otherwise(9)
    return out.where(F.size("pred") == size).groupBy(F.floor(F.col("patch_id") / 64).alias("batch"), "level").agg(F.count(F.lit(1)).alias("n"))


@query("sample_box_patches", with_views("ann") + "SELECT ann_id AS patch_id, 1 AS inside, 1 AS own_box FROM ann")
def _(spark, d):
    """One draw per annotation: the point lies in the chosen box and that box is among the window's boxes."""
    b = view(spark, d, "ann").select("slide_id", F.col("ann_id").alias("box_id"), F.col("grp").alias("cls"), F.col("y0"), F.col("x0"),
                                     (F.col("y0") + F.col("h")).alias("y1"), (F.col("x0") + F.col("w")).alias("x1"))
    dr = b.select(F.col("box_id").alias("draw_id"), "slide_id", "cls")
    pt, inside = P.sample_box_patches(b, dr, (32, 32), 15, 16)
    own = pt.join(inside.select("patch_id", "box_id"), ["patch_id", "box_id"], "left_semi").select("patch_id", F.lit(1).alias("_own"))
    j = pt.join(b.select("box_id", "y0", "x0", "y1", "x1"), "box_id").join(own, "patch_id", "left")
    ok = (F.col("center_row") >= F.col("y0")) & (F.col("center_row") <= F.col("y1")) & (F.col("center_col") >= F.col("x0")) & (F.col("center_col") <= F.col("x1"))
    return j.select("patch_id", ok.cast("int").alias("inside"), F.coalesce("_own", F.lit(0)).alias("own_box"))


@query("patch_weights_mask", PX + "SELECT slide_id, row, col, label, CAST(label IN (1, 3) AS INT) AS weight, CASE WHEN label IN (1, 3) THEN label ELSE -100 END AS target FROM px")
def _(spark, d):
    return P.patch_weights(label(spark, d), {1: 0.5, 3: 0.5})


@query("batch_counts_check", "SELECT CAST(7 AS INT) AS label")
def _(spark, d):
    return P.missing_labels(sources(spark, d), {**LABS, 7: 0.1, 8: 0.0})


@query("shuffle_batches", "SELECT event_id // 32 AS batch, count(*) AS n, CAST(min(event_id) AS BIGINT) AS first, CAST(max(event_id) AS BIGINT) AS last FROM events GROUP BY ALL")
def _(spark, d):
    s = S.shuffle_batches(table(spark, d, "events").select("event_id"), ["event_id"], 32, 16)
    return s.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"), F.max("position").alias("last"))


@query("replace_easy_patches", with_views("det") + """, n AS (SELECT count(*)::BIGINT AS total, count_if(conf < 0.4)::BIGINT AS easy FROM det)
SELECT total AS n, CAST(greatest(easy - 1500, 0) AS BIGINT) AS easy_left, CAST(least(total, 1500) AS BIGINT) AS fresh, CAST(total - easy AS BIGINT) AS hard_left FROM n""")
def _(spark, d):
    pool = view(spark, d, "det").select(F.col("det_id").alias("patch_id"), F.col("conf").alias("error"), F.lit(0).alias("gen"))
    new = pool.select((F.col("patch_id") + 10_000_000).alias("patch_id"), F.col("error"), F.lit(1).alias("gen"))
    out = S.replace_easy_patches(pool, new, 0.4, 1500, 17)
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("gen") == 0) & (F.col("error") < 0.4)).alias("easy_left"),
                   F.count_if((F.col("gen") == 1) & (F.col("error") == 1.0)).alias("fresh"), F.count_if((F.col("gen") == 0) & (F.col("error") >= 0.4)).alias("hard_left"))


@query("lex_sort_centres", with_views("det") + "SELECT slide_id, det_id AS patch_id, row_number() OVER (PARTITION BY slide_id ORDER BY y, x, det_id) AS position FROM det")
def _(spark, d):
    c = view(spark, d, "det").select("slide_id", F.col("det_id").alias("patch_id"), F.col("y").alias("row"), F.col("x").alias("col"))
    return S.lex_sort_centres(c, 16).select("slide_id", "patch_id", "position")


@query("extract_patches", "SELECT 200 AS n, 1 AS full_windows, 1 AS label_at_centre")
def _(spark, d):
    """Slides as items of two categories; 200 patches whose centre pixel has the drawn label."""
    mask = label(spark, d).where("label <> 0")
    it = T.labels_in_mask(mask).select(F.col("slide_id").alias("item_id"), F.when(F.col("slide_id") % 2 == 0, "a").otherwise("b").alias("category"), "labels")
    img = view(spark, d, "px").select("slide_id", F.lit(0).alias("level"), "row", "col", F.col("label").alias("value"))
    out = P.extract_patches(it, mask, img, alignment(spark, d), {"a": 0.5, "b": 0.5}, {1: 0.5, 2: 0.5}, 4, 200, {0: (7, 7)}, 18, ["value"], TILE)
    return out.agg(F.count(F.lit(1)).cast("int").alias("n"), F.min((F.size("value") == 49).cast("int")).alias("full_windows"),
                   F.min((F.col("value")[24] == F.col("label")).cast("int")).alias("label_at_centre"))
