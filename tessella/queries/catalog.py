"""Catalogue, configuration and path queries."""

from pyspark.sql import functions as F

from ..fixtures import annotations, table, view, with_views
from ..functions import paths as P
from ..operators import catalog as C
from ..registry import query
from ..session import scratch_path
from ..sources import configs, files

VARS = {"root": "/data/./lake", "images": "img", "masks": "../masks", "stats": "stats"}
PURPOSE = "CASE item_id % 5 WHEN 0 THEN 'testing' WHEN 1 THEN 'validation' ELSE 'training' END"
LABELS = "CASE WHEN mask IS NULL THEN {empty} ELSE {open}1 + quality, 3 + toxic{close} END"
DUCK_ITEMS = with_views("items").rstrip() + f""",
it AS (SELECT item_id, category, {PURPOSE} AS purpose, image, mask, CASE WHEN quality = 1 THEN replace(mask, 'masks', 'stats') END AS stat,
 {LABELS.format(empty='[]::INT[]', open='[', close=']')} AS labels FROM items)
"""


def items(spark, d):
    i = view(spark, d, "items")
    return i.select("item_id", "category", F.expr(PURPOSE).alias("purpose"), "image", "mask",
                    F.expr("CASE WHEN quality = 1 THEN replace(mask, 'masks', 'stats') END").alias("stat"),
                    F.expr(LABELS.format(empty="cast(array() as array<int>)", open="array(", close=")")).alias("labels"))


def images(spark, d):
    return view(spark, d, "images").select("path")


def masks(spark, d):
    return view(spark, d, "masks").select("path")


def stats(spark, d):
    return view(spark, d, "stats").select("path")


V = with_views("images", "masks", "stats")


@query("catalog_scan")
def _(spark, d):
    return files.catalog_scan(spark, d, "*.parquet", True, "[a-z]+").select(P.basename(F.col("path")).alias("name"), "length")


@query("content_hash")
def _(spark, d):
    return files.content_hash(spark, d, "*.parquet").select(P.basename(F.col("path")).alias("name"), "sha256")


# ---- joins ----
@query("match_images_masks", V + "SELECT i.path AS image, m.path AS mask FROM images i JOIN masks m USING (doc_id)")
def _(spark, d):
    return C.match_images_masks(images(spark, d), masks(spark, d), "{image}_mask")


@query("match_images_masks_optional", V + "SELECT i.path AS image, m.path AS mask FROM images i LEFT JOIN masks m USING (doc_id)")
def _(spark, d):
    return C.match_images_masks(images(spark, d), masks(spark, d), "{image}_mask", require_mask=False)


@query("match_image_mask_stat", V + """SELECT i.path AS image, m.path AS mask, s.path AS stat, CAST(m.path IS NOT NULL OR s.path IS NOT NULL AS INT) AS kept
 FROM images i LEFT JOIN masks m USING (doc_id) LEFT JOIN stats s USING (doc_id)""")
def _(spark, d):
    out = C.match_image_mask_stat(images(spark, d), masks(spark, d), stats(spark, d), "{image}_mask.tif", "{image}.stat")
    return out.withColumn("kept", F.col("kept").cast("int"))


@query("match_left_right", V + """SELECT i.path AS left, m.path AS right, concat('/out/', i.doc_id, '.tif') AS result
 FROM images i LEFT JOIN masks m USING (doc_id)""")
def _(spark, d):
    return C.match_left_right(images(spark, d), masks(spark, d), "doc_{base}.tif", "doc_{base}_mask.tif", "/out/{base}.tif", True)


@query("match_pairs_triplets", V + """SELECT i.path AS image, m.path AS mask, concat('/out/doc_', i.doc_id, '_doc_', i.doc_id, '_mask.jpg') AS preview, s.path AS stat
 FROM images i JOIN masks m USING (doc_id) LEFT JOIN stats s USING (doc_id)""")
def _(spark, d):
    pairs = C.match_with_target(images(spark, d), masks(spark, d), "{image}_mask", "/out/{image}_{mask}.jpg", ("image", "mask", "preview"))
    return C.match_triplets(pairs, stats(spark, d), "image", "{image}", "stat")


@query("match_prediction_gt", V + "SELECT i.path AS prediction, m.path AS truth FROM images i LEFT JOIN masks m USING (doc_id)")
def _(spark, d):
    return C.match_prediction_gt(images(spark, d), masks(spark, d), "{image}_mask")


@query("rename_join", with_views("ann") + """SELECT ann_id, a.slide_id, CASE WHEN r.o IS NOT NULL THEN r.n ELSE a.grp END AS grp, CAST(r.o IS NOT NULL AS INT) AS changed
 FROM ann a LEFT JOIN (SELECT DISTINCT CAST(floor(p_partkey / 40) AS INT) AS s, p_brand AS o, concat('group ', p_size % 3) AS n FROM part WHERE p_partkey % 40 = 0) r
 ON a.slide_id = r.s AND a.grp = r.o""")
def _(spark, d):
    return C.rename_join(view(spark, d, "ann"), brand_renames(spark, d)).select("ann_id", "slide_id", "grp", "changed")


def brand_renames(spark, d):
    """One rule per slide: the brand of its first part becomes a group name."""
    return table(spark, d, "part").where("p_partkey % 40 = 0").select(
        F.floor(F.col("p_partkey") / 40).cast("int").alias("slide_id"), F.col("p_brand").alias("old_name"),
        F.concat(F.lit("group "), (F.col("p_size") % 3).cast("string")).alias("new_name"))


@query("rename_report", with_views("ann") + """SELECT s AS slide_id, CAST(count(a.ann_id) AS BIGINT) AS n_changed, 0 AS missing FROM
 (SELECT DISTINCT CAST(floor(p_partkey / 40) AS INT) AS s, p_brand AS o FROM part WHERE p_partkey % 40 = 0) r
 LEFT JOIN ann a ON a.slide_id = r.s AND a.grp = r.o GROUP BY s""")
def _(spark, d):
    return C.rename_report(view(spark, d, "ann"), brand_renames(spark, d))


@query("manifest_join", V + """SELECT i.path AS image, CAST(NULL AS VARCHAR) AS annotation, CASE WHEN d.n_chars % 2 = 0 THEN concat('case_', d.doc_id) END AS target,
 CASE WHEN m.doc_id IS NOT NULL THEN 'found' ELSE 'missing' END AS status
 FROM documents d JOIN images i USING (doc_id) LEFT JOIN masks m USING (doc_id) WHERE d.n_chars % 5 <> 0""")
def _(spark, d):
    docs = table(spark, d, "documents").join(view(spark, d, "images"), "doc_id")
    rows = docs.select(F.when(F.col("n_chars") % 5 != 0, F.col("path")).alias("image_path"),
                       F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("case_"), F.col("doc_id").cast("string"))).alias("new_name"))
    path = scratch_path(spark)
    files.write_csv(rows, path)
    manifest = files.read_manifest(spark, path, ["image_path", "new_name"], "image_path", target="new_name")
    have = view(spark, d, "masks").select("doc_id").join(view(spark, d, "images"), "doc_id").select("path")
    return files.manifest_join(manifest, have)


@query("skip_existing", V + "SELECT i.path AS output FROM images i ANTI JOIN masks m USING (doc_id)")
def _(spark, d):
    done = view(spark, d, "masks").join(view(spark, d, "images").withColumnRenamed("path", "out"), "doc_id").select(F.col("out").alias("path"))
    return C.skip_existing(images(spark, d).withColumnRenamed("path", "output"), done)


# ---- items ----
@query("filter_items", DUCK_ITEMS + "SELECT item_id, category, purpose FROM it WHERE purpose IN ('training', 'none') AND category IN ('en', 'de')")
def _(spark, d):
    return C.filter_items(items(spark, d), ["training", "none"], ["en", "de"]).select("item_id", "category", "purpose")


@query("test_set_filter", DUCK_ITEMS + ", " + "m AS (SELECT doc_id, concat('/data/masks/doc_', doc_id, '_mask.tif') AS path FROM labels) "
       "SELECT replace(path, '_mask', '') AS path FROM m JOIN it ON it.item_id = m.doc_id WHERE purpose = 'testing'")
def _(spark, d):
    m = masks(spark, d).select(F.regexp_replace("path", "_mask", "").alias("path"))
    return C.test_set_filter(m, items(spark, d))


@query("purpose_counts", DUCK_ITEMS + """SELECT purpose, category, count(*) AS n, CAST(grouping(purpose) AS INT) AS all_purposes,
 CAST(grouping(category) AS INT) AS all_categories FROM it GROUP BY CUBE (purpose, category)""")
def _(spark, d):
    return C.purpose_counts(items(spark, d))


@query("label_index", DUCK_ITEMS + "SELECT DISTINCT unnest(labels) AS label, item_id FROM it")
def _(spark, d):
    return C.label_index(items(spark, d))


def found_labels(spark, d):
    """Labels measured in the masks: toxic items lack one configured label, quality 0 ones have an extra."""
    return view(spark, d, "items").where("mask IS NOT NULL").select("item_id", F.expr(
        "array_distinct(array(0, 1 + quality, CASE WHEN toxic = 1 THEN 0 ELSE 3 END, CASE WHEN quality = 0 THEN 9 ELSE 0 END))").alias("labels"))


@query("labels_equal_check", with_views("items") + """SELECT item_id, CASE WHEN toxic = 1 THEN '4' ELSE '' END AS missing, CASE WHEN quality = 0 THEN '9' ELSE '' END AS extra
 FROM items WHERE mask IS NOT NULL AND (toxic = 1 OR quality = 0)""")
def _(spark, d):
    out = C.labels_equal_check(found_labels(spark, d), items(spark, d).where("mask IS NOT NULL"))
    return out.select("item_id", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


@query("label_subset_check", with_views("items") + "SELECT item_id, '4' AS missing FROM items WHERE mask IS NOT NULL AND toxic = 1")
def _(spark, d):
    out = C.label_subset_check(found_labels(spark, d), items(spark, d).where("mask IS NOT NULL"))
    return out.select("item_id", F.array_join("missing", ",").alias("missing"))


@query("unknown_groups", with_views("ann") + "SELECT DISTINCT slide_id, grp FROM ann WHERE grp NOT IN ('Brand#1', 'Brand#2', 'Brand#3')")
def _(spark, d):
    from ..operators.vector import unknown_groups
    return unknown_groups(annotations(spark, d), ["Brand#1", "Brand#2", "Brand#3"])


@query("fold_union", DUCK_ITEMS + """SELECT item_id, CAST(f AS INT) AS fold, CASE WHEN item_id % 4 = f THEN 'validation' ELSE 'training' END AS purpose
 FROM it, (SELECT unnest(range(4)) AS f)""")
def _(spark, d):
    i = items(spark, d).select("item_id", (F.col("item_id") % 4).cast("int").alias("fold"))
    return C.fold_union(i, 4)


@query("sampler_delta", DUCK_ITEMS + """SELECT item_id, CASE WHEN item_id % 3 = 0 AND item_id % 2 = 0 THEN 'kept' WHEN item_id % 3 = 0 THEN 'removed' ELSE 'added' END AS state
 FROM it WHERE item_id % 3 = 0 OR item_id % 2 = 0""")
def _(spark, d):
    i = items(spark, d)
    return C.sampler_delta(i.where("item_id % 3 = 0"), i.where("item_id % 2 = 0"))


@query("push_items", DUCK_ITEMS + """SELECT purpose, count(*) AS ratio FROM (SELECT purpose FROM it UNION ALL SELECT 'validation' FROM it WHERE category = 'fr') GROUP BY purpose""")
def _(spark, d):
    i = items(spark, d)
    return C.push_items(i, i.where("category = 'fr'").drop("purpose"), "validation")[1]


@query("validate_distribution", DUCK_ITEMS + """SELECT purpose, count(*) AS n, 1 AS valid FROM it GROUP BY purpose""")
def _(spark, d):
    return C.validate_distribution(items(spark, d), {"training": 6, "validation": 2, "testing": 2},
                                   {"training": 0.6, "validation": 0.2, "other": 0.5, "testing": 0.2})


@query("check_counts", DUCK_ITEMS + """SELECT CAST(count(*) FILTER (p NOT LIKE '%stats%') AS BIGINT) AS n_ok, CAST(count(*) FILTER (p LIKE '%stats%') AS BIGINT) AS n_missing FROM
 (SELECT DISTINCT unnest([image, mask, stat]) AS p FROM it) WHERE p IS NOT NULL""")
def _(spark, d):
    i = items(spark, d)
    have = i.select(F.col("image").alias("path")).union(i.select("mask")).where("path IS NOT NULL")
    return C.check_counts(i, have)


# ---- path functions ----
@query("path_template", DUCK_ITEMS + """SELECT item_id, replace(replace(image, '{root}', '/data/lake'), '{images}', 'img') AS image,
 replace(replace(mask, '{root}/{masks}', '/data/masks'), '{masks}', 'masks') AS mask FROM it""")
def _(spark, d):
    return C.item_paths(items(spark, d), VARS).select("item_id", "image", "mask")


@query("path_parts", V + """SELECT path, concat('/data/images/', lang) AS dir, concat('doc_', doc_id, '.tif') AS base, concat('doc_', doc_id) AS stem, '.tif' AS ext
 FROM images JOIN documents USING (doc_id)""")
def _(spark, d):
    p = F.col("path")
    return images(spark, d).select("path", P.dirname(p).alias("dir"), P.basename(p).alias("base"), P.stem(p).alias("stem"), P.extension(p).alias("ext"))


@query("tag_path", V + "SELECT path, concat('{root}/{images}/', lang, '/doc_', doc_id, '.tif') AS tagged FROM images JOIN documents USING (doc_id)")
def _(spark, d):
    depth = P.common_depth("/data/images", "/data/masks", "/data/stats")
    return images(spark, d).select("path", P.tag_path(F.col("path"), depth, 1, "root", "images").alias("tagged"))


@query("target_name", """SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN concat('doc_', doc_id, '.mrxs') WHEN n_chars % 3 = 1 THEN concat('case', doc_id, '.mrxs') ELSE concat('case', doc_id, '.tiff') END AS copied,
 CASE WHEN n_chars % 3 = 0 THEN concat('doc_', doc_id, '.tif') WHEN n_chars % 3 = 1 THEN concat('case', doc_id, '.tif') ELSE concat('case', doc_id, '.tiff') END AS converted FROM documents""")
def _(spark, d):
    k = F.col("doc_id").cast("string")
    src = F.concat(F.lit("/in/doc_"), k, F.lit(".mrxs"))
    tgt = F.when(F.col("n_chars") % 3 == 1, F.concat(F.lit("case"), k)).when(F.col("n_chars") % 3 == 2, F.concat(F.lit("case"), k, F.lit(".tiff")))
    return table(spark, d, "documents").select("doc_id", P.target_name(src, tgt, False).alias("copied"), P.target_name(src, tgt, True).alias("converted"))


@query("rename_plan", """SELECT concat('/a/doc_', doc_id, '.mrxs') AS source, concat('/b/doc_', doc_id, '.mrxs') AS target FROM documents UNION ALL
 SELECT concat('/a/doc_', doc_id, '/Data', item_id, '.dat'), concat('/b/doc_', doc_id, '/Data', item_id, '.dat') FROM (SELECT DISTINCT doc_id, quality AS item_id FROM labels)""")
def _(spark, d):
    k = F.col("doc_id").cast("string")
    none = F.lit(None).cast("string")
    i = table(spark, d, "documents").select(F.concat(F.lit("{root}/doc_"), k, F.lit(".mrxs")).alias("image"), none.alias("mask"), none.alias("stat"))
    inside = table(spark, d, "labels").select(F.concat(F.lit("/a/doc_"), k, F.lit("/Data"), F.col("quality").cast("string"), F.lit(".dat")).alias("path")).distinct()
    return C.rename_plan(i, {"root": "/a/"}, {"root": "/b/./"}, inside)


@query("hex_color", with_views("rgb") + """SELECT slide_id, row, col, printf('#%02X%02X%02X', r, g, b) AS colour, r, g, b FROM rgb""")
def _(spark, d):
    c = view(spark, d, "rgb").select("slide_id", "row", "col", P.hex_colour(F.col("r"), F.col("g"), F.col("b")).alias("colour"))
    return c.select("*", *P.parse_hex(F.col("colour")))


# ---- configuration documents ----
_CFG = DUCK_ITEMS + "SELECT purpose, category, image, mask, stat, array_to_string(labels, ',') AS labels FROM it"


def _roundtrip(spark, i, distribution):
    path = scratch_path(spark)
    configs.save_data_config(i, path, VARS, distribution, part_items=200)
    return configs.read_saved_config(spark, path)


@query("save_data_config", _CFG)
def _(spark, d):
    docs = _roundtrip(spark, items(spark, d), {"training": 0.6, "validation": 0.2, "testing": 0.2})
    return configs.load_data_config(docs).select("purpose", "category", "image", "mask", "stat", F.array_join("labels", ",").alias("labels"))


@query("load_data_config", DUCK_ITEMS + "SELECT CAST(NULL AS VARCHAR) AS purpose, category, image, mask, array_to_string(labels, ',') AS labels FROM it")
def _(spark, d):
    docs = _roundtrip(spark, items(spark, d).drop("purpose"), None)
    return configs.load_data_config(docs).select("purpose", "category", "image", "mask", F.array_join("labels", ",").alias("labels"))


@query("distribution_mismatches", DUCK_ITEMS + "SELECT DISTINCT purpose FROM it WHERE purpose = 'testing' UNION ALL SELECT 'fourth'")
def _(spark, d):
    docs = _roundtrip(spark, items(spark, d), {"training": 0.6, "validation": 0.2, "fourth": 0.2})
    return configs.distribution_mismatches(docs)


@query("job_outcomes", V + """SELECT i.path AS image, CASE WHEN m.path IS NULL THEN 'failed' ELSE 'done' END AS status, CASE WHEN m.path IS NULL THEN 'no mask' END AS error
 FROM images i LEFT JOIN masks m USING (doc_id)""")
def _(spark, d):
    jobs = C.match_images_masks(images(spark, d), masks(spark, d), "{image}_mask", require_mask=False)
    return C.job_outcomes(jobs, F.when(F.col("mask").isNull(), "no mask")).select("image", "status", "error")


@query("collect_export", """SELECT slide_id, spacing AS target_spacing, level, action FROM (SELECT CAST(floor(o_orderkey / 2500) AS INT) AS slide_id, 1.0::DOUBLE AS spacing,
 CASE CAST(floor(o_orderkey / 2500) AS INT) % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS level,
 CASE CAST(floor(o_orderkey / 2500) AS INT) % 3 WHEN 0 THEN 'level' WHEN 1 THEN 'zoom' ELSE 'failed' END AS action FROM orders) GROUP BY ALL""")
def _(spark, d):
    from ..fixtures import levels
    m = view(spark, d, "slides").withColumn("target_spacing", F.lit(1.0))
    lv = levels(spark, d).where("slide_id % 3 = 0 OR (slide_id % 3 = 1 AND level <> 1) OR (slide_id % 3 = 2 AND level > 1)")
    return files.collect_plan(m, lv, 1.0).select("slide_id", "target_spacing", "level", "action")


@query("combine_csv", with_views("px") + "SELECT CAST(slide_id AS VARCHAR) AS case_id, round(avg(pred), 6) AS tsr_ratio FROM px GROUP BY slide_id")
def _(spark, d):
    path = scratch_path(spark)
    t = view(spark, d, "px").groupBy(F.col("slide_id").cast("string").alias("case_id")).agg(F.round(F.avg("pred"), 6).alias("tsr_ratio"))
    files.write_csv(t.repartition("case_id"), path)
    return files.combine_csv(spark, path, "case_id string, tsr_ratio double")
