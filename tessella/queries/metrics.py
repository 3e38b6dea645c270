"""Tile statistics, quality metrics, weights, losses and epoch history."""

from pyspark.sql import functions as F

from ..fixtures import PATCHES_SQL, levels, patches, table, view, with_views
from ..operators import history as H
from ..operators import metrics as M
from ..operators import tilestats as T
from ..registry import query

TILE = 16
PX = with_views("px")


def label(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", "label")


def pred(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", F.col("pred").alias("label"))


def level0(spark, d):
    return levels(spark, d).where("level = 0")


COUNTS = f"""counts AS (SELECT slide_id, row // {TILE} AS tile_row, col // {TILE} AS tile_col, label, count(*) AS n FROM px
 WHERE label IN (1, 2, 3) GROUP BY ALL)"""
PC = PX.rstrip() + ",\n" + COUNTS + "\n"


def counts(spark, d):
    return T.tile_label_counts(label(spark, d), TILE, [1, 2, 3])


@query("tile_label_counts", PC + "SELECT * FROM counts")
def _(spark, d):
    return counts(spark, d)


@query("tile_fill", with_views("px", "levels").rstrip() + """,
c8 AS (SELECT slide_id, row // 4 AS tile_row, col // 4 AS tile_col, label, count(*) AS n FROM px
 WHERE label IN (1, 2, 3) GROUP BY ALL),
g AS (SELECT slide_id, CAST(a AS INT) AS tile_row, CAST(b AS INT) AS tile_col FROM slides, (SELECT unnest(range(13)) AS a), (SELECT unnest(range(13)) AS b))
SELECT g.slide_id, g.tile_row, g.tile_col, CASE WHEN max(n) IS NULL THEN -1 WHEN max(n) = 16 THEN max_by(label, n) END AS fill_label
 FROM g LEFT JOIN c8 USING (slide_id, tile_row, tile_col) GROUP BY ALL""")
def _(spark, d):
    return T.tile_fill(T.tile_label_counts(label(spark, d), 4, [1, 2, 3]), level0(spark, d), 4)


@query("slide_label_counts", PX + "SELECT slide_id, label, count(*) AS n FROM px WHERE label IN (1, 2, 3) GROUP BY ALL")
def _(spark, d):
    return T.slide_label_counts(counts(spark, d))


@query("labels_in_mask", PX + """SELECT slide_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM px
 WHERE label IN (0, 2, 3) GROUP BY slide_id""")
def _(spark, d):
    return T.labels_in_mask(label(spark, d), [0, 2, 3, 9]).withColumn("labels", F.array_join("labels", ","))


@query("cumulative_tile_counts", PC + """SELECT *, CAST(sum(n) OVER (PARTITION BY slide_id, label, tile_row ORDER BY tile_col) AS BIGINT) AS cum_in_row,
 CAST(sum(n) OVER (PARTITION BY slide_id, label ORDER BY tile_row RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_rows FROM counts""")
def _(spark, d):
    return T.cumulative_tile_counts(counts(spark, d))


@query("nth_labelled_pixel", PX + f"""SELECT o.o_orderkey AS draw_id, r.slide_id, r.label, r.n, r.row, r.col FROM
 (SELECT slide_id, label, row, col, row_number() OVER (PARTITION BY slide_id, label
   ORDER BY row // {TILE}, col // {TILE}, row, col) - 1 AS n FROM px WHERE label <> 0) r
 JOIN (SELECT o_orderkey, CAST(o_orderkey // 2500 AS INT) AS slide_id, CAST(1 + o_orderkey % 3 AS INT) AS label,
   o_custkey AS n FROM orders) o ON o.slide_id = r.slide_id AND o.label = r.label AND o.n = r.n""")
def _(spark, d):
    draws = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("draw_id"), F.floor(F.col("o_orderkey") / 2500).cast("int").alias("slide_id"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("label"), F.col("o_custkey").alias("n"))
    return T.nth_labelled_pixel(label(spark, d), draws, TILE)


@query("construct_labels", PX + """SELECT w.ann_id AS win_id, CAST(y AS INT) AS y, CAST(x AS INT) AS x, coalesce(px.label, 0) AS label FROM
 (SELECT p_partkey AS ann_id, CAST(p_partkey % (SELECT max(o_orderkey) // 2500 + 1 FROM orders) AS INT) AS slide_id, CAST(p_partkey * 11 % 60 - 5 AS INT) AS r0, CAST(p_partkey * 7 % 60 - 5 AS INT) AS c0 FROM part) w,
 (SELECT unnest(range(6)) AS y), (SELECT unnest(range(9)) AS x)
 LEFT JOIN px ON px.slide_id = w.slide_id AND px.row = w.r0 + y AND px.col = w.c0 + x""")
def _(spark, d):
    mask = label(spark, d)
    fill = T.tile_fill(T.tile_label_counts(mask, 4, [1, 2, 3]), level0(spark, d), 4)
    win = spark.sql("""SELECT p_partkey AS win_id, CAST(p_partkey % (SELECT floor(max(o_orderkey) / 2500) + 1 FROM {orders}) AS INT) AS slide_id,
     CAST(p_partkey * 11 % 60 - 5 AS INT) AS row0, CAST(p_partkey * 7 % 60 - 5 AS INT) AS col0, 6 AS h, 9 AS w FROM {part}""",
                    part=table(spark, d, "part"), orders=table(spark, d, "orders"))
    return T.construct_labels(win, fill, mask, 4)


# ---- overlap scores ----
@query("dice_jaccard", PX + """SELECT slide_id, count_if(label = 2)::BIGINT AS size_l, count_if(pred = 2)::BIGINT AS size_r,
 count_if(label = 2 OR pred = 2)::BIGINT AS n_union, count_if(label = 2 AND pred = 2)::BIGINT AS n_inter,
 round(2.0 * count_if(label = 2 AND pred = 2) / (count_if(label = 2) + count_if(pred = 2)), 6)::DOUBLE AS dice,
 round(count_if(label = 2 AND pred = 2) / count_if(label = 2 OR pred = 2), 6)::DOUBLE AS jaccard FROM px GROUP BY slide_id""")
def _(spark, d):
    out = M.dice_jaccard(label(spark, d), pred(spark, d), 2, 2)
    return out.withColumn("dice", F.round("dice", 6)).withColumn("jaccard", F.round("jaccard", 6))


MAPPING = {0: 0, 1: 1, 2: 2, 3: 2}
CM = PX.rstrip() + """,
m AS (SELECT slide_id, CASE label WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 0 END AS t, pred AS p FROM px),
one AS (SELECT slide_id, CAST(a AS INT) AS y_true, CAST(b AS INT) AS y_pred,
  (SELECT count(*) FROM m WHERE m.slide_id = s.slide_id AND t = a AND p = b) AS n
 FROM (SELECT DISTINCT slide_id FROM px) s, (SELECT unnest([1, 2]) AS a), (SELECT unnest([1, 2]) AS b)),
cm AS (SELECT * FROM one UNION ALL SELECT NULL, y_true, y_pred, CAST(sum(n) AS BIGINT) FROM one GROUP BY y_true, y_pred)
"""


def cm(spark, d):
    return M.confusion_matrix(label(spark, d), pred(spark, d), MAPPING, [1, 2])


@query("confusion_matrix", CM + "SELECT * FROM cm")
def _(spark, d):
    return cm(spark, d)


F1 = """SELECT slide_id, label, tp, fn, fp, round(coalesce(2.0 * tp / nullif(2 * tp + fn + fp, 0), 0), 6)::DOUBLE AS f1,
 round(coalesce(1.0 * tp / nullif(tp + fn + fp, 0), 0), 6)::DOUBLE AS jaccard FROM (
 SELECT slide_id, k AS label, CAST(sum(CASE WHEN y_true = k AND y_pred = k THEN n ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN y_true = k AND y_pred <> k THEN n ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y_true <> k AND y_pred = k THEN n ELSE 0 END) AS BIGINT) AS fp
 FROM cm, (SELECT unnest([1, 2]) AS k) GROUP BY ALL)"""


@query("f1_from_cm", CM + F1)
def _(spark, d):
    out = M.cm_scores(cm(spark, d), ["slide_id"])
    return out.withColumn("f1", F.round("f1", 6)).withColumn("jaccard", F.round("jaccard", 6))


@query("overall_f1", CM + """SELECT slide_id, CAST(sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS BIGINT) AS tp, CAST(sum(n) AS BIGINT) AS n,
 round(1.0 * sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) / nullif(sum(n), 0), 6)::DOUBLE AS f1 FROM cm GROUP BY slide_id""")
def _(spark, d):
    return M.overall_f1(cm(spark, d), [1, 2], ["slide_id"]).withColumn("f1", F.round("f1", 6))


@query("normalized_cm", CM + """SELECT slide_id, y_true, y_pred, round(1.0 * n / nullif(sum(n) OVER (PARTITION BY slide_id, y_true), 0), 6)::DOUBLE AS share FROM cm""")
def _(spark, d):
    return M.normalized_cm(cm(spark, d), ["slide_id"]).withColumn("share", F.round("share", 6))


@query("tsr", PX + """SELECT slide_id, CAST(count_if(label = 1 AND pred >= 3) AS BIGINT) AS stroma, CAST(count_if(label = 2 AND pred >= 3) AS BIGINT) AS tumour,
 round(count_if(label = 1 AND pred >= 3) / nullif(count_if(label IN (1, 2) AND pred >= 3), 0), 6)::DOUBLE AS tsr_ratio FROM px GROUP BY slide_id""")
def _(spark, d):
    bulk = view(spark, d, "px").select("slide_id", "row", "col", (F.col("pred") >= 3).cast("int").alias("label"))
    return M.tsr(label(spark, d), bulk, tumour=2, stroma=1).withColumn("tsr_ratio", F.round("tsr_ratio", 6))


SEG = PX.rstrip() + """,
v AS (SELECT slide_id AS image_id, pred - 1 AS p, CASE WHEN label = 0 THEN -100 ELSE label END AS t FROM px WHERE label <> 0),
s AS (SELECT image_id, k, count_if(p = k AND t = k) AS tp, count_if(p = k AND t <> k) AS fp, count_if(p <> k AND t = k) AS fn,
 count_if(p <> k AND t <> k) AS tn FROM v, (SELECT unnest(range(5)) AS k) GROUP BY ALL)
"""


@query("seg_metrics", SEG + """SELECT (SELECT round(sum(tp) / sum(tp + fp + fn), 6) FROM s)::DOUBLE AS iou_score,
 (SELECT round(2 * sum(tp) / sum(2 * tp + fp + fn), 6) FROM s)::DOUBLE AS f1_score,
 (SELECT round(5 * sum(tp) / sum(5 * tp + 4 * fn + fp), 6) FROM s)::DOUBLE AS f2_score,
 (SELECT round(avg(a), 6) FROM (SELECT sum(tp + tn) / sum(tp + fp + fn + tn) AS a FROM s GROUP BY k))::DOUBLE AS accuracy,
 (SELECT round(avg(a), 6) FROM (SELECT sum(tp) / sum(tp + fn) AS a FROM s GROUP BY image_id))::DOUBLE AS recall""")
def _(spark, d):
    p = view(spark, d, "px").select(F.col("slide_id").alias("image_id"), (F.col("pred") - 1).alias("pred"),
                                    F.when(F.col("label") == 0, -100).otherwise(F.col("label")).alias("target"))
    m = M.seg_metrics(p, 5)
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query("ensemble_mean", with_views("scores") + """, m AS (SELECT slide_id, row, col, 0 AS cls, (s0 + s2) / 200.0::DOUBLE AS prob FROM scores
 UNION ALL SELECT slide_id, row, col, 1, (s1 + s3) / 200.0::DOUBLE FROM scores)
SELECT slide_id, row, col, cls, round(prob, 6) AS prob, round(prob - max(prob) OVER w - ln(sum(exp(prob)) OVER w / exp(max(prob) OVER w)), 6) AS logprob
 FROM m WINDOW w AS (PARTITION BY slide_id, row, col)""")
def _(spark, d):
    s = view(spark, d, "scores")
    parts = F.expr("""explode(array(named_struct('model', 0, 'cls', 0, 'score', s0 / 100.0D), named_struct('model', 0, 'cls', 1, 'score', s1 / 100.0D),
      named_struct('model', 1, 'cls', 0, 'score', s2 / 100.0D), named_struct('model', 1, 'cls', 1, 'score', s3 / 100.0D)))""")
    out = M.ensemble_mean(s.select("slide_id", "row", "col", parts.alias("m")).select("slide_id", "row", "col", "m.*"),
                          ["slide_id", "row", "col"])
    return out.withColumn("prob", F.round("prob", 6)).withColumn("logprob", F.round("logprob", 6))


@query("softmax_log", with_views("scores") + """SELECT slide_id, row, col, round(l[1], 6) AS l0, round(l[4], 6) AS l3 FROM (SELECT *,
 list_transform([s0, s1, s2, s3], lambda x: x / 100.0::DOUBLE - ln(exp(s0 / 100.0::DOUBLE) + exp(s1 / 100.0::DOUBLE) + exp(s2 / 100.0::DOUBLE) + exp(s3 / 100.0::DOUBLE))) AS l
 FROM scores)""")
def _(spark, d):
    s = view(spark, d, "scores").select("slide_id", "row", "col", F.expr("transform(array(s0, s1, s2, s3), v -> v / 100.0D)").alias("p"))
    s = s.withColumn("l", M.log_softmax("p"))
    return s.select("slide_id", "row", "col", F.round(F.col("l")[0], 6).alias("l0"), F.round(F.col("l")[3], 6).alias("l3"))


# ---- weights and losses ----
WPX = PX.rstrip() + """,
b AS (SELECT slide_id, row // 10 AS batch, row, col, label, CAST(pred <> 5 AS INT) AS valid FROM px)
"""


def weight_px(spark, d):
    return view(spark, d, "px").select("slide_id", F.floor(F.col("row") / 10).cast("int").alias("batch"), "row", "col", "label",
                                       (F.col("pred") != 5).cast("int").alias("valid"))


def weights_sql(keys, goal="v"):
    return f"""c AS (SELECT {keys}, label, sum(valid) AS n, count(*) AS z FROM b GROUP BY ALL),
g AS (SELECT {keys}, sum(n) AS v, sum(least(n, 1)) AS k, sum(z) AS size FROM c GROUP BY ALL),
w AS (SELECT {keys}, label, n, v, size, least(greatest(CASE WHEN n > 0 THEN v / k / n ELSE 0 END, 0.2), 1.5)::DOUBLE AS raw FROM c JOIN g USING ({keys})),
f AS (SELECT {keys}, label, raw * {goal} / sum(raw * n) OVER (PARTITION BY {keys}) AS wt FROM w)
SELECT b.*, round(CASE WHEN valid > 0 THEN wt ELSE 0 END, 6)::DOUBLE AS weight FROM b JOIN f USING ({keys}, label)"""


@query("label_weights", WPX.rstrip() + ",\n" + weights_sql("slide_id, batch"))
def _(spark, d):
    return M.label_weights(weight_px(spark, d), ["slide_id", "batch"], 0.2, 1.5).withColumn("weight", F.round("weight", 6))


@query("label_weights_batch", WPX.rstrip() + ",\n" + weights_sql("batch", "size"))
def _(spark, d):
    return M.label_weights(weight_px(spark, d), ["batch"], 0.2, 1.5, normalize=True).withColumn("weight", F.round("weight", 6))


@query("clean_weights", WPX + "SELECT slide_id, batch, row, col, label, valid, CAST(valid AS DOUBLE) AS weight FROM b")
def _(spark, d):
    return weight_px(spark, d).withColumn("weight", F.col("valid").cast("double"))


@query("error_histogram", with_views("det") + """SELECT cls, least(floor(conf * 20), 19)::INT AS bin, count(*) AS n,
 (least(floor(conf * 20), 19) + 1) / 20.0::DOUBLE AS edge FROM det WHERE conf BETWEEN 0 AND 1 GROUP BY ALL""")
def _(spark, d):
    return M.error_histogram(view(spark, d, "det").select("cls", F.col("conf").alias("error")), 20, ["cls"])


@query("errors_above", with_views("det") + "SELECT cls, CAST(count_if(conf > 0.5) AS BIGINT) AS n FROM det GROUP BY cls")
def _(spark, d):
    return view(spark, d, "det").groupBy("cls").agg(F.count_if(F.col("conf") > 0.5).alias("n"))


@query("tile_ssim", with_views("rgb") + f"""SELECT slide_id, tile_row, tile_col, round((2 * ma * mb + 6.5025) * (2 * c + 58.5225)
 / ((ma * ma + mb * mb + 6.5025) * (va + vb + 58.5225)), 6)::DOUBLE AS ssim FROM (SELECT slide_id, row // {TILE} AS tile_row, col // {TILE} AS tile_col,
 avg(r) AS ma, avg(g) AS mb, var_pop(r) AS va, var_pop(g) AS vb, covar_pop(r, g) AS c FROM rgb GROUP BY ALL)""")
def _(spark, d):
    p = T.at_tile(view(spark, d, "rgb"), TILE).select("slide_id", "tile_row", "tile_col", F.col("r").alias("a"), F.col("g").alias("b"))
    return M.tile_ssim(p, ["slide_id", "tile_row", "tile_col"]).withColumn("ssim", F.round("ssim", 6))


@query("weighted_dice", WPX + """SELECT slide_id, round((2.0 * sum(CASE WHEN b.label = px.pred THEN valid ELSE 0 END) + 1e-10)
 / (2 * sum(valid) + 1e-10), 6)::DOUBLE AS dice FROM b JOIN px USING (slide_id, row, col) GROUP BY slide_id""")
def _(spark, d):
    p = view(spark, d, "px").select("slide_id", F.col("label").alias("target"), "pred", (F.col("pred") != 5).cast("double").alias("weight"))
    return M.weighted_dice(p, ["slide_id"]).withColumn("dice", F.round("dice", 6))


@query("binary_dice", PX + """SELECT slide_id, round((2.0 * count_if(pred > 2 AND label > 0) + 1e-10)
 / (count_if(pred > 2) + count_if(label > 0) + 1e-10), 6)::DOUBLE AS dice FROM px GROUP BY slide_id""")
def _(spark, d):
    p = view(spark, d, "px").select("slide_id", (F.col("label") > 0).cast("double").alias("target"), (F.col("pred") / 5.0).alias("output"))
    return M.binary_dice(p, ["slide_id"]).withColumn("dice", F.round("dice", 6))


LOVASZ = with_views("scores", "px").rstrip() + """,
e AS (SELECT k AS cls, CAST(label = k AS INT) AS fg, abs(CAST(label = k AS INT) - [s0, s1, s2, s3][k + 1] / 101.0::DOUBLE) AS err
 FROM scores JOIN px USING (slide_id, row, col), (SELECT unnest([0, 1, 2, 3]) AS k)),
o AS (SELECT cls, fg, err, row_number() OVER w AS i, sum(fg) OVER w AS f, sum(fg) OVER (PARTITION BY cls) AS g FROM e
 WINDOW w AS (PARTITION BY cls ORDER BY err DESC, fg ROWS UNBOUNDED PRECEDING)),
j AS (SELECT *, 1 - (g - f) / (g + (i - f) + 1e-5) AS jac FROM o),
per_class AS (SELECT cls, sum(err * d) AS loss FROM (SELECT *, jac - coalesce(lag(jac) OVER (PARTITION BY cls ORDER BY i), 0) AS d FROM j) GROUP BY cls)
"""


def class_scores(spark, d):
    s = view(spark, d, "scores").join(view(spark, d, "px"), ["slide_id", "row", "col"])
    long = s.select("label", F.posexplode(F.array("s0", "s1", "s2", "s3")).alias("cls", "s")).select(
        "cls", (F.col("label") == F.col("cls")).cast("int").alias("fg"), (F.col("s") / 101.0).alias("prob"))
    return long


@query("lovasz_loss", LOVASZ + "SELECT CAST(cls AS INT) AS cls, round(loss, 6)::DOUBLE AS loss FROM per_class")
def _(spark, d):
    return M.lovasz_loss(class_scores(spark, d)).select("cls", F.round("loss", 6).alias("loss"))


@query("mean_lovasz_loss", LOVASZ + "SELECT round(avg(loss), 6)::DOUBLE AS loss, count(*) AS classes FROM per_class")
def _(spark, d):
    return M.mean_lovasz(M.lovasz_loss(class_scores(spark, d))).select(F.round("loss", 6).alias("loss"), "classes")


# ---- epochs ----
EP = with_views("epochs")


@query("epoch_means", """SELECT event_type AS run, CAST(event_id // 100 AS INT) AS epoch, round(avg(value), 6) AS loss, round(avg(value / 7), 6) AS scaled
 FROM events GROUP BY ALL""")
def _(spark, d):
    b = table(spark, d, "events").select(F.col("event_type").alias("run"), F.floor(F.col("event_id") / 100).cast("int").alias("epoch"),
                                         F.col("value").alias("loss"), (F.col("value") / 7).alias("scaled"))
    m = H.epoch_means(b, ["loss", "scaled"])
    return m.withColumn("loss", F.round("loss", 6)).withColumn("scaled", F.round("scaled", 6))


@query("early_stopping", EP.rstrip() + """,
a AS (SELECT run, epoch, validation_loss, row_number() OVER (PARTITION BY run ORDER BY epoch) AS rn,
 min(validation_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
 min(validation_loss) OVER (PARTITION BY run ORDER BY epoch) AS best_loss FROM epochs),
b AS (SELECT *, prev IS NULL OR validation_loss < prev AS best FROM a),
c AS (SELECT *, rn - max(CASE WHEN best THEN rn END) OVER (PARTITION BY run ORDER BY epoch) AS no_improve FROM b),
s AS (SELECT run, min(epoch) AS stop FROM c WHERE no_improve >= 12 GROUP BY run)
SELECT run, epoch, validation_loss, best_loss, CAST(best AS INT) AS is_best, no_improve, CAST(coalesce(epoch = stop, FALSE) AS INT) AS stopped
 FROM c LEFT JOIN s USING (run) WHERE stop IS NULL OR epoch <= stop""")
def _(spark, d):
    return H.early_stopping(view(spark, d, "epochs"), 12)


@query("metric_transitions", EP + """SELECT run, epoch, CAST(sign(validation_loss - p) AS INT) AS change FROM (SELECT *,
 lag(validation_loss) OVER (PARTITION BY run ORDER BY epoch) AS p FROM epochs) WHERE validation_loss <> p""")
def _(spark, d):
    return H.metric_transitions(view(spark, d, "epochs"), "validation_loss")


@query("rewind_stats", EP + """SELECT * FROM epochs WHERE epoch < 5 UNION ALL SELECT run, epoch + 100000, validation_loss, training_loss FROM epochs""")
def _(spark, d):
    e = view(spark, d, "epochs")
    return H.rewind_stats(e, 5, e.withColumn("epoch", (F.col("epoch") + 100000).cast("int")))
