"""Connected components, morphology and neighbourhood queries."""

from pyspark.sql import functions as F

from ..fixtures import levels, view, with_views
from ..operators import components as C
from ..operators import hotspots as H
from ..operators import morphology as M
from ..operators import region_compare as RC
from ..registry import query

TILE = 16  # 50 x 50 slides then have whole and partial tiles


def blocks(spark, d):
    return view(spark, d, "blocks").select("slide_id", "row", "col", "label")


def label(spark, d):
    return view(spark, d, "px").select("slide_id", "row", "col", "label")


def level0(spark, d):
    return levels(spark, d).where("level = 0")


def components_sql(source: str, diag: bool = False, name: str = "comps") -> str:
    """Row runs of equal label, linked to the touching runs of the next row, closed recursively.
    ``source`` selects (slide_id, row, col, label) of the foreground."""
    pad = 1 if diag else 0
    return f"""
{name}_fg AS ({source}),
{name}_isl AS (SELECT *, col - row_number() OVER (PARTITION BY slide_id, row, label ORDER BY col) AS g FROM {name}_fg),
{name}_runs AS (SELECT slide_id, row, label, min(col) AS c0, max(col) AS c1,
  row::BIGINT * 4294967296 + min(col) AS id FROM {name}_isl GROUP BY slide_id, row, label, g),
{name}_edges AS (SELECT a.slide_id, a.id AS x, b.id AS y FROM {name}_runs a JOIN {name}_runs b
  ON a.slide_id = b.slide_id AND b.row = a.row + 1 AND a.label = b.label AND b.c0 <= a.c1 + {pad} AND a.c0 <= b.c1 + {pad}),
{name}_both AS (SELECT slide_id, x, y FROM {name}_edges UNION ALL SELECT slide_id, y, x FROM {name}_edges),
{name}_reach AS (SELECT slide_id, id, id AS root FROM {name}_runs UNION
  SELECT r.slide_id, e.y AS id, r.root FROM {name}_reach r JOIN {name}_both e ON e.slide_id = r.slide_id AND e.x = r.id
  WHERE r.root < e.y),
{name}_root AS (SELECT slide_id, id, min(root) AS comp FROM {name}_reach GROUP BY slide_id, id),
{name} AS (SELECT f.slide_id, f.row, f.col, f.label, t.comp FROM {name}_fg f JOIN {name}_runs u
  ON f.slide_id = u.slide_id AND f.row = u.row AND f.label = u.label AND f.col BETWEEN u.c0 AND u.c1
  JOIN {name}_root t ON t.slide_id = u.slide_id AND t.id = u.id)
"""


BL = with_views("blocks").rstrip()
FG = "SELECT slide_id, row, col, label FROM blocks WHERE label <> 0"
ANY = "SELECT slide_id, row, col, 1 AS label FROM blocks WHERE label <> 0"


@query("connected_components", BL + "," + components_sql(FG) + "SELECT slide_id, row, col, label, comp FROM comps")
def _(spark, d):
    return C.label_components(blocks(spark, d).where("label <> 0"), 4, TILE)


@query("connected_components_8", BL + "," + components_sql(FG, True)
       + """SELECT slide_id, label, comp, count(*) AS n, min(row) AS y0, min(col) AS x0, max(row) + 1 AS y1,
 max(col) + 1 AS x1 FROM comps GROUP BY slide_id, label, comp""")
def _(spark, d):
    return C.component_stats(C.label_components(blocks(spark, d).where("label <> 0"), 8, TILE))


@query("filter_regions", BL + "," + components_sql(ANY) + """,
small AS (SELECT slide_id, comp FROM comps GROUP BY slide_id, comp
 HAVING NOT sqrt(((max(row) - min(row) + 1) ^ 2 + (max(col) - min(col) + 1) ^ 2)::DOUBLE) > 9)
SELECT b.slide_id, b.row, b.col, CASE WHEN s.comp IS NULL THEN b.label ELSE 0 END AS label FROM blocks b
 LEFT JOIN comps c ON b.slide_id = c.slide_id AND b.row = c.row AND b.col = c.col
 LEFT JOIN small s ON s.slide_id = c.slide_id AND s.comp = c.comp""")
def _(spark, d):
    return C.filter_regions(blocks(spark, d), 9.0, 4, tile=TILE)


HOLES = "SELECT slide_id, row, col, 0 AS label FROM blocks WHERE label = 0"


@query("fill_holes", BL + "," + components_sql(HOLES) + """,
small AS (SELECT slide_id, comp FROM comps GROUP BY slide_id, comp
 HAVING NOT sqrt(((max(row) - min(row) + 1) ^ 2 + (max(col) - min(col) + 1) ^ 2)::DOUBLE) > 3)
SELECT b.slide_id, b.row, b.col, CASE WHEN s.comp IS NULL THEN b.label ELSE 7 END AS label FROM blocks b
 LEFT JOIN comps c ON b.slide_id = c.slide_id AND b.row = c.row AND b.col = c.col
 LEFT JOIN small s ON s.slide_id = c.slide_id AND s.comp = c.comp WHERE b.label <> 0 OR s.comp IS NOT NULL""")
def _(spark, d):
    full = level0(spark, d)
    # the last slide may be cut short: its frame is what the table holds
    size = (blocks(spark, d).groupBy("slide_id").agg((F.max("row") + 1).cast("bigint").alias("rows"),
                                                     (F.max("col") + 1).cast("bigint").alias("cols")))
    lv = full.drop("rows", "cols").join(size, "slide_id")
    return C.fill_holes(blocks(spark, d).where("label <> 0"), lv, 3.0, 4, fill_value=7, tile=TILE)


@query("remove_small_objects", with_views("px") + """SELECT slide_id, row, col, label FROM px WHERE label <> 0 AND
 (slide_id, label) IN (SELECT (slide_id, label) FROM px WHERE label <> 0 GROUP BY slide_id, label HAVING count(*) >= 600)""")
def _(spark, d):
    return C.remove_small_objects(label(spark, d), 600)


BALL = "(SELECT unnest(range(-3, 4)) AS dr) o, (SELECT unnest(range(-3, 4)) AS dc) p"


@query("dilate", with_views("px") + f"""SELECT DISTINCT slide_id, CAST(row + dr AS INT) AS row, CAST(col + dc AS INT) AS col,
 1 AS label FROM px, {BALL} WHERE label = 1 AND abs(dr) + abs(dc) <= 3
 AND row + dr BETWEEN 0 AND 49 AND col + dc BETWEEN 0 AND 49""")
def _(spark, d):
    return M.dilate(label(spark, d).where("label = 1"), level0(spark, d), 1.5, 0.5, TILE)


@query("erode", with_views("px") + f"""SELECT slide_id, row, col, 1 AS label FROM (SELECT slide_id, row, col FROM px WHERE label = 2) a
 WHERE NOT EXISTS (SELECT 1 FROM {BALL} WHERE abs(dr) + abs(dc) <= 2 AND NOT EXISTS (SELECT 1 FROM px q
 WHERE q.slide_id = a.slide_id AND q.row = a.row + dr AND q.col = a.col + dc AND q.label = 2))""")
def _(spark, d):
    return M.erode_steps(label(spark, d).where("label = 2"), level0(spark, d), 2, TILE)


@query("region_margins", with_views("px") + f""", src AS (SELECT slide_id, row, col FROM px WHERE label = 2),
near AS (SELECT DISTINCT slide_id, row + dr AS row, col + dc AS col FROM src, {BALL} WHERE abs(dr) + abs(dc) <= 1),
away AS (SELECT DISTINCT s.slide_id, s.row, s.col FROM src s, {BALL} WHERE abs(dr) + abs(dc) <= 1 AND NOT EXISTS
 (SELECT 1 FROM src q WHERE q.slide_id = s.slide_id AND q.row = s.row + dr AND q.col = s.col + dc))
SELECT px.slide_id, px.row, px.col, CASE WHEN px.label = 2 AND a.slide_id IS NOT NULL THEN 8
 WHEN px.label <> 2 AND n.slide_id IS NOT NULL THEN 9 ELSE px.label END AS label FROM px
 LEFT JOIN near n ON n.slide_id = px.slide_id AND n.row = px.row AND n.col = px.col
 LEFT JOIN away a ON a.slide_id = px.slide_id AND a.row = px.row AND a.col = px.col""")
def _(spark, d):
    dense = label(spark, d)
    out = M.region_margins(dense, level0(spark, d), 2, 8, 9, 1, TILE)
    return out.join(dense.select("slide_id", "row", "col"), ["slide_id", "row", "col"], "left_semi")


DISC = "(SELECT unnest(range(-4, 5)) AS dr) o, (SELECT unnest(range(-4, 5)) AS dc) p"


@query("disc_density", with_views("px") + f"""SELECT slide_id, CAST(row + dr AS INT) AS row, CAST(col + dc AS INT) AS col,
 CAST(count_if(label = 1) AS BIGINT) AS wanted, CAST(count(*) AS BIGINT) AS among,
 round(count_if(label = 1) / count(*)::DOUBLE, 6) AS share FROM px, {DISC}
 WHERE label IN (1, 2) AND sqrt((dr * dr + dc * dc)::DOUBLE) < 4 AND row + dr BETWEEN 0 AND 49 AND col + dc BETWEEN 0 AND 49
 GROUP BY ALL""")
def _(spark, d):
    out = M.disc_share(label(spark, d), level0(spark, d), [1], [1, 2], M.circle_diameter_px(0.004, 0.5), TILE)
    return out.withColumn("share", F.round("share", 6))


@query("component_relabel_majority")
def _(spark, d):
    return C.relabel_majority(blocks(spark, d), level0(spark, d), {1: 2.0, 2: 3.0}, 0.5, TILE)


@query("top_hotspots", with_views("scores") + """,
s0 AS (SELECT slide_id, row, col, s0 * 100 + s1 AS score FROM scores), r AS (
 SELECT slide_id, 0 AS rank, NULL::INT AS row, NULL::INT AS col, NULL::INT AS score, list(struct_pack(r := s0.row, c := s0.col, v := s0.score)) AS left_
 FROM s0 GROUP BY slide_id
 UNION ALL
 SELECT slide_id, rank + 1, b.r, b.c, b.v, list_filter(left_, lambda q: (q.r - b.r) ^ 2 + (q.c - b.c) ^ 2 > 36)
 FROM (SELECT *, list_reduce(left_, lambda p, q: CASE WHEN q.v > p.v OR (q.v = p.v AND (q.r, q.c) < (p.r, p.c)) THEN q ELSE p END) AS b
  FROM r WHERE rank < 10 AND len(left_) > 0))
SELECT slide_id, rank, row, col, score FROM r WHERE rank > 0""")
def _(spark, d):
    s = view(spark, d, "scores").select("slide_id", "row", "col", (F.col("s0") * 100 + F.col("s1")).alias("score"))
    return H.top_hotspots(s, 6, 10)


BOTH = BL + "," + components_sql(ANY, name="ref") + "," + components_sql(
    "SELECT slide_id, row, col, 1 AS label FROM blocks WHERE hit = 1", name="tmp") + """,
refd AS (SELECT c.slide_id, c.comp, count(*) AS n, count_if(b.hit = 1) AS k FROM ref c JOIN blocks b
 ON b.slide_id = c.slide_id AND b.row = c.row AND b.col = c.col GROUP BY ALL),
tmpd AS (SELECT c.slide_id, c.comp, count(*) AS n, count_if(b.label <> 0) AS k FROM tmp c JOIN blocks b
 ON b.slide_id = c.slide_id AND b.row = c.row AND b.col = c.col GROUP BY ALL)
"""


def ref_tmp(spark, d):
    b = view(spark, d, "blocks")
    return (b.where("label <> 0").select("slide_id", "row", "col", F.lit(1).alias("label")),
            b.where("hit = 1").select("slide_id", "row", "col", F.lit(1).alias("label")))


@query("region_detection_stats", BOTH + """SELECT slide_id, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fn) AS BIGINT) AS fn,
 CAST(sum(fp) AS BIGINT) AS fp FROM (
 SELECT slide_id, CAST(k / n > 0.6 AS INT) AS tp, CAST(k / n <= 0.6 AS INT) AS fn, 0 AS fp FROM refd UNION ALL
 SELECT slide_id, 0, 0, CAST(k / n <= 0.6 AS INT) FROM tmpd) GROUP BY slide_id""")
def _(spark, d):
    ref, tmp = ref_tmp(spark, d)
    return RC.region_detection_stats(ref, tmp, 0.6, 4, TILE)


@query("region_comparison_map", BOTH + """SELECT b.slide_id, b.row, b.col, CASE
 WHEN b.label <> 0 THEN CASE WHEN rd.k / rd.n > 0.6 THEN CASE WHEN b.hit = 1 THEN 1 ELSE 2 END
  ELSE CASE WHEN b.hit = 1 THEN 3 ELSE 4 END END
 ELSE CASE WHEN td.k / td.n > 0.6 THEN 5 ELSE 6 END END AS label
FROM blocks b LEFT JOIN ref r ON r.slide_id = b.slide_id AND r.row = b.row AND r.col = b.col
LEFT JOIN refd rd ON rd.slide_id = r.slide_id AND rd.comp = r.comp
LEFT JOIN tmp t ON t.slide_id = b.slide_id AND t.row = b.row AND t.col = b.col
LEFT JOIN tmpd td ON td.slide_id = t.slide_id AND td.comp = t.comp
WHERE b.label <> 0 OR b.hit = 1""")
def _(spark, d):
    ref, tmp = ref_tmp(spark, d)
    return RC.region_comparison_map(ref, tmp, 0.6, 4, TILE)
