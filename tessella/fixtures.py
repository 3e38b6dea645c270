"""Deterministic views over the given tables that play the raster, annotation, detection and
catalogue roles. One SQL text serves both engines: integer division is written floor(a / b)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 50  # every slide is a SIDE x SIDE raster cut from consecutive orders

_BLOCK = ("(floor(floor((o_orderkey % 2500) / 50) / 6) + floor((o_orderkey % 50) / 8)"
          " + floor(o_orderkey / 2500)) % 4")
_AT = """CAST(floor(o_orderkey / 2500) AS INT) AS slide_id,
 CAST(floor((o_orderkey % 2500) / 50) AS INT) AS row, CAST(o_orderkey % 50 AS INT) AS col"""

VIEWS: dict[str, str] = {
    # dense label raster with a noisy prediction
    "px": f"""SELECT {_AT},
 CAST(CASE WHEN {_BLOCK} = 0 AND o_totalprice < 200000 THEN 1 WHEN {_BLOCK} = 1 THEN 2
      WHEN o_orderstatus = 'F' THEN 3 ELSE 0 END AS INT) AS label,
 CAST(substr(o_orderpriority, 1, 1) AS INT) AS pred FROM orders""",
    # a cleaner raster whose label 1 and 2 regions are compact (few components per slide)
    "blocks": f"""SELECT {_AT},
 CAST(CASE WHEN {_BLOCK} = 0 AND o_totalprice < 450000 THEN 1 WHEN {_BLOCK} = 1 THEN 2 ELSE 0 END AS INT)
  AS label,
 CAST(CASE WHEN {_BLOCK} IN (0, 1) AND o_totalprice >= 120000 THEN 1 ELSE 0 END AS INT) AS hit FROM orders""",
    "rgb": f"""SELECT {_AT}, CAST(o_custkey % 256 AS INT) AS r,
 CAST(CAST(floor(o_totalprice) AS BIGINT) % 256 AS INT) AS g, CAST((o_orderkey * 31) % 256 AS INT) AS b
 FROM orders""",
    # integer class scores 1..100 for four classes; probabilities are s_k / (s0 + s1 + s2 + s3)
    "scores": f"""SELECT {_AT}, CAST(1 + (o_custkey * 7 + o_orderkey) % 100 AS INT) AS s0,
 CAST(1 + (o_custkey * 11 + o_orderkey * 3) % 100 AS INT) AS s1,
 CAST(1 + (o_custkey * 13 + o_orderkey * 5) % 100 AS INT) AS s2,
 CAST(1 + (o_custkey * 17 + o_orderkey * 7) % 100 AS INT) AS s3 FROM orders""",
    "ann": """SELECT p_partkey AS ann_id, CAST(floor(p_partkey / 40) AS INT) AS slide_id,
 concat('Annotation ', CAST(p_partkey AS VARCHAR(20))) AS name, p_brand AS grp,
 CAST(p_partkey * 11 % 40 AS INT) AS y0, CAST(p_partkey * 7 % 40 AS INT) AS x0,
 CAST(p_size % 9 + 2 AS INT) AS h, CAST(p_size % 7 + 2 AS INT) AS w FROM part""",
    "det": """SELECT event_id AS det_id, CAST(floor(event_id / 250) AS INT) AS slide_id,
 CAST(event_id * 13 % 50 AS INT) AS x, CAST(event_id * 29 % 50 AS INT) AS y, event_type AS cls,
 value / 500 AS conf, CAST(8 + event_id % 5 AS INT) AS side FROM events""",
    "items": """SELECT d.doc_id AS item_id, d.lang AS category,
 concat('{root}/{images}/doc_', CAST(d.doc_id AS VARCHAR(20)), '.tif') AS image,
 CASE WHEN l.doc_id IS NOT NULL
  THEN concat('{root}/{masks}/doc_', CAST(d.doc_id AS VARCHAR(20)), '.tif') END AS mask,
 CAST(l.quality AS INT) AS quality, CAST(l.toxic AS INT) AS toxic
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "images": """SELECT doc_id, concat('/data/images/', lang, '/doc_', CAST(doc_id AS VARCHAR(20)), '.tif') AS path
 FROM documents""",
    "masks": """SELECT doc_id, concat('/data/masks/doc_', CAST(doc_id AS VARCHAR(20)), '_mask.tif') AS path
 FROM labels""",
    "stats": """SELECT doc_id, concat('/data/stats/doc_', CAST(doc_id AS VARCHAR(20)), '.stat') AS path
 FROM labels WHERE quality = 1""",
    "stream": """SELECT user_id AS slide_id,
 CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS seq,
 event_id * 7919 % 10007 AS arrival, event_id, value FROM events""",
    "epochs": """SELECT event_type AS run, CAST(floor(event_id / 100) AS INT) AS epoch,
 round(avg(value), 6) AS validation_loss, round(max(value), 6) AS training_loss
 FROM events GROUP BY event_type, CAST(floor(event_id / 100) AS INT)""",
    "renames": """SELECT CAST(n_nationkey % 6 AS INT) AS slide_id, n_name AS old_name, r_name AS new_name
 FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "slides": "SELECT DISTINCT CAST(floor(o_orderkey / 2500) AS INT) AS slide_id FROM orders",
}

_TABLES = re.compile(r"\b(FROM|JOIN)\s+(orders|part|events|documents|labels|nation|region|embeddings)\b")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named role view as a DataFrame over the parquet tables in ``sf_dir``."""
    tables = {m.group(2) for m in _TABLES.finditer(VIEWS[name])}
    text = VIEWS[name].replace("{", "{{").replace("}", "}}")
    text = _TABLES.sub(r"\1 {\2}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in tables})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LEVELS_SQL = """SELECT slide_id, CAST(k AS INT) AS level, CAST(50 >> k AS BIGINT) AS rows,
 CAST(50 >> k AS BIGINT) AS cols, CAST(1 << k AS DOUBLE) AS downsampling, 0.5::DOUBLE * (1 << k) AS spacing
 FROM (SELECT slide_id, unnest(range(4)) AS k FROM slides)"""


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four resolution levels per slide: shape, downsampling and spacing."""
    k = F.col("level")
    return (view(spark, sf_dir, "slides")
            .select("slide_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("level"))
            .select("slide_id", "level", F.expr("cast(shiftright(50, level) as bigint)").alias("rows"),
                    F.expr("cast(shiftright(50, level) as bigint)").alias("cols"),
                    F.pow(F.lit(2.0), k).alias("downsampling"),
                    (F.pow(F.lit(2.0), k) * 0.5).alias("spacing")))


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings read as 8 x 8 single-channel byte patches, row-major."""
    return (table(spark, sf_dir, "embeddings")
            .select(F.col("vec_id").alias("patch_id"), "label",
                    F.expr("transform(embedding, v -> cast(floor((cast(v as double) + 1) * 127.5) as int))")
                    .alias("px")))


PATCHES_SQL = """SELECT vec_id AS patch_id, label,
 list_transform(embedding, lambda v: CAST(floor((CAST(v AS DOUBLE) + 1) * 127.5) AS INT)) AS px FROM embeddings"""


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rectangles of ``ann`` as polygon rows with (y, x) corners."""
    return (view(spark, sf_dir, "ann")
            .select("slide_id", "ann_id", "name", F.lit("Polygon").alias("type"), "grp",
                    F.expr("array(named_struct('y', cast(y0 as double), 'x', cast(x0 as double)),"
                           "named_struct('y', cast(y0 as double), 'x', cast(x0 + w as double)),"
                           "named_struct('y', cast(y0 + h as double), 'x', cast(x0 + w as double)),"
                           "named_struct('y', cast(y0 + h as double), 'x', cast(x0 as double)))").alias("coords")))


def with_views(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for an oracle that reads the named role views."""
    parts = []
    for n in names:
        if n == "levels":
            if "slides" not in names:
                parts.append(f"slides AS ({VIEWS['slides']})")
            parts.append(f"levels AS ({LEVELS_SQL})")
        elif n == "patches":
            parts.append(f"patches AS ({PATCHES_SQL})")
        else:
            parts.append(f"{n} AS ({VIEWS[n]})")
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"
