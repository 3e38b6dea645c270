"""Annotation documents (XML) <-> annotation rows ``(slide_id, name, type, grp, colour, coords)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the file format: tag of a file of many documents, document tag, annotation type names, and the name of "no group".
FILE_TAG = "Documents"
DOCUMENT_TAG = "ASAP_Annotations"
TYPE_NAMES = {"dot": "Dot", "polygon": "Polygon", "spline": "Spline", "points": "PointSet",
              "measurement": "Measurement", "rectangle": "Rectangle"}
NO_GROUP = "None"

_ANNOTATION = ("_Name string, _Type string, _PartOfGroup string, _Color string, "
               "Coordinates struct<Coordinate: array<struct<_Order: bigint, _X: double, _Y: double>>>")
_GROUP = "_Name string, _PartOfGroup string, _Color string"
_PLACE = "slide_id int, part int"


def _names(mapping: dict, column):
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[column], column)


def _write_documents(docs: DataFrame, annotation: Column, group: Column, path: str, packed: bool) -> None:
    """One document per row ``(slide_id, part)``: a folder each, or with ``packed`` many documents in a file, each
    with its slide and part as attributes. Folders cost the driver and the file system a step per document."""
    body = [F.struct(annotation.alias("Annotation")).alias("Annotations"), F.struct(group.alias("Group")).alias("AnnotationGroups")]
    if packed:
        place = [F.col(c).cast("int").alias(f"_{c}") for c in ("slide_id", "part")]
        docs.select(*place, *body).write.format("xml").option("rootTag", FILE_TAG).option("rowTag", DOCUMENT_TAG).save(path)
    else:
        docs.select("slide_id", "part", F.to_xml(F.struct(*body), {"rowTag": DOCUMENT_TAG}).alias("value")).write.partitionBy(
            "slide_id", "part").text(path)


def read_elements(spark: SparkSession, path: str, packed: bool = False, groups: bool = False) -> DataFrame:
    """Annotation (or group) elements as stored, with the ``slide_id`` and ``part`` of their document."""
    tag, kind = ("Group", _GROUP) if groups else ("Annotation", _ANNOTATION)
    xml = spark.read.format("xml")
    if not packed:
        return xml.option("rowTag", tag).schema(f"{kind}, {_PLACE}").load(path)
    outer = "AnnotationGroups" if groups else "Annotations"
    element = StructType.fromDDL(kind).simpleString()
    docs = xml.option("rowTag", DOCUMENT_TAG).schema(f"_slide_id int, _part int, {outer} struct<{tag}: array<{element}>>").load(path)
    return docs.select(F.inline(f"{outer}.{tag}"), F.col("_slide_id").alias("slide_id"), F.col("_part").alias("part"))


def write_annotations(annotations: DataFrame, groups: DataFrame, path: str, spacing: float | None = None,
                      part_rows: int = 5_000, packed: bool = False) -> None:
    """Write documents under ``slide_id=.../part=...``, or ``packed`` into files of many documents; coordinates in
    micrometers are divided by the spacing.

    A slide with many annotations is cut into parts of about ``part_rows`` by a hash of the whole row, so that
    unnamed ones spread as well; each part is a whole document that repeats the slide's groups. A slide that
    has groups only is written as one document without annotations.
    """
    scale = 1.0 / spacing if spacing else 1.0
    coordinate = F.transform("coords", lambda c, i: F.struct(
        i.cast("bigint").alias("_Order"), (c["x"] * scale).alias("_X"), (c["y"] * scale).alias("_Y")))
    a = annotations.select("slide_id", "name", F.struct(
        F.col("name").alias("_Name"), _names(TYPE_NAMES, F.col("type")).alias("_Type"),
        F.coalesce("grp", F.lit(NO_GROUP)).alias("_PartOfGroup"), F.col("colour").alias("_Color"),
        F.struct(coordinate.alias("Coordinate")).alias("Coordinates")).alias("a"))
    parts = annotations.groupBy("slide_id").agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("_n"))
    docs = (a.join(parts, "slide_id").withColumn("part", F.pmod(F.xxhash64("a"), "_n"))
            .groupBy("slide_id", "part").agg(F.collect_list("a").alias("Annotation")))
    g = groups.select("slide_id", F.struct(
        F.col("grp").alias("_Name"), F.coalesce("parent", F.lit(NO_GROUP)).alias("_PartOfGroup"),
        F.col("colour").alias("_Color")).alias("g")).groupBy("slide_id").agg(F.collect_list("g").alias("Group"))
    whole = docs.join(g, "slide_id", "full").withColumn("part", F.coalesce("part", F.lit(0)))
    _write_documents(whole, F.col("Annotation"), F.col("Group"), path, packed)


def read_annotations(spark: SparkSession, path: str, spacing: float | None = None, packed: bool = False) -> DataFrame:
    """Annotations of all documents below the path, coordinates in file order times the spacing."""
    scale = spacing or 1.0
    df = read_elements(spark, path, packed)
    ordered = F.array_sort(F.col("Coordinates.Coordinate"))
    back = {v: k for k, v in TYPE_NAMES.items()}
    return df.select("slide_id", F.col("_Name").alias("name"), _names(back, F.col("_Type")).alias("type"),
                     F.when(F.col("_PartOfGroup") != NO_GROUP, F.col("_PartOfGroup")).alias("grp"),
                     F.col("_Color").alias("colour"),
                     F.transform(ordered, lambda c: F.struct((c["_Y"] * scale).alias("y"), (c["_X"] * scale).alias("x"))).alias("coords"))


def read_annotation_groups(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    df = read_elements(spark, path, packed, groups=True)
    return df.select("slide_id", F.col("_Name").alias("grp"),
                     F.when(F.col("_PartOfGroup") != NO_GROUP, F.col("_PartOfGroup")).alias("parent"),
                     F.col("_Color").alias("colour")).distinct()


def missing_parents(groups: DataFrame) -> DataFrame:
    """Groups whose parent is not a group of the slide."""
    known = groups.select("slide_id", F.col("grp").alias("parent"))
    return groups.where("parent IS NOT NULL").join(known, ["slide_id", "parent"], "left_anti")


def detection_points(detections: DataFrame, order_by: str, chunk: int = 10_000) -> DataFrame:
    """Detections as point-set rows: per slide and class the coordinate ``ord`` counts 0.. in arrival order.

    The order is a two-level rank over chunks of the arrival number, so one huge class stays distributed.
    """
    from ..functions.ranking import prefix_scan
    r = prefix_scan(detections, ["slide_id", "cls"], [order_by], F.floor(F.col(order_by) / chunk), "ord")
    return r.withColumn("ord", F.col("ord") - 1)


def write_detections(points: DataFrame, path: str, part_points: int = 10_000, packed: bool = False) -> None:
    """One PointSet 'Annotation {class}' per slide and class, in parts of ``part_points`` coordinates; the
    order numbers run on over the parts. Documents are laid out as by ``write_annotations``."""
    c = F.struct(F.col("ord").alias("_Order"), F.col("x").cast("double").alias("_X"), F.col("y").cast("double").alias("_Y"))
    part = F.floor(F.col("ord") / part_points).cast("int").alias("part")
    sets = points.groupBy("slide_id", part, "cls").agg(F.sort_array(F.collect_list(c)).alias("Coordinate"))
    a = F.struct(F.concat(F.lit("Annotation "), F.col("cls")).alias("_Name"), F.lit("PointSet").alias("_Type"),
                 F.lit("inference").alias("_PartOfGroup"), F.lit("#000000").alias("_Color"),
                 F.struct("Coordinate").alias("Coordinates"))
    g = F.array(F.struct(F.lit("inference").alias("_Name"), F.lit(NO_GROUP).alias("_PartOfGroup"), F.lit("#000000").alias("_Color")))
    docs = sets.groupBy("slide_id", "part").agg(F.collect_list(a).alias("Annotation"))
    _write_documents(docs, F.col("Annotation"), g, path, packed)
