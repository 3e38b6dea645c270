"""Data configuration documents: nested purpose / category / item trees <-> item rows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "struct<image: string, mask: string, stat: string, labels: array<int>>"
_LIST = f"map<string, array<{ITEM}>>"
_HEAD = "struct<type: string, path: map<string, string>, distribution: map<string, double>>"


def _yaml_to_json(batches):
    import yaml
    for pdf in batches:
        yield pd.DataFrame({"file": pdf["file"], "value": [json.dumps(yaml.safe_load(v)) for v in pdf["value"]]})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(file, head, list_data, dist_data)`` per JSON or YAML document below the path."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    yaml_docs = docs.where(F.lower("file").rlike(r"\.ya?ml$")).mapInPandas(_yaml_to_json, "file string, value string")
    docs = docs.where(~F.lower("file").rlike(r"\.ya?ml$")).unionByName(yaml_docs)
    d = docs.select("file", F.from_json("value", _HEAD).alias("head"), "value")
    kind = F.col("head.type")
    return d.select("file", "head",
                    F.when(kind == "list", F.from_json("value", f"struct<data: {_LIST}>")["data"]).alias("list_data"),
                    F.when(kind == "distributed", F.from_json("value", f"struct<data: map<string, {_LIST}>>")["data"])
                    .when((kind != "list") | kind.isNull(), F.raise_error(F.lit("unknown data configuration type")))
                    .alias("dist_data"))


def load_data_config(docs: DataFrame) -> DataFrame:
    """Item rows ``(file, purpose, category, image, mask, stat, labels)``; purpose is null for type 'list'."""
    flat = docs.where("list_data IS NOT NULL").select("file", F.lit(None).cast("string").alias("purpose"),
                                                      F.explode("list_data").alias("category", "items"))
    dist = (docs.where("dist_data IS NOT NULL").select("file", F.explode("dist_data").alias("purpose", "cats"))
            .select("file", "purpose", F.explode("cats").alias("category", "items")))
    both = flat.unionByName(dist)
    return both.select("file", "purpose", "category", F.explode("items").alias("i")).select(
        "file", "purpose", "category", "i.*")


def distribution_mismatches(docs: DataFrame) -> DataFrame:
    """Purposes that have items but no ratio, or a ratio but no items, over all parts of a configuration."""
    d = docs.where("dist_data IS NOT NULL")
    used = d.select(F.explode(F.map_keys("dist_data")).alias("purpose")).distinct().withColumn("_u", F.lit(True))
    rated = d.select(F.explode(F.map_keys("head.distribution")).alias("purpose")).distinct().withColumn("_r", F.lit(True))
    return used.join(rated, "purpose", "full_outer").where("_u IS NULL OR _r IS NULL").select("purpose")


def save_data_config(items: DataFrame, path: str, path_vars: dict[str, str], distribution: dict[str, float] | None,
                     part_items: int = 10_000) -> None:
    """Write items as configuration documents of about ``part_items`` items each; every part is a complete
    document, so a category with a third of all items becomes many parts instead of one row."""
    keys = ["purpose", "category"] if distribution else ["category"]
    sized = items.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / part_items).alias("_parts"))
    cut = items.join(sized, keys).withColumn("_part", F.pmod(F.xxhash64("image"), "_parts"))
    item = F.struct("image", "mask", "stat", "labels")
    groups = cut.groupBy(*keys, "_part").agg(F.collect_list(item).alias("_items"))
    inner = F.map_from_arrays(F.array("category"), F.array("_items"))
    data = F.map_from_arrays(F.array("purpose"), F.array(inner)) if distribution else inner
    to_map = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])
    fields = [F.lit("distributed" if distribution else "list").alias("type"), to_map(path_vars).alias("path"), data.alias("data")]
    if distribution:
        fields.append(to_map(distribution).alias("distribution"))
    groups.select(F.to_json(F.struct(*fields)).alias("value")).write.text(path, lineSep="\n")


def read_saved_config(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a saved configuration, one per line."""
    docs = spark.read.text(path).select(F.lit(path).alias("file"), "value")
    d = docs.select("file", F.from_json("value", _HEAD).alias("head"), "value")
    return d.select("file", "head",
                    F.when(F.col("head.type") == "list", F.from_json("value", f"struct<data: {_LIST}>")["data"]).alias("list_data"),
                    F.when(F.col("head.type") == "distributed", F.from_json("value", f"struct<data: map<string, {_LIST}>>")["data"]).alias("dist_data"))
