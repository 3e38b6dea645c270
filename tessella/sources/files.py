"""File catalogues, manifests and CSV reports."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.digest import Sha256
from ..functions.paths import basename
from ..operators.levels import resolve_level
from ..session import Table, materialize, scratch_path

STRETCH = 1 << 28  # bytes of a file that a task hashes at most
COMPRESSED = r"(?i)\.(gz|bz2|zst|snappy|lz4|deflate)$"


def catalog_scan(spark: SparkSession, folder: str, wildcard: str = "*", recursive: bool = False,
                 name_regex: str | None = None) -> DataFrame:
    """Files of a folder by wildcard and an optional pattern anchored at the start of the base name. Only
    names and sizes are read; file contents stay on disk."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", wildcard)
          .option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "length"))
    if name_regex:
        df = df.where(basename(F.col("path")).rlike(f"^(?:{name_regex})"))
    return df


def content_hash(spark: SparkSession, folder: str, wildcard: str = "*", stretch: int = STRETCH) -> DataFrame:
    """SHA-256 of every file.

    A file of up to ``stretch`` bytes is a row. Longer ones are read in splits and hashed a stretch in a round, all files
    at once, where the state of the digest goes from round to round; so no task reads more than a stretch of a file.
    Files that Hadoop would decompress by their name are always a row, which Spark limits to 2 GB.
    """
    def listed(kind: str, *columns: str, **options: str) -> DataFrame:
        m = F.col("_metadata")
        df = spark.read.format(kind).options(pathGlobFilter=wildcard, **options).load(folder)
        return df.select(*columns, m["file_path"].alias("_file"), m["file_size"].alias("_size"), m["file_name"].alias("_name"), m["file_block_start"].alias("_start"))

    is_long = (F.col("_size") > stretch) & ~F.col("_name").rlike(COMPRESSED)
    short = listed("binaryFile", "path", "content").where(~is_long).select("path", F.sha2("content", 256).alias("sha256"))
    long_files = listed("binaryFile", "path").where(is_long).select("path", "_file", "_size")
    if long_files.isEmpty():
        return short
    pieces = scratch_path(spark)
    lines = listed("text", "value", lineSep="\n").where(is_long).select("_file", "_start", F.col("value").cast("binary").alias("value"))
    (lines.mapInArrow(_pieces, "_file string, _start long, _seq long, piece binary, n long")
     .withColumn("stretch", F.floor(F.col("_start") / stretch)).write.partitionBy("stretch").parquet(pieces))
    read = spark.read.schema("_file string, _start long, _seq long, piece binary, n long, stretch long").parquet(pieces)
    # lines come without a byte order mark before the first and without a line end behind the last
    left = F.col("_size") - F.col("_read")
    sizes = long_files.join(read.groupBy("_file").agg(F.sum("n").alias("_read")), "_file", "left").na.fill(0, ["_read"]).select(
        "path", "_file", F.when(left.isin(0, 1, 3, 4), left).otherwise(F.raise_error(F.concat(F.lit("not read as a whole: "), "path"))).alias("_left"))
    sizes = materialize(sizes)
    start, marked = Sha256(), Sha256()
    marked.update(b"\xef\xbb\xbf")
    states = Table(sizes.select("_file", F.when(F.col("_left") >= 3, F.lit(marked.state)).otherwise(F.lit(start.state)).alias("piece")))
    for k in range(read.agg(F.max("stretch")).first()[0] + 1):
        rows = states.df.select("_file", F.lit(-1).cast("long").alias("_start"), F.lit(0).cast("long").alias("_seq"), "piece").unionByName(
            read.where(F.col("stretch") == k).select("_file", "_start", "_seq", "piece"))
        now = Table(rows.repartition("_file").sortWithinPartitions("_file", "_start", "_seq").mapInArrow(_hashed, "_file string, piece binary"))
        states.drop()
        states = now
    done = states.df.join(sizes, "_file").select("path", "piece", F.col("_left").isin(1, 4).alias("_end")).mapInArrow(_digests, "path string, sha256 string")
    return short.unionByName(done)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each split joined again, a line end before every line but the first of a file."""
    split, seq = None, 0
    for batch in batches:
        name, start, value = batch.columns
        cuts = pc.or_(pc.not_equal(name[1:], name[:-1]), pc.not_equal(start[1:], start[:-1])) if len(name) > 1 else pa.array([], pa.bool_())
        edges = [0, *(np.flatnonzero(cuts.to_numpy(zero_copy_only=False)) + 1).tolist(), len(name)] if len(name) else []
        for i, j in pairwise(edges):
            here = (name[i].as_py(), start[i].as_py())
            first = here != split
            split, seq = here, 0 if first else seq + 1
            piece = b"\n".join(value[i:j].to_pylist())
            piece = piece if first and here[1] == 0 else b"\n" + piece
            yield pa.RecordBatch.from_pydict({"_file": [here[0]], "_start": [here[1]], "_seq": [seq], "piece": pa.array([piece], pa.binary()), "n": [len(piece)]})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state of each file behind its pieces, which follow the state before them."""
    name, digest = None, None

    def state():
        return pa.RecordBatch.from_pydict({"_file": [name], "piece": pa.array([digest.state], pa.binary())})

    for batch in batches:
        names, starts = batch.column("_file"), batch.column("_start").to_pylist()
        for i, at in enumerate(starts):
            piece = batch.column("piece")[i].as_buffer().to_pybytes()
            if at < 0:
                if digest is not None:
                    yield state()
                name, digest = names[i].as_py(), Sha256(piece)
            else:
                digest.update(piece)
    if digest is not None:
        yield state()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for piece, end in zip(batch.column("piece").to_pylist(), batch.column("_end").to_pylist(), strict=True):
            digest = Sha256(piece)
            digest.update(b"\n" if end else b"")
            out.append(digest.hexdigest())
        yield pa.RecordBatch.from_pydict({"path": batch.column("path"), "sha256": pa.array(out, pa.string())})


def read_manifest(spark: SparkSession, path: str, columns: list[str], image: str, annotation: str | None = None,
                  target: str | None = None) -> DataFrame:
    """Rows of a CSV manifest that name an image; missing columns are an error."""
    for c in (image, annotation, target):
        if c is not None and c not in columns:
            raise ValueError(f"the manifest has no column {c}")
    df = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(path, header=True)
    none = F.lit(None).cast("string")
    return df.where(F.col(image).isNotNull()).select(
        F.col(image).alias("image"), (F.col(annotation) if annotation else none).alias("annotation"),
        (F.col(target) if target else none).alias("target"))


def manifest_join(manifest: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Manifest rows with the catalogue entry of their image; ``status`` is 'missing' without one."""
    c = catalogue.select(F.col("path").alias("image"), F.lit(True).alias("_ok"))
    return (manifest.join(c, "image", "left")
            .withColumn("status", F.when(F.col("_ok"), "found").otherwise("missing")).drop("_ok"))


def collect_plan(manifest: DataFrame, levels: DataFrame, spacing: float, tol: float = 0.25) -> DataFrame:
    """How each slide reaches the spacing: 'level' with the level to save, 'zoom' from the level at half the
    spacing by 0.5 when the spacing itself is missing, 'failed' when neither exists."""
    ask = manifest.select("slide_id").distinct()
    direct = resolve_level(ask.withColumn("req_spacing", F.lit(spacing)), levels, tol).select("slide_id", F.col("level").alias("_d"))
    half = resolve_level(ask.withColumn("req_spacing", F.lit(spacing / 2)), levels, tol).select("slide_id", F.col("level").alias("_h"))
    j = manifest.join(direct, "slide_id", "left").join(half, "slide_id", "left")
    action = F.when(F.col("_d").isNotNull(), "level").when(F.col("_h").isNotNull(), "zoom").otherwise("failed")
    return j.withColumn("action", action).withColumn("level", F.coalesce("_d", "_h")).drop("_d", "_h")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """One header per file; a single file only on request, for reports known to be small."""
    (df.coalesce(1) if single_file else df).write.csv(path, header=True)


def combine_csv(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """All rows of many small CSV files that share a header."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").csv(glob, header=True)
