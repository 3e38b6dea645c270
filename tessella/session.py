"""Session defaults and the shared scratch folder that iterative operators write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on (AQE, Arrow, UTC)."""
    b = (SparkSession.builder.appName("tessella")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only when Spark runs locally."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A fresh path under the work folder, removed when the application ends."""
    path = f"{work_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that a later round has replaced."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


class Table:
    """A DataFrame written to the work folder, with the metrics observed while writing."""

    def __init__(self, df: DataFrame, **metrics):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark)
        if metrics:
            obs = Observation()
            df = df.observe(obs, *[c.alias(n) for n, c in metrics.items()])
        df.write.parquet(self.path)
        self.metrics = obs.get if metrics else {}
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write once to the shared folder and read back (survives lost executors)."""
    return Table(df).df


def row_count(df: DataFrame) -> tuple[DataFrame, int]:
    """Materialise and count in the same job."""
    t = Table(df, n=F.count(F.lit(1)))
    return t.df, t.metrics["n"]
