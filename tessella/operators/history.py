"""Epoch statistics: means, best-so-far, transitions, rewinding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import prefix_scan


def _chunk() -> Column:
    return F.floor(F.col("epoch") / 1024)


def epoch_means(batches: DataFrame, metrics: list[str]) -> DataFrame:
    return batches.groupBy("run", "epoch").agg(*[F.avg(m).alias(m) for m in metrics])


def early_stopping(epochs: DataFrame, patience: int, loss: str = "validation_loss") -> DataFrame:
    """Per epoch up to the stop: best loss so far, whether it is a new (strict) best, epochs since the best.
    The run stops at the first epoch whose count reaches ``patience``."""
    e = prefix_scan(epochs, ["run"], ["epoch"], _chunk(), "_rn", {"_prev": ("min", loss, "before")})
    best = F.col("_prev").isNull() | (F.col(loss) < F.col("_prev"))
    e = e.withColumn("is_best", best.cast("int")).withColumn("_at", F.when(best, F.col("_rn")))
    e = prefix_scan(e, ["run"], ["epoch"], _chunk(), None, {"_last": ("max", "_at"), "best_loss": ("min", loss)})
    e = e.withColumn("no_improve", F.col("_rn") - F.col("_last"))
    stop = e.where(F.col("no_improve") >= patience).groupBy("run").agg(F.min("epoch").alias("_stop"))
    return (e.join(stop, "run", "left").where("_stop IS NULL OR epoch <= _stop")
            .select("run", "epoch", loss, "best_loss", "is_best", "no_improve",
                    F.coalesce(F.col("epoch") == F.col("_stop"), F.lit(False)).cast("int").alias("stopped")))


def metric_transitions(epochs: DataFrame, metric: str) -> DataFrame:
    """Epochs at which the metric differs from the row before: ``change`` is 1 (rise) or -1 (fall)."""
    e = prefix_scan(epochs, ["run"], ["epoch"], _chunk(), None, {"_prev": ("last", metric, "before")})
    return (e.where(F.col(metric) != F.col("_prev"))
            .select("run", "epoch", F.signum(F.col(metric) - F.col("_prev")).cast("int").alias("change")))


def rewind_stats(epochs: DataFrame, index: int, new_rows: DataFrame | None = None) -> DataFrame:
    """Keep the rows before ``index`` and append new ones."""
    kept = epochs.where(F.col("epoch") < index)
    return kept if new_rows is None else kept.unionByName(new_rows)
