"""Greedy selection of the hottest places of a score raster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Table


def top_hotspots(scores: DataFrame, radius: int, count: int = 10) -> DataFrame:
    """Per slide: take the highest score (first in row-major order on a tie), blank the disc around it,
    repeat up to ``count`` times or until no positive score is left. Returns ``(slide_id, rank, row, col, score)``.

    Each round is one map-side aggregate over the pixels; only the winners, one row per slide, are kept.
    """
    base = scores.where("score > 0").select("slide_id", "row", "col", "score")
    left, winners = base, []
    for rank in range(1, count + 1):
        best = left.groupBy("slide_id").agg(
            F.max_by(F.struct("row", "col", "score"), F.struct(F.col("score"), -F.col("row"), -F.col("col"))).alias("b"))
        t = Table(best.select("slide_id", F.lit(rank).alias("rank"), "b.*"), n=F.count(F.lit(1)))
        if not t.metrics["n"]:
            break
        winners.append(t.df)
        # at most ``count`` discs per slide; slides without a winner this round have nothing left
        taken = reduce(DataFrame.unionByName, winners).groupBy("slide_id").agg(
            F.collect_list(F.struct("row", "col")).alias("_taken"), F.max("rank").alias("_rank"))
        left = (base.join(taken.where(F.col("_rank") == rank), "slide_id")
                .where(~F.exists("_taken", lambda p: (p["row"] - F.col("row")) ** 2 + (p["col"] - F.col("col")) ** 2
                                 <= radius * radius)).drop("_taken", "_rank"))
    if not winners:
        return base.select("slide_id", F.lit(0).alias("rank"), "row", "col", "score")
    return reduce(DataFrame.unionByName, winners)
