"""Splitting populations by ratio and items into purposes and folds. Every random choice is a hash of the row
identity and a seed, so a result does not depend on how the data is partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import null_safe_join, prefix_scan, shuffled_rank
from ..session import Table
from .catalog import fold_union


def distribute_population(bins: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Whole numbers ``n`` per bin ``(keys, bin, ratio, lo, hi, population)`` that sum to the population.

    Each bin starts at its half-even rounded share within [lo, hi]; the difference is handed out one by one
    over the bins with room, in random order, evenly. Ratios outside [0, 1], ratios that do not sum to 1 and
    bounds that cannot hold the population are errors.
    """
    keys = keys or ["_all"]
    if keys == ["_all"]:
        bins = bins.withColumn("_all", F.lit(0))
    check = bins.groupBy(*keys).agg(
        F.count_if((F.col("ratio") < 0) | (F.col("ratio") > 1)).alias("_bad"), F.sum("ratio").alias("_r"),
        F.sum("lo").alias("_lo"), F.sum("hi").alias("_hi"), F.max("population").alias("_p"))
    problem = (F.when(F.col("_bad") > 0, "ratio outside [0, 1]")
               .when(F.abs(F.col("_r") - 1.0) > 1e-9 * F.greatest(F.abs("_r"), F.lit(1.0)), "ratios do not sum to 1")
               .when(F.col("_lo") > F.col("_p"), "minimums exceed the population")
               .when(F.col("_hi") < F.col("_p"), "maximums are below the population"))
    guard = check.select(*keys, F.when(problem.isNotNull(), F.raise_error(problem)).cast("boolean").alias("_stop"))
    share = F.bround(F.col("ratio") * F.col("population"), 0).cast("bigint")
    start = (null_safe_join(bins, guard, keys).where("_stop IS NULL").drop("_stop")
             .withColumn("n", F.least(F.greatest(F.col("lo").cast("bigint"), share), F.col("hi").cast("bigint"))))

    def gap(df):
        t = df.groupBy(*keys).agg((F.max("population") - F.sum("n")).alias("_gap"))
        return null_safe_join(df, t, keys)
    cur = Table(gap(start), left=F.max(F.abs("_gap")))
    step = 0
    while cur.metrics["left"]:
        room = F.when(F.col("_gap") > 0, F.col("hi") - F.col("n")).when(F.col("_gap") < 0, F.col("n") - F.col("lo")).otherwise(0)
        open_ = cur.df.withColumn("_room", room).withColumn("_closed", (F.col("_room") <= 0).cast("int"))
        r = shuffled_rank(open_, keys, ["bin"], seed + step, "_rn", head=["_closed"])
        k = open_.groupBy(*keys).agg(F.sum(1 - F.col("_closed")).alias("_k"))
        r = null_safe_join(r, k, keys)
        level = F.floor(F.abs("_gap") / F.greatest("_k", F.lit(1)))
        give = F.when(F.col("_room") <= 0, 0).when(level > 0, F.least(level, F.col("_room"))).when(
            F.col("_rn") <= F.abs("_gap"), 1).otherwise(0)
        nxt = r.withColumn("n", (F.col("n") + F.signum("_gap") * give).cast("bigint")).select(*start.columns)
        cur, step = Table(gap(nxt), left=F.max(F.abs("_gap"))), step + 1
    return cur.df.drop("_gap", "_all")


def split_purposes(items: DataFrame, ratios: dict[str, float], seed: int) -> DataFrame:
    """Assign a ``purpose`` to every item, per category in a random order by the distributed counts; every
    purpose gets an item when the category has enough of them."""
    total = sum(ratios.values())
    names = list(ratios)
    size = items.groupBy("category").agg(F.count(F.lit(1)).alias("population"))
    share = F.explode(F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(ratios[p] / total).alias("ratio")) for i, p in enumerate(names)]))
    bins = size.select("category", "population", share.alias("s")).select(
        "category", "population", "s.*", F.when(F.col("population") >= len(names), 1).otherwise(0).alias("lo"), F.col("population").alias("hi"))
    counts = distribute_population(bins, ["category"], seed)
    ends = counts.groupBy("category").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("_b"))
    ranked = null_safe_join(shuffled_rank(items.drop("purpose"), ["category"], ["item_id"], seed, "_rn"), ends, ["category"])
    before = lambda i: F.aggregate(F.slice("_b", 1, i + 1), F.lit(0).cast("bigint"), lambda acc, b: acc + b["n"])
    purpose = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        purpose = F.when(F.col("_rn") <= before(i), F.lit(names[i])).otherwise(purpose)
    return ranked.withColumn("purpose", purpose).drop("_rn", "_b")


def kfold(items: DataFrame, folds: int, seed: int) -> DataFrame:
    """Each item in every fold configuration, 'validation' in exactly one of them."""
    s = split_purposes(items, {str(i): 1.0 for i in range(folds)}, seed)
    own = s.withColumn("fold", F.col("purpose").cast("int")).drop("purpose")
    return fold_union(own, folds)


def shuffle_batches(rows: DataFrame, identity: list[str], batch_size: int, seed: int) -> DataFrame:
    """Random reading order cut into batches."""
    r = shuffled_rank(rows, [], identity, seed, "_rn")
    return r.withColumn("position", F.col("_rn") - 1).withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size)).drop("_rn")


def replace_easy_patches(pool: DataFrame, new: DataFrame, threshold: float, count: int, seed: int) -> DataFrame:
    """Refresh a pool ``(patch_id, error, ...)``: ``count`` new patches with error 1.0 overwrite rows, those with
    error below the threshold first, each part in random order. A count of 0 (or of the whole pool) replaces
    everything."""
    if count == 0:
        return new.withColumn("error", F.lit(1.0))
    flagged = pool.withColumn("_hard", (F.col("error") >= threshold).cast("int") if threshold > 0 else F.lit(0))
    r = shuffled_rank(flagged, [], ["patch_id"], seed, "_rn", head=["_hard"])
    kept = r.where(F.col("_rn") > count).drop("_rn", "_hard")
    fresh = shuffled_rank(new, [], ["patch_id"], seed + 1, "_rn").where(F.col("_rn") <= count).drop("_rn")
    return kept.unionByName(fresh.withColumn("error", F.lit(1.0)).select(kept.columns))


def tile_batches(tiles: DataFrame, batch_size: int) -> DataFrame:
    """Batch number and slot of each tile ``(slide_id, seq)`` from its sequence number; the last batch of a
    slide is partial, there are no filler rows."""
    return tiles.withColumn("batch", F.floor(F.col("seq") / batch_size)).withColumn("slot", F.col("seq") % batch_size)


def reorder_stream(arrived: DataFrame) -> DataFrame:
    """Rows of each slide that can be emitted so far: the contiguous run of ``seq`` from 0."""
    r = prefix_scan(arrived, ["slide_id"], ["seq"], F.floor(F.col("seq") / 100_000), "_rn")
    # with distinct numbers the row at position p is part of the run exactly while seq = p - 1
    return r.where(F.col("seq") == F.col("_rn") - 1).drop("_rn")


def lex_sort_centres(centres: DataFrame, band: int = 256) -> DataFrame:
    """Position of each patch centre in (row, col) order within its slide."""
    return prefix_scan(centres, ["slide_id"], ["row", "col", "patch_id"], F.floor(F.col("row") / band), "position")

