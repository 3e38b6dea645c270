"""Running ranks and aggregates that stay parallel when one key holds most of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TOTAL = {"sum": F.sum, "min": F.min, "max": F.max}


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of one name in which null matches null; the keys are those of ``left``."""
    named = right.select(*[F.col(k).alias(f"_at_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_at_{i}")) for i, k in enumerate(keys)]
    return left.join(named, reduce(and_, same), how).drop(*[f"_at_{i}" for i in range(len(keys))])


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column, rank: str | None = "rn",
                running: dict[str, tuple] | None = None) -> DataFrame:
    """Exact row numbers (``rank``) and running aggregates along ``order`` inside ``keys``.

    ``running`` maps a new column to ``(kind, column)`` or ``(kind, column, "before")``; kind is ``sum``,
    ``min``, ``max`` or ``last``, and "before" leaves the current row out.

    ``bucket`` must not decrease along ``order`` and must hold a bounded number of rows. Bucket totals are
    aggregated map-side and only they are scanned per key, so a key with a third of all rows is still cut
    into many window groups. A null key is a key of its own and a null bucket a bucket of its own: no row is lost.
    """
    running = {k: (v if len(v) == 3 else (*v, "upto")) for k, v in (running or {}).items()}
    cut = df.withColumn("_bucket", bucket)
    line = F.struct(*order)

    def total(kind, col):
        return F.max_by(col, line) if kind == "last" else _TOTAL[kind](col)

    totals = cut.groupBy(*keys, "_bucket").agg(
        F.count(F.lit(1)).alias("_n"), *[total(k, c).alias(f"_t_{new}") for new, (k, c, _) in running.items()])
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)

    def carried(kind, new):
        fn = (lambda c: F.last(c, ignorenulls=True)) if kind == "last" else _TOTAL[kind]
        return fn(f"_t_{new}").over(before).alias(f"_t_{new}")

    offsets = totals.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
                            *[carried(k, new) for new, (k, _, _) in running.items()])
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)

    def value(new, kind, col, mode):
        w = inner.rowsBetween(Window.unboundedPreceding, 0 if mode == "upto" else -1)
        here, prev = (F.last(col) if kind == "last" else _TOTAL[kind](col)).over(w), F.col(f"_t_{new}")
        if kind == "last":
            return F.coalesce(here, prev)
        if kind == "sum":
            return F.coalesce(here, F.lit(0)) + F.coalesce(prev, F.lit(0))
        return F.least(here, prev) if kind == "min" else F.greatest(here, prev)

    cols = [F.col(c) for c in df.columns]
    if rank:
        cols.append((F.row_number().over(inner) + F.col("_n")).cast("bigint").alias(rank))
    cols += [value(new, *spec).alias(new) for new, spec in running.items()]
    return null_safe_join(cut, offsets, [*keys, "_bucket"]).select(*cols)


def shuffled_rank(df: DataFrame, keys: list[str], identity: list[str], seed: int, rank: str = "rn",
                  head: list[str] = ()) -> DataFrame:
    """Row numbers 1.. inside ``keys`` in an order that depends only on the row identity and the seed
    (after the 0/1 columns in ``head``, if any).

    The order is the hash of (identity, seed): it does not change with the partitioning, and its top
    bits cut every key into 65536 even buckets.
    """
    hashed = df.withColumn("_h", F.xxhash64(*identity, F.lit(seed)))
    bucket = F.shiftright("_h", 48)
    for i, c in enumerate(reversed(head)):
        bucket = bucket + F.col(c).cast("bigint") * F.lit(1 << (17 + i))
    return prefix_scan(hashed, keys, [*head, "_h", *identity], bucket, rank=rank).drop("_h")


def uniform(seed: int, *cols) -> Column:
    """A number in [0, 1) fixed by the row identity and the seed."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 11).cast("double") / F.lit(float(1 << 53))
