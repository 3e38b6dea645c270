"""Run a small numpy kernel on every tile of a pixel table, with a halo copied from its neighbours."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _span(index: str, last, tile: int):
    lo = F.greatest(F.floor((F.col(index) - F.col("_halo")) / tile), F.lit(0)).cast("int")
    hi = F.least(F.floor((F.col(index) + F.col("_halo")) / tile), last).cast("int")
    return F.explode(F.sequence(lo, hi))


def with_halo(px: DataFrame, levels: DataFrame, tile: int, halo: int | str) -> DataFrame:
    """Tag each pixel with every tile that needs it: its own and those within ``halo``, a number or a column of ``levels``.

    The merge hint keeps pixels from being broadcast to the slides where the planner sizes them lower."""
    reach = (F.col(halo) if isinstance(halo, str) else F.lit(halo)).cast("int")
    size = levels.select("slide_id", F.col("rows").cast("int").alias("_rows"), F.col("cols").cast("int").alias("_cols"), reach.alias("_halo"))
    out = px.join(size.hint("merge"), "slide_id")
    out = out.withColumn("_tr", _span("row", F.floor((F.col("_rows") - 1) / tile), tile))
    return out.withColumn("_tc", _span("col", F.floor((F.col("_cols") - 1) / tile), tile))


def map_tiles(px: DataFrame, levels: DataFrame, kernel: Callable[[np.ndarray, np.ndarray, int], np.ndarray],
              value: str, out: str, out_type: str, tile: int = 512, halo: int | str = 0) -> DataFrame:
    """``kernel(values, inside, halo) -> values`` on the (tile + 2 halo)^2 window of each stored tile.

    ``inside`` is true within the slide. ``halo`` is one number or a column of ``levels`` with one per slide. The non-zero results of the tile's own pixels are returned, so a
    tile without any pixel in its window costs nothing. A group never exceeds one window.
    """
    sid_type = px.schema["slide_id"].dataType.simpleString()
    types = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}

    def run(key, table):
        sid, tr, tc = (k.as_py() for k in key)
        rows, cols = table["_rows"][0].as_py(), table["_cols"][0].as_py()
        h = table["_halo"][0].as_py()
        side = tile + 2 * h
        top, left = tr * tile - h, tc * tile - h
        grid = np.zeros((side, side), dtype=np.float64 if out_type == "double" else np.int64)
        grid[table["row"].to_numpy() - top, table["col"].to_numpy() - left] = table[value].to_numpy()
        rr, cc = np.arange(top, top + side), np.arange(left, left + side)
        inside = ((rr >= 0) & (rr < rows))[:, None] & ((cc >= 0) & (cc < cols))[None, :]
        res = np.where(inside, kernel(grid, inside, h), 0)[h:h + tile, h:h + tile]
        r, c = np.nonzero(res)
        return pa.table({"slide_id": pa.array(np.full(len(r), sid), types[sid_type]), "row": pa.array(r + top + h, pa.int32()),
                         "col": pa.array(c + left + h, pa.int32()), out: pa.array(res[r, c], types[out_type])})

    tagged = with_halo(px.select("slide_id", "row", "col", value), levels, tile, halo)
    return tagged.groupBy("slide_id", "_tr", "_tc").applyInArrow(
        run, f"slide_id {sid_type}, row int, col int, {out} {out_type}")
