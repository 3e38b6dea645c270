"""Structured Streaming: ordered assembly of scored tiles and running epoch statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "slide_id bigint, seq bigint, value double, closed boolean"


NONE = -(1 << 63)  # a slide whose number of tiles is not known yet
_SLIDES = ("slides", "nexts", "finals", "seen")  # of the open slides of a bucket
_STATE = ", ".join(f"{c} array<bigint>" for c in (*_SLIDES, "at", "seqs")) + ", vals array<double>"


def _stitch(held: tuple | None, batches: list[pd.DataFrame], now: int, timeout_ms: int | None) -> tuple[pd.DataFrame, tuple | None]:
    """What leaves a bucket of slides after new messages, and what is held from now on (None: no slide is open)."""
    slides, nexts, finals, seen, at, seqs, vals = held or ([],) * 7
    old = pd.DataFrame({"next": nexts, "final": finals, "seen": seen}, pd.Index(slides, dtype="int64"), dtype="int64")
    new = pd.concat(batches) if batches else pd.DataFrame({"slide": [], "seq": [], "value": [], "n_final": []})
    new = new.astype({"slide": "int64"})
    came = np.unique(new["slide"].to_numpy())
    open_ = old.reindex(old.index.union(came))
    open_ = open_.fillna({"next": 0, "final": NONE, "seen": now}).astype("int64")
    open_.loc[came, "seen"] = now
    ends = new.dropna(subset="n_final").drop_duplicates("slide", keep="last")
    open_.loc[ends["slide"], "final"] = ends["n_final"].astype("int64").to_numpy()
    tiles = new[new["seq"].notna()]
    waiting = pd.DataFrame({"slide": np.concatenate([np.array(at, np.int64), tiles["slide"]]), "seq": np.concatenate([np.array(seqs, np.int64), tiles["seq"].astype("int64")]),
                            "value": np.concatenate([np.array(vals, np.float64), tiles["value"].astype("float64")])})
    # a tile sent again replaces the waiting one; one that has left already does not leave again
    waiting = waiting.drop_duplicates(["slide", "seq"], keep="last").sort_values(["slide", "seq"], ignore_index=True)
    waiting = waiting[waiting["seq"].to_numpy() >= open_["next"].reindex(waiting["slide"]).to_numpy()]
    run = waiting.groupby("slide").cumcount().to_numpy() + open_["next"].reindex(waiting["slide"]).to_numpy() == waiting["seq"].to_numpy()
    open_["next"] += waiting["slide"][run].value_counts().reindex(open_.index, fill_value=0)
    done = (open_["final"] != NONE) & (open_["next"] >= open_["final"])
    late = ~done & (open_["seen"] + timeout_ms <= now) if timeout_ms is not None else done & False
    gone = late.reindex(waiting["slide"]).to_numpy()
    out = waiting[run | gone]
    out = out.assign(closed=done.reindex(out["slide"]).to_numpy())
    open_ = open_[~done & ~late]
    waiting = waiting[~run & waiting["slide"].isin(open_.index).to_numpy()]
    if not len(open_):
        return out, None
    return out, tuple(c.tolist() for c in (open_.index, *(open_[c] for c in ("next", "final", "seen")), waiting["slide"], waiting["seq"], waiting["value"]))


def ordered_stitch_stream(tiles: DataFrame, timeout_ms: int | None = None, buckets: int = 256) -> DataFrame:
    """Emit tiles ``(slide_id, seq, value, n_final)`` per slide in sequence order.

    Tiles that arrive early wait in the state; a message with ``n_final`` announces the number of tiles and
    closes the slide once all were emitted, which also frees its state. For endless runs a timeout can be set
    as a safeguard: a slide that stays silent that long gives out its waiting tiles, past the gaps and with closed
    false, and its state is freed. (A timeout keeps the query awake, so leave
    it out when processing what is available and stopping.)

    Slides are dealt by hash into ``buckets``, each with one state row of its open slides, as a call for every slide
    costs far more than its tiles; null slides are a bucket of their own.
    """
    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = 0 if timeout_ms is None else state.getCurrentProcessingTimeMs()
        out, held = _stitch(state.get if state.exists else None, [] if state.hasTimedOut else list(batches), now, timeout_ms)
        if held is not None:
            state.update(held)
            if timeout_ms is not None:
                state.setTimeoutDuration(max(1, min(held[3]) + timeout_ms - now))
        elif state.exists:
            state.remove()
        if len(out):
            yield pd.DataFrame({"slide_id": out["slide"] if key[0] >= 0 else pd.array([None] * len(out), "Int64"), "seq": out["seq"].to_numpy(),
                                "value": out["value"].to_numpy(), "closed": out["closed"].to_numpy()})

    bucket = F.coalesce(F.when(F.col("slide_id").isNotNull(), F.pmod(F.xxhash64("slide_id"), F.lit(buckets))), F.lit(-1)).alias("bucket")
    dealt = tiles.select(bucket, F.coalesce(F.col("slide_id").cast("bigint"), F.lit(0)).alias("slide"), "seq", "value", "n_final")
    return dealt.groupBy("bucket").applyInPandasWithState(
        step, OUTPUT, _STATE, "append", GroupStateTimeout.NoTimeout if timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


class StitchProcessor(StatefulProcessor):
    """The same assembly with one state entry per waiting tile: a slide with very many early tiles never has
    to fit into a single state row. Needs the RocksDB state store."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", "next bigint, final bigint")
        self.waiting = handle.getMapState("waiting", "seq bigint", "value double")

    def handleInputRows(self, key, rows, timerValues):
        nxt, final = self.cursor.get() if self.cursor.exists() else (0, None)
        for pdf in rows:
            ends = pdf["n_final"].dropna()
            if len(ends):
                final = int(ends.iloc[0])
            data = pdf[pdf["seq"].notna()]
            for s, v in zip(data["seq"].astype("int64").tolist(), data["value"].tolist()):
                self.waiting.updateValue((s,), (v,))
        out = []
        while self.waiting.containsKey((nxt,)):
            out.append((key[0], nxt, self.waiting.getValue((nxt,))[0]))
            self.waiting.removeKey((nxt,))
            nxt += 1
        done = final is not None and nxt >= final
        if done:
            self.cursor.clear()
            self.waiting.clear()
        else:
            self.cursor.update((nxt, final))
        if out:
            yield pd.DataFrame(out, columns=["slide_id", "seq", "value"]).assign(closed=done)

    def close(self) -> None:
        pass


def ordered_stitch_stream_mapstate(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("slide_id").transformWithStateInPandas(
        statefulProcessor=StitchProcessor(), outputStructType=OUTPUT, outputMode="append", timeMode="None")


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into a parquet table and stop."""
    q = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def epoch_stats_stream(rows: DataFrame, path: str, checkpoint: str, report: Callable[[DataFrame], DataFrame] | None = None,
                       report_path: str | None = None) -> None:
    """Append metric rows to a table; after every batch an optional report over the whole table (for example
    early stopping) is rewritten. A batch that is replayed after a failure replaces itself."""
    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if report is not None:
            whole = batch.sparkSession.read.parquet(path).drop("batch")
            report(whole).write.mode("overwrite").parquet(report_path)
    q = (rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
