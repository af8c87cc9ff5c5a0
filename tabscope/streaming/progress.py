"""Stage progress while runs are still going."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabscope.operators.telemetry import COUNTED_NODES, PROGRESS_CAP, SPAN_STAGES, STAGE_WEIGHTS, stage_progress

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE = "done bigint, seq bigint, node string, at bigint"


def _advance(
    weights: Sequence[int], following: Mapping[str, str], final: int, quiet: int, linger: int, timed: bool
) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What a batch does to one run: its state is the stages done, one bit each, the newest span's number
    and node, and the newest time; its timeout is when the state ends."""

    def advance(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        done, seq, node, at = state.get if state.exists else (0, None, None, 0)
        for part in rows:
            done |= int(np.bitwise_or.reduce(part["done"].to_numpy(np.int64)))
            top = part.loc[part["seq"].idxmax()]
            if seq is None or int(top["seq"]) >= seq:
                seq, node = int(top["seq"]), top["node"]
            if timed:
                at = max(at, int(part["at"].max().timestamp() * 1000))
        state.update((done, seq, node, at))
        period = linger if done & final else quiet
        if timed:  # a run whose end is past already ends with the next batch
            state.setTimeoutTimestamp(max(at + period, state.getCurrentWatermarkMs() + 1))
        else:
            state.setTimeoutDuration(period)
        gained = sum(w for i, w in enumerate(weights) if done >> i & 1)
        yield pd.DataFrame(
            {"trace_id": [key[0]], "progress": [min(gained, PROGRESS_CAP)], "current_stage": [following.get(node, node)]}
        )

    return advance


def _millis(period: str) -> int:
    return int(pd.Timedelta(period).total_seconds() * 1000)


def stage_progress_stream(
    spans: DataFrame,
    weights: Mapping[str, int] = STAGE_WEIGHTS,
    order: Sequence[str] = SPAN_STAGES,
    event_time: str | None = None,
    quiet: str = "1 day",
    linger: str = "10 minutes",
    watermark: str = "1 hour",
    counted: Sequence[str] | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """``trace_id, progress, current_stage`` of every run that got spans in a batch, for update mode.

    The figures are those of ``stage_progress``. A run's state is a few numbers, and a timer ends it:
    ``linger`` after its last span once the final stage of ``order`` is done, ``quiet`` after its last
    span otherwise. Time is that of the column ``event_time``, as far as the watermark has come, or without
    one the time of processing. A run is one state however long it takes, so no boundary of a day or window
    splits it; spans later than the watermark are dropped, and spans after the end begin a new state.

    Spans of a run are put together inside each task first, so a run with many spans reaches its state as a
    few rows. Rows without a run or a number are left out; other columns are not read.

    ``keep_all`` is for input that ends, such as catching up on a folder: every run's state is kept to the end by
    the plain aggregate of ``stage_progress``, which costs far less for each run.
    """
    if keep_all:
        return stage_progress(spans, weights, order, counted=counted)
    if counted is None:
        counted = COUNTED_NODES if weights is STAGE_WEIGHTS else list(weights)
    stages = [s for s in weights if weights[s] and s in counted]
    if len(stages) > 62:
        raise ValueError("at most 62 stages")
    bits = {stage: 1 << i for i, stage in enumerate(stages)}
    following = dict(zip(order, [*order[1:], order[-1]]))
    timed = event_time is not None
    at = F.col(event_time).cast("timestamp") if timed else F.lit(None).cast("timestamp")
    rows = spans.where("trace_id IS NOT NULL AND seq IS NOT NULL")
    rows = rows.select("trace_id", F.col("seq").cast("bigint").alias("seq"), F.col("node_name").alias("node"), at.alias("at"))

    def combine(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            part["done"] = part["node"].map(bits).fillna(0).astype(np.int64)
            grouped = part.groupby("trace_id", sort=False)
            newest = part.loc[grouped["seq"].idxmax(), ["trace_id", "seq", "node"]].reset_index(drop=True)
            newest["done"] = grouped["done"].agg(np.bitwise_or.reduce).to_numpy()
            newest["at"] = grouped["at"].max().to_numpy()
            yield newest

    kind = spans.schema["trace_id"].dataType.simpleString()
    few = rows.mapInPandas(combine, f"trace_id {kind}, seq bigint, node string, done bigint, at timestamp")
    if timed:
        few = few.withWatermark("at", watermark)
    advance = _advance(
        [weights[s] for s in stages], following, bits.get(order[-1], 0), _millis(quiet), _millis(linger), timed
    )
    timeout = GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.ProcessingTimeTimeout
    return few.groupBy("trace_id").applyInPandasWithState(
        advance, f"trace_id {kind}, progress int, current_stage string", STATE, "update", timeout
    )


def write_progress(progress: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's changed runs under its batch number; a retried batch overwrites.

    Handles what has arrived and stops. Batches without data, which timers on the clock would ask for without
    end, are off in this query, so states end with the next batch that has some; the session's own setting stays.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    conf = progress.sparkSession.conf
    before = conf.get(EMPTY_BATCHES, None)
    conf.set(EMPTY_BATCHES, "false")
    try:
        return (
            progress.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(save)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.unset(EMPTY_BATCHES) if before is None else conf.set(EMPTY_BATCHES, before)


def latest_progress(written: DataFrame, by: Sequence[str] = ("trace_id",)) -> DataFrame:
    """The newest row of every run out of what ``write_progress`` wrote."""
    return written.groupBy(*by).agg(
        F.max_by("progress", "batch").alias("progress"),
        F.max_by("current_stage", "batch").alias("current_stage"),
    )
