import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabscope.operators.telemetry import stage_progress
from tabscope.session import shared_dir
from tabscope.streaming.progress import latest_progress, stage_progress_stream, write_progress
from tests.conftest import SF

NODES = ["scout", "cleaner_plan", "cleaner_execute", "analyst", "visualizer"]
SPAN = "trace_id string, seq bigint, node_name string, ts timestamp"


def spans_of(spark):
    nodes = F.create_map(*[F.lit(x) for pair in zip(["view", "click", "signup", "purchase", "error"], NODES) for x in pair])
    return spark.read.parquet(f"{SF}/events.parquet").select(
        F.concat_ws("-", "user_id", F.hour("ts")).alias("trace_id"),
        F.col("event_id").alias("seq"),
        nodes[F.col("event_type")].alias("node_name"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def run(spark, parts, **how):
    """The parts arriving as one file and batch each, every one after a restart."""
    folder = shared_dir(spark, "stream-test")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        live = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        query = write_progress(stage_progress_stream(live, **how), f"{folder}/out", f"{folder}/state")
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), folder


def states(spark, folder):
    """Runs that still have a state, and when it ends."""
    kept = spark.read.format("statestore").load(f"{folder}/state")
    return {r["trace_id"]: r["timeoutTimestamp"] for r in kept.select("key.trace_id", "value.timeoutTimestamp").collect()}


def test_stream_equals_batch(spark):
    spans = spans_of(spark)
    for how in ({}, {"keep_all": True}):
        out, _ = run(spark, [spans.where(F.col("seq") % 3 == k) for k in range(3)], **how)
        assert {tuple(r) for r in latest_progress(out).collect()} == {tuple(r) for r in stage_progress(spans).collect()}


def at(day, hour, minute=0):
    return datetime.datetime(2024, 5, day, hour, minute)


def test_state_ends_and_runs_stay_whole(spark):
    batches = [
        # a run across midnight, one that gets to its end, one that falls silent, and one in a single batch of many rows
        [("night", 0, "scout", at(1, 23)), ("night", 1, "cleaner_plan", at(1, 23, 50)), ("done", 0, "scout", at(1, 22)),
         ("done", 5, "reporter", at(1, 22, 30)), ("silent", 0, "scout", at(1, 20)), (None, 0, "scout", at(1, 20)),
         ("late", None, "scout", at(1, 20))] + [("many", k, "scout" if k % 2 else "analyst", at(1, 23)) for k in range(500)],
        [("night", 2, "cleaner_execute", at(2, 0, 30)), ("clock", 0, "scout", at(2, 2)), ("done", 1, "analyst", at(1, 22, 10))],
        [("clock", 1, "analyst", at(2, 23)), ("late", 0, "scout", at(1, 1))],  # the last one is later than the watermark
        [("night", 3, "reporter", at(2, 21, 30)), ("clock", 2, "visualizer", at(2, 23, 10))],
        [("clock", 3, "visualizer", at(2, 23, 20))],
    ]
    parts = [spark.createDataFrame(b, SPAN) for b in batches]
    out, folder = run(spark, parts, event_time="ts", quiet="20 hours", linger="10 minutes", watermark="2 hours")
    found = {r["trace_id"]: (r["progress"], r["current_stage"]) for r in latest_progress(out).collect()}
    assert found == {"night": (55, "reporter"), "done": (50, "reporter"), "silent": (15, "cleaner_plan"),
                     "many": (35, "cleaner_plan"), "clock": (50, "reporter")}
    assert set(states(spark, folder)) == {"clock", "night"}


def test_state_ends_by_default(spark, monkeypatch):
    """Without event time the clock ends a state; the default arguments set a timer for every run."""
    spans = spark.createDataFrame([("a", 0, "scout", at(1, 1)), ("b", 0, "reporter", at(1, 1))], SPAN)
    _, folder = run(spark, [spans])
    rows = states(spark, folder)
    now = pd.Timestamp.now(tz="UTC").value // 1_000_000
    assert 0 < rows["b"] - now + 600_000 and rows["b"] <= now + 600_000 < rows["a"] <= now + 86_400_000
    late = spark.createDataFrame([("c", 0, "scout", at(1, 2))], SPAN)
    _, folder = run(spark, [spans, late, late], quiet="1 ms", linger="1 ms")
    assert set(states(spark, folder)) <= {"c"}


def test_own_weights(spark):
    with pytest.raises(ValueError, match="62"):
        stage_progress_stream(spark.createDataFrame([], SPAN), {f"s{k}": 1 for k in range(63)}, ["s0"])


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
