"""Streams of metric rows: running aggregates with a watermark, early stopping with state, an append-only log.

Rows are (run, ord, ts, loss, operation). Early stopping keeps a few numbers per run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vellum.streaming import runs

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, folder: str, per_trigger: int = 1) -> DataFrame:
    """events files of a folder as a stream of metric rows."""
    return rows_of(spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*.parquet").option("maxFilesPerTrigger", per_trigger).parquet(folder))


def rows_of(raw: DataFrame) -> DataFrame:
    """Metric rows of events, batch or stream."""
    return raw.select(F.col("user_id").alias("run"), F.col("event_id").alias("ord"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("loss"), F.col("event_type").alias("operation"))


def windowed(rows: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Per time window and operation: rows, mean and greatest loss. Rows later than `late` are dropped."""
    agg = rows.withWatermark("ts", late).groupBy(F.window("ts", window), "operation").agg(F.count("*").alias("n"), F.round(F.avg("loss"), 6).alias("mean_loss"), F.max("loss").alias("max_loss"))
    return agg.select(F.col("window.start").alias("start"), "operation", "n", "mean_loss", "max_loss")


def early_stopping(rows: DataFrame, patience: int = 3, min_delta: float = 0.01) -> DataFrame:
    """Per run and trigger: rows seen, best loss, rows waited, and the row at which it stopped (null if not yet)."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, best, wait, stopped = state.get if state.exists else (0, math.inf, 0, None)
        for ord_, loss in pd.concat(list(frames)).sort_values("ord")[["ord", "loss"]].itertuples(index=False):
            if stopped is not None or loss is None or math.isnan(loss):
                continue
            seen += 1
            if seen > 1:
                wait = 0 if best - loss > min_delta else wait + 1
            best = min(best, loss)
            if wait >= patience:
                stopped = int(ord_)
        state.update((seen, best, wait, stopped))
        yield pd.DataFrame({"run": [key[0]], "seen": [seen], "best": [best], "wait": [wait], "stopped_at": pd.array([stopped], dtype="Int64")})

    return rows.groupBy("run").applyInPandasWithState(step, "run long, seen long, best double, wait long, stopped_at long", "seen long, best double, wait long, stopped_at long", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over what is there, in a folder of its own, and returns the rows it put out with their batch."""
    return runs.resume(stream, runs.new_folder(stream.sparkSession), mode)


def log(rows: DataFrame) -> DataFrame:
    """The append-only metric log of a stream."""
    return run_once(rows, "append").drop("batch")
