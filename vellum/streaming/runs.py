"""Streams that can be stopped and taken up again: landed files, a sink that a batch can't enter twice, progress rows.

A stream owns a folder of the shared storage: `state` holds Spark's checkpoint (offsets read, batches done,
operators' state), `out` a folder for each batch. A batch that is run again after a failure writes its own folder
anew, so each row is put out once however often the stream stops.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from vellum.session import shared_dir

PROGRESS = "query string, batch long, at string, rows long, rows_per_second double, ms long, state_rows long"
#: The state store that processors with several state variables need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Bytes of a row group of a landed file.
GROUP = 8 << 20


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def land(parts: list[DataFrame], folder: str) -> None:
    """Writes frames as files of `folder`, one frame after the other, so that a stream takes them up in this order.

    A frame is read by all cores and only written by one; its file's row groups are so small that a trigger splits it.
    """
    for part in parts:
        part.repartition(1).write.mode("append").option("parquet.block.size", GROUP).parquet(folder)


def read(spark: SparkSession, folder: str, schema: str | T.StructType, per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, so many a trigger, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def _start(stream: DataFrame, folder: str, mode: str, put: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """The query, started; its state store is one that every operator here can use, whatever the session's setting."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    conf.set(key, STORE)
    try:
        return stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    finally:
        conf.set(key, before) if before else conf.unset(key)


def resume(stream: DataFrame, folder: str, mode: str = "append", check: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Runs `stream` over what has arrived, from where the last run in `folder` ended; all rows put out so far, with batch.

    `check` is called with each batch and its number before it is written; what it raises ends the run, and the next
    one begins with that batch. A stream that has put out nothing gives no rows.
    """
    spark = stream.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        if check:
            check(batch, number)
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    _start(stream, folder, mode, put).awaitTermination()
    return written(spark, folder, stream.schema)


def written(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All rows that the stream of `folder` has put out, with the batch that did."""
    whole = T.StructType([*schema, T.StructField("batch", T.IntegerType())])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/out")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(f"{folder}/out")


class Progress(StreamingQueryListener):
    """Appends a row for each trigger of the session's streams to a folder: a small file each, named by query and batch.

    A trigger that is told twice replaces its file. `wait` returns when the end of a query has been told.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows == 0:  # a trigger that only moves state on has read nothing
            return
        row = {"query": str(p.id), "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond, "ms": p.batchDuration, "state_rows": sum(s.numRowsTotal for s in p.stateOperators)}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{p.id}-{p.batchId}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60.0) -> bool:
        return self._end(run).wait(seconds)


def progress(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Runs a stream as `resume` and returns its progress rows, of this run and earlier ones: rows read by trigger and how long it took."""
    spark = stream.sparkSession
    listener = Progress(spark, f"{folder}/progress")
    spark.streams.addListener(listener)
    try:
        put = lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
        query = _start(stream, folder, mode, put)
        query.awaitTermination()
        listener.wait(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    return spark.read.schema(PROGRESS).json(f"{folder}/progress")


def new_keys(stream: DataFrame, key: str, time: str, late: str, existing: DataFrame | None = None) -> DataFrame:
    """The rows of a stream whose key hasn't come before, and isn't among those of `existing` (key).

    A key is forgotten `late` after its time, which bounds the state by what arrives in that span: a row that comes
    again later than that is new. Rows without a key, or without a time, don't pass.
    """
    fresh = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    if existing is not None:
        fresh = fresh.join(existing.select(key).distinct(), key, "left_anti")
    return fresh.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def delayed(rows: DataFrame, parts: int, by: Column, late: Column | None = None) -> list[DataFrame]:
    """`rows` dealt to `parts` by equal spans of the whole number `by`; those that are `late` come one part after their own, the last ones in time."""
    lo, hi = rows.agg(F.min(by), F.max(by)).first()
    span = max(1, -(-((hi or 0) - (lo or 0) + 1) // parts))
    part = F.floor((by - F.lit(lo or 0)) / span)
    dealt = rows.withColumn("_part", F.least(part + (0 if late is None else F.when(late, 1).otherwise(0)), F.lit(parts - 1)))
    return [dealt.where(F.col("_part") == i).drop("_part") for i in range(parts)]
