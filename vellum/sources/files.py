"""Readers and writers: text files with their paths, training data, metric logs, checkpoint catalogues, configurations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.base import let, lines, strip
from vellum.operators import telemetry
from vellum.operators.ingest import CONTENT_TYPES, target_path
from vellum.session import shared_dir

c = F.col
# fixed values: columns of the step and epoch logs
METRICS = "step long, timestamp double, loss double, learning_rate double, perplexity double, epoch int, global_step long, cpu_memory_mb double, cpu_memory_percent double"
EPOCHS = "epoch int, timestamp double, avg_loss double, eval_loss double, eval_metrics struct<perplexity:double,accuracy:double>"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of all .txt files below a folder, or of one file; a path that isn't there raises."""
    reader = spark.read
    if not path.endswith(".txt"):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    return reader.text(path, wholetext=True).select(c("_metadata.file_path").alias("path"), c("value").alias("content"))


def _there(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches; only the folders that the pattern names are listed, in whatever store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def _listed(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, modificationTime, length) of the files that match, none if there are none; contents aren't read."""
    if not _there(spark, pattern):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return spark.read.format("binaryFile").load(pattern).drop("content")


def list_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of the text files below a folder; contents aren't read. A missing folder has none."""
    if not _there(spark, path):
        return _listed(spark, path)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path).drop("content")


def existing_texts(spark: SparkSession, path: str, year: int, month: int | None = None, content_type: str = CONTENT_TYPES[0]) -> DataFrame:
    """(file_name, path, length, modificationTime) of the texts kept for a month, or for a year as a whole.

    Only that folder is listed, `path`/type/YYYY-MM or `path`/type/YYYY; one that isn't there has no texts. Feeds `ingest.remaining`.
    """
    if content_type not in CONTENT_TYPES or not 1900 <= year <= 2100 or not (month is None or 1 <= month <= 12):
        raise ValueError("year, month or content type out of range")
    folder = f"{path.rstrip('/')}/{content_type}/{year}" + (f"-{month:02d}" if month is not None else "")
    return _listed(spark, f"{folder}/*.txt").select(F.url_decode(F.replace(F.substring_index("path", "/", -1), F.lit("+"), F.lit("%2B"))).alias("file_name"), "path", "length", "modificationTime")


def positional(texts: DataFrame, mark: str = "2:3") -> DataFrame:
    """Documents of texts that hold a line with `mark`: the next is the title, then the author, then the text."""

    def of(ls):
        marked = F.filter(F.transform(ls, lambda x, i: F.when(F.contains(x, F.lit(mark)), i).otherwise(-1)), lambda i: i >= 0)
        return let(F.get(marked, F.lit(0)), lambda at: let(at.isNotNull() & (at + 2 < F.size(ls)), lambda ok: F.struct(
            F.when(ok, F.regexp_replace(strip(F.get(ls, at + 1)), '^["“”]+|["“”]+$', "")).otherwise("Untitled").alias("title"),
            F.when(ok, strip(F.replace(strip(F.get(ls, at + 2)), F.lit("By "), F.lit("")))).otherwise("Unknown").alias("author"),
            strip(F.array_join(F.when(ok, F.slice(ls, at + 4, F.size(ls))).otherwise(ls), "\n")).alias("content"),
        )))

    read = texts.select("path", let(lines(c("content")), of).alias("x"))
    return read.select("x.content", "x.author", "x.title", F.lit("Unknown").alias("date"), F.substring_index("path", "/", -1).alias("source"))


def write_texts(docs: DataFrame, folder: str) -> None:
    """Writes `docs` (content_type, year, month, content, ...) that aren't blank under content_type=/ym=; bad keys raise."""
    path = target_path(c("content_type"), c("year"), c("month"), F.lit("x"))
    checked = docs.where(strip(c("content")) != "").withColumn("ym", F.when(path.isNull(), F.raise_error(F.lit("year, month or content type out of range")).cast("string")).otherwise(F.format_string("%d-%02d", "year", "month")))
    checked.write.mode("append").partitionBy("content_type", "ym").parquet(folder)


def save_training_data(examples: DataFrame, path: str, format: str = "jsonl") -> None:
    """JSON lines, one example each; or `json`: the part files, in order of their names, are one array."""
    rows = examples.select("prompt", "response", "metadata")
    if format == "jsonl":
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif format == "json":
        _write_array(rows.select(F.to_json(F.struct("prompt", "response", "metadata"), {"ignoreNullFields": "false"}).alias("j")), path)
    else:
        raise ValueError(f"Unsupported format: {format}")


def _write_array(rows: DataFrame, path: str) -> None:
    """Writes `rows` (j), a JSON value each, as text whose part files in order are one array, an empty one of no rows.

    The values are written once, so that the second reading deals them alike: a row's number tells which is the first and
    which the last of all, and each row brings the bracket or comma about it. No task sees more than its own rows.
    """
    spark = rows.sparkSession
    folder = f"{shared_dir(spark)}/array-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    numbered = spark.read.schema("j string").parquet(folder).withColumn("n", F.monotonically_increasing_id())
    first, last = numbered.agg(F.min("n"), F.max("n")).first()
    if first is None:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    value = F.concat(F.when(c("n") == first, "[\n").otherwise(""), "j", F.when(c("n") == last, "\n]").otherwise(","))
    numbered.select(value.alias("value")).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str, schema: str = METRICS) -> DataFrame:
    return spark.read.schema(schema).json(path).withColumn("ts", F.timestamp_seconds("timestamp"))


def append_metrics(rows: DataFrame, path: str, every: int | None = None) -> None:
    """Appends every row once; with `every`, as a step collector: a run's last so many `rows` (run, ord, ...) at each step that it divides."""
    kept = rows if every is None else telemetry.flushed(rows, every).drop("flushed_at")
    kept.write.mode("append").json(path)


def checkpoints(spark: SparkSession, folder: str, run: str = "run") -> DataFrame:
    """(run, path, mtime, step, length) of checkpoint_step_*.pt files; blobs aren't read. A missing folder has none."""
    files = _listed(spark, f"{folder.rstrip('/')}/checkpoint_step_*.pt")
    return files.select(F.lit(run).alias("run"), "path", c("modificationTime").alias("mtime"), F.regexp_extract("path", r"checkpoint_step_(\d+)\.pt$", 1).cast("long").alias("step"), "length")


def load_checkpoint(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """The catalogue row of a checkpoint, by path or the latest by time, then step; no row if there is none."""
    if path is not None:
        files = _listed(spark, path)
        return files.select(F.lit("run").alias("run"), "path", c("modificationTime").alias("mtime"), F.regexp_extract("path", r"checkpoint_step_(\d+)\.pt$", 1).try_cast("long").alias("step"), "length")
    found = checkpoints(spark, folder)
    latest = found.agg(F.max_by(F.struct(*found.columns), F.struct("mtime", "step")).alias("x")).where("x is not null")
    return latest.select("x.*")


def union_documents(*frames: DataFrame) -> DataFrame:
    """All rows of document frames, columns by name, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
