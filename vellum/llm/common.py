"""Shared pieces: scratch tables in the folder all executors see, and connected components."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.tables import spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from spark.checkpoint.dir; where unset, a folder of our own if there is no cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def tidy(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function over Arrow batches that gives memory back when a task ends, as Python workers live on."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not this C library
                pass

    return run


#: Shares of a table beyond 1 in so many count as heavy.
HEAVY = 1024


class Scratch:
    """Tables written once to the shared folder, so that lineage ends there and a lost executor costs nothing.

    A table stays until `drop` or the end of the session's process, since results are read lazily.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone at exit; the folder is the cluster's to clear
            pass


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """`rows` with the columns of their group: (keys, size, ...) of `groups`, one row each.

    Groups with more than a share of 1 in HEAVY of all rows are fewer than HEAVY, so they are broadcast and their
    rows aren't moved; the rest are joined by shuffling.
    """
    heavy = groups.where(F.col(size) > total / HEAVY)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(groups.where(F.col(size) <= total / HEAVY), keys)
    return rows.join(F.broadcast(heavy), keys).unionByName(rest)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of an undirected graph given as edges (u, v) of longs.

    Alternates the large-star and small-star contractions until no edge changes; each round is written
    to the shared folder, so plans stay short. Returns (node, root), root being the smallest node of the
    component; a node without edges doesn't appear. Hubs are reduced by partial aggregation, and the join
    back to their edges is one that adaptive execution can split.
    """
    now = scratch.write(_canonical(edges), "cc0")
    state, turn = _state(now), 0
    while True:
        turn += 1
        after = scratch.write(_small_star(_large_star(now)), f"cc{turn}")
        fresh = _state(after)
        scratch.drop(f"cc{turn - 1}")
        if fresh == state:
            break
        now, state = after, fresh
    roots = after.select(F.col("v").alias("root")).distinct()
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("root").alias("node"), "root"))


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.join(least, both.u == least.c).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _canonical(moved.unionByName(least.select("u", F.col("m").alias("v"))))
