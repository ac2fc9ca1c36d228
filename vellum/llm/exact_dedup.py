"""Exact deduplication by deterministic block naming.

A text is cut into fixed-size byte blocks. All distinct blocks are sorted and numbered, so that each
gets an integer name, its place in the order of first bytes, digests and whole contents; then adjacent names are paired and the distinct pairs
sorted and numbered in the same way, round after round, until each document is one name. Names depend on the
set of texts alone, not on partitions. They stand for content that was compared byte by byte: the 64-bit digest
of a block only chooses where equal ones meet, and blocks that share a digest get names of their own. Two
documents get the same (round, name) exactly when their bytes are equal.

Content is shuffled after each task has merged its own equal blocks, and once more, by ranges, to be sorted;
later rounds move integers. Groups of copies shrink to one row a task before the shuffle, so a hot group is no
heavier than others, and large groups are broadcast to their rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, join_groups

BLOCK_BYTES = 4096
#: Digests shared by different blocks are looked up by broadcast up to so many, by a shuffled join beyond.
BROADCAST_DIGESTS = 100_000


def _blocks(docs: DataFrame, block_bytes: int, digest: Callable[[Column], Column]) -> DataFrame:
    whole = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("b"),
    )
    cut = whole.select(
        "rid",
        "doc_id",
        F.sha2("b", 256).alias("sha"),
        F.expr(f"cast(greatest(1, ceil(length(b) / {block_bytes})) as int)").alias("n"),
        F.expr(f"transform(sequence(0, cast(greatest(1, ceil(length(b) / {block_bytes})) as int) - 1), i -> substring(b, i * {block_bytes} + 1, {block_bytes}))").alias("blocks"),
    )
    rows = cut.select("rid", "doc_id", "sha", "n", F.posexplode("blocks").alias("pos", "blk"))
    return rows.withColumn("h", digest(F.col("blk"))).withColumn("sha", F.expr("if(pos = 0, sha, null)"))


def _numbered(rows: DataFrame, ranges: list[Column], order: list[Column], kept: list[str], scratch: Scratch, label: str) -> DataFrame:
    """(kept, name): each of the distinct `rows` with its place, from 0, in the order of `ranges`, then of `order`.

    Only `ranges` are sampled to deal rows out, so they should be short and no value of theirs common.
    """
    sorted_ = rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges, *order).select(*kept, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("nth"))
    placed = scratch.write(sorted_, label)
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    first = sizes.select("part", F.coalesce(F.expr("sum(n) over (order by part rows between unbounded preceding and 1 preceding)"), F.lit(0)).alias("first"))
    return placed.join(F.broadcast(first), "part").select(*kept, (F.col("first") + F.col("nth")).alias("name"))


def _name_blocks(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(h, key, name) for each distinct block; key holds the bytes where several blocks share h, else nothing."""
    sets = rows.groupBy("h").agg(F.collect_set("blk").alias("blks"))
    flat = sets.select("h", F.size("blks").alias("k"), F.explode("blks").alias("blk"))
    return _numbered(flat.withColumn("key", F.expr("if(k > 1, concat(X'01', blk), X'')")), [F.substring("blk", 1, 16), F.col("h")], [F.col("blk")], ["h", "key"], scratch, "names0")


def _first_round(docs: DataFrame, scratch: Scratch, block_bytes: int, digest: Callable[[Column], Column]) -> DataFrame:
    rows = _blocks(docs, block_bytes, digest)
    names = _name_blocks(rows, scratch)
    shared = names.where("key <> X''").select("h").distinct()
    n_shared = shared.count()
    if n_shared:
        mark = shared.withColumn("clash", F.lit(True))
        rows = rows.join(F.broadcast(mark) if n_shared <= BROADCAST_DIGESTS else mark, "h", "left")
        rows = rows.withColumn("key", F.expr("if(clash, concat(X'01', blk), X'')")).drop("blk", "clash")
        out = rows.join(names, ["h", "key"])
    else:
        out = rows.drop("blk").join(names.drop("key"), "h")
    return scratch.write(out.select("rid", "doc_id", "sha", "n", "pos", "name"), "round0")


def identities(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row (rid, doc_id, sha, level, name) per input row; (level, name) is equal exactly for equal texts."""
    now = _first_round(docs, scratch, block_bytes, digest)
    longest = now.agg(F.max("n")).first()[0] or 1
    done = now.where("n = 1").withColumn("level", F.lit(0))
    for level in range(1, math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        pairs = (
            now.where("n > 1")
            .groupBy("rid", F.expr("pos div 2").alias("pos"))
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.max("sha").alias("sha"),
                F.expr("cast(ceil(max(n) / 2) as int)").alias("n"),
                F.expr("max(if(pos % 2 = 0, name, null))").alias("a"),
                F.expr("coalesce(max(if(pos % 2 = 1, name, null)), -1)").alias("b"),
            )
        )
        names = _numbered(pairs.select("a", "b").distinct(), [F.col("a"), F.col("b")], [], ["a", "b"], scratch, f"names{level}")
        now = scratch.write(pairs.join(names, ["a", "b"]).select("rid", "doc_id", "sha", "n", F.col("pos").cast("int").alias("pos"), "name"), f"round{level}")
        scratch.drop(f"names{level}")
        done = done.unionByName(now.where("n = 1").withColumn("level", F.lit(level)))
    return done.select("rid", "doc_id", "sha", "level", "name")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; of rows that repeat that doc_id too, one.
    A null text counts as empty; a null doc_id is below all others; an empty table gives no rows; other
    columns are ignored. digest may be any expression of the bytes: results don't depend on it.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    ids = identities(docs, scratch, block_bytes, digest)
    groups = ids.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("top"), F.count("*").alias("group_size"))
    return join_groups(ids, scratch.write(groups, "groups"), ["level", "name"], "group_size", ids.count()).select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
