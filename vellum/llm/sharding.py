"""Resharding by minimum-cost flow: equal shard sizes for the fewest bytes moved.

Rows of equal text form a group, and groups fall into blocks by the hash of their text, a fixed number of
blocks a shard. The sizes of the blocks (a bounded table) go to the driver, which solves a transport
problem from old shard sizes to new capacities: a byte that stays costs nothing, one that moves costs one.
Blocks are then chosen to carry each flow, largest first as they fit. Groups stay whole, except a group
that alone outgrows a shard: its rows are dealt over blocks of their own, or sizes couldn't be equal.

Slots are numbered within blocks by many tasks, those of blocks with many rows within salted parts of them, and
each part's first slot comes from the same table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import HEAVY, Scratch

SHARDS = 16
BLOCKS = 4096
#: Blocks that a group too large for one shard is dealt over, for each shard there is.
PARTS = 64
LAW = "bytes"

SIZE = "cast(coalesce(octet_length(text), 0) + 1 as long)"


def min_cost_flow(supply: list[int], demand: list[int]) -> dict[tuple[int, int], int]:
    """Flow (i, j) -> bytes that sends supplies to demands of the same sum; only i -> j with i != j costs.

    Successive shortest paths on the residual network, by Bellman-Ford. Each path uses up a supply, a
    demand or an arc, so there are few whatever the amounts.
    """
    n, m = len(supply), len(demand)
    if sum(supply) != sum(demand):
        raise ValueError("supplies and demands differ")
    flow: dict[tuple[int, int], int] = {}
    left, need = list(supply), list(demand)
    while any(left):
        far = 10**9
        cost = [0 if left[i] else far for i in range(n)] + [far] * m
        came: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    step = int(i != j)
                    if cost[i] + step < cost[n + j]:
                        cost[n + j], came[n + j], changed = cost[i] + step, i, True
                    if flow.get((i, j)) and cost[n + j] - step < cost[i]:
                        cost[i], came[i], changed = cost[n + j] - step, n + j, True
        end = min((j for j in range(m) if need[j]), key=lambda j: cost[n + j])
        path, at = [], n + end
        while came[at] is not None:
            path.append((came[at], at))
            at = came[at]
        amount = min(left[at], need[end], *(flow[b, a - n] for a, b in path if a >= n)) if any(a >= n for a, _ in path) else min(left[at], need[end])
        for a, b in path:
            if a < n:
                flow[a, b - n] = flow.get((a, b - n), 0) + amount
            else:
                flow[b, a - n] -= amount
        left[at] -= amount
        need[end] -= amount
    return {k: v for k, v in flow.items() if v}


@dataclass
class Block:
    shard: int
    block: int
    size: int
    rows: int


def assign(blocks: list[Block], capacities: list[int]) -> list[int]:
    """The new shard of each block: flows from old sizes to capacities, carried by blocks, largest first."""
    n_old = max([b.shard + 1 for b in blocks] + [len(capacities)])
    sizes = [0] * n_old
    for b in blocks:
        sizes[b.shard] += b.size
    flows = min_cost_flow(sizes, capacities)
    to = [b.shard if b.shard < len(capacities) else -1 for b in blocks]
    stock: dict[int, list[int]] = {}
    for k in sorted(range(len(blocks)), key=lambda k: (-blocks[k].size, blocks[k].block)):
        stock.setdefault(blocks[k].shard, []).append(k)
    room = list(capacities)
    for (i, j), amount in sorted(flows.items(), key=lambda x: (-x[1], x[0])):
        if i == j:
            continue
        kept = []
        for k in stock.get(i, []):
            if blocks[k].size <= amount:
                to[k], amount = j, amount - blocks[k].size
            else:
                kept.append(k)
        stock[i] = kept
    for k, b in enumerate(blocks):
        if to[k] >= 0:
            room[to[k]] -= b.size
    for k in sorted((k for k in range(len(blocks)) if to[k] < 0), key=lambda k: -blocks[k].size):
        to[k] = max(range(len(room)), key=lambda j: room[j])  # what is left of shards that go
        room[to[k]] -= blocks[k].size
    return _even_out(blocks, to, room)


def _even_out(blocks: list[Block], to: list[int], room: list[int]) -> list[int]:
    """Moves single blocks from the fullest to the emptiest shard as long as both come nearer to capacity."""
    held: dict[int, list[int]] = {}
    for k in sorted(range(len(blocks)), key=lambda k: -blocks[k].size):
        held.setdefault(to[k], []).append(k)
    for _ in range(64 * len(room)):
        full, empty = min(range(len(room)), key=lambda j: room[j]), max(range(len(room)), key=lambda j: room[j])
        gap = room[empty] - room[full]
        best = max((k for k in held.get(full, []) if blocks[k].size < gap), key=lambda k: min(blocks[k].size, gap - blocks[k].size), default=None)
        if best is None:
            break
        held[full].remove(best)
        held.setdefault(empty, []).append(best)
        to[best] = empty
        room[full] += blocks[best].size
        room[empty] -= blocks[best].size
    return to


def capacities_of(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _keyed(docs: DataFrame, old: Column | None, shards: int, blocks: int) -> DataFrame:
    """`docs` with _old, _h, _block and _size; without an old shard, rows start where the hash of the text puts them."""
    hashed = docs.withColumn("_h", F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull()))
    old = F.pmod(F.col("_h"), F.lit(shards)) if old is None else old
    return hashed.withColumns({"_old": old.cast("int"), "_block": F.expr(f"cast(pmod(xxhash64(_h), {blocks}) as int)"), "_size": F.expr(SIZE)})


def _split_giants(keyed: DataFrame, total: int, shards: int, blocks: int) -> DataFrame:
    """Deals the rows of groups larger than a shard, by their number _n, over blocks of their own; there are fewer than `shards` such groups."""
    most = max(1, total // shards)
    heavy = keyed.groupBy("_old", "_block").agg(F.sum("_size").alias("s")).where(F.col("s") > most).select("_old", "_block").collect()
    if not heavy:
        return keyed
    inside = F.lit(False)
    for r in heavy:  # at most `shards` blocks
        inside |= (F.col("_old") == r._old) & (F.col("_block") == r._block)
    giants = [r._h for r in keyed.where(inside).groupBy("_h").agg(F.sum("_size").alias("s")).where(F.col("s") > most).select("_h").collect()]
    if not giants:
        return keyed
    parts = PARTS * shards
    nth = F.coalesce(*[F.when(F.col("_h") == h, F.lit(i)) for i, h in enumerate(giants)])
    own = F.lit(blocks) + nth * parts + F.pmod(F.xxhash64("_n", F.lit(7)), F.lit(parts)).cast("int")
    return keyed.withColumn("_block", F.when(F.col("_h").isin(giants), own).otherwise(F.col("_block")).cast("int"))


def _salted(keyed: DataFrame, rows: int) -> DataFrame:
    """`keyed` with _salt: blocks with more than a share of 1 in HEAVY of all rows, fewer than HEAVY, are dealt over several."""
    most = max(1, rows // HEAVY)
    heavy = keyed.groupBy("_old", "_block").agg(F.count("*").alias("n")).where(F.col("n") > most)
    parts = heavy.select("_old", "_block", F.ceil(F.col("n") / most).alias("_parts"))
    return keyed.join(F.broadcast(parts), ["_old", "_block"], "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_n"), "_parts"), F.lit(0)).cast("int")).drop("_parts")


def plan(keyed: DataFrame, shards: int, capacities: list[int] | None = None) -> tuple[DataFrame, dict]:
    """(_old, _block, _salt, _shard, _first) per part of a block, and what moves: {"moved_bytes": ..., "affected": [...]}."""
    # at most (blocks + parts of giants) rows a shard, and 2 x HEAVY for salted blocks
    rows = keyed.groupBy("_old", "_block", "_salt").agg(F.sum("_size").alias("s"), F.count("*").alias("n")).orderBy("_old", "_block", "_salt").collect()
    blocks: list[Block] = []
    for r in rows:
        if blocks and (blocks[-1].shard, blocks[-1].block) == (r._old, r._block):
            blocks[-1].size += r.s
            blocks[-1].rows += r.n
        else:
            blocks.append(Block(r._old, r._block, r.s, r.n))
    total = sum(b.size for b in blocks)
    to = assign(blocks, capacities or capacities_of(total, shards)) if blocks else []
    home = {(b.shard, b.block): j for b, j in zip(blocks, to, strict=True)}
    first, out = [0] * shards, []
    for r in rows:
        j = home[r._old, r._block]
        out.append((r._old, r._block, r._salt, j, first[j]))
        first[j] += r.n
    moved = [(b, j) for b, j in zip(blocks, to, strict=True) if b.shard != j]
    report = {"moved_bytes": sum(b.size for b, _ in moved), "affected": sorted({x for b, j in moved for x in (b.shard, j)})}
    spark = keyed.sparkSession
    return spark.createDataFrame(out, "_old int, _block int, _salt int, _shard int, _first long"), report


def shard(docs: DataFrame, shards: int = SHARDS, old: Column | None = None, blocks: int = BLOCKS) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `bytes`: shard sizes are as near equal as whole groups of equal text allow; slots count from 0 in
    each shard. A null text has size 1, as an empty one has, is a group apart from it, and its CRC is that
    of no bytes. Repeated rows get slots of their own, and are dealt out as others are where their group outgrows a
    shard; doc_id may be null or the same for all; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    base = docs.select("doc_id", "text", *([old.alias("_given")] if old is not None else []))
    keyed = _keyed(base, F.col("_given") if old is not None else None, shards, blocks)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    # each row's number is written with it, so that rows that repeat in all columns are told apart alike ever after
    slim = scratch.write(keyed.select("doc_id", "_h", "_old", "_block", "_size", crc, F.monotonically_increasing_id().alias("_n")), "rows")
    total = slim.agg(F.sum("_size")).first()[0] or 0
    slim = _salted(_split_giants(slim, total, shards, blocks), slim.count())
    table, _ = plan(slim, shards)
    nth = F.expr("row_number() over (partition by _old, _block, _salt order by doc_id, _h, _n)") - 1
    placed = slim.withColumn("_nth", nth).join(F.broadcast(table), ["_old", "_block", "_salt"])  # the table is bounded, see plan
    return placed.select(
        "doc_id",
        F.col("_size").alias("size"),
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("_first") + F.col("_nth")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def reshard_files(spark: SparkSession, source: str, target: str, shards: int = SHARDS, blocks: int = BLOCKS) -> dict:
    """Writes `source` (folders shard=0, shard=1, ... of doc_id, text and any other columns) to `target` with equal shards; returns the report.

    Only shards that give or take rows have their rows placed anew. Those that neither give nor take, listed
    under "kept", are copied as they are, so that `target` is whole. `target` is another folder than `source`.
    Columns pass through, whatever their names; a null text has size 1; an empty source gives an empty target. Rows
    whose shard is null come from a shard that goes: all of them are placed.
    """
    docs = spark.read.parquet(source)
    none = max(shards, (docs.agg(F.max("shard")).first()[0] or 0) + 1)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    number = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_n")  # a row's place, whatever is read with it
    keyed = _keyed(docs.select(row, F.col("doc_id"), F.col("text"), F.coalesce(F.col("shard"), F.lit(none)).alias("_given"), number), F.col("_given"), shards, blocks)
    total = keyed.agg(F.sum("_size")).first()[0] or 0
    keyed = _split_giants(keyed, total, shards, blocks).withColumn("_salt", F.lit(0))
    table, report = plan(keyed, shards)
    kept = [s for s in range(shards) if s not in report["affected"]]
    columns = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != "shard"]
    moved = keyed.where(F.col("_given").isin(report["affected"])).join(F.broadcast(table), ["_old", "_block", "_salt"])
    moved.select(*columns, F.col("_shard").alias("shard")).write.mode("overwrite").partitionBy("shard").parquet(target)
    docs.where(F.col("shard").isin(kept)).select(*[F.col(f"`{c}`") for c in docs.columns]).write.mode("append").partitionBy("shard").parquet(target)
    return report | {"kept": kept}
