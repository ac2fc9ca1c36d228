"""SimHash near-duplicates with bit-sliced comparison.

Each text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints that differ in at most
three bits are linked. By the pigeonhole principle such a pair agrees on one of four 16-bit blocks, so
fingerprints meet in the groups of equal (block number, block value). Groups are sorted and packed whole
into tiles; in a tile the fingerprints are stored as bit planes (plane b holds bit b of 64 fingerprints
per machine word), and the distances of one fingerprint to all others are counted together by carry-save
adders, plane after plane; a fingerprint is abandoned once all its distances exceed the radius.

A tile emits a spanning forest of its links, never all pairs, so rows grow with fingerprints and not with
the square of a group. Groups beyond HOT fingerprints are told apart beforehand by four 12-bit blocks of
the other 48 bits (a second pigeonhole, exact), and large groups within a task by further ones. There are
at most 4 x 65536 groups, which bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, components, tidy

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 512
HOT = 200_000
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: bit b is 1 if it is set in over half of the shingles' XXH64."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), len(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    last = ends[min(shingle, size) - 1 :]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, last)], dtype="<u8")  # noqa: B905
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""

    @tidy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch["text"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


# ---- comparison of a tile


def near(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Square boolean matrix: which of the given fingerprints (uint64) differ in at most `radius` bits."""
    m = len(fps)
    lanes = -(-m // 64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")  # m x 64
    padded = np.zeros((64, lanes * 64), dtype=np.uint8)
    padded[:, :m] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)  # 64 x lanes
    flip = (0 - bits.astype(np.uint64)).T.copy()  # all ones where the query's bit is 1
    depth = max(1, radius.bit_length())
    limit = (1 << depth) - 1  # counters hold up to this; one more raises `over`
    rows = np.arange(m)
    counters = [np.zeros((m, lanes), dtype=np.uint64) for _ in range(depth)]
    over = np.zeros((m, lanes), dtype=np.uint64)
    # counters start so that they overflow exactly when the distance exceeds the radius
    for k in range(depth):
        if (limit - radius) >> k & 1:
            counters[k][:] = ~np.uint64(0)
    full = np.packbits(np.arange(lanes * 64) < m, bitorder="little").view(np.uint64)
    for b in range(64):
        carry = planes[b] ^ flip[b][rows][:, None]
        for c in counters:
            held = c & carry
            c ^= carry
            carry = held
        over |= carry
        if b % 8 == 7 and b >= 15 and b < 63:
            self_lane = over | ~full
            # a fingerprint is within the radius of itself; it stays only if another one may be
            left = np.bitwise_count(~self_lane).sum(axis=1) > 1
            if not left.all():
                rows, over = rows[left], over[left]
                counters = [c[left] for c in counters]
                if not len(rows):
                    break
    out = np.zeros((m, m), dtype=bool)
    if len(rows):
        hits = np.unpackbits((~over & full).view(np.uint8), axis=1, bitorder="little")[:, :m]
        out[rows] = hits.astype(bool)
    np.fill_diagonal(out, False)
    return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (node, centre) of the graph given by a symmetric boolean matrix."""
    todo = linked.any(axis=1)
    nodes, centres = [], []
    for start in np.flatnonzero(todo):
        if not todo[start]:
            continue
        todo[start] = False
        frontier = np.array([start])
        while len(frontier):
            frontier = np.flatnonzero(linked[frontier].any(axis=0) & todo)
            todo[frontier] = False
            nodes.append(frontier)
            centres.append(np.full(len(frontier), start))
    if not nodes:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(nodes), np.concatenate(centres)


def _cross(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    both = np.concatenate([a, b])
    n, c = forest(near(both, radius))
    if len(n):
        yield both[n], both[c]


def link_group(fps: np.ndarray, free: list[int], radius: int, tile: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within one group of any size: by pigeonhole on the free bits until groups fit a tile."""
    if len(fps) <= tile:
        n, c = forest(near(fps, radius))
        if len(n):
            yield fps[n], fps[c]
        return
    if len(free) < 4 * (radius + 1):  # nearly all bits are used up: compare tile by tile
        half = tile // 2
        parts = [fps[i : i + half] for i in range(0, len(fps), half)]
        for i, a in enumerate(parts):
            for b in parts[i + 1 :] or [a[:0]]:
                yield from _cross(a, b, radius)
        return
    step = len(free) // (radius + 1)
    for k in range(radius + 1):
        block = free[k * step : (k + 1) * step] if k < radius else free[k * step :]
        value = np.zeros(len(fps), dtype=np.uint64)
        for j, bit in enumerate(block):
            value |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(j)
        order = np.argsort(value, kind="stable")
        taken = set(block)
        rest = [x for x in free if x not in taken]
        yield from link_sorted(fps[order], value[order], lambda _, rest=rest: rest, radius, tile)


def link_sorted(fps: np.ndarray, keys: np.ndarray, free: Callable[[int], list[int]], radius: int, tile: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within groups of equal keys, given sorted; small groups share a tile, as a link found is a link."""
    cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
    sizes = np.diff(cuts)
    pending: list[np.ndarray] = []
    held = 0
    for i in np.flatnonzero(sizes > 1):
        part = fps[cuts[i] : cuts[i + 1]]
        if len(part) > tile:
            yield from link_group(part, free(int(keys[cuts[i]])), radius, tile)
            continue
        if held + len(part) > tile:
            yield from link_group(np.concatenate(pending), [], radius, tile)
            pending, held = [], 0
        pending.append(part)
        held += len(part)
    if pending:
        yield from link_group(np.concatenate(pending), [], radius, tile)


# ---- candidates


def _first_blocks(classes: DataFrame) -> DataFrame:
    """(fp, block, rest) for the four 16-bit blocks; rest holds the other 48 bits."""
    parts = []
    for t in range(4):
        high = f"shiftleft(shiftrightunsigned(fp, {16 * (t + 1)}), {16 * t})" if t < 3 else "0L"
        low = f"fp & {(1 << 16 * t) - 1}L" if t else "0L"
        parts.append(f"named_struct('block', cast({t * 65536} + (shiftrightunsigned(fp, {16 * t}) & 65535L) as int), 'rest', ({high}) | ({low}))")
    return classes.select("fp", F.explode(F.expr(f"array({', '.join(parts)})")).alias("x")).select("fp", "x.block", "x.rest")


def _grouped(classes: DataFrame, hot: int) -> DataFrame:
    """(gid, fp): gid numbers the group of fp in each block, of hot blocks by a 12-bit block of the rest too."""
    rows = _first_blocks(classes)
    sizes = rows.groupBy("block").count().where(F.col("count") > hot).select("block", F.lit(True).alias("is_hot"))
    marked = rows.join(F.broadcast(sizes), "block", "left")  # at most 4 x 65536 rows
    split = marked.withColumn("sub", F.explode(F.expr("if(is_hot, array(0, 1, 2, 3), array(-1))")))
    value = "if(sub < 0, 0L, shiftrightunsigned(rest, 12 * greatest(sub, 0)) & 4095L)"
    return split.select(F.expr(f"(cast(block as long) * 5 + sub + 1) * 4096 + {value}").alias("gid"), "fp")


def _free_bits(gid: int) -> list[int]:
    sub, block = gid // 4096 % 5 - 1, gid // 4096 // 5
    t = block // 65536
    rest = [b for b in range(64) if not 16 * t <= b < 16 * (t + 1)]
    return rest if sub < 0 else rest[: 12 * sub] + rest[12 * (sub + 1) :]


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE, hot: int = HOT) -> DataFrame:
    """Edges (u, v) whose components are those of all links between the distinct fingerprints `classes.fp`."""
    if radius > 3:
        raise ValueError("four blocks find pairs that differ in three bits at most")

    @tidy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)

        def found(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            for u, v in link_sorted(f, k, _free_bits, radius, tile):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            keys = np.concatenate([keys, batch["gid"].to_numpy()])
            fps = np.concatenate([fps, batch["fp"].to_numpy().view(np.uint64)])
            if len(keys) and keys[-1] != keys[0]:
                whole = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
                yield from found(keys[:whole], fps[:whole])
                keys, fps = keys[whole:].copy(), fps[whole:].copy()
        yield from found(keys, fps)

    dealt = _grouped(classes, hot).repartition("gid").sortWithinPartitions("gid", "fp")
    return dealt.mapInArrow(run, "u long, v long")


def linked_classes(prints: DataFrame, scratch: Scratch, radius: int = RADIUS, tile: int = TILE, hot: int = HOT) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint; component_id is the smallest doc_id of the component."""
    classes = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, radius, tile, hot), scratch)
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE, hot: int = HOT) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, fingerprint, component_id.

    Null and empty texts, and those of white space, have fingerprint zero, which is linked like any other.
    Rows that repeat are repeated; a null doc_id is no component's smallest unless no other is there; an
    empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write(fingerprints(docs, shingle), "prints")
    classes = linked_classes(prints, scratch, radius, tile, hot)
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
