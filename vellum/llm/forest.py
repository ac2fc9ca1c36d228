"""Nearest neighbours by a forest of random-projection trees with one priority queue.

A node of a tree projects a vector, less the node's centre, onto a few random orthogonal directions; the vector
goes down the branch of the direction, and side of it, along which it lies farthest. Directions are drawn for
each tree and level; centres come from a bounded sample, and a node without sample vectors enough takes over
its parent's. Trees get as many leaves as the table's size asks for, about SPREAD times its square root, so that
leaves stay small beside the table and yet a query needs no more of them as it grows.

Every vector of the table is indexed: it has one leaf in each tree. A query walks all trees together: a shared
priority queue holds the branches not taken, keyed by the log-probability that a near vector went there (a
softmax of the query's projections, whose sharpness is fitted on near pairs of the sample), and gives up
leaves, likeliest first, until they hold enough vectors. How many are enough is measured: ASKED vectors of the
sample, kept out of the fit of the forest where the table is larger than the sample, are compared with the whole table
in one pass, and a walk tells how much its leaves hold when it reaches each of their true neighbours; enough is
what reaches a share RECALL of these, and BREADTH times the square root of the table at least. So recall
doesn't fall as the table grows. Leaves and the queries that ask for them meet in
sorted partitions, crowded leaves dealt over several, where candidates are compared exactly, in double
precision and in blocks; each leaf returns its best few per query, never all pairs.

Equal vectors are indexed once, with their smallest ids, of which a query can use no more than k + 1.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import Scratch, tidy

K = 10
QUERY_EVERY = 100
TREES = 16
#: Vectors that centres and sharpness are fitted on at most: those with the smallest hashes. Bounds the forest that tasks get.
SAMPLE = 50_000
#: Leaves of a tree, and vectors that a query's leaves hold together (over all trees, counted with repeats), in square roots of the table.
SPREAD = 16.0
BREADTH = 32.0
#: Vectors whose neighbours are found exactly, to measure recall, and the share of their neighbours that must be reached.
ASKED = 96
RECALL = 0.94
#: Directions of a node at most, and sample vectors that a node needs for a centre of its own.
DIRECTIONS = 64
OWN = 32
#: Vectors of a leaf that one task compares; a leaf expected to hold more is dealt over several.
CROWD = 8192
SALTS = 64
#: Queries that a task looks up leaves for.
QUERIES = 64
#: Queries whose answers a task holds before it hands them on.
HELD = 100_000


@dataclass
class Level:
    """One level of one tree: directions (dim, k), and by node the row of its centre's projections and spread."""

    directions: np.ndarray
    slot: np.ndarray
    centres: np.ndarray  # (rows, k), projected
    spread: np.ndarray

    def branches(self, projected: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        z = projected - self.centres[self.slot[nodes]]
        at = np.abs(z).argmax(axis=1)
        return at + z.shape[1] * (z[np.arange(len(z)), at] < 0)


@dataclass
class Forest:
    trees: list[list[Level]]
    leaves_a_tree: int
    sharpness: float
    weights: dict[int, float]  # vectors expected in each leaf that has some of the sample
    other: float  # and in any other leaf

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row in each tree."""
        out = np.empty((len(x), len(self.trees)), dtype=np.int64)
        for t, levels in enumerate(self.trees):
            node = np.zeros(len(x), dtype=np.int64)
            for level in levels:
                node = node * 2 * level.directions.shape[1] + level.branches(x @ level.directions, node)
            out[:, t] = t * self.leaves_a_tree + node
        return out

    def _costs(self, level: Level, projected: np.ndarray, node: int) -> np.ndarray:
        """Minus the log-probability of each branch of a node."""
        row = level.slot[node]
        z = self.sharpness / level.spread[row] * (projected - level.centres[row])
        z = np.concatenate([z, -z])
        top = z.max()
        return top + math.log(np.exp(z - top).sum()) - z

    def probes(self, q: np.ndarray, enough: float) -> list[int]:
        """Leaves of all trees, likeliest first, until they hold `enough` vectors."""
        found, held = [], 0.0
        for leaf, n in self.walk(q):
            found.append(leaf)
            held += n
            if held >= enough:
                break
        return found

    def reached(self, q: np.ndarray, neighbours: np.ndarray) -> list[float]:
        """For each row of leaves of a neighbour (rows, trees), what a walk's leaves held when it came to one of them."""
        of_leaf: dict[int, list[int]] = {}
        for i, leaves in enumerate(neighbours.tolist()):
            for leaf in leaves:
                of_leaf.setdefault(leaf, []).append(i)
        out, left, held = [math.inf] * len(neighbours), len(neighbours), 0.0
        for leaf, n in self.walk(q):
            if not left:
                break
            for i in of_leaf.get(leaf, ()):
                if out[i] == math.inf:
                    out[i], left = held, left - 1  # the leaf that has it is looked up while less than enough is held
            held += n
        return out

    def walk(self, q: np.ndarray) -> Iterator[tuple[int, float]]:
        """(leaf, vectors expected in it) of all trees, likeliest first."""
        projected = [[q @ level.directions for level in levels] for levels in self.trees]
        queue: list[tuple] = []
        count = 0

        def open_(t: int, depth: int, node: int, base: float) -> None:
            nonlocal count
            if depth == len(self.trees[t]):
                return
            costs = self._costs(self.trees[t][depth], projected[t][depth], node)
            order = np.argsort(costs, kind="stable")
            count += 1
            heapq.heappush(queue, (base + costs[order[0]], count, t, depth, node, 0, base, costs, order))

        for t in range(len(self.trees)):
            open_(t, 0, 0, 0.0)
        if not (self.trees and self.trees[0]):  # trees of one leaf: all of them, which together hold enough
            yield from ((t * self.leaves_a_tree, 0.0) for t in range(len(self.trees)))
        while queue:
            cost, _, t, depth, node, nth, base, costs, order = heapq.heappop(queue)
            if nth + 1 < len(order):
                count += 1
                heapq.heappush(queue, (base + costs[order[nth + 1]], count, t, depth, node, nth + 1, base, costs, order))
            child = node * len(order) + int(order[nth])
            if depth + 1 < len(self.trees[t]):
                open_(t, depth + 1, child, cost)
            elif (n := self.weights.get(t * self.leaves_a_tree + child, self.other)) > 0:
                yield t * self.leaves_a_tree + child, n

    def tasks(self, leaf: int) -> int:
        return math.ceil(max(self.weights.get(leaf, 0.0), 1.0) / CROWD)


def grow(sample: np.ndarray, total: int, trees: int, spread: float = SPREAD, seed: int = 0) -> Forest:
    """A forest for `total` vectors, of which `sample` are given."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] if sample.ndim == 2 and len(sample) else 1
    wanted, widths = spread * math.sqrt(total), []
    while wanted >= 1.5 and len(sample) > 1:
        widths.append(min(dim, DIRECTIONS, math.ceil(wanted / 2)))
        wanted /= 2 * widths[-1]
    made = []
    for _ in range(trees):
        levels, node = [], np.zeros(len(sample), dtype=np.int64)
        slot, centres = np.zeros(1, dtype=np.int64), np.zeros((1, dim))
        for k in widths:
            directions = np.linalg.qr(rng.standard_normal((dim, k)))[0]
            many = np.bincount(node, minlength=len(slot))
            own = np.flatnonzero(many >= min(OWN, len(sample)))
            sums = np.zeros((len(own), dim))
            place = np.full(len(slot), -1, dtype=np.int64)
            place[own] = np.arange(len(own))
            inside = np.flatnonzero(place[node] >= 0)
            np.add.at(sums, place[node[inside]], sample[inside])
            centres = np.concatenate([centres, sums / many[own, None]])
            slot = np.where(place >= 0, len(centres) - len(own) + place, slot)
            row = slot[node]
            projected = sample @ directions
            flat = centres @ directions
            off = ((projected - flat[row]) ** 2).mean(axis=1)
            whole = math.sqrt(max(off.mean(), 1e-300))
            seen = np.bincount(row, minlength=len(centres))
            wide = np.where(seen >= OWN, np.sqrt(np.bincount(row, off, minlength=len(centres)) / np.maximum(seen, 1)), whole)
            levels.append(Level(directions, slot, flat, np.maximum(wide, 1e-9 * whole)))
            node = node * 2 * k + levels[-1].branches(projected, node)
            slot = np.repeat(slot, 2 * k)
        made.append(levels)
    forest = Forest(made, int(np.prod([2 * k for k in widths], dtype=np.int64)), 1.0, {}, 0.0)
    leaf, many = np.unique(forest.leaves(sample), return_counts=True)
    each = total / max(len(sample), 1)
    forest.weights = dict(zip(leaf.tolist(), (many * each).tolist(), strict=True))
    forest.other = each / 2 if each > 1 else 0.0
    forest.sharpness = _sharpness(forest, sample)
    return forest


def _sharpness(forest: Forest, sample: np.ndarray, queries: int = 64, near: int = 10) -> float:
    """That under which the branches of the sample's near vectors are likeliest, given those near them."""
    if len(sample) < 2 or not forest.trees or not forest.trees[0]:
        return 1.0
    asked = np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int)
    square = np.einsum("ij,ij->i", sample, sample)
    pairs = []
    for i in asked:
        d = square - 2 * sample @ sample[i]
        d[i] = np.inf
        pairs += [(i, j) for j in np.argsort(d, kind="stable")[: min(near, len(sample) - 1)]]
    q, x = sample[[i for i, _ in pairs]], sample[[j for _, j in pairs]]
    seen = []
    for levels in forest.trees[:4]:
        node = np.zeros(len(q), dtype=np.int64)
        for level in levels:
            row = level.slot[node]
            z = (q @ level.directions - level.centres[row]) / level.spread[row, None]
            took = level.branches(x @ level.directions, node)
            seen.append((np.concatenate([z, -z], axis=1), took))
            node = node * 2 * level.directions.shape[1] + took
    best = (-math.inf, 1.0)
    for b in np.geomspace(0.25, 16, 25):
        likely = sum(float((b * z[np.arange(len(took)), took] - np.log(np.exp(b * (z - z.max(axis=1, keepdims=True))).sum(axis=1)) - b * z.max(axis=1)).sum()) for z, took in seen)
        best = max(best, (likely, float(b)))
    return best[1]


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: with an id, and finite, not zero, without nulls."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return v.where("vec_id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)")


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(key, v, ids): each distinct vector with its k + 1 smallest ids, the first of which is its key.

    Copies are cut to k + 1 in each of a number of salted groups beforehand: a vector that fills a third
    of the table is dealt over many tasks, and what is cut can be in no answer.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    few = salted.withColumn("n", F.expr("row_number() over (partition by v, salt order by vec_id)")).where(f"n <= {k + 1}")
    cut = few.withColumn("n", F.expr("row_number() over (partition by v order by vec_id)")).where(f"n <= {k + 1}")
    return cut.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("key"), "v", "ids")


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


class _Best:
    """The best answers of the queries of one task: per query the `most` smallest (distance, id)."""

    def __init__(self, most: int):
        self.most, self.held = most, {}

    def add(self, query: str, d: np.ndarray, ids: np.ndarray) -> None:
        if (old := self.held.get(query)) is not None:
            d, ids = np.concatenate([old[0], d]), np.concatenate([old[1], ids])
        order = np.lexsort((ids, d))
        first = np.sort(np.unique(ids[order], return_index=True)[1])[: self.most]  # a candidate may come from several trees
        self.held[query] = (d[order[first]], ids[order[first]])

    def worst(self, query: str) -> float:
        old = self.held.get(query)
        return old[0][-1] if old is not None and len(old[0]) == self.most else np.inf

    def rows(self) -> pa.RecordBatch:
        keys = [q for q, (d, _) in self.held.items() for _ in range(len(d))]
        d, ids = (np.concatenate([x[i] for x in self.held.values()] or [np.empty(0)]) for i in (0, 1))
        self.held = {}
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids.astype(np.int64)), pa.array(d.astype(np.float64))], names=["key", "vec_id", "score"])


def _nearest(classes: DataFrame, forest: Forest, asked: np.ndarray, k: int) -> list[tuple[int, np.ndarray]]:
    """(row of `asked`, leaves of its k nearest vectors of the whole table but itself), compared exactly in one pass."""
    square = np.einsum("ij,ij->i", asked, asked)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, x = np.empty((len(asked), 0)), np.empty((0, asked.shape[1]))
        for b in batches:
            there = _matrix(b["v"]).reshape(-1, asked.shape[1])
            for at in range(0, len(there), CROWD):
                part = there[at : at + CROWD]
                far = square[:, None] - 2 * asked @ part.T + np.einsum("ij,ij->i", part, part)
                far[(asked[:, None, 0] == part[None, :, 0]) & (far <= 1e-9 * square[:, None])] = np.inf  # itself
                d, x = np.concatenate([d, far], axis=1), np.concatenate([x, part])
                best = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
                keep = np.unique(best)
                d, x = d[:, keep], x[keep]
        if d.shape[1]:
            best = np.argsort(d, axis=1, kind="stable")[:, :k]
            q, at = np.repeat(np.arange(len(asked)), best.shape[1]), best.ravel()
            real = np.isfinite(d[q, at])
            q, at = q[real], at[real]
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(d[q, at]), pa.array(list(forest.leaves(x[at])), pa.list_(pa.int64()))], names=["q", "d", "leaves"])

    found = classes.select("v").mapInArrow(run, "q long, d double, leaves array<long>")
    got = found.withColumn("n", F.expr("row_number() over (partition by q order by d, leaves)")).where(f"n <= {k}").collect()  # ASKED * k rows
    of_query: dict[int, list] = {}
    for row in got:
        of_query.setdefault(row.q, []).append(row.leaves)
    return [(q, np.array(leaves, dtype=np.int64)) for q, leaves in sorted(of_query.items())]


def measured_breadth(classes: DataFrame, forest: Forest, asked: np.ndarray, k: int = K, recall: float = RECALL) -> float:
    """How many vectors a query's leaves must hold to reach a share `recall` of the true neighbours of `asked`."""
    near = _nearest(classes, forest, asked, k) if len(asked) else []
    if not near:
        return 0.0
    spark = classes.sparkSession
    rows = [(asked[q].tolist(), leaves.tolist()) for q, leaves in near]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [h for q, leaves in zip(_matrix(b["v"]), b["leaves"].to_pylist(), strict=True) for h in forest.reached(q, np.array(leaves, dtype=np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.float64())], names=["held"])

    walks = spark.createDataFrame(rows, "v array<double>, leaves array<array<long>>").repartition(len(rows)).mapInArrow(run, "held double")
    held = sorted(r.held for r in walks.collect())  # ASKED * k numbers
    finite = [h for h in held if h < math.inf]
    return float(np.nextafter(finite[min(math.ceil(recall * len(held)), len(finite)) - 1], np.inf)) if finite else 0.0


def search(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, trees: int = TREES, sample: int = SAMPLE, spread: float = SPREAD, breadth: float | None = None, seed: int = 0) -> DataFrame:
    """Nearest found of `vectors` (vec_id, embedding) for each row whose vec_id is divisible by `every`.

    Returns query_id, rank (from 1), vec_id, score: the k rows, but for the query's own, with the smallest
    Euclidean distances, nearest first, ties to the smaller vec_id; fewer where there are no more. Vectors
    null, zero or with null or non-finite components take no part, nor those of another length than most of
    the sample has. Ids that repeat with equal vectors count once; an id that repeats with different vectors
    names them all, so its query asks from each of them, and a neighbour or query counts at its nearest. An
    empty table, or one without queries, gives no rows; other columns are ignored. A query's leaves hold `breadth`
    times the square root of the table together; without it, as much as measuring asks for.
    """
    scratch = Scratch(vectors.sparkSession, "forest")
    rows = valid(vectors).distinct()
    classes = scratch.write(classes_of(rows, k), "classes")
    taken = classes.select("v").orderBy(F.xxhash64("key", "v")).limit(sample).toArrow()["v"].combine_chunks()  # the bounded sample
    widths = np.array([len(x) for x in taken], dtype=np.int64)
    dim = int(np.bincount(widths).argmax()) if len(widths) else 1
    points = np.array([x.as_py() for x, w in zip(taken, widths, strict=True) if w == dim], dtype=np.float64).reshape(-1, dim)
    classes = classes.where(F.size("v") == dim)
    total = classes.count()
    asked = points[:ASKED]
    forest = grow(points[len(asked) :] if total > sample else points, total, trees, spread, seed)
    # in a table of no more than 2 k vectors all are compared
    enough = max((breadth or BREADTH) * math.sqrt(total), 2.0 * k * trees)
    if breadth is None and total > 2 * k:
        enough = max(enough, measured_breadth(classes, forest, asked, k))
    asking = rows.where(f"vec_id % {every} = 0 and size(v) = {dim}").select(F.col("vec_id").alias("query_id"), "v")
    asking = scratch.write(asking.withColumn("key", F.md5(F.array_join(F.col("v").cast("array<string>"), ",").cast("binary"))), "asking")
    queries = asking.dropDuplicates(["key"]).select("key", "v")
    queries = queries.repartition(max(1, queries.count() // QUERIES))  # few rows, but long work for each
    kind = vectors.schema["embedding"].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)  # as doubles they'd be twice as long on the way
    held = pa.float32() if narrow else pa.float64()

    @tidy
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = forest.leaves(_matrix(b["v"]).reshape(-1, dim))
            own, v, none = b["key"].to_numpy(), b["v"].cast(pa.list_(held)), pa.nulls(len(b), pa.string())
            for t in range(leaves.shape[1]):
                tasks = np.array([forest.tasks(x) for x in leaves[:, t].tolist()], dtype=np.int64)
                salt = pa.array(((own % tasks) + tasks) % tasks)
                yield pa.RecordBatch.from_arrays([pa.array(leaves[:, t]), salt, pa.array(np.ones(len(leaves), np.int32)), none, v, b["ids"]], names=["leaf", "salt", "kind", "key", "v", "ids"])

    @tidy
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 64):
                part = b.slice(at, 64)
                found = [(i, x, s) for i, q in enumerate(_matrix(part["v"]).reshape(-1, dim)) for x in forest.probes(q, enough) for s in range(forest.tasks(x))]
                if not found:
                    continue
                who, leaf, salt = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
                n, whose = len(who), pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), pa.array(salt), pa.array(np.zeros(n, np.int32)), part["key"].take(whose), part["v"].cast(pa.list_(held)).take(whose), pa.nulls(n, pa.list_(pa.int64()))],
                    names=["leaf", "salt", "kind", "key", "v", "ids"],
                )

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, leaf_now, keys, points_ = _Best(k + 1), None, [], []
        for b in batches:
            leaves, salts, kinds = (b[x].to_numpy() for x in ("leaf", "salt", "kind"))
            cuts = [0, *(np.flatnonzero((leaves[1:] != leaves[:-1]) | (salts[1:] != salts[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(leaves)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a == z:
                    continue
                if (leaves[a], salts[a]) != leaf_now:
                    leaf_now, keys, points_ = (leaves[a], salts[a]), [], []
                part = b.slice(a, z - a)
                if kinds[a] == 0:
                    keys += part["key"].to_pylist()
                    points_ += list(_matrix(part["v"]))
                    continue
                if not keys:
                    continue
                there, ids = _matrix(part["v"]), part["ids"]
                many = np.diff(ids.offsets.to_numpy())
                flat = ids.flatten().to_numpy()
                starts = np.cumsum(many) - many
                for key, q in zip(keys, points_, strict=True):
                    off = there - q
                    d = np.sqrt(np.einsum("ij,ij->i", off, off))
                    near = np.flatnonzero(d <= best.worst(key))
                    if len(near) > k + 1:
                        near = near[d[near] <= np.partition(d[near], k)[k]]
                    if len(near):
                        n = many[near]
                        pick = np.repeat(starts[near] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                        best.add(key, np.repeat(d[near], n), flat[pick])
            if len(best.held) > HELD:
                yield best.rows()
        yield best.rows()

    schema = f"leaf long, salt long, kind int, key string, v array<{'float' if narrow else 'double'}>, ids array<long>"
    both = classes.select("key", "v", "ids").mapInArrow(index, schema).unionByName(queries.mapInArrow(ask, schema))
    found = both.repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", "kind").mapInArrow(meet, "key string, vec_id long, score double").groupBy("key", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("n", F.expr("row_number() over (partition by key order by score, vec_id)")).where(f"n <= {k + 1}").drop("n")
    mine = asking.select("query_id", "key").distinct().join(ranked, "key").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.expr("cast(row_number() over (partition by query_id order by score, vec_id) as int)")
    return mine.select("query_id", rank.alias("rank"), "vec_id", "score").where(f"rank <= {k}")
