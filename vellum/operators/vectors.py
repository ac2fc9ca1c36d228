"""Cosine similarity of embeddings: means in closed form, and nearest by blocks of queries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
#: Queries, and rows of the table, that meet in one task.
QUERY_BLOCK = 20_000
TABLE_PART = 200_000
#: Queries of a block that meet a batch of rows at a time.
TOGETHER = 256


def unit(v: Column) -> Column:
    """The vector in double precision at length one; null for a zero vector."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm))


def mean_similarity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per pair of key values: the mean cosine similarity of all pairs, by the dot product of mean unit vectors.

    No pair is formed: the mean of dot products is the dot product of the means.
    """

    def means(t: DataFrame, side: str) -> DataFrame:
        flat = t.select(c(key).alias(side), F.posexplode(unit(c("embedding"))).alias("i", "x"))
        return flat.groupBy(side, "i").agg(F.avg("x").alias(f"m_{side}"))

    both = means(left, "left_key").join(means(right, "right_key"), "i")
    return both.groupBy("left_key", "right_key").agg(F.round(F.sum(c("m_left_key") * c("m_right_key")), 6).alias("mean_similarity"))


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows with an id and a finite vector that isn't zero."""
    v = vectors.select(c("vec_id").cast("long").alias("vec_id"), c("embedding").cast("array<double>").alias("v"))
    return v.where("vec_id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)")


def _best(who: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, id, similarity), the k most similar distinct ids of each query, ties to the smaller id; an id counts at its nearest."""
    order = np.lexsort((-sims, ids, who))
    who, ids, sims = who[order], ids[order], sims[order]
    once = np.concatenate([[True], (who[1:] != who[:-1]) | (ids[1:] != ids[:-1])]) if len(who) else np.zeros(0, bool)
    who, ids, sims = who[once], ids[once], sims[once]
    order = np.lexsort((ids, -sims, who))
    who, ids, sims = who[order], ids[order], sims[order]
    start = np.searchsorted(who, who)  # the first place of each query
    kept = np.arange(len(who)) - start < k
    return who[kept], ids[kept], sims[kept]


def _near(own: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_best` of some queries (numbered from `first`) against some rows: what is beyond the k-th most similar distinct id isn't sorted."""
    names, at = np.unique(ids, return_inverse=True)
    sims = np.round(q @ x.T, 12)
    if len(names) < len(ids):
        order = np.argsort(at, kind="stable")
        sims = np.maximum.reduceat(sims[:, order], np.searchsorted(at[order], np.arange(len(names))), axis=1)
    else:
        sims = sims[:, np.argsort(ids)]
    sims[own[:, None] == names[None, :]] = -np.inf
    least = np.partition(sims, -k, axis=1)[:, -k] if len(names) > k else np.full(len(q), -np.inf)
    who, which = np.nonzero((sims >= least[:, None]) & np.isfinite(sims))
    return _best(who + first, names[which], sims[who, which], k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = QUERY_BLOCK, part: int = TABLE_PART) -> DataFrame:
    """(query_id, rank, vec_id, similarity): the k most similar rows but the query's own, ties to the smaller id.

    Blocks of queries meet parts of the table in tasks, each of which hands on k rows a query; nothing is
    collected. Similarities that agree to 12 places are ties. Vectors null, zero or with null or non-finite
    components take no part; vectors of different lengths aren't compared; an id that repeats is one neighbour, at
    its nearest, and one that repeats among the queries asks once for each vector.
    """
    rows, asked = _usable(vectors), _usable(queries)
    n, m = rows.count(), asked.count()
    blocks, parts = max(1, -(-m // block)), max(1, -(-n // part))
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    own = lambda many: F.pmod(F.xxhash64("vec_id"), F.lit(many)).cast("int")
    left = asked.select(own(blocks).alias("block"), every(parts).alias("part"), F.size("v").alias("dim"), F.lit(0).alias("kind"), "vec_id", "v")
    right = rows.select(every(blocks).alias("block"), own(parts).alias("part"), F.size("v").alias("dim"), F.lit(1).alias("kind"), "vec_id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, here, best = None, [], None, None

        def answers() -> pa.RecordBatch:
            who, ids, sims = best
            return pa.RecordBatch.from_arrays([pa.array(here[0][who]), pa.array(ids), pa.array(sims)], names=["query_id", "vec_id", "similarity"])

        for b in batches:
            keys = np.stack([b[x].to_numpy() for x in ("block", "part", "dim", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, z in pairwise(cuts):
                if a == z:
                    continue
                key, kind = tuple(keys[a, :3].tolist()), keys[a, 3]
                if key != now:
                    if best is not None:
                        yield answers()
                    now, held, here, best = key, [], None, None
                piece = b.slice(a, z - a)
                ids = piece["vec_id"].to_numpy()
                x = piece["v"].flatten().to_numpy().reshape(len(ids), -1)
                x = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                if kind == 0:
                    held.append((ids, x))
                elif held:
                    if here is None:
                        here = tuple(np.concatenate(y) for y in zip(*held, strict=True))
                    found = [_near(here[0][q : q + TOGETHER], here[1][q : q + TOGETHER], ids, x, k, q) for q in range(0, len(here[0]), TOGETHER)]
                    best = _best(*(np.concatenate(y) for y in zip(*found, *([best] if best else []), strict=True)), k)
        if best is not None:
            yield answers()

    met = left.unionByName(right).repartition("block", "part", "dim").sortWithinPartitions("block", "part", "dim", "kind", "vec_id")
    found = met.mapInArrow(search, "query_id long, vec_id long, similarity double").groupBy("query_id", "vec_id").agg(F.max("similarity").alias("similarity"))
    ranked = found.withColumn("rank", F.expr("cast(row_number() over (partition by query_id order by similarity desc, vec_id) as int)"))
    return ranked.where(c("rank") <= k).select("query_id", "rank", "vec_id", F.round("similarity", 6).alias("similarity"))
