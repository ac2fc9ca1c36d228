"""Near duplicates by MinHash over word sets, and filters by quality."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import quality
from vellum.session import shared_dir

c = F.col
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: Classes, and words of theirs, that one task compares with as many others at most, about: larger groups are compared tile by tile.
TILE, WORDS = 4096, 1 << 21
#: Bits of the map of classes that are compared, by which texts are picked: 8 MB, whatever the table.
BITS = 1 << 26

_SEEDS = np.random.default_rng(42).integers(0, 1 << 64, HASHES, np.uint64)
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_NIBBLES = np.uint64(0x1111111111111111)


def _kept(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder, so that what uses it more than once doesn't make it again."""
    folder = f"{shared_dir(df.sparkSession)}/near-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _minima(words: np.ndarray) -> np.ndarray:
    """The least of each hash function over a set's word hashes, a thousand words at a time."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(words), 1024):
        np.minimum(least, _mixed(words[at : at + 1024] ^ _SEEDS[:, None]).min(axis=1), out=least)
    return least


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.reshape(-1).view(np.int64)))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, hashes) to (doc_id, digest, n_words, keys, sketch): a key for each band, four bits of each minimum."""
    for batch in batches:
        hashes = batch.column("hashes")
        values, ends = hashes.values.to_numpy().view(np.uint64), hashes.offsets.to_numpy()
        least = np.array([_minima(values[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)], np.uint64).reshape(-1, HASHES)
        keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(least), BANDS))
        for r in range(ROWS):
            keys = _mixed(keys * _MIX[0] ^ least[:, r::ROWS])
        parts = (least & np.uint64(15)).reshape(-1, HASHES // 16, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
        sketch = np.bitwise_or.reduce(parts, axis=2)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(ends).astype(np.int64)), _lists(np.ascontiguousarray(keys)), _lists(sketch)], ["doc_id", "digest", "n_words", "keys", "sketch"])


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """The rows of each group, which stand together."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        if rest and any(rest[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.concat_batches(rest)
            rest = []
        for x, y in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            rest.append(batch.slice(x, y - x))
            if y < batch.num_rows:
                yield pa.concat_batches(rest) if len(rest) > 1 else rest[0]
                rest = []
    if rest:
        yield pa.concat_batches(rest)


def _table(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)


class _Likely:
    """Which rows may be that similar to one, by sizes of sets and by minima that agree."""

    def __init__(self, n_words: np.ndarray, sketch: np.ndarray, least: float):
        self.n_words, self.sketch, self.least, self.differ = n_words, sketch, least, HASHES - HASHES * least * 0.625

    def of(self, row: int, others: np.ndarray) -> np.ndarray:
        n = self.n_words[others]
        others = others[np.minimum(n, self.n_words[row]) >= np.maximum(n, self.n_words[row]) * self.least]
        x = self.sketch[others] ^ self.sketch[row]
        x |= x >> np.uint64(2)
        x = (x | (x >> np.uint64(1))) & _NIBBLES
        return others[np.bitwise_count(x).sum(axis=1) <= self.differ]


def _stars(least: float):
    """(class_id, to): spanning stars of the likely pairs of each tile, centred at the smallest class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for group in _groups(batches, "key", "lo", "hi"):
            ids = group.column("class_id").to_numpy()
            likely, rest = _Likely(group.column("n_words").to_numpy(), _table(group, "sketch"), least), np.argsort(ids)
            while len(rest) > 1:
                start, rest = rest[0], rest[1:]
                todo = [start]
                while todo and len(rest):
                    near = likely.of(todo.pop(), rest)
                    if len(near):
                        found.append((ids[near], np.full(len(near), ids[start])))
                        rest = rest[~np.isin(rest, near, assume_unique=True)]
                        todo += near.tolist()
            if len(found) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["class_id", "to"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["class_id", "to"])

    return run


def _counted(least: float):
    """(class_id, n, to): of each tile's classes, the documents of similar classes there and the smallest of these classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "place", "lo", "hi"):
            ids, sizes, parts = (group.column(k).to_numpy() for k in ("class_id", "size", "part"))
            n_words = group.column("words").value_lengths().to_numpy().astype(np.int64)
            words, ends = np.unique(group.column("words").flatten().to_numpy(), return_inverse=True)[1], np.concatenate([[0], np.cumsum(n_words)])
            likely, mark = _Likely(n_words, _table(group, "sketch"), least), np.zeros(len(words) + 1, bool)
            n, to = np.zeros(len(ids), np.int64), np.full(len(ids), np.iinfo(np.int64).max)
            across, order = group.column("lo")[0] != group.column("hi")[0], np.argsort(n_words, kind="stable")
            for at, row in enumerate(order):
                # sets of one size after another: those too large come last
                later = order[at + 1 : np.searchsorted(n_words, n_words[row] / least, "right", sorter=order) + 1]
                near = likely.of(row, later[parts[later] != parts[row]] if across else later)
                if not len(near):
                    continue
                mine = words[ends[row] : ends[row + 1]]
                mark[mine] = True
                for some in np.split(near, np.flatnonzero(np.diff(np.cumsum(n_words[near]) >> 18)) + 1):
                    size, first = n_words[some], np.cumsum(n_words[some]) - n_words[some]
                    taken = words[np.repeat(ends[some] - first, size) + np.arange(size.sum())]
                    shared = np.add.reduceat(mark[taken], first, dtype=np.int64)
                    close = some[shared / (size + n_words[row] - shared) >= least]
                    if len(close):
                        n[row] += sizes[close].sum()
                        n[close] += sizes[row]
                        to[row] = min(to[row], ids[close].min())
                        to[close] = np.minimum(to[close], ids[row])
                mark[mine] = False
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (ids, n, to)], ["class_id", "n", "to"])

    return run


def _tiled(rows: DataFrame, tiles: Column) -> DataFrame:
    """`rows` with part, lo and hi: each goes to the tiles of its part and every other, so that any two meet in one (lo, hi)."""
    dealt = rows.withColumn("tiles", tiles.cast("int")).withColumn("part", F.pmod(F.xxhash64("class_id"), c("tiles")).cast("int"))
    return dealt.withColumn("q", F.explode(F.sequence(F.lit(0), c("tiles") - 1))).withColumns({"lo": F.least("part", "q"), "hi": F.greatest("part", "q")}).drop("tiles", "q")


def _places(edges: DataFrame) -> DataFrame:
    """(class_id, place) of the classes in `edges` (class_id, to): place is the smallest class that edges lead to.

    Every node's larger neighbours, then its smaller ones, are hung on the smallest, until nothing changes.
    """
    down = lambda df: df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    now = _kept(down(edges.select(c("class_id").alias("u"), c("to").alias("v"))))
    at = state(now)
    while True:
        both = now.unionByName(now.select(c("v").alias("u"), c("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(c("v").alias("u"), c("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        after = _kept(down(large.join(least, "u").select("v", "m").toDF("u", "v").unionByName(least.toDF("u", "v"))))
        fresh = state(after)
        if fresh == at:
            break
        now, at = after, fresh
    return after.select(c("u").alias("class_id"), c("v").alias("place")).unionByName(after.select(c("v").alias("class_id"), c("v").alias("place")).distinct())


def _picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of `docs` whose doc_id may be a class_id of `ids`, by a map of BITS bits: few texts go on that aren't asked for."""
    at = lambda k: F.pmod(F.xxhash64(k), F.lit(BITS))
    bucket, bit = lambda k: F.shiftright(at(k), 15), lambda k: at(k).bitwiseAND(32767)
    maps = ids.select(bucket("class_id").alias("bucket"), bit("class_id").alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    byte = F.conv(F.hex(F.substring("map", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = docs.withColumns({"bucket": bucket("doc_id"), "bit": bit("doc_id")}).join(F.broadcast(maps), "bucket")
    return known.withColumn("byte", byte).where("(shiftright(byte, cast(bit % 8 as int)) & 1) = 1").drop("bucket", "bit", "map", "byte")


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """Per row of `docs` (doc_id, content): class_id, n_links, nearest_id.

    Texts with the same set of words form a class, named by its smallest doc_id; sets count as equal by SHA-256, words
    by 64 bits. Classes that share a band of minimum hashes are likely pairs if the sizes of their sets allow the
    similarity and half of all their minimum hashes agree (five eighths of `least`;
    of those 0.8 similar, 3 in a million share no band, and less than one in a thousand million agrees in less than half).
    Likely pairs only tell which classes are compared, and are handed on as stars; the sets of each connected group are
    brought together once, in tiles if there are many, and compared exactly where they are counted, so no table holds a
    row for each pair. n_links counts the other documents with that similarity, of the same
    class too, and nearest_id is the smallest of them. Copies are counted, not expanded into pairs.
    A null text has no words, as an empty one; texts without words are one class and link to no other.
    """
    words = F.sort_array(F.array_distinct(F.filter(F.split(F.coalesce("content", F.lit("")), r"\s+"), lambda w: w != "")))
    hashes = lambda w: F.transform(w, lambda x: F.xxhash64(x))
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), "content")
    sets = docs.select("doc_id", words.alias("words")).select("doc_id", F.unhex(F.sha2(F.array_join("words", " "), 256)).alias("digest"), hashes("words").alias("hashes"))
    signed = _kept(sets.mapInArrow(_signed, "doc_id long, digest binary, n_words long, keys array<long>, sketch array<long>"))
    alike = signed.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size"), *[F.first(k).alias(k) for k in ("n_words", "keys", "sketch")])
    classes = _kept(alike)
    some = classes.where("n_words > 0")
    bands = some.select("class_id", F.explode("keys").alias("key")).withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")
    met = _tiled(bands.join(some.select("class_id", "n_words", "sketch"), "class_id"), F.ceil(c("n") / TILE)).select("key", "lo", "hi", "class_id", "n_words", "sketch")
    edges = met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_stars(least), "class_id long, to long")
    placed = _kept(_places(edges).join(some.select("class_id", "size", "n_words", "sketch"), "class_id"))
    tiles = placed.groupBy("place").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n_words") / WORDS)).alias("need"))
    hashed = _picked(docs, placed).select(c("doc_id").alias("class_id"), hashes(words).alias("words"))
    dealt = _tiled(placed.join(tiles, "place").join(hashed, "class_id"), c("need")).drop("need")
    close = dealt.repartition("place", "lo", "hi").sortWithinPartitions("place", "lo", "hi").mapInArrow(_counted(least), "class_id long, n long, to long")
    found = close.groupBy("class_id").agg(F.sum("n").alias("n"), F.min("to").alias("to"))
    named = signed.select("doc_id", "digest").join(classes.select("digest", "class_id", "size"), "digest").join(found, "class_id", "left")
    return named.select("doc_id", "class_id", (c("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.least(F.when(c("doc_id") != c("class_id"), c("class_id")), c("to")).alias("nearest_id"))


def by_quality(docs: DataFrame, least: float = 0.7) -> DataFrame:
    """`docs` with quality_score and kept, by recognition faults, readability, completeness and form."""
    return docs.withColumn("quality_score", F.round(quality.quality_score(c("content")), 6)).withColumn("kept", c("quality_score") >= least)
