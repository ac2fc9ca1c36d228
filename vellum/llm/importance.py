"""Importance resampling towards a target corpus: hashed n-gram features, log-ratio gains, Gumbel top-k.

Features are counted by external sort-count. One pass over the texts writes each block of documents as a
packed stream of 16-bit bucket numbers with the documents' offsets. Streams are then sorted and run-length
encoded into partial counts, which Spark adds up. With the gains of all buckets at hand, the same streams are
read again: gains are gathered by bucket and summed between offsets by np.add.reduceat. Texts are read once.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vellum.llm.common import Scratch, tidy

c = F.col
BUCKETS, GRAMS = 10_000, 3
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
#: Bytes of text read at a time, and features in a block.
PIECE, BLOCK = 1 << 20, 1 << 21
#: Bytes that aren't part of a word become blanks, A-Z becomes a-z.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
STREAM = "doc_ids array<long>, offsets array<long>, words array<long>, stream binary"


def _pieces(text: str) -> Iterator[list[bytes]]:
    """Words of a text, some at a time, so that a very long text isn't held as one list."""
    data = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def buckets(text: str) -> tuple[int, list[np.ndarray]]:
    """(words, buckets of all runs of 1 to 3 words in parts of uint16)."""
    n, last, out = 0, [], []
    for words in _pieces(text):
        if not words:
            continue
        k = len(last)
        joined = last + words
        spaced = [b" " + w for w in joined]
        hashes = list(map(zlib.crc32, joined))
        found = hashes[k:]
        for g in range(1, GRAMS):
            hashes = list(map(zlib.crc32, spaced[g:], hashes))
            # runs that end among words of this piece
            found += hashes[max(0, k - g) :]
        out.append((np.array(found, dtype=np.uint32) % BUCKETS).astype(np.uint16))
        n += len(words)
        last = joined[-(GRAMS - 1) :]
    return n, out


@tidy
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: ids, offsets (one more than ids), words, and the stream of uint16 buckets as bytes."""
    ids: list[int | None] = []
    offsets, words, parts = [0], [], []

    def block() -> pa.RecordBatch:
        stream = np.concatenate(parts).astype("<u2").tobytes() if parts else b""
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([offsets], pa.list_(pa.int64())), pa.array([words], pa.list_(pa.int64())), pa.array([stream], pa.binary())], names=["doc_ids", "offsets", "words", "stream"]
        )

    for b in batches:
        for key, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
            n, found = buckets(text.as_py() or "")
            ids.append(key)
            words.append(n)
            parts += found
            offsets.append(offsets[-1] + sum(map(len, found)))
            if offsets[-1] >= BLOCK or len(ids) >= BLOCK // 64:
                yield block()
                ids, offsets, words, parts = [], [0], [], []
    if ids:
        yield block()


def streams(docs: DataFrame) -> DataFrame:
    """Packed bucket streams of `docs` (doc_id, text), many documents a row."""
    return docs.select(c("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packed, STREAM)


@tidy
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for raw in b["stream"]:
            x = np.sort(np.frombuffer(raw.as_buffer(), dtype="<u2"), kind="stable")
            if len(x):
                start = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
                yield pa.RecordBatch.from_arrays([pa.array(x[start].astype(np.int32)), pa.array(np.diff(np.append(start, len(x))))], names=["bucket", "n"])


def counts(packed: DataFrame) -> np.ndarray:
    """Features by bucket, BUCKETS numbers at most reach the driver."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in packed.select("stream").mapInArrow(_runs, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, the log of the smoothed ratio of its share of the target to that of the source, in thousandths, floored."""
    s_all, t_all = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(float((t + 1) * s_all) / float((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def _noise(key: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(packed: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of the documents of packed streams; score adds Gumbel noise by doc_id."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, offsets, words, raw in zip(b["doc_ids"], b["offsets"], b["words"], b["stream"], strict=True):
                at = offsets.values.to_numpy()
                n = np.diff(at)
                weight = np.zeros(len(n), dtype=np.int64)
                full = np.flatnonzero(n)  # reduceat gives an empty stretch its first element
                if len(full):
                    weight[full] = np.add.reduceat(gain[np.frombuffer(raw.as_buffer(), dtype="<u2")], at[:-1][full])
                keys = ids.as_py()
                noise = np.array([_noise(k, seed) for k in keys], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), words.values, pa.array(n), pa.array(weight), pa.array(weight + noise)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return packed.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def _numbered(rows: DataFrame, draw: int, scratch: Scratch) -> DataFrame:
    """`rows` (fit, columns of a score, copies) with first: the rank of the first copy of those that come before `draw` and some more.

    Rows are dealt over ranges of the order; a range's rows are numbered within it, after those of the ranges before.
    """
    order = [c("fit").desc(), c("score").desc(), c("doc_id").asc_nulls_last(), c("n_features"), c("n_words"), c("weight")]
    dealt = scratch.write(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    before, seen = [], 0
    for r, n in sorted(dealt.groupBy("range").agg(F.sum("copies")).collect()):  # a row for each partition
        if seen < draw:
            before.append((r, seen))
        seen += n
    ahead = F.broadcast(rows.sparkSession.createDataFrame(before, "range int, before long"))
    within = F.sum("copies").over(W.partitionBy("range").orderBy(*order)) - c("copies")
    first = dealt.join(ahead, "range").withColumn("first", c("before") + within + 1).drop("before")
    return first.unionByName(dealt.join(ahead, "range", "left_anti").withColumn("first", F.lit(None).cast("long"))).drop("range")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank per row of `docs` (doc_id, text), towards `target` (text).

    A row's weight is the sum of its features' gains, its score adds noise hashed from `seed` and doc_id. Of the rows
    with `least` words or more, `percent` in a hundred, rounded down, with the highest scores are drawn, ties to the
    smaller doc_id; rank numbers them from 1 and is null for the rest.
    A null text has no features and weight 0; a null doc_id is hashed as empty and comes last in ties; rows that repeat
    are drawn each; an empty table gives no rows, an empty target has no features; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    packed = scratch.write(streams(docs), "streams")
    gain = gains(counts(packed), counts(streams(target.select(F.lit(0).alias("doc_id"), "text"))))
    scored = scratch.write(weigh(packed, gain, seed), "scored")
    scratch.drop("streams")
    marked = scored.withColumn("fit", c("n_words") >= least)
    draw = marked.where("fit").count() * percent // 100
    # equal rows are numbered as one and dealt out again, so that no repeated row crowds a range
    held = marked.groupBy(*marked.columns).agg(F.count("*").alias("copies"))
    each = _numbered(held, draw, scratch).select("*", F.explode(F.transform(F.sequence(F.lit(0), c("copies") - 1), lambda i: c("first") + i)).alias("_rank"))
    return each.select(*scored.columns, F.when(c("_rank") <= draw, c("_rank")).alias("rank"))
