"""One document of each group of near copies: SimHash finds candidates, shingles decide.

Texts whose sets of five-word shingles have a Jaccard similarity of 0.8 differ in about 15 % of a SimHash's
bits, far more than three. So each distinct text gets two fingerprints (two seeds); texts meet in the groups
of equal sampled bits of the first, in as many samples as bring such pairs together with the probability
asked for; and in a group's tiles both fingerprints are compared bit-sliced, as in `simhash`. Of what is
close, each tile hands on stars around leaders, which are no neighbours of each other, and not all pairs.
The similarity of each pair handed on is then computed from the texts themselves, and components are formed
of pairs that have it. Being close is looser than being similar, so a leader may strike off texts that it isn't
similar to, and pairs among those. Hence a second pass over the same groups: texts that are close to one of
another component come with the hashes of their shingles, and in a tile every close pair that no verified link
joins yet is compared on them. What is found is verified as before and joins the components; a tile hands on
no more than a forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm import simhash
from vellum.llm.common import HEAVY, Scratch, components, tidy

SHINGLE = 5
SIMILARITY = 0.8
FOUND = 0.97
TILE = 512
#: Texts that a group of equal sampled bits should hold on average.
GROUP = 64
BITS = (11, 24)


def shingles(text: str | None, k: int = SHINGLE) -> set[bytes]:
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def two_fingerprints(text: str | None, k: int = SHINGLE) -> tuple[int, int]:
    """SimHashes of the distinct shingles under two seeds."""
    parts = list(shingles(text, k))
    if not parts:
        return 0, 0
    h = xxhash.xxh64_intdigest
    out = []
    for seed in (1, 2):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(parts), simhash.COUNTED):
            part = np.array([h(x, seed) for x in parts[at : at + simhash.COUNTED]], dtype="<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0]))
    return out[0], out[1]


def differing(least: float) -> float:
    """Share of bits in which texts of that similarity and of like length differ."""
    return math.acos(2 * least / (1 + least)) / math.pi


def layout(n: int, least: float) -> tuple[int, int, int]:
    """(bits a sample, samples, radius) for n distinct texts."""
    p = differing(least)
    bits = min(max(round(math.log2(max(n, 1) / GROUP + 1)), BITS[0]), BITS[1])
    samples = math.ceil(math.log(1 - FOUND) / math.log(1 - (1 - p) ** bits))
    return bits, samples, math.ceil(64 * p + 2.5 * math.sqrt(64 * p * (1 - p)))


def _stars(texts: np.ndarray, a: np.ndarray, b: np.ndarray, salt: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    close = simhash.near(a, radius)
    if not close.any():
        return
    close &= simhash.near(b, radius)
    todo = close.any(axis=1)
    order = np.flatnonzero(todo)
    order = order[np.argsort((texts[order].view(np.uint64) ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15), kind="stable")]
    for i in order:
        if todo[i]:
            others = np.flatnonzero(close[i])
            todo[others] = False
            yield texts[others], np.full(len(others), texts[i])


def _dealt(classes: DataFrame, n: int, least: float) -> DataFrame:
    """`classes` (th, a, b and more) once for each sample, with gid, the group of equal sampled bits; whole groups in order."""
    bits, samples, _ = layout(n, least)
    rng = np.random.default_rng(17)
    places = [np.sort(rng.choice(64, bits, replace=False)).astype(np.uint64) for _ in range(samples)]

    @tidy
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["a"].to_numpy().view(np.uint64)
            for s, own in enumerate(places):
                key = np.full(len(fps), s, dtype=np.int64)
                for bit in own:
                    key = key << 1 | ((fps >> bit) & np.uint64(1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["gid", *batch.schema.names])

    dealt = classes.mapInArrow(deal, T.StructType([T.StructField("gid", T.LongType()), *classes.schema]))
    return dealt.repartition("gid").sortWithinPartitions("gid", "th")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted rows, gid first, cut between groups."""
    held: list[np.ndarray] = []
    for batch in batches:
        fresh = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        held = [np.concatenate(x) for x in zip(held, fresh, strict=True)] if held else fresh
        if len(held[0]) and held[0][-1] != held[0][0]:
            whole = int(np.searchsorted(held[0], held[0][-1]))
            yield [x[:whole] for x in held]
            held = [x[whole:].copy() for x in held]
    if held and len(held[0]):
        yield held


def candidates(classes: DataFrame, n: int, least: float) -> DataFrame:
    """Pairs (u, v) of text hashes in `classes` (th, a, b) that may be as similar as that."""
    bits, _, radius = layout(n, least)

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gid, th, a, b in _whole_groups(batches):
            yield from _met(gid, th, a, b, bits, radius)

    pairs = _dealt(classes, n, least).mapInArrow(meet, "u long, v long")
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _tiles(gid: np.ndarray) -> list[np.ndarray]:
    """Rows to be compared with each other; large groups tile by tile, small ones share a tile."""
    cuts = np.concatenate([[0], np.flatnonzero(gid[1:] != gid[:-1]) + 1, [len(gid)]])
    tiles, held = [], []
    for x, y in zip(cuts, cuts[1:], strict=False):
        if y - x > TILE:
            half = [np.arange(i, min(i + TILE // 2, y)) for i in range(x, y, TILE // 2)]
            tiles += [np.concatenate([p, q]) for i, p in enumerate(half) for q in half[i + 1 :]]
        elif y - x > 1:
            if sum(map(len, held)) + y - x > TILE:
                tiles.append(np.concatenate(held))
                held = []
            held.append(np.arange(x, y))
    if held:
        tiles.append(np.concatenate(held))
    return tiles


def _met(gid: np.ndarray, th: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int, radius: int) -> Iterator[pa.RecordBatch]:
    for rows in _tiles(gid):
        salt = int(gid[rows[0]]) >> bits
        for u, v in _stars(th[rows], a[rows].view(np.uint64), b[rows].view(np.uint64), salt * 0x9E3779B97F4A7C15 % 2**64, radius):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _close(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    close = simhash.near(a.view(np.uint64), radius)
    return close & simhash.near(b.view(np.uint64), radius) if close.any() else close


def _links(sets: list[np.ndarray], close: np.ndarray, label: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
    """Close pairs of similar sets (numbers below the sum of their sizes) of different labels; a link makes labels equal before the next text."""
    sizes = np.array([len(x) for x in sets])
    seen = np.zeros(int(sizes.sum()) + 1, dtype=bool)
    for i in np.flatnonzero(close.any(axis=1)):
        small, large = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
        others = np.flatnonzero(close[i] & (label != label[i]) & (small >= least * large))
        others = others[others > i]
        if not len(others):
            continue
        seen[sets[i]] = True
        ends = np.cumsum(sizes[others])
        counted = np.concatenate([[0], np.cumsum(seen[np.concatenate([sets[j] for j in others])])])
        common = counted[ends] - counted[ends - sizes[others]]
        seen[sets[i]] = False
        # similarity() divides the same integers, so both agree at the limit
        every = sizes[i] + sizes[others] - common
        for j in others[(every == 0) | (common / np.maximum(every, 1) >= least)]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield int(i), int(j)


def missed(classes: DataFrame, texts: DataFrame, n: int, least: float, k: int) -> DataFrame:
    """Pairs (u, v) of `classes` (th, a, b, root) that join different roots: all similar ones but those that others of them join.

    `texts` (th, text) has the text of each class, `n` is what `candidates` was called with.
    """
    radius = layout(n, least)[2]

    @tidy
    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gid, th, a, b, root in _whole_groups(batches):
            some = np.zeros(len(gid), dtype=bool)
            for rows in _tiles(gid):
                g, r = gid[rows], root[rows]
                if (r != r[0]).any():
                    some[rows] |= (_close(a[rows], b[rows], radius) & (g[:, None] == g) & (r[:, None] != r)).any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (gid, th, a, b, root)], names=["gid", "th", "a", "b", "root"])

    @tidy
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.array([xxhash.xxh64_intdigest(x) for x in shingles(t.as_py(), k)], dtype=np.uint64)).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["th"], pa.array(sets, pa.binary())], names=["th", "hashes"])

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gid, th, a, b, root, hashes in _whole_groups(batches):
            label = root.copy()
            for rows in _tiles(gid):
                mine = label[rows]
                if (mine == mine[0]).all():
                    continue
                raw = [np.frombuffer(hashes[i], dtype=np.uint64) for i in rows]
                numbers = np.unique(np.concatenate(raw), return_inverse=True)[1]
                sets = np.split(numbers, np.cumsum([len(x) for x in raw])[:-1])
                found = list(_links(sets, _close(a[rows], b[rows], radius), mine, least))
                if found:
                    for i, j in found:
                        label[label == label[rows[j]]] = label[rows[i]]
                    u, v = (np.array(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(th[rows[u]]), pa.array(th[rows[v]])], names=["u", "v"])

    where = _dealt(classes.select("th", "a", "b", "root"), n, least).mapInArrow(apart, "gid long, th long, a long, b long, root long")
    sets = texts.select("th", "text").mapInArrow(hashed, "th long, hashes binary")
    full = where.join(sets, "th").select("gid", "th", "a", "b", "root", "hashes")
    pairs = full.repartition("gid").sortWithinPartitions("gid", "th").mapInArrow(compare, "u long, v long")
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, least: float, k: int) -> DataFrame:
    """The pairs whose texts (`texts`: th, text) have that similarity."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(shingles(s.as_py(), k), shingles(t.as_py(), k)) >= least for s, t in zip(batch["s"], batch["t"], strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    some = texts.join(pairs.select(F.explode(F.array("u", "v")).alias("th")).distinct(), "th", "left_semi")
    both = pairs.join(some.withColumnsRenamed({"th": "u", "text": "s"}), "u").join(some.withColumnsRenamed({"th": "v", "text": "t"}), "v")
    return both.select("u", "v", "s", "t").mapInArrow(run, "u long, v long")


def groups(docs: DataFrame, scratch: Scratch, least: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    """(th, sig, copies, root, keep, keep_th): hash, digest and rows of each distinct text, its group, and the doc_id and the hash of what stays of the group."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumns({"th": F.xxhash64("text"), "sig": F.md5(F.col("text").cast("binary"))})

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[int, tuple[int, int]] = {}
            for h, t in zip(batch["th"].to_pylist(), batch["text"], strict=True):
                if h not in made:
                    made[h] = two_fingerprints(t.as_py(), k)
            both = np.array([made[h] for h in batch["th"].to_pylist()], dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["th"], batch["sig"], pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["doc_id", "th", "sig", "a", "b"])

    prints = hashed.select("doc_id", "th", "sig", "text").mapInArrow(run, "doc_id long, th long, sig string, a long, b long")
    # a class is the text of the least digest where several share a hash; the others take no part, see drop_near_copies
    own = prints.groupBy("th", "sig").agg(F.min("doc_id").alias("least"), F.min("a").alias("a"), F.min("b").alias("b"), F.count("*").alias("copies"))
    classes = scratch.write(own.groupBy("th").agg(F.min_by(F.struct("sig", "least", "a", "b", "copies"), "sig").alias("x")).select("th", "x.*"), "classes")
    n, total = classes.agg(F.count("*"), F.sum("copies")).first()
    # of classes with more than a share of 1 in HEAVY of all rows, fewer than HEAVY, one copy's text is enough
    heavy = classes.where(F.col("copies") > total / HEAVY).select(F.col("th").alias("_h"), F.col("least").alias("_one")) if total else None
    if heavy is not None:
        hashed = hashed.join(F.broadcast(heavy), (F.col("th") == F.col("_h")) & ~F.col("doc_id").eqNullSafe(F.col("_one")), "left_anti")
    pairs = scratch.write(candidates(classes.select("th", "a", "b"), n, least), "pairs")
    met = classes.select("th", "sig").join(pairs.select(F.explode(F.array("u", "v")).alias("th")).distinct(), "th", "left_semi")
    texts = hashed.select("th", "sig", "text").join(met, ["th", "sig"], "left_semi").groupBy("th").agg(F.first("text").alias("text"))
    texts = scratch.write(texts, "texts")
    links = scratch.write(verified(pairs, texts, least, k), "links")
    roots = scratch.write(components(links, scratch), "roots")
    met = texts.select("th").join(classes, "th").join(roots, F.col("th") == F.col("node"), "left").select("th", "a", "b", F.coalesce("root", "th").alias("root"))
    more = scratch.write(missed(met, texts, n, least, k), "more")
    if not more.isEmpty():
        roots = components(links.unionByName(verified(more, texts, least, k)), scratch)
    rooted = classes.join(roots, classes.th == roots.node, "left").select("th", "sig", "least", "copies", F.coalesce("root", "th").alias("root"))
    keep = rooted.groupBy("root").agg(F.min("least").alias("keep"), F.min(F.struct(F.col("least").isNull(), "least", "th")).alias("top"))
    return rooted.join(keep, "root").select("th", "sig", "copies", "root", "keep", F.col("top.th").alias("keep_th"))


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    """`docs` with one document of each group of near copies: that of the smallest doc_id.

    Groups are the components of pairs of similar texts; texts with the same words in the same order are
    similar, null and empty ones and those of white space too. Texts are the same by 64 and 128 bits of two
    digests; of different texts that share the first, all but one stay without being compared. Rows that repeat both doc_id and text are one
    document and stay together; so do rows without a doc_id whose text stays. Other columns pass through.
    """
    scratch = Scratch(docs.sparkSession, "near")
    gone = groups(docs, scratch, least, k).select("copies", F.col("th").alias("_kth"), F.col("sig").alias("_ksig"), F.when(F.col("th") == F.col("keep_th"), F.struct(F.col("keep").alias("id"))).alias("_kid"))
    text = F.coalesce("text", F.lit(""))
    marked = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_th"), F.md5(text.cast("binary")).alias("_sig"))
    goes = (F.col("_th") == F.col("_kth")) & (F.col("_sig") == F.col("_ksig")) & (F.col("_kid").isNull() | ~F.col("_id").eqNullSafe(F.col("_kid.id")))
    gone = scratch.write(gone, "gone")
    rows = gone.agg(F.sum("copies")).first()[0] or 0
    # rows of heavy classes, which are few, go without being moved
    left = marked.join(F.broadcast(gone.where(F.col("copies") > rows / HEAVY)), goes, "left_anti")
    return left.join(gone.where(F.col("copies") <= rows / HEAVY), goes, "left_anti").select("_row.*")
