"""Best-fit packing of token sequences by minimum bin slack.

Documents are tokenised and cut into pieces of at most `capacity` tokens. All that packing needs to know
is how many pieces there are of each length, a histogram of at most `capacity` numbers whatever the size
of the corpus. On it the driver builds bins: the longest piece left opens a bin, and a bitset subset-sum
dynamic programme over the lengths left finds the fullest combination that fits beside it; the combination
is removed, as many times as it is available, since it stays the fullest as long as it can be made.
The resulting patterns say where the r-th piece of each length goes. Pieces are ranked within (length, salt)
groups, with as many salts as a length has pieces enough for, so that a common length is ranked by many tasks.
Pieces of the whole capacity fill a sequence each and need no rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm import tokens
from vellum.llm.common import Scratch, tidy

CAPACITY = 1024
END_ID = 2
#: Pieces ranked together: at most so many, and at most a share of 1 in DEALT; groups at most in all.
RANKED = 100_000
DEALT = 4096
GROUPS = 65_536
#: Tokens of slack that a bin may keep, tried in turn.
SPARES = (0, 1, 2, 4, 8, 12, 16, 24, 32)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids followed by end_id."""
    path = tokenizer or tokens.default_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            seen: dict[str, list] = {}
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                text = text or ""
                if (made := seen.get(text)) is None:
                    ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                    made = [(k, a, n, zlib.crc32(ids[a : a + n].tobytes()), ids[a : a + n] if with_ids else None) for k, (a, n) in enumerate(cut(len(ids), capacity))]
                    seen[text] = made
                for row in made:
                    for column, value in zip(out, (doc_id, *row), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(out[5], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES + (", ids array<long>" if with_ids else ""))


def fullest(left: dict[int, int], room: int, spare: int = 0) -> list[tuple[int, int]]:
    """The combination of lengths, of at most `left` pieces each, whose sum is the largest up to `room`.

    Lengths are tried from the longest, and the first combinations that leave `spare` or less will do.
    """
    mask, reach, steps, enough = (1 << room + 1) - 1, 1, [], max(0, room - spare)
    for length in sorted((x for x in left if 0 < x <= room and left[x] > 0), reverse=True):
        many, chunk = min(left[length], room // length), 1
        while many > 0 and not reach >> enough:
            take = min(chunk, many)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            many -= take
            chunk *= 2
        if reach >> enough:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return list(used.items())


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, pieces of it), ...]) of the bins, longest pieces first, until none is left.

    Exact fits use up short pieces that later bins need, so a few amounts of slack that a bin may keep are
    tried too, and the plan with the fewest bins is taken; none can have fewer than the sum of lengths asks.
    """
    if not counts:
        return []
    least, best = -(-sum(x * n for x, n in counts.items()) // capacity), None
    for spare in SPARES:
        made = _patterns(counts, capacity, spare)
        if best is None or sum(k for k, _ in made) < sum(k for k, _ in best):
            best = made
        if sum(k for k, _ in best) == least:
            break
    return best


def _patterns(counts: dict[int, int], capacity: int, spare: int) -> list[tuple[int, list[tuple[int, int]]]]:
    left, made = dict(counts), []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        need = {longest: 1}
        for length, n in fullest(rest, capacity - longest, spare):
            need[length] = need.get(length, 0) + n
        times = min(left[x] // n for x, n in need.items())
        made.append((times, sorted(need.items(), reverse=True)))
        for x, n in need.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return made


def _slots(made: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces a bin, offset in the bin), by length and rank."""
    rows, used, first_bin = [], {}, 0
    for times, need in made:
        offset = 0
        for length, n in need:
            rows.append((length, used.get(length, 0), first_bin, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        first_bin += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(items: DataFrame, capacity: int = CAPACITY, ranked_at_once: int = RANKED) -> DataFrame:
    """`items` (a written table with doc_id, piece, length, ...) with sequence_id and offset."""
    short = items.where(F.col("length") < capacity)
    counts = {r.length: r.n for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}  # fewer than `capacity` rows
    total = sum(counts.values())
    each = max(min(ranked_at_once, total // DEALT + 1), -(-total // GROUPS))
    salts = [-(-counts.get(length, 0) // each) or 1 for length in range(capacity)]
    salted = short.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(F.lit(salts), F.col("length").cast("int"))).cast("int"))
    # at most `capacity` + GROUPS rows
    sizes = salted.groupBy("length", "salt").count().orderBy("length", "salt").collect()
    first = np.cumsum([0, *salts])[:-1]
    before, seen = np.zeros(sum(salts), dtype=np.int64), dict.fromkeys(counts, 0)
    for length, salt, n in sizes:
        before[first[length] + salt] = seen[length]
        seen[length] += n
    made = patterns(counts, capacity)
    slots = _slots(made)
    ranked = salted.withColumn("nth", F.expr("row_number() over (partition by length, salt order by doc_id, piece, ids_crc32)"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema) + ", sequence_id long, offset long"
    kept = items.columns

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = slots[:, 0] << 48 | slots[:, 1]
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = before[first[length] + batch["salt"].to_numpy()] + batch["nth"].to_numpy() - 1
            row = slots[np.searchsorted(keys, length << 48 | rank, side="right") - 1] if len(rank) else slots[:0]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    whole = items.where(F.col("length") >= capacity).select(*kept, (F.monotonically_increasing_id() + sum(k for k, _ in made)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return ranked.mapInArrow(run, schema).unionByName(whole)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows are packed as often as they occur; doc_id may be
    null; an empty table gives no rows; other columns are ignored. With `with_ids` the ids themselves are
    kept, for `sequences`.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    return place(scratch.write(pieces(docs, capacity, end_id, tokenizer, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of what `pack(..., with_ids=True)` gave; a sequence has at most `capacity` ids."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", F.expr("flatten(transform(p, x -> x.ids))").alias("ids"))
