"""Spelling variants: words of a corpus that differ by one letter, and the common form that a rare one stands for.

Each word of the vocabulary gives its full neighbourhood, every distinct string at one deletion, replacement
or insertion over the letters that occur, and the neighbourhood is hash-joined to the vocabulary on the
strings themselves, so nothing needs a distance. A neighbourhood has some thousand strings and few of them
are words: tasks first hash it without writing it out (a prefix's and a suffix's polynomial give the hash of
each edit in one step) and ask a Bloom filter of the vocabulary. Only what the filter lets through becomes
strings and is joined. The filter has 16 bits or more a word up to a bound; beyond the bound it lets more
through, and the join, which alone decides, has more to do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, tidy

c = F.col
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: One occurrence in so many, by hash, loses a letter.
FAULTS = 31
#: Bits of the filter: at least so many a word, at most 2 ** TOP (128 MB), probed at PROBES places, built in parts of 2 ** PART.
BITS, TOP, PROBES, PART = 16, 30, 4, 20
#: Strings of a neighbourhood hashed at a time.
BLOCK = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_U64 = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_MIX = [_U64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def occurrences(docs: DataFrame, least: int = LEAST_LENGTH, faults: int = FAULTS) -> DataFrame:
    """(word) per run of letters of `docs` (doc_id, text): lower-cased in A-Z, one in `faults` short of a letter.

    Runs shorter than `least` can't come to have that length, so they aren't read.
    """
    runs = docs.select(F.coalesce(c("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("_run"))
    low = runs.select("_id", F.when(c("_run").rlike("[A-Z]"), F.translate("_run", _UPPER, _LOWER)).otherwise(c("_run")).alias("_run"))
    hashed = low.select("_run", F.crc32(F.concat("_id", F.lit(":"), "_run")).alias("_h"))
    at = (c("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    return hashed.select(F.when(c("_h") % faults == 0, cut).otherwise(c("_run")).alias("word")).where(F.length("word") >= least)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, _U64), np.full(n, _P, dtype=_U64)]))


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), length).astype(_U64)


def _probe(h: np.ndarray, k: int, bits: int) -> np.ndarray:
    return ((h ^ (h >> _U64(29))) * _MIX[k]) >> _U64(64 - bits)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def _places(bits: int):
    """(part, place) of the filter's bits that a word sets."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b["word"].to_pylist()
            h = np.empty(len(words), dtype=_U64)
            for n, which in _by_length(words).items():
                h[which] = (_codes([words[i] for i in which], n) * _powers(n)[:n]).sum(axis=1, dtype=_U64)
            at = np.concatenate([_probe(h, k, bits) for k in range(PROBES)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> PART).astype(np.int32)), pa.array((at & ((1 << PART) - 1)).astype(np.int32))], names=["part", "place"])

    return run


def _fill(bits: int):
    def run(key: tuple, places: pa.Table) -> pa.Table:
        part = np.zeros(1 << min(PART, bits), dtype=bool)
        part[places["place"].to_numpy()] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())})

    return run


def _filter(vocabulary: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """(bits as a power of two, the filter of a vocabulary of n words); its size is bounded by 2 ** TOP bits."""
    bits = min(TOP, max(10, (BITS * n - 1).bit_length()))
    parts = vocabulary.select("word").mapInArrow(_places(bits), "part int, place int").groupBy("part").applyInArrow(_fill(bits), "part int, bits binary")
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    size = (1 << min(PART, bits)) // 8
    for row in parts.toLocalIterator():
        out[row.part * size : (row.part + 1) * size] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits, out


def _may_hold(h: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    """Places of a flat array of hashes that pass the filter."""
    left = np.arange(len(h))
    for k in range(PROBES):
        at = _probe(h if k == 0 else h[left], k, bits)
        left = left[(table[at >> _U64(3)] >> (at & _U64(7)).astype(np.uint8)) & 1 == 1]
    return left


def edits(words: list[str], alphabet: np.ndarray, passing) -> Iterator[tuple[int, str]]:
    """(number of the word, string) over all distinct one-letter edits of `words` that `passing`, given hashes, keeps.

    An insertion beside an equal letter, or a deletion from a run of equal ones, is made at its first place only.
    """
    letters = [chr(x) for x in alphabet.tolist()]
    a = len(alphabet)
    for n, which in _by_length(words).items():
        pw = _powers(n)
        wide = max(1, BLOCK // (a * (n + 1)))  # words at a time; the places of a very long one are dealt out instead
        span = n + 1 if wide > 1 else max(1, BLOCK // a)
        for s in range(0, len(which), wide):
            own = which[s : s + wide]
            x = _codes([words[i] for i in own], n)
            term = x * pw[:n]
            head = np.concatenate([np.zeros((len(own), 1), _U64), np.cumsum(term, axis=1, dtype=_U64)], axis=1)
            total = head[:, -1:]
            tail = total - head  # from place i on
            before = np.concatenate([np.zeros((len(own), 1), _U64), x], axis=1)  # the letter before place i
            gone = head[:, :-1] + tail[:, 1:] * _U64(_P_INV)
            for f in passing(gone.ravel()).tolist():
                r, i = divmod(f, n)
                if before[r, i] != x[r, i]:
                    w = words[own[r]]
                    yield own[r], w[:i] + w[i + 1 :]
            for lo in range(0, n + 1, span):
                hi = min(lo + span, n)
                if hi > lo:
                    put = (total - term[:, lo:hi])[:, :, None] + pw[lo:hi][None, :, None] * alphabet
                    for f in passing(put.ravel()).tolist():
                        r, rest = divmod(f, (hi - lo) * a)
                        i, k = divmod(rest, a)
                        if alphabet[k] != x[r, lo + i]:
                            w = words[own[r]]
                            yield own[r], w[: lo + i] + letters[k] + w[lo + i + 1 :]
                hi = min(lo + span, n + 1)
                put = (head[:, lo:hi] + tail[:, lo:hi] * _U64(_P))[:, :, None] + pw[lo:hi][None, :, None] * alphabet
                for f in passing(put.ravel()).tolist():
                    r, rest = divmod(f, (hi - lo) * a)
                    i, k = divmod(rest, a)
                    if alphabet[k] != before[r, lo + i]:
                        w = words[own[r]]
                        yield own[r], w[: lo + i] + letters[k] + w[lo + i :]


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of `vocabulary` (word, n), words without repeats: all pairs, both ways, that differ by one letter."""
    n = vocabulary.count()
    # at most the letters of the vocabulary's runs, 90 or so
    alphabet = np.array(sorted(ord(r.x) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("x")).where("x <> ''").distinct().collect()), dtype=_U64)
    bits, table = _filter(vocabulary, n)
    shared = vocabulary.sparkSession.sparkContext.broadcast(table)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            words, counts = b["word"].to_pylist(), b["n"].to_pylist()
            held: list[tuple[int, str]] = []
            size = 0
            for who, near in edits(words, alphabet, lambda h: _may_hold(h, bits, table)):
                held.append((who, near))
                size += len(near)
                if size > 4 * BLOCK:
                    yield batch(words, counts, held)
                    held, size = [], 0
            if held:
                yield batch(words, counts, held)

    def batch(words: list[str], counts: list[int], held: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i, _ in held]), pa.array([counts[i] for i, _ in held], pa.int64()), pa.array([x for _, x in held])], names=["word", "n", "near"])

    made = vocabulary.select("word", "n").mapInArrow(run, "word string, n long, near string")
    return made.join(vocabulary.select(c("word").alias("near"), c("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of `forms` (word, form), a row each: forms are followed to the last.

    Counts grow along a chain at least RATIO times a step, so chains are short; each round doubles how far is seen.
    """
    now, turn = scratch.write(forms.select("word", c("form").alias("root")), "roots0"), 0
    while True:
        onward = now.select(c("word").alias("root"), c("root").alias("_then"))
        after = scratch.write(now.join(onward, "root", "left").select("word", F.coalesce("_then", "root").alias("root"), c("_then").isNotNull().alias("moved")), f"roots{turn + 1}")
        scratch.drop(f"roots{turn}")
        turn += 1
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of `counted` (word, n).

    n_near counts the words one letter away; form is the one of them with the largest n (ties: the smallest in
    code-point order) if that is at least `ratio` times the word's own, else null; root follows forms to the last.
    """
    scratch = Scratch(counted.sparkSession, "spelling")
    vocabulary = scratch.write(counted, "words")
    pairs = neighbours(vocabulary)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-c("near_n")).alias("m"), "near")).alias("x"))
    fits: Column = -c("x.m") >= ratio * c("n")
    found = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, c("x.near")).alias("form"), F.when(fits, -c("x.m")).alias("form_n"))
    found = scratch.write(found, "found")
    followed = roots(found.where("form is not null"), scratch)
    return found.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, ratio: int = RATIO, faults: int = FAULTS) -> DataFrame:
    """Per word of `docs` (doc_id, text): word, form, root, n, n_near, form_n, over all rows and whole texts.

    A null text has no words, a null doc_id counts as empty in the hash; rows that repeat count each; an empty table
    gives no rows; other columns are ignored; a run of any length is a word and has its whole neighbourhood.
    """
    words = occurrences(docs.select("doc_id", "text"), least, faults)
    return variants(words.groupBy("word").agg(F.count("*").alias("n")).where(c("n") >= count), ratio)
