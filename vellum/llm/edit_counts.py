"""Token counts that follow edits: per document a segment tree over its pre-tokens.

Byte-level BPE never merges across pre-tokens, so a text's token count is the sum over its pre-tokens. The
tree's leaves hold short runs of pre-tokens with their lengths, counts and text; inner nodes hold the sums
of characters and tokens. An edit finds its leaves by descending on characters. What lies to the left of
an edit can change only if a pre-token ends within two characters of it (the pattern looks no further
ahead), so re-encoding starts at the pre-token over that place and stops at the first boundary that the
old text had too, beyond the edit. Only the sums above the leaves touched are updated.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm import tokens
from vellum.llm.common import tidy

LEAF = 64
#: Characters that a match may depend on beyond its end.
AHEAD = 2
#: Pre-tokens whose counts a worker remembers before it starts anew.
MEMO = 400_000

PRETOKEN = regex.compile(public_tokenizers.PATTERN)


class Counts(dict):
    """Pre-token -> number of tokens."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, piece: str) -> int:
        if len(self) > MEMO:
            self.clear()
        n = self[piece] = self.count(piece)
        return n


class CountTree:
    """The tree of one text. `total` is its token count, `encoded` the characters encoded so far."""

    def __init__(self, text: str, counts: Counts, leaf: int = LEAF):
        self.counts, self.leaf, self.encoded = counts, leaf, len(text)
        self._build(PRETOKEN.findall(text), text)

    def _build(self, pieces: list[str], text: str) -> None:
        lens, toks = list(map(len, pieces)), list(map(self.counts.__getitem__, pieces))
        cut = range(0, len(pieces), self.leaf) if pieces else [0]
        self.lens = [lens[i : i + self.leaf] for i in cut]
        self.toks = [toks[i : i + self.leaf] for i in cut]
        self.size = 1 << (len(self.lens) - 1).bit_length()
        chars = [sum(x) for x in self.lens]
        ends = np.cumsum([0, *chars]).tolist()
        self.texts = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        self.chars = self._tree(chars)
        self.sums = self._tree([sum(x) for x in self.toks])

    def _tree(self, leaves: list[int]) -> list[int]:
        level = np.zeros(self.size, dtype=np.int64)
        level[: len(leaves)] = leaves
        levels = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2).sum(axis=1)
            levels.append(level)
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def total(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def _find(self, at: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds the character `at`, or of the last with any."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            left = self.chars[node]
            if at >= before + left and self.chars[node + 1]:
                before += left
                node += 1
        return node - self.size, before

    def _update(self, leaf: int) -> None:
        node = leaf + self.size
        self.chars[node], self.sums[node] = sum(self.lens[leaf]), sum(self.toks[leaf])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replaces the characters [start, stop) by `new` and returns the new count."""
        start = min(max(start, 0), self.length)
        stop = min(max(stop, start), self.length)
        first, before = self._find(max(start - AHEAD, 0))
        keep, at = 0, before
        while keep < len(self.lens[first]) and at + self.lens[first][keep] <= start - AHEAD:
            at += self.lens[first][keep]
            keep += 1
        # the text from `at` on, edited; it grows by whole leaves as matches come near its end
        last, last_before = self._find(stop)
        last = max(last, first)
        joined = "".join(self.texts[first : last + 1])
        text = joined[at - before : start - before] + new + joined[stop - before :]
        shift = len(new) - (stop - start)
        old_leaf, old_at, old = last, last_before, 0  # the next old boundary, from the leaf that holds `stop` on
        pos, pieces = 0, []
        while True:
            while last + 1 < len(self.lens) and pos >= len(text):
                last += 1
                text += self.texts[last]
            if pos >= len(text):
                old_leaf, old = last + 1, 0
                break
            here = at + pos - shift  # in old characters
            if here >= stop and pos >= start - at + len(new):
                while old_leaf < len(self.lens) and old_at < here:
                    if old < len(self.lens[old_leaf]):
                        old_at += self.lens[old_leaf][old]
                        old += 1
                    else:
                        old_leaf, old = old_leaf + 1, 0
                if old_at == here:
                    break
            m = PRETOKEN.match(text, pos)
            while m.end() + AHEAD > len(text) and last + 1 < len(self.lens):
                last += 1
                text += self.texts[last]
                m = PRETOKEN.match(text, pos)
            pieces.append(m.group())
            pos = m.end()
        self._splice(first, keep, old_leaf, old, pieces)
        return self.total

    def _splice(self, first: int, keep: int, leaf: int, skip: int, pieces: list[str]) -> None:
        """Puts `pieces` in the place of the pre-tokens from (first, keep) up to (leaf, skip)."""
        self.encoded += sum(map(len, pieces))
        lens, toks = list(map(len, pieces)), list(map(self.counts.__getitem__, pieces))
        head = self.texts[first][: sum(self.lens[first][:keep])] + "".join(pieces)
        rest = leaf < len(self.lens)
        tail = (self.lens[leaf][skip:], self.toks[leaf][skip:], self.texts[leaf][sum(self.lens[leaf][:skip]) :]) if rest else ([], [], "")
        self.lens[first], self.toks[first] = self.lens[first][:keep] + lens, self.toks[first][:keep] + toks
        self.texts[first] = head
        for i in range(first + 1, min(leaf + 1, len(self.lens))):
            self.lens[i], self.toks[i], self.texts[i] = [], [], ""
        if rest:
            into = first if leaf == first else leaf
            self.lens[into], self.toks[into], self.texts[into] = self.lens[into] + tail[0], self.toks[into] + tail[1], self.texts[into] + tail[2]
        if len(self.lens[first]) > 8 * self.leaf:  # a long insertion: deal it over leaves again
            text, flat = self.text, [n for x in self.lens for n in x]
            ends = np.cumsum([0, *flat]).tolist()
            self._build([text[a:b] for a, b in zip(ends, ends[1:], strict=False)], text)
            return
        for i in range(first, min(leaf + 1, len(self.lens))):
            self._update(i)


def recount(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text, edits): doc_id, n_tokens, n_tokens_after, n_chars_after, n_encoded, text_crc32.

    edits is an array of (start, stop, new), applied in order, each in characters of the text as the ones
    before left it, clipped to it. n_encoded counts the characters encoded for the edits; text_crc32 is that
    of the edited text. A null text counts as empty, null edits as none, a null in an edit as 0 or as no
    text. Special tokens' strings are ordinary text. Rows that repeat are repeated, doc_id may be null, an
    empty table gives no rows, other columns are ignored.
    """
    path = tokenizer or tokens.default_path()

    @tidy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(tokens.encoder(path).count)
        for b in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for text, edits in zip(b["text"].to_pylist(), b["edits"].to_pylist(), strict=True):
                tree = CountTree(text or "", counts)
                before, encoded = tree.total, tree.encoded
                for e in edits or []:
                    if e:
                        tree.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                for column, value in zip(out, (before, tree.total, tree.length, tree.encoded - encoded, zlib.crc32(tree.text.encode())), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, pa.int64()) for c in out)], names=["doc_id", "n_tokens", "n_tokens_after", "n_chars_after", "n_encoded", "text_crc32"])

    edits = F.col("edits").cast("array<struct<start:bigint,stop:bigint,new:string>>").alias("edits")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", edits).mapInArrow(run, "doc_id long, n_tokens long, n_tokens_after long, n_chars_after long, n_encoded long, text_crc32 long")


def sample_edits(docs: DataFrame) -> DataFrame:
    """`docs` with three edits a document at places that depend on its id: an insertion, a deletion, a replacement."""
    at = lambda k: f"pmod(xxhash64(doc_id, {k}), coalesce(length(text), 0) + 1)"
    edit = lambda a, n, new: f"named_struct('start', {a}, 'stop', {a} + {n}, 'new', '{new}')"
    return docs.withColumn("edits", F.expr(f"array({edit(at(1), 0, ' an inserted phrase, 2024 ')}, {edit(at(2), 12, '')}, {edit(at(3), 5, 'Wörter')})"))
