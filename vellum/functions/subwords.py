"""Sub-word counts by longest match in a given vocabulary, and chunking to a budget of sub-words.

The vocabulary is a file of a public tokenizer, read once a worker into a trie: JSON with model.vocab, or a piece a
line. Pieces mark a word's end (`</w>`) or its continuation (`##`); which, the file shows. A word, white space
around it, is cut from its start into the longest pieces there are; a character without a piece counts as one.
Counts of words add up, so that packing works on numbers: a word is looked up once for the paragraph it is in (once
more for its sentence, where a paragraph is over budget), and chunks and overlaps add what their parts have. Texts are
cut as UTF-8, since `bytes` splits and strips at just the white space that is meant, which is ASCII.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.chunks import MAX_TOKENS, OVERLAP, STRATEGIES
from vellum.tables import DOCUMENT

#: Words whose counts a worker remembers before it starts anew.
MEMO = 500_000
#: Texts that are Python objects at once; a batch of Arrow has 10,000.
SLICE = 64
_END = re.compile(rb"(?<=[.!?])[ \t\n\x0b\f\r]+")
#: The number of tokens of a word.
Counter = Callable[[bytes], int]
#: A chunk, its tokens, and the words of each of its parts.
Chunk = tuple[bytes, int, list[list[bytes]]]


class Memo(dict[bytes, int]):
    """Tokens of the words that a worker has met, by `count` of a word; beyond MEMO words it starts anew."""

    def __init__(self, count: Callable[[str], int]):
        self.count = count

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self[word] = self.count(word.decode())
        return n


class Vocabulary:
    """A trie of pieces, each node a dictionary of next characters; the empty key says that a piece ends there."""

    def __init__(self, pieces: list[str], lower: bool = False):
        self.continued = any(p.startswith("##") and len(p) > 2 for p in pieces)
        self.closed = not self.continued and any(p.endswith("</w>") for p in pieces)
        self.first: dict = {}
        self.later: dict = {} if self.continued else self.first
        self.last: dict = {} if self.closed else self.first
        for p in pieces:
            if self.continued and p.startswith("##") and len(p) > 2:
                self._add(self.later, p[2:])
            elif self.closed and p.endswith("</w>"):
                self._add(self.last, p[:-4])
            else:
                self._add(self.first, p)
        self.word: Counter = Memo(lambda w: len(self.ends(w.lower() if lower else w))).__getitem__

    @staticmethod
    def _add(node: dict, piece: str) -> None:
        for ch in piece:
            node = node.setdefault(ch, {})
        node[""] = True

    def _closes(self, word: str, at: int) -> bool:
        node = self.last
        for i in range(at, len(word)):
            node = node.get(word[i])
            if node is None:
                return False
        return "" in node

    def ends(self, word: str) -> list[int]:
        """Where a word's pieces end, longest first; where pieces mark a word's end, one that ends it wins over a shorter one."""
        out, at, most, root = [], 0, len(word), self.first
        while at < most:
            if self.closed and self._closes(word, at):
                out.append(most)
                break
            i, node, at = at, root, at + 1
            while i < most and (node := node.get(word[i])) is not None:
                i += 1
                if "" in node:
                    at = i
            out.append(at)
            root = self.later
        return out

    def pieces(self, word: str) -> list[str]:
        ends = self.ends(word)
        return [word[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def count(self, text: str) -> int:
        return sum(map(self.word, text.encode().split()))


@lru_cache(maxsize=4)
def vocabulary(path: str, lower: bool = False) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    pieces = list(json.loads(text)["model"]["vocab"]) if path.endswith(".json") else text.splitlines()
    return Vocabulary(list(dict.fromkeys(p.lower() for p in pieces)) if lower else pieces, lower)


def _pack(parts: Iterable[bytes], budget: int, separator: bytes, count: Counter) -> list[Chunk]:
    """Consecutive parts joined while they fit; a part over budget is a chunk of its own."""
    out: list[tuple[list[bytes], list[list[bytes]]]] = []
    sizes: list[int] = []
    for part in parts:
        words = part.split()
        k = sum(map(count, words))
        if out and (sizes[-1] == 0 or sizes[-1] + k <= budget):
            sizes[-1] += k
        else:
            out.append(([], []))
            sizes.append(k)
        out[-1][0].append(part)
        out[-1][1].append(words)
    return [(x, n, words) for (texts, words), n in zip(out, sizes, strict=True) if (x := separator.join(texts).strip())]


def _sentences(text: bytes, budget: int, count: Counter) -> list[Chunk]:
    return _pack(_END.split(text), budget, b" ", count)


def _paragraphs(text: bytes, budget: int, delimiter: bytes, count: Counter) -> list[Chunk]:
    paras = [x for p in text.split(delimiter) if (x := p.strip())]
    return [x for p in _pack(paras, budget, b"\n\n", count) for x in (_sentences(p[0], budget, count) if p[1] > budget else [p])]


def _tail(parts: list[list[bytes]], most: int, count: Counter) -> tuple[bytes, int]:
    """The last whole words of a chunk with at most `most` tokens, and how many these have."""
    kept: list[bytes] = []
    n = 0
    for word in chain.from_iterable(map(reversed, reversed(parts))):
        k = count(word)
        if n + k > most:
            break
        kept.append(word)
        n += k
    return b" ".join(reversed(kept)), n


def cut(text: bytes, strategy: str, budget: int, overlap: int, delimiter: bytes, count: Counter) -> list[tuple[bytes, int]]:
    """Chunks of a text as `chunks.chunk` has them, with their tokens, for any count of a word's tokens; overlap is in tokens too."""
    made = _sentences(text, budget, count) if strategy == "sentences" else _paragraphs(text, budget, delimiter, count)
    if strategy != "overlap":
        return [(x, n) for x, n, _ in made]
    led = [(b"", 0), *(_tail(parts, overlap, count) for _, _, parts in made[:-1])]
    return [(b"%b\n\n%b" % (tail, x) if i else x, k + n) for i, ((tail, k), (x, n, _)) in enumerate(zip(led, made, strict=False))]


def chunk(docs: DataFrame, path: str, strategy: str = "paragraph_aware", budget: int = MAX_TOKENS, overlap: int = OVERLAP, delimiter: str = "\n\n", lower: bool = False) -> DataFrame:
    """`chunks.chunk` with budget, overlap and token_count in sub-words of the vocabulary file at `path`.

    `lower` counts texts as lower-case; chunks keep their case. The file must be at this path on every worker.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown chunking strategy: {strategy}")
    known = [F.coalesce(F.col(x), F.lit("")).alias(x) if x in docs.columns else F.lit("").alias(x) for x in DOCUMENT[1:]]
    rest = [x for x in docs.columns if x not in DOCUMENT]
    made = T.StructType([T.StructField("content", T.StringType()), T.StructField("token_count", T.IntegerType())])

    @F.arrow_udf(T.ArrayType(made))
    def chunks_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = vocabulary(path, lower).word
        for texts in batches:
            for at in range(0, len(texts), SLICE):
                cuts = [cut(t, strategy, budget, overlap, delimiter.encode(), count) for t in texts.slice(at, SLICE).cast(pa.binary()).to_pylist()]
                contents = pa.array([x for c in cuts for x, _ in c], pa.string())
                counts = pa.array([n for c in cuts for _, n in c], pa.int32())
                yield pa.ListArray.from_arrays(list(accumulate(map(len, cuts), initial=0)), pa.StructArray.from_arrays([contents, counts], ["content", "token_count"]))

    made_rows = docs.select(*rest, *known, chunks_of(F.coalesce("content", F.lit(""))).alias("_chunks"))
    exploded = made_rows.select(*rest, *DOCUMENT[1:], F.size("_chunks").alias("total_chunks"), F.posexplode_outer("_chunks").alias("chunk_id", "_x"))
    return exploded.where("_x is not null").select(*rest, *DOCUMENT[1:], "total_chunks", "chunk_id", "_x.*")
