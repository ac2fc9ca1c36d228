"""Byte-pair encoding and decoding by a segment tree over adjacent pair ranks.

A pre-token starts as one symbol a byte. The leaves of a tree hold the merge rank of each symbol with the
next, inner nodes the least of their two, so the root names the leftmost pair of lowest rank. That pair
merges, which changes three leaves; their paths to the root are brought up to date, until the root holds no
pair. A pre-token of n bytes so takes n log n steps, however long it is.

Normalisation, splitting and special tokens are those that the vocabulary file states; a file that states
others than these raises. Decoding joins the tokens' strings as a file without decoder does.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import tidy

#: Pre-tokens that a worker remembers before it starts anew, and the longest of them in characters.
MEMO, MEMO_LENGTH = 500_000, 48
#: Pre-tokens of at most so many bytes are merged together, so many at once; a longer one alone.
SHORT, TOGETHER = 64, 20_000
#: Characters of text that are encoded together, ids or characters that are put out together.
GROUP = 2_000_000
_NONE = 1 << 62
# fixed values: what a file must state to be read here
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def _char_of_byte() -> list[str]:
    """Byte-level vocabularies write printable bytes as themselves, the others as characters from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in kept else extra))
        extra += b not in kept
    return out


class Merges:
    """Merge ranks of pairs of symbols; `ranks` maps a pair to (rank, merged symbol), ranks counting from 0."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        self.ranks = ranks
        self.base = max((max(*pair, made) for pair, (_, made) in ranks.items()), default=0) + 2
        keys = np.array([a * self.base + b + 1 for a, b in ranks] + [-1], dtype=np.int64)
        of = np.array([r for r, _ in ranks.values()] + [-1], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.of = keys[order], of[order]
        self.made = np.zeros(int(of.max()) + 1, dtype=np.int64)
        for r, m in ranks.values():
            self.made[r] = m

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, below 0 where there is none; a symbol of -1 pairs with nothing."""
        key = np.where(a < 0, 0, a * self.base + b + 1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.of[at], -1)

    def one(self, symbols: list[int]) -> list[int]:
        """`symbols` after all merges, the leftmost pair of lowest rank first."""
        n, ranks = len(symbols), self.ranks
        if n < 2:
            return symbols
        size = 1 << (n - 1).bit_length()
        tree = [_NONE] * (2 * size)
        # a leaf's number is rank and place, so the least one is the leftmost of lowest rank
        for i in range(n - 1):
            found = ranks.get((symbols[i], symbols[i + 1]))
            if found is not None:
                tree[size + i] = found[0] * size + i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        symbols = symbols[:]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                least = a if a < b else b
                if tree[i] == least:
                    return
                tree[i] = least
                i >>= 1

        def leaf(i: int) -> int:
            j = after[i]
            found = ranks.get((symbols[i], symbols[j])) if j < n else None
            return _NONE if found is None else found[0] * size + i

        while tree[1] != _NONE:
            i = tree[1] % size
            j = after[i]
            symbols[i] = ranks[symbols[i], symbols[j]][1]
            symbols[j] = -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            put(j, _NONE)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        return [s for s in symbols if s >= 0]

    def many(self, symbols: np.ndarray) -> np.ndarray:
        """`one` for each row of a matrix padded with -1: a tree a row, a merge of all rows at a time."""
        m, n = symbols.shape
        size = 1 << max(n - 1, 1).bit_length()
        sym = np.full((m, size + 1), -1, dtype=np.int64)
        sym[:, :n] = symbols
        rank = self.rank(sym[:, :size], sym[:, 1:])
        tree = np.full((m, 2 * size), _NONE, dtype=np.int64)
        tree[:, size:] = np.where(rank < 0, _NONE, rank * size + np.arange(size))
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        after = np.tile(np.arange(1, size + 2), (m, 1))
        after[:, size] = size
        before = np.tile(np.arange(-1, size), (m, 1))
        wide = size + 1
        flat, leaves, on, back = sym.ravel(), tree.ravel(), after.ravel(), before.ravel()

        def put(rows: np.ndarray, at: np.ndarray, value) -> None:
            own, at = rows * (2 * size), at + size
            leaves[own + at] = value
            while at[0] > 1:
                at = at >> 1
                below = own + 2 * at
                leaves[own + at] = np.minimum(leaves[below], leaves[below + 1])

        def leaf(at: np.ndarray, place: np.ndarray, then: np.ndarray) -> np.ndarray:
            found = self.rank(flat[at], flat[then])
            return np.where(found < 0, _NONE, found * size + place)

        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root, own = leaves[rows * (2 * size) + 1], rows * wide
            i = root % size
            j = on[own + i]
            flat[own + i], flat[own + j] = self.made[root // size], -1
            k = on[own + j]
            on[own + i] = k
            back[own + k] = i
            put(rows, j, _NONE)
            put(rows, i, leaf(own + i, i, own + k))
            h = back[own + i]
            led = np.flatnonzero(h >= 0)
            if len(led):
                put(rows[led], h[led], leaf(own[led] + h[led], h[led], own[led] + i[led]))
            rows = rows[leaves[rows * (2 * size) + 1] != _NONE]
        return sym[:, :n]


@lru_cache(maxsize=1)
def _differences() -> tuple[dict[int, str], list[str]]:
    """(lower-case forms that Python lacks, characters that only `regex` takes as letters or numbers), against `tokenizers`.

    The three follow different versions of Unicode, and ids must be those of `tokenizers`.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    every = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    low = normalizers.Lowercase().normalize_str("\n".join(every)).split("\n")
    low = low[:10] + ["\n"] + low[12:]  # the line break itself lies between two
    lower = {ord(x): y for x, y in zip(every, low, strict=True) if x.lower() != y}
    ours = regex.findall(r"[\p{L}\p{N}]", "".join(every))
    theirs = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True).pre_tokenize_str("".join(ours))
    return lower, sorted(set(ours) - {x for x, _ in theirs})


class Coder:
    """Text to ids and back, for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"].get("pretokenizers", [{}])
        if spec["normalizer"].get("normalizers") != _NORMAL or len(split) != 2 or split[1] != _LEVEL or split[0].get("behavior") != "Removed" or not split[0].get("invert"):
            raise ValueError(f"normalizer or splitting of {path} isn't covered")
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or spec["decoder"] or model.get("ignore_merges"):
            raise ValueError(f"model or decoder of {path} isn't covered")
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pattern = split[0]["pattern"]["Regex"]
        self.lower, newer = _differences()
        cut = f"[{''.join(newer)}]"
        self.usual, self.newer = regex.compile(pattern), regex.compile(cut) if newer else None
        # the same for texts of Latin-1, on its bytes: all of them are in NFC, and lower-cased by a table
        shown = {k: "".join(f"\\x{b:02x}" for b in range(256) if regex.match(k, chr(b))) for k in (r"\p{L}", r"\p{N}", r"\s")}
        self.low = bytes(ord(chr(b).lower()) for b in range(256))
        self.latin = re.compile(regex.sub(r"(\[\^?)?(\\p\{[LN]\}|\\s)", lambda x: f"{x.group(1) or ''}{shown[x.group(2)]}", pattern).encode("ascii"))
        self.careful = regex.compile(regex.sub(r"\\p\{[LN]\}", lambda x: f"[{x.group()}--{cut}]", pattern), regex.V1) if newer else None
        chars = _char_of_byte()
        self.inner, self.last = np.array([vocab[x] for x in chars]), np.array([vocab[x + end] for x in chars])
        ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.merges = Merges(ranks)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        known = {i: x for x, i in vocab.items()} | {i: x for x, i in self.special.items()}
        self.token = [known.get(i) for i in range(max(known) + 1)]
        self.memo: dict[str | bytes, bytes] = {}

    def normal(self, text: str) -> str:
        """NFC, white space to blanks, every character lower-cased on its own (a sigma at a word's end too)."""
        return unicodedata.normalize("NFC", text).translate(self.lower).replace("Σ", "σ").lower()

    def split(self, text: str) -> list[str] | list[bytes]:
        """Pre-tokens of a text without special tokens: characters, or bytes of Latin-1 if it has no others."""
        try:
            return self.latin.findall(text.encode("latin-1").translate(self.low))
        except UnicodeEncodeError:
            text = self.normal(text)
            return (self.careful if self.newer and self.newer.search(text) else self.usual).findall(text)

    def learn(self, pieces: list[str | bytes]) -> dict[str | bytes, bytes]:
        """The ids of distinct pre-tokens as little-endian 32-bit numbers."""
        out, sizes = {}, {}
        for piece in pieces:
            raw = (piece.decode("latin-1") if isinstance(piece, bytes) else piece).encode("utf-8", "surrogatepass")
            sizes.setdefault(max(2, (len(raw) - 1).bit_length()) if len(raw) <= SHORT else 0, []).append((piece, raw))
        for bits, held in sizes.items():
            if not bits:
                for piece, raw in held:
                    out[piece] = np.array(self.merges.one(self.inner[np.frombuffer(raw, np.uint8)[:-1]].tolist() + [int(self.last[raw[-1]])]), dtype="<u4").tobytes()
                continue
            for s in range(0, len(held), TOGETHER):
                some = held[s : s + TOGETHER]
                length = np.array([len(raw) for _, raw in some])
                x = np.frombuffer(b"".join(raw.ljust(1 << bits, b"\0") for _, raw in some), np.uint8).reshape(len(some), 1 << bits)
                place = np.arange(1 << bits)
                x = np.where(place < length[:, None] - 1, self.inner[x], np.where(place == length[:, None] - 1, self.last[x], -1))
                x = self.merges.many(x)
                kept = x >= 0
                ids, ends = x[kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(axis=1)) * 4).tolist()
                at = 0
                for (piece, _), end in zip(some, ends, strict=True):
                    out[piece] = ids[at:end]
                    at = end
        return out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; pre-tokens that aren't known yet are merged together."""
        parts: list[list] = []
        for text in texts:
            own: list = []
            at = 0
            for mark in self.marks.finditer(text) if self.marks else ():
                own += self.split(text[at : mark.start()])
                own.append(self.special[mark.group()])
                at = mark.end()
            parts.append(own + self.split(text[at:]) if at else self.split(text))
        if len(self.memo) > MEMO:
            self.memo.clear()
        fresh = {x for own in parts for x in own}.difference(self.memo)
        made = self.learn([x for x in fresh if not isinstance(x, int)]) | {x: np.array([x], "<u4").tobytes() for x in fresh if isinstance(x, int)}
        long = {x: y for x, y in made.items() if not isinstance(x, int) and len(x) > MEMO_LENGTH}
        self.memo |= {x: y for x, y in made.items() if x not in long}
        get = self.memo.__getitem__ if not long else lambda x: long[x] if x in long else self.memo[x]
        return [np.frombuffer(b"".join(map(get, own)), dtype="<u4") for own in parts]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings, joined by blanks; ids without a token are left out."""
        try:
            return " ".join(map(self.token.__getitem__, ids.tolist()))
        except (TypeError, IndexError):
            return " ".join(x for i in ids.tolist() if 0 <= i < len(self.token) and (x := self.token[i]) is not None)


@lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    return Coder(path)


Rows = Iterator[tuple[int | None, object]]


def _rows(batches: Iterator[pa.RecordBatch], column: str) -> Rows:
    for b in batches:
        values = b[column]
        for i, key in enumerate(b["doc_id"].to_pylist()):
            x = values[i]
            yield key, (x.values.to_numpy() if pa.types.is_list(x.type) and x.is_valid else x.as_py())


def _put(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size) -> Iterator[pa.RecordBatch]:
    """Batches of rows, each of about GROUP by `size`."""
    held: list[tuple] = []
    n = 0
    for row in rows:
        held.append(row)
        n += 64 + size(row)
        if n > GROUP:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def _encoded(model: Coder, rows: Rows) -> Iterator[tuple[int | None, np.ndarray]]:
    keys: list[int | None] = []
    texts: list[str] = []
    n = 0
    for key, text in rows:
        keys.append(key)
        texts.append(text or "")
        n += 100 + len(texts[-1])
        if n > GROUP:
            yield from zip(keys, model.encode_all(texts), strict=True)
            keys, texts, n = [], [], 0
    yield from zip(keys, model.encode_all(texts), strict=True)


def _decoded(model: Coder, rows: Iterator[tuple[int | None, np.ndarray]]) -> Iterator[tuple[int | None, np.ndarray, str]]:
    for key, ids in rows:
        ids = np.zeros(0, "<u4") if ids is None else ids
        yield key, ids, model.decode(ids)


def _keyed(docs: DataFrame, column: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), column)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) per row of `docs` (doc_id, text), whole texts.

    A null text counts as empty and has no ids; a null doc_id stays null; rows that repeat give a row each; an empty
    table gives no rows; other columns are ignored.
    """
    path = model or default_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _put(_encoded(coder(path), _rows(batches, "text")), ["doc_id", "ids"], [pa.int64(), pa.list_(pa.int32())], lambda r: len(r[1]))

    return _keyed(docs, "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) per row of `rows` (doc_id, ids); null ids count as none. Edge cases as `encode`."""
    path = model or default_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _decoded(coder(path), _rows(batches, "ids"))
        yield from _put(((key, text) for key, _, text in made), ["doc_id", "text"], [pa.int64(), pa.string()], lambda r: len(r[1]))

    return _keyed(rows, "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts encoded and decoded as above in one pass.

    ids_sha256 is that of the ids as little-endian 32-bit numbers, decoded_sha256 that of the decoded text in UTF-8.
    Edge cases as `encode`.
    """
    path = model or default_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _decoded(coder(path), _encoded(coder(path), _rows(batches, "text")))
        rows = ((key, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest()) for key, ids, text in both)
        yield from _put(rows, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.int64(), pa.string(), pa.string()], lambda r: 160)

    return _keyed(docs, "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
