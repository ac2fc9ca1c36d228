"""Sampled segmentation into SentencePiece pieces: forward filtering, backward sampling.

All ways of writing a text as pieces form a lattice. Pieces have Zipf weights by their rank, as the model
file holds ranks and no probabilities. Filtering forwards sums, at each position, the weights of all ways
to get there; sampling backwards then draws, from the end, each piece with exactly its share of that sum,
so a segmentation comes up in proportion to its weight. The draws are a hash of the row's key and the
position, so that a row is segmented alike in every run, on every machine.

No piece crosses from text into a following space, or holds a line break, so the lattice falls apart into
short stretches. Those are filtered once per worker and sampled together, a step for all at a time.
Characters without a piece are written as bytes, and spaces as themselves: decoding gives the same text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import tidy

#: Characters of stretches that a worker remembers before it starts anew.
MEMO = 3_000_000
#: Characters of text whose stretches are sampled together.
GROUP = 2_000_000
#: Stretches beyond so many characters (of ASCII, of any) are filtered on their own; others together, so many characters at once.
LONG, SHORT = 32, 16
DENSE = 60_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
STRETCH = re.compile(r"\n| *[^ \n]+| +")
_U64 = np.uint64


def default_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Lattices:
    """Filtered lattices of stretches, kept in flat arrays that sampling searches.

    Each position of a stretch is a node. The edges into a node lie side by side, longest piece first, with
    their cumulated shares of the node's weight, the last of which is one: a draw u picks the first edge
    whose share is above u. Shares depend on the stretch alone, not on what else is held.
    """

    def __init__(self, path: str, power: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        self.weight: dict[str, tuple[float, int]] = {}
        self.byte_id = [0] * 256
        plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: -model.get_score(i)))}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif i in rank:
                text = piece.replace("▁", " ")
                self.bytes.append(text.encode())
                if re.fullmatch(r" *[^ \n]*", text):
                    self.weight[text] = ((rank[i] + 10.0) ** -power, i)
            else:
                self.bytes.append(b"")
        self.low = (len(rank) + 10.0) ** -power  # of each byte of a character without a piece
        self.longest = max(map(len, self.weight))
        self.spelling = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.spelt = np.array([len(x) for x in self.bytes], dtype=np.int64)
        self.spelt_at = np.cumsum(self.spelt) - self.spelt
        self._plant()
        self.clear()

    def _plant(self) -> None:
        """The trie of the pieces: a state per prefix, and a hash table from (state, character) to the next state."""
        chars = sorted(set("".join(self.weight)))
        self.char = np.zeros(0x110000, dtype=np.int32)  # of each code point; 0: in no piece
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.kinds = len(chars) + 1
        number = {c: i for i, c in enumerate(chars, 1)}
        states, edges = {"": 0}, {}
        for text in self.weight:
            for n in range(1, len(text) + 1):
                if text[:n] not in states:
                    edges[states[text[: n - 1]] * self.kinds + number[text[n - 1]]] = states[text[:n]] = len(states)
        self.piece_of, self.weight_of = np.full(len(states), -1, dtype=np.int32), np.zeros(len(states))
        for text, (w, i) in self.weight.items():
            self.piece_of[states[text]], self.weight_of[states[text]] = i, w
        keys, to = (np.array(list(x), dtype=np.int64) for x in (edges.keys(), edges.values()))
        self.inner = np.zeros(len(states), dtype=bool)
        self.inner[keys // self.kinds] = True
        bits = len(keys).bit_length() + 2
        self.shift, self.cells = _U64(64 - bits), 1 << bits
        self.cell_key, self.cell_to = np.full(self.cells + 64, -1, dtype=np.int64), np.full(self.cells + 64, -1, dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.cell_key[slot] < 0)
            _, own = np.unique(slot[free], return_index=True)
            put = free[own]
            self.cell_key[slot[put]], self.cell_to[slot[put]] = keys[put], to[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, to, slot = keys[rest], to[rest], slot[rest] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(_U64) * _BASE) >> self.shift).astype(np.int64)

    def _next(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The state after each state's character, -1 for none."""
        keys = state * np.int64(self.kinds) + char
        slot = self._slot(keys)
        there = self.cell_key[slot]
        out = np.where(there == keys, self.cell_to[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slot[open_] += 1
            there = self.cell_key[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.cell_to[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.nodes = self.edges = 0
        self.base, self.length = _Grown(np.int64), _Grown(np.int64)
        self.share, self.prev, self.piece = _Grown(np.float64), _Grown(np.int32), _Grown(np.int32)
        self.first = _Grown(np.int64)  # of each node: the first edge into it

    def _unknown(self, c: str) -> tuple[float, int]:
        """Weight and id of a character without a piece: its byte's, or minus one minus its code point for several."""
        data = c.encode("utf-8", "surrogatepass")
        return self.low ** len(data), self.byte_id[data[0]] if len(data) == 1 else -1 - ord(c)

    def _filter_long(self, stretch: str) -> tuple[np.ndarray, ...]:
        """(edges into each node, shares, previous positions, pieces) of one stretch, position by position."""
        n, weight = len(stretch), self.weight
        alpha = [1.0] + [0.0] * n
        many, share, prev, piece = [0], [], [], []
        for i in range(1, n + 1):
            total, before = 0.0, len(share)
            for j in range(max(0, i - self.longest), i):
                if (w := weight.get(stretch[j:i])) is not None:
                    total += alpha[j] * w[0]
                    share.append(total)
                    prev.append(j)
                    piece.append(w[1])
            if len(prev) == before or prev[-1] != i - 1:
                w, p = self._unknown(stretch[i - 1])
                total += alpha[i - 1] * w
                share.append(total)
                prev.append(i - 1)
                piece.append(p)
            share[before:] = [x / total for x in share[before:-1]] + [1.0]
            many.append(len(share) - before)
            alpha[i] = total
            if total < 1e-150:  # only ratios within reach of a piece matter
                for j in range(max(0, i - self.longest), i + 1):
                    alpha[j] *= 1e150
        return np.array(many, np.int64), np.array(share), np.array(prev, np.int32), np.array(piece, np.int32)

    def _filter(self, stretches: list[str]) -> tuple[np.ndarray, ...]:
        """The same for many short stretches of falling length together, a position and a length of all at a time.

        Weights flow from each position to those that a piece reaches from it; what a position holds after an
        edge has come in is that edge's cumulated share, as edges come in longest piece first.
        """
        sizes = np.array([len(x) for x in stretches], dtype=np.int64)
        wide, high = len(stretches), len(stretches[0])
        rows, columns = _places(sizes)
        code = np.zeros((high, wide), dtype=np.uint32)
        code[rows, columns] = _codes("".join(stretches))
        alive = np.searchsorted(-sizes, -np.arange(1, high + 1), side="right").tolist()  # stretches longer than each position
        char = self.char[code]
        begin = self._next(np.zeros(wide * high, dtype=np.int64), char.ravel()).reshape(high, wide)
        single = np.where(begin >= 0, self.piece_of[begin], -1)
        weight = np.where(single >= 0, self.weight_of[begin], 0.0)
        bare = np.flatnonzero(single.ravel() < 0)
        if len(bare):
            kinds, which = np.unique(code.ravel()[bare], return_inverse=True)
            of = [self._unknown(chr(c)) for c in kinds.tolist()]
            single.ravel()[bare] = np.array([p for _, p in of], dtype=np.int32)[which]
            weight.ravel()[bare] = np.array([w for w, _ in of])[which]
        alpha, seen = np.zeros((high + 1, wide)), np.zeros((high + 1, wide), dtype=np.int32)
        alpha[0] = 1.0
        made: list[tuple[np.ndarray, ...]] = []
        begin[begin < 0] = 0  # the root has children: told apart by `going`
        going = self.inner[begin] & (begin > 0)
        every = np.arange(wide)
        for p in range(high):
            many = alive[p]
            here = alpha[p]

            def carry(to: int, who: np.ndarray, w: np.ndarray, piece: np.ndarray, p=p, here=here) -> None:
                row, count = alpha[to], seen[to]
                row[who] += here[who] * w
                made.append((to * wide + who, count[who], row[who], np.full(len(who), p, dtype=np.int32), piece))
                count[who] += 1

            carry(p + 1, every[:many], weight[p, :many], single[p, :many])
            who = np.flatnonzero(going[p, :many])
            state = begin[p, who]
            for n in range(2, min(self.longest, high - p) + 1):
                left = int(np.searchsorted(who, alive[p + n - 1]))
                who, state = who[:left], state[:left]
                if not left:
                    break
                state = self._next(state, char[p + n - 1, who])
                on = np.flatnonzero(state >= 0)
                who, state = who[on], state[on]
                piece = self.piece_of[state]
                whole = np.flatnonzero(piece >= 0)
                if len(whole):
                    carry(p + n, who[whole], self.weight_of[state[whole]], piece[whole])
                on = np.flatnonzero(self.inner[state])
                who, state = who[on], state[on]
        at, nth, share, prev, piece = (np.concatenate(x) for x in zip(*made, strict=True))
        share = share / alpha.ravel()[at]
        many = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        many[first[columns] + rows + 1] = seen[rows + 1, columns]
        node = first[at % wide] + at // wide
        spot = (np.cumsum(many) - many)[node] + nth
        out = np.empty(len(at)), np.empty(len(at), dtype=np.int32), np.empty(len(at), dtype=np.int32)
        for held, x in zip(out, (share, prev, piece), strict=True):
            held[spot] = x
        return many, *out

    def add(self, stretches: Iterable[str]) -> None:
        """Filters stretches that aren't held yet."""
        falling = sorted(stretches, key=len, reverse=True)
        # so few characters have a weight above the least number even as bytes; others are kept in range one by one
        alone = [x for x in falling if len(x) > SHORT and not (len(x) <= LONG and x.isascii())]
        short = falling if not alone else [x for x in falling if len(x) <= SHORT or len(x) <= LONG and x.isascii()]
        sizes = np.fromiter(map(len, chain(alone, short)), np.int64, len(falling))
        self.ids.update(zip(chain(alone, short), range(self.base.n, self.base.n + len(falling))))
        self.base.add(self.nodes + np.cumsum(sizes + 1) - sizes - 1)
        self.length.add(sizes)
        for x in alone:
            self._hold(*self._filter_long(x))
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes[len(alone) :]) // DENSE)) + 1
        for x, y in pairwise([0, *cuts.tolist(), len(short)]):
            if x < y:
                self._hold(*self._filter(short[x:y]))

    def _hold(self, many: np.ndarray, share: np.ndarray, prev: np.ndarray, piece: np.ndarray) -> None:
        self.first.add(self.edges + np.cumsum(many) - many)
        self.share.add(share)
        self.prev.add(prev)
        self.piece.add(piece)
        self.nodes += len(many)
        self.edges += len(share)


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.n = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            grown = np.empty((self.n + len(more)) * 3 // 2, self.held.dtype)
            grown[: self.n] = self.held[: self.n]
            self.held = grown
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)

    def now(self) -> np.ndarray:
        return self.held[: self.n]


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, stretch) of each character of stretches of such sizes, written one after the other."""
    columns = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(columns)) - np.repeat(np.cumsum(sizes) - sizes, sizes), columns


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@lru_cache(maxsize=2)
def lattices(path: str, power: float) -> Lattices:
    return Lattices(path, power)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit splittable generator."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def sample(model: Lattices, texts: list[str], seeds: list[int]) -> list[np.ndarray]:
    """Piece ids of one sampled segmentation per text; a character without a piece is its bytes' ids."""
    if model.nodes > MEMO:
        model.clear()
    owned = [STRETCH.findall(t) for t in texts]
    parts = list(chain.from_iterable(owned))
    if new := set(parts).difference(model.ids):
        model.add(new)
    which = np.fromiter(map(model.ids.__getitem__, parts), np.int64, len(parts))
    counts = np.fromiter(map(len, owned), np.int64, len(owned))
    share, prev, piece, entry, base, length = (x.now() for x in (model.share, model.prev, model.piece, model.first, model.base, model.length))
    first = np.cumsum(counts) - counts
    nth = (np.arange(len(which)) - np.repeat(first, counts)).astype(np.uint64)
    state = _mix(np.repeat(np.array(seeds, dtype=np.uint64), counts) + nth * _U64(0x9E3779B97F4A7C15))
    at, bottom = length[which], base[which]
    open_, steps = np.arange(len(which)), []
    taken = np.zeros(len(which), dtype=np.int64)
    step = 0
    while len(open_):
        u = (_mix(state + _U64((step + 1) * 0xD1342543DE82EF95 % 2**64)) >> _U64(11)).astype(np.float64) * 2.0**-53
        edge = entry[bottom + at]
        behind = np.flatnonzero(share[edge] <= u)
        while len(behind):
            edge[behind] += 1
            behind = behind[share[edge[behind]] <= u[behind]]
        steps.append((open_, piece[edge]))
        taken[open_] += 1
        at = prev[edge]
        on = np.flatnonzero(at > 0)
        open_, at, bottom, state = open_[on], at[on], bottom[on], state[on]
        step += 1
    start = np.cumsum(taken) - taken
    flat = np.empty(int(taken.sum()), dtype=np.int32)
    for k, (who, what) in enumerate(steps):
        flat[start[who] + taken[who] - 1 - k] = what
    ends = np.append(start, len(flat))
    out = [flat[ends[a] : ends[a + n]] for a, n in zip(first.tolist(), counts.tolist(), strict=True)]
    return [_spelt(model, x) if len(x) and x.min() < 0 else x for x in out]


def _spelt(model: Lattices, ids: np.ndarray) -> np.ndarray:
    """Replaces characters without a piece by the ids of their bytes."""
    out: list[int] = []
    for i in ids.tolist():
        out += [model.byte_id[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")] if i < 0 else [i]
    return np.array(out, dtype=np.int32)


def spell(model: Lattices, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes that the ids stand for, the end of each id among them)."""
    many = model.spelt[ids]
    ends = np.cumsum(many)
    return model.spelling[np.repeat(model.spelt_at[ids] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)], ends


def decode(model: Lattices, ids: np.ndarray) -> str:
    return spell(model, ids)[0].tobytes().decode("utf-8", "surrogatepass")


def segment(docs: DataFrame, model: str | None = None, power: float = 1.0, seed: int = 0, with_ids: bool = False) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_pieces, n_bytes, ids_crc32, lossless[, ids].

    The row's key is its doc_id: rows that repeat an id and a text are segmented alike, null is a key too.
    n_bytes counts byte pieces; ids_crc32 is that of the ids as little-endian 32-bit numbers; lossless says
    that decoding them gave the text. A null text counts as empty, an empty table gives no rows, other
    columns are ignored. Texts are segmented whole.
    """
    path = model or default_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(path, power)
        is_byte = np.zeros(len(lat.bytes), dtype=bool)
        is_byte[lat.byte_id] = True
        for b in batches:
            texts, keys = [t or "" for t in b["text"].to_pylist()], b["doc_id"].to_pylist()
            seeds = [xxhash.xxh64_intdigest(str(k), seed) for k in keys]
            cuts, held = [0], 0
            for i, t in enumerate(texts):
                held += len(t)
                if held > GROUP:
                    cuts.append(i + 1)
                    held = 0
            cuts.append(len(texts))
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a == z:
                    continue
                ids = sample(lat, texts[a:z], seeds[a:z])
                arrays = [
                    pa.array(keys[a:z], pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([decode(lat, x) == t for x, t in zip(ids, texts[a:z], strict=True)], pa.bool_()),
                ]
                names = ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "lossless"]
                if with_ids:
                    arrays.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, lossless boolean" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
