"""Personal data: exact patterns, and a character-level BiLSTM-CRF for what is written otherwise.

The patterns give the base spans. The tagger reads every text from its first to its last character: overlapping
windows of fixed length are scored together, each character's scores are averaged over the windows that cover
it, weighted towards their middles, and one Viterbi pass over the whole stretch decides, so that windows can't
disagree. Stretches end where the tagger has been sure for long that there is nothing; there the path without
spans is the best one. The tagger decides what is a span and of which kind; what it decodes is only checked
lightly (an address names its at sign and a dot, numbers have as many digits as their kind and a card its check
digit) and is left out where it touches a match of a pattern, dropped ones included.

The weights lie beside this module, with the record of their training: `train_tagger` fits them in numpy on
labelled spans, those that the patterns find in documents and invented ones written into the documents' prose,
with dates, versions, amounts and keys as counter-examples. Held-out documents take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm import bilstm
from vellum.llm.common import tidy

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

WEIGHTS = Path(__file__).with_name("tagger.npz")
#: Characters of a window at most, and those that neighbouring ones share at least.
WINDOW = 384
SHARED = 48
#: Windows scored at once, and characters of texts read together.
COLUMNS = 1024
GROUP = 2_000_000
#: Characters on both sides of anything doubtful that are decoded with it.
SURE = 48
#: Windows are put together where a span would pay in one of them, were it worth so much more.
WARY = 1.0

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
# a match can't start inside a run of digits: where its first digit fails, so do the others
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches; each holds one at sign, so they are found from those, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_END.match(text[start - 1]):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, matches that their rule dropped, but for card matches with too few digits)."""
    good: list[Span] = []
    bad: list[Span] = []
    if "@" in text:
        good += [("email", a, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            (good if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")) else bad).append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if len(digits) >= 12:
                (good if len(digits) <= 19 and luhn(digits) else bad).append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                n = len(re.sub(r"[^0-9]", "", m.group()))
                (good if 9 <= n <= 15 else bad).append(("phone", *m.span()))
    return ordered(good), bad


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- the tagger

TAGS = ("O", *(f"{x}-{k}" for k in KINDS for x in "BI"))
SHOWN = "abcdefghijklmnopqrstuvwxyz@.+-()[]_%,:;/#$&*!?=\"' \n"
NUMBER, OTHER, PAD = len(SHOWN), len(SHOWN) + 1, len(SHOWN) + 2
_TABLE = np.full(128, OTHER, dtype=np.int16)
for _i, _c in enumerate(SHOWN):
    _TABLE[ord(_c)] = _i
    _TABLE[ord(_c.upper())] = _i
_TABLE[ord("0") : ord("9") + 1] = NUMBER


def encode(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 128, _TABLE[np.minimum(codes, 127)], np.int16(OTHER))


class Writer:
    """Invented text with labelled spans."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, *options: str) -> str:
        return options[int(self.rng.integers(len(options)))]

    def digits(self, n: int) -> str:
        return "".join(map(str, self.rng.integers(0, 10, n)))

    def word(self) -> str:
        w = "".join(self.pick("an", "er", "th", "on", "re", "in", "ou", "st", "ti", "ch", "le", "qu", "é", "ü", "o", "s", "ja", "de", "ma", "bo", "ki", "pe", "vi", "wa", "zu", "fo", "gy", "mp", "x", "l", "d") for _ in range(int(self.rng.integers(1, 5))))
        return w.capitalize() if self.rng.random() < 0.15 else w

    def plain(self) -> str:
        r = self.rng.random()
        if r < 0.72:
            return self.word() + self.pick("", "", "", "", ",", ".", ":", "###", "!!", "$$$")
        n = lambda a, b: self.digits(int(self.rng.integers(a, b)))
        return self.pick(
            f"20{n(2, 3)}-{n(2, 3)}-{n(2, 3)}", f"{n(1, 3)}/{n(1, 3)}/20{n(2, 3)}", f"v{n(1, 2)}.{n(1, 3)}.{n(1, 3)}", f"{n(1, 4)}.{n(2, 3)}", f"{n(1, 7)}", f"${n(1, 4)},{n(3, 4)}",
            f'"{n(3, 9)}ab{n(2, 9)}f{n(3, 9)}"', f"{n(20, 26)}", f"{n(7, 10)}", f"{n(1, 3)}.{n(1, 3)}.", f"p. {n(1, 4)}-{n(1, 4)}", f"@{self.word()}", "dot", "at", f"at {self.word()}. {self.word().capitalize()}", f"at {self.word()}. {self.word()}", f"{n(2, 3)}:{n(2, 3)}:{n(2, 3)}", f"#{n(5, 9)}",
        )

    def private(self) -> tuple[str, str]:
        kind = self.pick(*KINDS)
        d = self.digits
        if kind == "email":
            name = self.pick("", f"{self.word()}.", f"{self.word()}_") + self.word() + self.pick("", d(2))
            host, end = self.word() + self.pick("", d(1)), self.pick("com", "org", "net", "example", "edu", "io")
            at, dot = self.pick("@ .", "@ .", " at | dot ", " (at) | (dot) ", " [at] | [dot] ", " @ | . ", "(at)|(dot)", " at |.", " (at) |.", " [at] |.", "(at)|.", "[at]|.").replace("@ .", "@|.").split("|")
            return kind, f"{name}{at}{host}{dot}{end}"
        if kind == "ip":
            sep = self.pick(".", ".", "[.]", " . ", "(.)")
            return kind, sep.join(str(x) for x in self.rng.integers(0, 256, 4))
        if kind == "card":
            sep = self.pick("", " ", "-", ".", "/", "  ")
            raw = self.pick("4", "5", "6") + d(15)
            return kind, sep.join(raw[i : i + 4] for i in range(0, 16, 4))
        return kind, self.pick(f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(3)} {d(3)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"00{d(2)} {d(2)} {d(4)} {d(4)}", f"({d(3)}){d(3)}-{d(4)}")


@lru_cache(maxsize=1)
def tagger() -> dict[str, np.ndarray]:
    with np.load(WEIGHTS) as held:
        return {k: held[k] for k in held.files if k != "record"}


def windows(n: int) -> list[tuple[int, int]]:
    """(start, length) of the overlapping windows that cover a text of n characters: as few as will do, of one length, evenly spread."""
    if n <= WINDOW:
        return [(0, n)]
    many = -(-(n - SHARED) // (WINDOW - SHARED))
    length = -(-(n + (many - 1) * SHARED) // many)
    return [(i * (n - length) // (many - 1), length) for i in range(many)]


@lru_cache(maxsize=WINDOW + 1)
def _weight(length: int) -> np.ndarray:
    return (1 + np.minimum(np.arange(length), np.arange(length)[::-1])).astype(np.float32)[:, None]


def _gain(e: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """What the best run of tags that ends at each position gains on no span, at most, beyond what beginning and ending it costs.

    e has positions first and tags second. Where nothing is above 0 the path without spans is the best one.
    """
    a, none = model["A"], model["A"][0, 0]
    inner = a[1:, 1:].max() - none
    cost = 2 * none - a[0, 1:].max() - a[1:, 0].max() + inner
    best = reduce(np.maximum, (e[:, k] for k in range(1, e.shape[1])))
    total = np.cumsum(best - e[:, 0] + inner, axis=0)
    before = np.minimum.accumulate(np.concatenate([np.zeros_like(total[:1]), total[:-1]]), axis=0)
    return total - before - cost


def doubtful(gain: np.ndarray, cost: float) -> list[tuple[int, int]]:
    """Stretches of positions where a run of tags can pay, from where it may begin, widened and merged."""
    out: list[list[int]] = []
    for end in np.flatnonzero(gain > 0).tolist():
        if out and end < out[-1][1]:
            continue
        begin = end
        while begin > 0 and gain[begin - 1] > -cost:
            begin -= 1
        after = np.flatnonzero(gain[end:] <= -cost)
        a, b = max(0, begin - SURE), min(len(gain), end + (int(after[0]) if len(after) else len(gain) - end) + SURE)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scored(codes: list[np.ndarray], model: dict[str, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(text, tag scores of its characters) of the texts with anything doubtful."""
    cut = [windows(len(x)) if len(x) else [] for x in codes]
    order = sorted((k for k, x in enumerate(codes) if len(x)), key=lambda k: (cut[k][0][1], k))  # windows of like length together
    todo: list[tuple[int, int, int]] = []

    def run(part: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(text, start, length, scores) of windows; all of a text's, or none where nothing is doubtful in these."""
        wide = -(-len(part) // 64) * 64  # whole blocks, so that a window is computed alike in any company
        ids = np.full((max(n for *_, n in part), wide), PAD, dtype=np.int64)
        for c, (k, start, n) in enumerate(part):
            ids[:n, c] = codes[k][start : start + n]
        e = bilstm.emissions(model, ids)
        some = {part[c][0] for c in np.flatnonzero(bilstm.pays(e, model["A"], WARY)[: len(part)])}
        mine = [c for c, (k, *_) in enumerate(part) if k in some]
        for c, x in zip(mine, np.ascontiguousarray(e[:, :, mine].transpose(2, 0, 1)), strict=True):
            k, start, n = part[c]
            yield k, start, n, x[:n]

    def whole(parts: Iterable[tuple[int, int, int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, start, n, e in parts:
            if k not in sums:
                sums[k] = np.zeros((len(codes[k]), len(TAGS)), np.float32), np.zeros((len(codes[k]), 1), np.float32)
            sums[k][0][start : start + n] += e * _weight(n)
            sums[k][1][start : start + n] += _weight(n)
        for k, (total, weight) in sums.items():
            if not weight.all():  # a long text's windows elsewhere were sure
                total[weight[:, 0] == 0, 0] = 100.0
                weight[weight == 0] = 1
            yield k, total / weight

    for k in order:
        mine = [(k, a, n) for a, n in cut[k]]
        if todo and len(todo) + len(mine) > COLUMNS:
            yield from whole(run(todo))
            todo = []
        if len(mine) > COLUMNS:
            yield from whole(x for i in range(0, len(mine), COLUMNS) for x in run(mine[i : i + COLUMNS]))
        else:
            todo += mine
    if todo:
        yield from whole(run(todo))


def tag_spans(texts: list[str], model: dict[str, np.ndarray]) -> list[list[Span]]:
    """Spans that the tagger decodes in each text, before any check."""
    found: list[list[Span]] = [[] for _ in texts]
    jobs = []
    cost = 2 * model["A"][0, 0] - model["A"][0, 1:].max() - model["A"][1:, 0].max() + model["A"][1:, 1:].max() - model["A"][0, 0]
    for k, e in _scored([encode(t) for t in texts], model):
        jobs += [(k, a, e[a:b].copy()) for a, b in doubtful(_gain(e, model), float(cost))]
    jobs.sort(key=lambda j: len(j[2]))
    at = 0
    while at < len(jobs):
        end = at + 1
        while end < len(jobs) and (end + 1 - at) * len(jobs[end][2]) <= 100_000:
            end += 1
        part, at = jobs[at:end], end
        sizes = np.array([len(x) for *_, x in part])
        e = np.zeros((int(sizes.max()), len(part), len(TAGS)), np.float32)
        for c, (*_, x) in enumerate(part):
            e[: len(x), c] = x
        tags = bilstm.viterbi(e, sizes, model["A"])
        for c in np.flatnonzero(tags.any(axis=0)):
            k, first, _ = part[c]
            start, kind = -1, 0
            for i, t in enumerate([*tags[: sizes[c], c].tolist(), 0]):
                if start >= 0 and t != kind + 1:
                    found[k].append((TAGS[kind][2:], first + start, first + i))
                    start = -1
                if t and t % 2:
                    start, kind = i, t
    return found


_AT, _DOT = re.compile(r"@|\bat\b", re.I), re.compile(r"\.|\bdot\b", re.I)


#: What makes numbers that follow it an order's, a part's or a version's, in four languages.
_OTHERWISE = re.compile(r"\b(?:sku|order|part|item|invoice|reference|ref|serial|version|ver|release|isbn|artikel|bestellung|bestell|auftrag|rechnung|teil|serien|commande|facture|article|pedido|factura|versión|serie|artículo)(?:s|nummer|number)?[ .:#-]*(?:(?:no|nr|num|number|nummer|numéro|número|id|code)\b|n[°º])?[ .:#-]*$", re.I)
#: A name that could be no plain word of a sentence.
_NAMELIKE = re.compile(r"[0-9._%+-]")


def plausible(kind: str, part: str, before: str = "") -> bool:
    """The light check of what the tagger has decoded, in view of what stands before it.

    "at" as a bare word before a host with a literal dot is mostly a place ("available at example.com"): the word before
    it must then hold a digit or a sign, as few words of a sentence do, and the host mustn't begin with www.
    """
    if kind == "email" and (at := re.search(r"[ \t\n]at[ \t\n]+", part, re.I)) and "@" not in part and "." in part[at.end() :]:
        if not _NAMELIKE.search(part[: at.start()].rstrip("._%+- ")) or part[at.end() :].lower().startswith("www."):
            return False
    if kind != "email" and _OTHERWISE.search(before):
        return False
    numbers = re.findall(r"[0-9]+", part)
    digits = "".join(numbers)
    if kind == "email":
        at = _AT.search(part, 1)
        return bool(at) and bool(_DOT.search(part, at.end() + 1)) and part[0].isalnum() and part[-1].isalnum()
    if re.search(r"[^\W\d_]", _DOT.sub("", part)) or "\n" in part:
        return False
    if kind == "ip":
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def trimmed(text: str, kind: str, a: int, b: int) -> tuple[int, int]:
    """[a, b) without what isn't a letter or digit at its ends, but for an opening bracket before digits; an address begins with one word."""
    if kind == "email" and (at := _AT.search(text, a + 1, b)):
        name = text[a : at.start()].rstrip(" \t([{<")
        a += max(map(name.rfind, " \t\n")) + 1
    while a < b and not (text[a].isalnum() or text[a] in "(+" and a + 1 < b and text[a + 1].isdigit()):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    return a, b


def all_spans(texts: list[str], model: dict[str, np.ndarray]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    out, held, cuts = [], 0, [0]
    for i, text in enumerate(texts):
        if held and held + len(text) > GROUP:
            cuts.append(i)
            held = 0
        held += len(text)
    tagged_spans = chain.from_iterable(tag_spans(texts[a:b], model) for a, b in pairwise([*cuts, len(texts)]))
    for text, tagged in zip(texts, tagged_spans, strict=True):
        base, dropped = matches(text)
        taken = [(a, b) for _, a, b in [*base, *dropped]]
        added = []
        for kind, a, b in tagged:
            a, b = trimmed(text, kind, a, b)
            if a < b and plausible(kind, text[a:b], text[max(0, a - 40) : a]) and not any(a < y and x < b for x, y in taken):
                added.append((kind, a, b))
                taken.append((a, b))
        out.append((base, ordered([*base, *added])))
    return out


# ---- queries

_COLUMNS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (of the base spans), base_sha256, spans, n_added.

    A null text counts as empty: no spans, the hash of nothing. Rows that repeat are repeated, doc_id may be
    null, an empty table gives no rows, other columns are ignored. Texts are read whole.
    """
    model = tagger()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = all_spans([t or "" for t in b["text"].to_pylist()], model)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in spans], pa.int64()) for k in KINDS]
            shas = pa.array([hashlib.sha256(told(base).encode()).hexdigest() for base, _ in spans], pa.string())
            full = pa.array([told(every) for _, every in spans], pa.string())
            extra = pa.array([len(every) - len(base) for base, every in spans], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], *counts, shas, full, extra], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _COLUMNS)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or what overlapping ones cover together, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame) -> DataFrame:
    """`docs` with personal data masked in `text`; null stays null, other columns pass through."""
    model = tagger()
    at = docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].to_pylist()
            clean = [None if t is None else masked(t, every) for t, (_, every) in zip(texts, all_spans([t or "" for t in texts], model), strict=True)]
            yield b.set_column(at, "text", pa.array(clean, b.schema.field("text").type))

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
