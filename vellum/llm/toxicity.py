"""Toxicity by maximum-scoring segments of token log-odds.

Training takes a bounded sample of labelled rows, near copies of one text counted once. Each token, and each
token's prefix of four or five letters (which covers inflected forms not seen before), gets a log-odds ratio
between toxic and other documents under an informative Dirichlet prior, the sample's own frequencies. Those
held by more toxic than other documents of the sample (a rule that keeps chance finds among the many common
tokens out) and significantly toxic by a z-test are kept; all other tokens share one slightly negative score.

A text is scanned once, in linear time, for all maximal scoring segments (the disjoint segments whose sums
no extension or shortening improves). Under the clean documents' distribution of token scores the best of
such sums follow an extreme-value law; its two parameters turn a segment's sum into the number of equally
good segments that chance would find in a clean text as long as the longest of the sample. Segments beyond
chance are the toxic passages.

The score is a logistic curve, fitted on sample rows that took no part in the log-odds, over one number: the
calibrated value of the toxic weight that all significant segments of a text hold together, or of its best
segment where that is more. Its weight is held at zero or more. A sum of the segments' own calibrated values would
fall where two segments grow into one, so weights are summed before they are calibrated. A text's segments lie
within those of any text that goes on from it, whose sums and weights are as large at least, and calibration
doesn't depend on a text's own length: so repeating a passage, or appending whatever text, never lowers a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import Scratch, tidy

#: Labelled rows that training takes at most: those with the smallest hashes of their ids.
MAX_TRAIN = 20_000
FOLDS = 5
PRIOR = 200.0
MIN_Z = 3.0
PREFIXES = (5, 4)
#: Expected number of equally good segments in a clean text up to which a segment is significant.
SIGNIFICANT = 0.05
#: Tokens whose scores a worker remembers before it starts anew.
MEMO = 200_000
#: Counts that a task of the training holds before it hands them on.
HELD = 200_000

WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The token itself, then its prefixes, most specific first."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def maximal_segments(scores: list[tuple[int, int, float]], rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, sum) of a sequence given by its nonneutral items.

    scores: (position, position after it, score > 0) in order; every position between them scores `rest` < 0.
    """
    # first, last, sum before it, sum up to it, and the nearest earlier entry with a smaller sum before it:
    # by these links no entry is passed over twice, which keeps the scan linear
    stack: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for start, stop, score in scores:
        before = total + (start - at) * rest
        total, at = before + score, stop
        first, left = start, before
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                break
            merged = j
            first, left, _, j = stack[merged][0], *stack[merged][2:]
            del stack[merged:]
        stack.append((first, stop - 1, left, total, j))
    return [(a, b, right - left) for a, b, left, right, _ in stack]


@dataclass
class Model:
    """weights: feature -> log-odds; rest: score of all other tokens; lam, k: extreme-value parameters; space: tokens of the text they are stated for."""

    weights: dict[str, float] = field(default_factory=dict)
    rest: float = -0.01
    lam: float = 1.0
    k: float = 0.1
    space: int = 1
    curve: tuple[float, float] = (0.0, 0.0)

    def __post_init__(self):
        self.memo = _Memo(self.weights)

    def __getstate__(self):
        return {n: getattr(self, n) for n in ("weights", "rest", "lam", "k", "space", "curve")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.memo = _Memo(self.weights)

    def bits(self, total: float) -> float:
        """Minus the log of the number of segments this good that chance finds in a clean text."""
        return self.lam * total - math.log(max(self.k * max(self.space, 1), 1e-9))

    def read(self, text: str | None) -> Reading:
        words = WORD.findall((text or "").lower())
        if len(self.memo) > MEMO:
            self.memo.clear()
        values = list(map(self.memo.__getitem__, words))
        if not any(values):
            return Reading([], [], 0.0, 0.0, len(words))
        hits = [(i, i + 1, v) for i, v in enumerate(values) if v]
        found = maximal_segments(hits, self.rest)
        good = [x for x in found if self.bits(x[2]) >= -math.log(SIGNIFICANT)]
        weight = math.fsum(v for a, b, _ in good for v in values[a : b + 1])
        return Reading(found, good, max(s for *_, s in found), weight, len(words))

    def evidence(self, reading: Reading) -> float:
        """Calibrated value, never below 0, of all significant segments together, or of the best one where that is more."""
        b = self.bits(max(reading.best, reading.weight))
        return max(b, 0.0) + math.log1p(math.exp(-abs(b))) if reading.found else 0.0

    def score(self, reading: Reading) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-min(max(a + b * self.evidence(reading), -30.0), 30.0)))

    def passages(self, text: str | None, reading: Reading) -> list[tuple[int, int, float]]:
        """(start, end, bits) in characters of the significant passages."""
        if not reading.good:
            return []
        lowered = text.lower()
        spans = [m.span() for m in WORD.finditer(text if len(lowered) == len(text) else lowered)]
        return [(spans[a][0], spans[min(b, len(spans) - 1)][1], self.bits(s)) for a, b, s in reading.good if a < len(spans)]


@dataclass
class Reading:
    """What a scan finds: all maximal segments in token positions, the significant ones, the best sum, the weight of toxic tokens in the latter."""

    found: list[tuple[int, int, float]]
    good: list[tuple[int, int, float]]
    best: float
    weight: float
    tokens: int


class _Memo(dict):
    """Token -> weight of its most specific kept feature, 0 for none."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = next((self.weights[f] for f in features(word) if f in self.weights), 0.0)
        self[word] = value
        return value


# ---- training


def signature(text: str | None) -> int:
    """Least hash of three-word shingles: equal for most near copies."""
    words = (text or "").split()
    h = xxhash.xxh64_intdigest
    return min((h(" ".join(x)) for x in zip(words, words[1:], words[2:], strict=False)), default=h(" ".join(words))) - (1 << 63)


def training_rows(docs: DataFrame, labels: DataFrame, scratch: Scratch, limit: int) -> DataFrame:
    """(doc_id, text, toxic, fold) of at most `limit` labelled rows, fold 1 to FOLDS - 1; fold 0 is held out."""
    own = labels.select(F.col("doc_id").alias("lid"), F.col("toxic").cast("int").alias("toxic")).where("lid is not null and toxic in (0, 1)")
    own = own.groupBy("lid").agg(F.max("toxic").alias("toxic"))
    fold = F.expr(f"cast(crc32(cast(cast(lid as string) as binary)) % {FOLDS} as int)")
    picked = own.withColumn("fold", fold).where("fold <> 0").orderBy(F.xxhash64("lid"), "lid").limit(limit)  # the bounded sample
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), F.col("doc_id") == F.col("lid"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs = pa.array([signature(t.as_py()) for t in b["text"]], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text"], b["toxic"], b["fold"], sigs], names=["doc_id", "text", "toxic", "fold", "sig"])

    signed = scratch.write(rows.select("doc_id", "text", "toxic", "fold").mapInArrow(run, "doc_id long, text string, toxic int, fold int, sig long"), "signed")
    firsts = signed.groupBy("sig", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return scratch.write(signed.join(firsts, ["sig", "toxic", "doc_id"], "left_semi").dropDuplicates(["doc_id"]), "train")


def _counts(train: DataFrame) -> dict[str, tuple[int, int]]:
    """Feature -> (toxic documents, other documents) that hold it, of the significant ones; "" has the totals."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
                held = {f for w in set(WORD.findall((text or "").lower())) for f in features(w)}
                seen[toxic].update(held)
                seen[toxic][""] += 1
        keys = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], names=["f", "c1", "c0"])

    sums = train.mapInArrow(run, "f string, c1 long, c0 long").groupBy("f").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
    return {r.f: (r.c1, r.c0) for r in sums.where("f = '' or c1 >= 3 and c1 > c0").collect()}  # of a bounded sample


def log_odds(c1: int, c0: int, n1: int, n0: int) -> tuple[float, float]:
    """Log-odds ratio and its standard error under the Dirichlet prior."""
    p = (c1 + c0 + 0.5) / (n1 + n0 + 1)
    a = PRIOR * p
    odds = lambda c, n: math.log((c + a) / (n + PRIOR - c - a + 1e-9))
    return odds(c1, n1) - odds(c0, n0), math.sqrt(1 / (c1 + a) + 1 / (c0 + a))


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge logistic regression on one number by Newton steps; a weight that would be negative is 0."""
    for used in (True, False):
        design = np.stack([np.ones(len(x)), x], axis=1) if used else np.ones((len(x), 1))
        w = np.zeros(design.shape[1])
        ridge = np.diag([1e-3, 1e-2][: len(w)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            gradient = design.T @ (y - p) - ridge @ w
            hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
            step = np.linalg.solve(hessian, gradient)
            w += step * min(1.0, 8 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        if w[1:].min(initial=0.0) >= 0:
            break
    return float(w[0]), float(w[1]) if used else 0.0


def train_model(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> Model:
    """Fits on labelled rows whose crc32(doc_id) mod 5 is not 0: folds 1 to 3 give log-odds, fold 4 the curve."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    train = training_rows(docs, labels, scratch, limit)
    counts = _counts(train.where("fold <> 4"))
    n1, n0 = counts.pop("", (0, 0))
    model = Model()
    if n1 and n0:
        scored = {f: (*log_odds(a, b, n1, n0), a, b) for f, (a, b) in counts.items()}
        model.weights = {f: d - e for f, (d, e, _, _) in scored.items() if d - MIN_Z * e > 0}
        model = _calibrated(model, train)
    rows = train.where("fold = 4" if n1 and n0 else "true")
    x, y, _, _ = _evidence(rows, model)
    if len(y) < 20 or not 0 < y.sum() < len(y):  # too few rows of their own: all that there are
        x, y, _, _ = _evidence(train, model)
    model.curve = _fit_logistic(x, y) if len(y) else (0.0, 0.0)
    return model


def _evidence(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[float]] = [[], [], []]
            for text in b["text"].to_pylist():
                reading = model.read(text)
                for column, value in zip(out, (model.evidence(reading), float(reading.tokens), reading.best), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in out), b["toxic"], b["doc_id"]], names=["x", "tokens", "best", "toxic", "doc_id"])

    # three numbers a row of the bounded sample
    got = rows.select("text", "toxic", "doc_id").mapInArrow(run, "x double, tokens double, best double, toxic int, doc_id long").orderBy("doc_id").collect()
    return np.array([r.x for r in got], dtype=float), np.array([r.toxic for r in got], dtype=float), np.array([r.tokens for r in got]), np.array([r.best for r in got])


def _calibrated(model: Model, train: DataFrame) -> Model:
    """Sets the score of all other tokens and the extreme-value parameters from the clean and toxic sample rows."""
    weights = model.weights

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, tokens = (Counter(), Counter()), [0, 0]
        memo = _Memo(weights)
        for b in batches:
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
                words = WORD.findall((text or "").lower())
                tokens[toxic] += len(words)
                seen[toxic].update(v for w in words if (v := memo[w]))
                if len(memo) > MEMO:
                    memo.clear()
        rows = [(toxic, v, n) for toxic in (0, 1) for v, n in [*seen[toxic].items(), (0.0, tokens[toxic])]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.float64(), pa.int64()), strict=True)], names=["toxic", "v", "n"])

    got = train.where("fold <> 4").mapInArrow(run, "toxic int, v double, n long").groupBy("toxic", "v").agg(F.sum("n").alias("n")).collect()
    tokens = {t: sum(r.n for r in got if r.toxic == t and r.v == 0) for t in (0, 1)}
    hits = {t: {r.v: r.n for r in got if r.toxic == t and r.v > 0} for t in (0, 1)}
    rate = {t: (sum(hits[t].values()) + 0.5) / (tokens[t] + 1) for t in (0, 1)}
    model.rest = min(math.log((1 - rate[1]) / (1 - rate[0])), -1e-4)
    spread = hits[0] or {v: 0.5 / len(hits[1]) for v in hits[1]} or {1.0: 0.5}
    total = sum(spread.values())
    law = [(v, rate[0] * n / total) for v, n in spread.items()]

    def excess(lam: float) -> float:
        return sum(p * math.exp(min(lam * v, 700)) for v, p in law) + (1 - rate[0]) * math.exp(lam * model.rest) - 1

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    model.lam = (low + high) / 2
    model = Model(model.weights, model.rest, model.lam)
    _, toxic, n, best = _evidence(train.where("fold <> 4"), model)
    clean, bar = toxic == 0, min(v for v, _ in law)
    beyond = ((best >= bar) & clean).sum() + 0.5
    model.k = float(beyond / max(n[clean].sum(), 1) * math.exp(min(model.lam * bar, 50)))
    model.space = int(max(n[clean].max(initial=1), 1))
    return model


# ---- scoring


def score(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, held_out, score, predicted, passages.

    `labels` has doc_id and toxic; rows with a null in either are no labels, and if none is left every score
    is one half. Null and empty texts score as texts without toxic tokens. Appending to a text never lowers its
    score, however long it gets. Rows that repeat are repeated; a
    null doc_id is not held out; an empty table gives no rows; other columns are ignored.
    """
    model = train_model(docs, labels, limit)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].to_pylist()
            readings = [model.read(t) for t in texts]
            scores = [model.score(r) for r in readings]
            spans = [[{"start": s, "end": e, "bits": x} for s, e, x in model.passages(t, r)] for t, r in zip(texts, readings, strict=True)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, kind)],
                names=["doc_id", "held_out", "score", "predicted", "passages"],
            )

    held = F.expr(f"coalesce(crc32(cast(cast(doc_id as string) as binary)) % {FOLDS} = 0, false)").alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, passages array<struct<start:int,end:int,bits:double>>")


def keep_clean(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """The rows of `docs` that aren't predicted toxic, with all their columns; odd rows as in `score`."""
    model = train_model(docs, labels, limit)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([model.score(model.read(t)) < 0.5 for t in b["text"].to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
