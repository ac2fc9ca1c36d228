"""Fits the tagger of `pii` and writes its weights: python -m vellum.llm.train_tagger FOLDER.

FOLDER holds documents.parquet. Documents whose crc32(doc_id as text) mod 5 is 0 are held out; of the others at
most MAX_DOCUMENTS, those with the smallest hashes of their ids, give the prose and its labelled spans.
"""

from __future__ import annotations

import json
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq
import xxhash

from vellum.llm import bilstm, pii

MAX_DOCUMENTS = 6000
LENGTH = 112
EXAMPLES = 9000
ROUNDS = 1400
BATCH = 64
HIDDEN = 12


class Examples:
    """Stretches of documents with labelled spans, their own and written in."""

    def __init__(self, texts: list[str], seed: int):
        self.writer = pii.Writer(seed)
        self.rng = self.writer.rng
        self.texts = [t for t in texts if len(t) > 20]
        self.spans = [pii.matches(t)[0] for t in self.texts]
        self.with_spans = [i for i, s in enumerate(self.spans) if s]

    def marks(self, i: int) -> np.ndarray:
        out = np.zeros(len(self.texts[i]), dtype=np.int64)
        for kind, a, b in self.spans[i]:
            out[a:b] = pii.TAGS.index(f"B-{kind}") + 1
            out[a] -= 1
        return out

    def one(self) -> tuple[np.ndarray, np.ndarray]:
        rng, w = self.rng, self.writer
        own = self.with_spans and rng.random() < 0.15
        i = int(rng.choice(self.with_spans)) if own else int(rng.integers(len(self.texts)))
        text, marks = self.texts[i], self.marks(i)
        near = self.spans[i][int(rng.integers(len(self.spans[i])))][1] if own else int(rng.integers(len(text)))
        start = max(0, near - int(rng.integers(0, LENGTH)))
        text, marks = text[start : start + LENGTH], marks[start : start + LENGTH].tolist()
        for _ in range(int(rng.integers(0, 4))):
            if rng.random() < 0.55:
                kind, part = w.private()
                tag = pii.TAGS.index(f"B-{kind}")
                new = [tag] + [tag + 1] * (len(part) - 1)
            else:
                part = w.plain()
                new = [0] * len(part)
            gaps = [k for k, c in enumerate(text) if c in " \n" and not marks[k]]
            at = int(rng.choice(gaps)) + 1 if gaps else 0
            if at < len(marks) and marks[at] and marks[at] % 2 == 0:
                continue
            tail = w.pick(" ", " ", " ", ", ", ". ", "\n")
            lead = "" if at else " "
            text = text[:at] + lead + part + tail + text[at:]
            marks = marks[:at] + [0] * len(lead) + new + [0] * len(tail) + marks[at:]
        cut = int(rng.integers(0, max(1, len(text) - LENGTH + 1)))
        text, marks = text[cut : cut + LENGTH], marks[cut : cut + LENGTH]
        ids, tags = np.full(LENGTH, pii.PAD, dtype=np.int64), np.zeros(LENGTH, dtype=np.int64)
        ids[: len(text)], tags[: len(text)] = pii.encode(text), marks
        return ids, tags


def documents(folder: str) -> list[str]:
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    rows = [(xxhash.xxh64_intdigest(str(i)), t) for i, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True) if i is not None and t and zlib.crc32(str(i).encode()) % 5]
    return [t for _, t in sorted(rows)[:MAX_DOCUMENTS]]


def main(folder: str, seed: int = 11) -> None:
    texts = documents(folder)
    made = Examples(texts, seed)
    ids, tags = (np.stack(x, axis=1) for x in zip(*(made.one() for _ in range(EXAMPLES)), strict=True))
    p = bilstm.init(pii.PAD + 1, 12, HIDDEN, len(pii.TAGS), seed)
    p = bilstm.train(p, ids, tags, ROUNDS, BATCH, 0.02, seed)
    record = {"documents": len(texts), "examples": EXAMPLES, "characters": LENGTH, "rounds": ROUNDS, "batch": BATCH, "hidden": HIDDEN, "seed": seed, "final_loss": bilstm.loss(p, ids[:, :512], tags[:, :512])[0]}
    np.savez_compressed(pii.WEIGHTS, **p, record=np.array(json.dumps(record)))
    print(record)


if __name__ == "__main__":
    main(sys.argv[1])
