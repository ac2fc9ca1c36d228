import zlib
from itertools import product

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer
from vellum.llm import packing


def test_fullest_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(200):
        left = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 30, 4)}
        room = int(rng.integers(0, 60))
        got = packing.fullest(left, room)
        assert all(n <= left[x] for x, n in got)
        best = max(s for c in product(*(range(n + 1) for n in left.values())) if (s := sum(x * k for x, k in zip(left, c, strict=True))) <= room)
        assert sum(x * n for x, n in got) == best


def check(rows, capacity=1024):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs).collect()
    bins = check(rows)
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 1024) + 1
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = np.array([*tok.encode(d.text, add_special_tokens=False).ids, 2], dtype="<u4")
        parts = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert sum(r.length for r in parts) == len(ids) and [r.piece for r in parts] == list(range(len(parts)))
        assert all(r.length == 1024 for r in parts[1:])
        for r in parts:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32


def test_odd_rows_and_sequences(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a <|endoftext|> b"), (5, "x " * 3000), (6, "y" * 5000)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, length int")
    packed = packing.pack(docs, with_ids=True)
    got = packed.collect()
    check(got)
    assert sum(r.length == 1 for r in got) == 3
    special = next(r for r in got if r.doc_id is None)
    assert 50256 in special.ids
    out = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in out) == sum(r.length for r in got)
    assert packing.pack(docs.limit(0)).count() == 0
