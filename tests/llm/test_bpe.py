import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer
from vellum.llm import bpe

PARTS = ["a", "'s", "ΑΣ", "Σ ", " ", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "é", "é", "İ", "ß", "ǅ", "日本", "١", "²", "_", "!!", "😀", "\t\n", "Ɤ", "Ᲊ", "가", "“x”", "don't", "THE END", "0123"]


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(bpe.default_path())


def of(known, text):
    ids = known.encode(text or "", add_special_tokens=False).ids
    return ids, known.decode(ids, skip_special_tokens=False)


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice([*PARTS, "ab" * rng.randint(1, 60)]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return [None, "", " \n", "x" * 30000, "ab" * 20000 + "=" * 20000, *made]


def test_ids_and_text_are_those_of_the_library(spark, sf, known):
    rows = list(enumerate(texts())) + [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()] + [(None, "null key"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, ids string, n_tokens int")
    want = sorted(((-1 if k is None else k), *of(known, t)) for k, t in rows)
    coded = bpe.encode(docs)
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.ids) for r in coded.collect()) == [w[:2] for w in want]
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.text) for r in bpe.decode(coded).collect()) == sorted((k, x) for k, _, x in want)
    digests = [((-1 if r.doc_id is None else r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect()]
    assert sorted(digests) == sorted((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(x.encode()).hexdigest()) for k, ids, x in want)


def test_every_kind_of_character(known):
    model = bpe.coder(bpe.default_path())
    rows = [f"a{chr(x)}b!{chr(x)}?" for x in range(0, 0x110000, 7) if not 0xD800 <= x < 0xE000]
    got = model.encode_all(rows)
    assert all(a.tolist() == b.ids for a, b in zip(got, known.encode_batch(rows, add_special_tokens=False), strict=True))


def plain(symbols, ranks):
    symbols = list(symbols)
    while found := [(ranks[p][0], i) for i in range(len(symbols) - 1) if (p := (symbols[i], symbols[i + 1])) in ranks]:
        i = min(found)[1]
        symbols[i : i + 2] = [ranks[symbols[i], symbols[i + 1]][1]]
    return symbols


def test_trees_merge_as_the_plain_rule():
    rng = random.Random(2)
    for _ in range(40):
        pairs = {(rng.randrange(8), rng.randrange(8)) for _ in range(12)}
        ranks = {p: (r, rng.choice([8 + r, rng.randrange(8)])) for r, p in enumerate(rng.sample(sorted(pairs), len(pairs)))}
        merges = bpe.Merges(ranks)
        for n in (1, 2, 3, 5, 8, 9, 33):
            rows = [[rng.randrange(8) for _ in range(rng.randint(1, n))] for _ in range(6)]
            want = [plain(r, ranks) for r in rows]
            assert [merges.one(r) for r in rows] == want
            padded = np.array([r + [-1] * (n - len(r)) for r in rows])
            assert [[x for x in r if x >= 0] for r in merges.many(padded).tolist()] == want


def test_a_small_memory_changes_nothing(monkeypatch, known):
    monkeypatch.setattr(bpe, "MEMO", 3)
    monkeypatch.setattr(bpe, "MEMO_LENGTH", 4)
    model = bpe.Coder(bpe.default_path())
    for t in texts()[5:60]:
        assert model.encode(t).tolist() == of(known, t)[0]


def test_decoding_skips_ids_without_a_token(spark, known):
    rows = spark.createDataFrame([(1, [320, 10**6, -3, 49407]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in bpe.decode(rows).collect()) == [(1, "a</w> <|endoftext|>"), (2, ""), (3, "")]


def test_an_empty_table_gives_no_rows(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
