import random
import zlib

import public_tokenizers
from tokenizers import Tokenizer
from vellum.llm import edit_counts, tokens


def counter():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return lambda text: len(tok.encode(text, add_special_tokens=False).ids)


def test_random_edits_against_encoding_anew():
    count, rng = counter(), random.Random(5)
    counts = edit_counts.Counts(tokens.encoder(tokens.default_path()).count)
    parts = ["a", "b'", "'ll", "l", "'s", " ", "  ", "\n", "\t ", "12", "é", "日本", "!", " x", "word", " another", "'", "r", "e"]
    make = lambda n: "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))
    for _ in range(150):
        text = make(120)
        tree = edit_counts.CountTree(text, counts, leaf=4)
        for _ in range(8):
            a = rng.randint(0, len(text) + 1)
            b = a + rng.choice([0, 0, 1, 2, 5, 40])
            new = make(rng.choice([0, 1, 3, 60]))
            text = text[:a] + new + text[b:]
            got = tree.edit(a, b, new)
            assert tree.text == text and got == tree.total == count(text) and tree.length == len(text)


def test_only_what_an_edit_touches_is_encoded():
    counts = edit_counts.Counts(tokens.encoder(tokens.default_path()).count)
    tree = edit_counts.CountTree("some words " * 20000, counts)
    before = tree.encoded
    tree.edit(100_001, 100_004, "thing")
    assert tree.encoded - before < 60


def test_documents_and_odd_rows(spark, sf):
    count = counter()
    docs = edit_counts.sample_edits(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = {r.doc_id: r for r in docs.collect()}
    for r in edit_counts.recount(docs).collect():
        text = rows[r.doc_id].text
        assert r.n_tokens == count(text)
        for e in rows[r.doc_id].edits:
            text = text[: e.start] + e.new + text[e.stop :]
        assert (r.n_tokens_after, r.n_chars_after, r.text_crc32) == (count(text), len(text), zlib.crc32(text.encode()))
    odd = spark.createDataFrame([(1, None, None, 1), (None, "", [(0, 9, "x y")], 1), (2, "<|endoftext|>", [None, (None, None, None)], 1)], "doc_id long, text string, edits array<struct<start:int,stop:int,new:string>>, n_tokens int")
    assert [(r.n_tokens, r.n_tokens_after) for r in edit_counts.recount(odd).collect()] == [(0, 0), (0, 2), (count("<|endoftext|>"),) * 2]
    assert edit_counts.recount(odd.limit(0)).count() == 0
