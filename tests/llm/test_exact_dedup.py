import hashlib

from pyspark.sql import functions as F
from vellum.llm import exact_dedup
from vellum.llm.common import Scratch


def slow(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            stays = i == top and not kept
            kept |= stays
            out.append((i, top, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted((tuple(r) for r in exact_dedup.exact_dedup(docs, **kw).collect()), key=str)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert run(docs) == slow([(r.doc_id, r.text) for r in docs.collect()])


def test_blocks_levels_and_shared_digests(spark):
    base = "abcd" * 9
    texts = [base, base, base[:-1], base + "a", base[:16], base[:32], "", None, "é" * 7, "é" * 7, "e" * 14, base[::-1]]
    rows = [*enumerate(texts), (3, base + "a"), (None, ""), (None, "only null"), (None, "only null")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, name string")
    for digest in (F.xxhash64, lambda c: F.lit(1).cast("long"), lambda c: F.length(c).cast("long")):
        assert run(docs, block_bytes=4, digest=digest) == slow(rows)
    assert run(docs.limit(0)) == []


def test_names_follow_contents(spark):
    texts = ["b" * 5, "a", "abcdabcd", "", "zz", "abcdzzzz", "é", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    named = []
    for parts in (1, 5, 11):
        rows = exact_dedup.identities(docs.repartition(parts), Scratch(spark, "names"), block_bytes=4).collect()
        named.append({r.doc_id: (r.level, r.name) for r in rows})
    assert named[0] == named[1] == named[2]
    short = sorted((texts[i].encode(), n) for i, (level, n) in named[0].items() if level == 0)
    assert [n for _, n in short] == sorted(n for _, n in short) and named[0][1] == named[0][7]
