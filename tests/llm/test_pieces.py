import random
from collections import Counter

from vellum.llm import pieces


def all_ways(lat, text):
    """Every segmentation of a short text and its weight."""
    if not text:
        return {(): 1.0}
    out = {}
    for n in range(1, len(text) + 1):
        head = text[:n]
        if head in lat.weight:
            w, i = lat.weight[head]
        elif n == 1:
            w, i = lat.low ** len(head.encode()), None
        else:
            continue
        for rest, v in all_ways(lat, text[n:]).items():
            own = (i,) if i is not None else tuple(lat.byte_id[b] for b in head.encode())
            out[own + rest] = out.get(own + rest, 0.0) + w * v
    return out


def test_samples_follow_the_weights():
    lat = pieces.lattices(pieces.default_path(), 1.0)
    for text in ("then", " able\n", "a▁b", "  日x"):
        ways = all_ways(lat, text)
        total, n = sum(ways.values()), 20000
        got = Counter(tuple(x.tolist()) for x in pieces.sample(lat, [text] * n, list(range(n))))
        assert got.keys() <= ways.keys()
        for way, w in ways.items():
            p = w / total
            assert abs(got[way] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3, (text, way)


def test_filters_agree_whatever_is_held(monkeypatch):
    lat = pieces.Lattices(pieces.default_path(), 1.0)
    texts = ["then", " ableness", "  日xé", "a▁b😀", "0123456789012345"]
    many, *rest = lat._filter(sorted(texts, key=len, reverse=True))
    alone = [lat._filter_long(x) for x in sorted(texts, key=len, reverse=True)]
    assert many.tolist() == [n for m, *_ in alone for n in m.tolist()]
    for k, held in enumerate(rest):
        assert held.tolist() == [v for x in alone for v in x[k + 1].tolist()]
    rng = random.Random(3)
    letters = "etaoinshrdlu"
    rows = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(400)) for _ in range(30)]
    seeds = list(range(30))
    first = [x.tolist() for x in pieces.sample(pieces.Lattices(pieces.default_path(), 1.0), rows, seeds)]
    full = pieces.Lattices(pieces.default_path(), 1.0)
    full.add({f"{a}{b}{i}" for i in range(400_000) for a in "x" for b in "qz"})
    assert full.nodes > 5_000_000
    monkeypatch.setattr(pieces, "MEMO", 10**9)
    assert [x.tolist() for x in pieces.sample(full, rows, seeds)] == first
    monkeypatch.setattr(pieces, "MEMO", 10_000)
    once = pieces.Lattices(pieces.default_path(), 1.0)
    assert [pieces.sample(once, [r], [k])[0].tolist() for r, k in zip(reversed(rows), reversed(seeds), strict=True)] == first[::-1]
    pieces.sample(once, ["y" * (pieces.MEMO + 1)], [1])
    pieces.sample(once, ["b"], [1])
    assert once.nodes < 10  # what is held is bounded in characters


def test_documents_are_lossless_and_reproducible(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = {r.doc_id: r for r in pieces.segment(docs, with_ids=True).collect()}
    again = {r.doc_id: r.ids_crc32 for r in pieces.segment(docs.repartition(7)).collect()}
    other = {r.doc_id: r.ids_crc32 for r in pieces.segment(docs, seed=1).collect()}
    assert all(r.lossless for r in first.values()) and {i: r.ids_crc32 for i, r in first.items()} == again
    assert sum(other[i] != again[i] for i in again) > 0.9 * len(again)
    lat = pieces.lattices(pieces.default_path(), 1.0)
    for d in docs.limit(20).collect():
        assert b"".join(lat.bytes[i] for i in first[d.doc_id].ids).decode() == d.text


def test_odd_rows(spark):
    long = "no_spaces_at_all" * 20000
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, " ▁\n\n  x\t\r\x00 😀", 0), (3, long, 0), (3, long, 0)], "doc_id long, text string, ids int")
    rows = pieces.segment(docs).collect()
    assert all(r.lossless for r in rows) and [r.n_pieces for r in rows][:2] == [0, 0]
    assert rows[3].ids_crc32 == rows[4].ids_crc32
    assert pieces.segment(docs.limit(0)).count() == 0
