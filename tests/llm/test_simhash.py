import numpy as np
import xxhash
from vellum.llm import simhash


def slow_fingerprint(text, k=3):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    fps = {i: slow_fingerprint(t) for i, t in rows}
    label = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return {i: (f"{fps[i]:016x}", label[i]) for i in fps}


def test_fingerprint_of_odd_texts():
    for text in (None, "", " \t\r\n\x0b\x0c", "One", "One two", "Ünï CÖDE a b c", "a b c " * 5000):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_near_matches_popcount():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 6, 300)], dtype=np.uint64)
    fps = np.unique(base[rng.integers(0, 40, 300)] ^ flips)
    for radius in (0, 1, 2, 3):
        want = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        np.fill_diagonal(want, False)
        assert (simhash.near(fps, radius) == want).all()


def grown(n, rng):
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 7, n)], dtype=np.uint64)
    return np.unique(centre ^ flips)


def roots_of(nodes, edges):
    at = {int(x): int(x) for x in nodes}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for u, v in edges:
        a, b = find(int(u)), find(int(v))
        at[max(a, b)] = min(a, b)
    return {x: find(x) for x in at}


def test_large_groups_are_split_exactly():
    fps = grown(700, np.random.default_rng(1))
    want = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    got = [p for u, v in simhash.link_group(fps, list(range(64)), 3, 32) for p in zip(u, v, strict=True)]
    assert roots_of(fps, got) == roots_of(fps, [(fps[a], fps[b]) for a, b in want])


def test_links_with_hot_blocks(spark):
    fps = np.concatenate([grown(150, np.random.default_rng(s)) for s in range(3)])
    fps = np.unique(fps)
    classes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    want = roots_of(fps.view(np.int64), [(fps.view(np.int64)[a], fps.view(np.int64)[b]) for a, b in np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)])
    for hot in (5, 10**9):
        got = [tuple(r) for r in simhash.links(classes, tile=16, hot=hot).collect()]
        assert roots_of(fps.view(np.int64), got) == want


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == slow_components(rows)


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "a b c d", 0), (3, "a b c d", 0), (None, "a b c d", 0), (None, "q r s t u", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (3, 3), (None, 3), (None, None)], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
