import numpy as np
import pytest
from vellum.llm import forest


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = np.array(v, dtype=np.float64)
    ids = np.array(sorted(ok))
    x = np.stack([ok[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        d = np.sqrt(((x - ok[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_recall_on_embeddings(spark, size):
    table = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()], 10, 100)
    got = found(forest.search(table))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(abs(dict(want[q]).get(i, s) - s) < 1e-12 for q in got for i, s in got[q])


def test_large_breadth_is_exact_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(300)]
    rows += [(2000, None), (2010, [0.0] * 4), (2020, [1.0, None, 2.0, 3.0]), (2030, [float("nan")] * 4), (2040, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0] * 4), (0, rows[0][1])]
    table = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    got = found(forest.search(table, k=10, every=10, sample=200, breadth=1000.0))
    assert got == brute(rows, 10, 10)
    assert forest.search(table.limit(0)).count() == 0
    few = found(forest.search(table.where("vec_id in (10, 11)"), every=10))
    assert [i for i, _ in few[10]] == [11]


def test_share_compared_and_recall_on_many_leaves():
    rng = np.random.default_rng(5)
    middles = rng.standard_normal((40, 24)) * 4
    x = middles[rng.integers(0, 40, 20000)] + rng.standard_normal((20000, 24))  # clusters: trees must split them
    made = forest.grow(x, len(x), forest.TREES)
    assert made.leaves_a_tree > 1000
    leaves, hits, share, queries = made.leaves(x), 0, [], range(0, 20000, 400)
    for i in queries:
        seen = np.isin(leaves, made.probes(x[i], forest.BREADTH * len(x) ** 0.5)).any(axis=1)
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        hits += seen[np.argsort(d)[:10]].sum()
        share.append(seen.mean())
    assert hits >= 0.9 * 10 * len(queries) and np.mean(share) < 0.2
    assert np.bincount(leaves.ravel()).max() < 0.05 * len(x)


def test_crowded_leaves_are_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(a) for a in rng.standard_normal(6)]) for i in range(600)] + [(1000 + i, [5.0 + 1e-4 * i, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(300)]
    monkeypatch.setattr(forest, "CROWD", 20)
    got = found(forest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), breadth=1000.0))
    want = brute(rows, 10, 100)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}


def test_repeated_ids_with_other_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 3.0]), (1, [1.0, 1.0]), (2, [0.0, 2.5]), (2, [9.0, 9.0]), (3, [-5.0, 0.0])]
    got = found(forest.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    assert [i for i, _ in got[0]] == [2, 1, 3] and np.allclose([d for _, d in got[0]], [0.5, 1.0, 34**0.5])


def test_breadth_follows_measured_recall(spark):
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    classes = forest.classes_of(forest.valid(table), 10)
    made, asked = forest.grow(x[200:], len(x), forest.TREES), x[:60]
    near = forest._nearest(classes, made, asked, 10)
    leaves = made.leaves(x)
    for q, got in near:
        d = ((x - asked[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        assert (got == leaves[np.argsort(d)[:10]]).all()
    for recall in (0.5, 0.9):
        enough = forest.measured_breadth(classes, made, asked, 10, recall)
        hits = sum(np.isin(got, made.probes(asked[q], enough)).any(axis=1).sum() for q, got in near)
        assert recall <= hits / 600 <= recall + 0.02
    assert forest.measured_breadth(classes, made, asked[:0]) == 0.0
