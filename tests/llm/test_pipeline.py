import pytest
import corpus_pipeline
from vellum.llm import near_text, pii
from vellum.llm.common import Scratch


def slow_groups(rows, least=0.8):
    sets = {i: near_text.shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small >= least * large and near_text.similarity(sets[a], sets[b]) >= least:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(rng, words, changes):
    out = list(words)
    for i in rng.sample(range(len(out)), changes):
        out[i] = "changed"
    return " ".join(out)


def test_near_copies_against_all_pairs(spark):
    import random

    rng = random.Random(9)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for k in range(300):
        words = rng.choice(rows[:900])[1].split()
        if len(words) > 60:
            rows.append((10_000 + k, edited(rng, words, max(1, len(words) // rng.choice([60, 100, 200])))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_groups(rows)
    got = {r.doc_id for r in near_text.drop_near_copies(docs).collect()}
    removable = {i for i, root in want.items() if i != root}
    removed = set(want) - got
    assert removed <= removable
    assert len(removed) >= 0.95 * len(removable) and len(removable) > 250


def test_copies_near_to_their_source_only(spark):
    import random

    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 1001):
        words = list(base)
        for i in range(4):
            words[20 + 45 * i + rng.randrange(35)] = f"c{k}x{i}"
        rows.append((k, " ".join(words)))
    sets = [near_text.shingles(t) for _, t in rows]
    assert all(near_text.similarity(sets[0], x) >= 0.8 for x in sets)
    assert sum(near_text.similarity(sets[k], sets[k + 1]) >= 0.8 for k in range(1, 1000)) < 50
    got = {r.doc_id for r in near_text.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 0 in got and len(got) <= 31  # a pair is found with a probability of 0.97


def test_odd_rows_of_near_copies(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "a b c d e f", 5), (3, "a b c d e f", 5), (4, "A b  c d e f", 6), (None, "q r s", 7), (None, "q r s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, th int")
    out = near_text.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id) for r in out.collect())) == ["1", "3", "3", "None", "None"]
    assert near_text.drop_near_copies(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark, sf):
    scratch = Scratch(spark, "test")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.write(stage(spark, docs, sf), str(k))
        out.append(docs)
    return out


def test_stages_hand_on_documents(spark, sf, stages):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [source.count(), *(s.count() for s in stages[:4])]
    assert all(s.columns == source.columns and s.dtypes == source.dtypes for s in stages[:4])
    assert counts[0] >= counts[1] == counts[2] >= counts[3] == counts[4] > 0
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {i for i, root in slow_groups(rows).items() if i == root}
    kept = {r.doc_id for r in stages[2].collect()}
    assert want <= kept and len(kept - want) <= 2
    for before, after in zip(sorted(stages[2].collect(), key=lambda r: r.doc_id), sorted(stages[3].collect(), key=lambda r: r.doc_id), strict=True):
        assert pii.matches(after.text)[0] == [] and after.n_chars == len(after.text)
        assert before.text == after.text or pii.all_spans([before.text], pii.tagger())[0][1]


def test_run_gives_the_last_stage(spark, sf, stages):
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, sf).collect())) == sorted(map(key, stages[-1].collect()))
