import random

from vellum.llm import toxicity


def slow_segments(values):
    """Maximal segments by definition: split around the best segment, again and again."""

    def split(a, b):
        best = max(((sum(values[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        *_, i, j = best
        return [*split(a, i), (i, j - 1, best[0]), *split(j, b)]

    return split(0, len(values))


def test_segments_against_all():
    rng = random.Random(4)
    for _ in range(300):
        values = [rng.choice([-1.0, -1.0, -1.0, 1.25, 2.5, 4.125]) for _ in range(rng.randint(0, 14))]
        got = toxicity.maximal_segments([(i, i + 1, v) for i, v in enumerate(values) if v > 0], -1.0)
        assert got == slow_segments(values), values


def corpus(spark, n):
    rng = random.Random(7)
    plain = [f"w{''.join(rng.choice('abcdefgh') for _ in range(4))}" for _ in range(400)]
    rows = []
    for i in range(n):
        toxic = int(i % 5 == 0)
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        for _ in range(4 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(["vilest", "scoundrel", "vermin", "oafish"]) + rng.choice(["", "x", "yz"]))
        rows.append((i, " ".join(words), "s", toxic))
    return rows


def test_held_out_accuracy_and_passages(spark):
    rows = corpus(spark, 1500)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    truth = {r[0]: r[3] for r in rows}
    got = toxicity.score(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    texts = {r[0]: r[1] for r in rows}
    passages = [texts[r.doc_id][p.start : p.end] for r in held for p in r.passages if truth[r.doc_id]]
    assert passages and all(any(x in p for x in ("vilest", "scoundrel", "vermin", "oafish")) for p in passages)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and abs(kept.count() - 1200) < 30


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "a b", 1), (3, "x " * 50000, 1)], "doc_id long, text string, toxic int")
    for rows in ([], [(1, None), (None, 1)], [(1, 0), (2, 1), (3, 1), (77, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = toxicity.score(docs, labels).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert toxicity.keep_clean(docs, labels).columns == docs.columns
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_more_toxic_text_never_scores_lower(spark):
    rng = random.Random(9)
    for n in (300, 900, 1800):
        rows = corpus(spark, n)
        docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
        labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
        model = toxicity.train_model(docs, labels)
        assert min(model.curve[1:]) >= 0 and max(model.curve[1:]) > 0
        score = lambda t, model=model: model.score(model.read(t))
        passages = [r[1] for r in rows if r[3]][:20]
        clean = [r[1] for r in rows if not r[3]][:20]
        for p in passages:
            repeated = [score(" ".join([p] * k)) for k in (1, 2, 5, 50, 500)]
            assert repeated == sorted(repeated) and repeated[-1] >= 0.5
            text, before = rng.choice(clean), 0.0
            for _ in range(12):
                text = f"{text} {rng.choice(passages + clean)}"
                assert score(text) >= before
                before = score(text)
        assert all(score(c) < 0.5 for c in clean)


def test_very_long_toxic_texts_go(spark):
    rows = corpus(spark, 1500)
    long = " ".join(w for r in rows if r[3] for w in r[1].split())
    text = " ".join((long.split() * 20)[:20_000])
    docs = spark.createDataFrame([r[:2] for r in rows] + [(9001, text), (9002, " ".join(x[1] for x in rows if not x[3])), (9003, "clean " * 20_000 + text)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    left = {r.doc_id for r in toxicity.keep_clean(docs, labels).where("doc_id > 9000").collect()}
    assert left == {9002}


def test_ties_between_labels(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len({r.score for r in got}) == 1 and all(r.predicted == int(r.score >= 0.5) for r in got)


def test_every_significant_passage_counts():
    model = toxicity.Model({"vile": 2.0}, rest=-0.5, lam=1.0, k=0.1, space=2, curve=(-8.0, 1.0))
    passage, gap = "vile vile vile", "fine " * 30
    readings = [model.read(gap.join([passage] * n)) for n in (0, 1, 2, 3)]
    assert [len(r.good) for r in readings] == [0, 1, 2, 3]
    scores = [model.score(r) for r in readings]
    assert scores == sorted(set(scores)) and len({r.best for r in readings[1:]}) == 1
