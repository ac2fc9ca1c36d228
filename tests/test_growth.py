"""What queries move between tasks grows with their input, not with its square or with fixed lists for each row."""

import math
import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F
from vellum.functions import html
from vellum.operators import boundaries, curation, evaluation


def written(spark, run):
    """(what `run` returns, rows that its stages wrote to shuffles, bytes that they wrote there)."""
    jvm, gateway, sc = spark._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.sc()

    def total():
        sc.listenerBus().waitUntilEmpty(30_000)
        stages = sc.statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        each = [stages.apply(i) for i in range(stages.size())]
        return {(x.stageId(), x.attemptId()): (x.shuffleWriteRecords(), x.shuffleWriteBytes()) for x in each}

    before, out = total(), run()
    new = [x for k, x in total().items() if k not in before]
    return out, sum(r for r, _ in new), sum(b for _, b in new)


def grams(text):
    w = [x for x in text.lower().split() if len(x) > 1]
    return Counter(" ".join(w[i : i + k]) for k in (2, 3) for i in range(len(w) - k + 1))


def cosine(own, ref, features):
    """By the definition: TF-IDF of both over the `features` terms that are most frequent in both together."""
    terms = sorted(own.keys() | ref.keys(), key=lambda t: (-own[t] - ref[t], t))[:features]
    a, b = ([n[t] * (math.log(3 / (1 + (own[t] > 0) + (ref[t] > 0))) + 1) for t in terms] for n in (ref, own))
    norm = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b, strict=True)) / norm if norm else 0.0


def test_ngrams_of_a_text_meet_the_corpus_without_a_row_for_each_frequent_term(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "ii", "jj", "kk"])
    say = lambda n: " ".join(word() for _ in range(n))
    refs = [(f"a{i % 3}", say(rng.randint(0, 60))) for i in range(90)] + [("few", "aa bb cc"), ("none", "x"), (None, "aa bb")]
    texts = [(i, ["a0", "a1", "a2", "few", "none", "unknown", None][i % 7], say(rng.choice([0, 1, 2, 5, 30, 200]))) for i in range(300)]
    r = spark.createDataFrame(refs, "author string, text string")
    t = spark.createDataFrame(texts, "id long, author string, text string")
    corpora = {}
    for author, text in refs:
        corpora.setdefault(author, Counter()).update(grams(text))
    for features in (1, 7, 100, 1000):
        got = dict(evaluation.ngram_similarity(t, r, features).collect())
        for i, author, text in texts:
            want = cosine(grams(text), corpora[author], features) if author in corpora and author is not None else 0.0
            assert abs(got[i] - want) < 1e-9, (features, i, author, text)
    many = spark.range(3000).select("id", F.lit("a0").alias("author"), F.lit("aa bb cc").alias("text"))
    rows, records, _ = written(spark, lambda: evaluation.ngram_similarity(many, r).collect())
    assert len(rows) == 3000 and records < 60_000


def test_near_copies_are_compared_without_a_text_for_each_pair(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"word{i}" for i in range(300)]
    texts = [" ".join(rng.sample(base, len(base))) for _ in range(5)]  # one set of words
    texts += [" ".join(w for w in base if rng.random() > 0.1) + f" own{i}" for i in range(200)]
    texts += [" ".join(f"w{rng.randint(0, 400)}" for _ in range(60)) for _ in range(50)] + ["", None, "  \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string").repartition(7)
    sets = [frozenset((t or "").split()) for t in texts]
    similar = lambda x, y: len(x & y) / len(x | y) >= 0.8
    linked = {i: [j for j in range(len(sets)) if j != i and (sets[i] == sets[j] or sets[i] and sets[j] and similar(sets[i], sets[j]))] for i in range(len(sets))}
    first = [min(j for j in range(len(sets)) if sets[j] == x) for x in sets]
    want = {i: (first[i], len(js), min({first[j] for j in js} - {i}, default=None)) for i, js in linked.items()}
    for tile in (4096, 16):  # a cluster as one, and cut into tiles
        monkeypatch.setattr(curation, "TILE", tile)
        rows, _, size = written(spark, lambda: curation.near_duplicates(docs).collect())
        assert {r.doc_id: (r.class_id, r.n_links, r.nearest_id) for r in rows} == want
        if tile == 4096:
            assert size < 8 * sum(len(t or "") for t in texts)
    assert sum(map(len, linked.values())) > 20_000


def test_pages_become_strings_a_few_at_a_time():
    pages = ["<p>a &amp; b</p>", None, ""] * 100
    parts = list(html.text_of.func(iter([pa.array(pages), pa.array(pages[:1])])))
    assert max(map(len, parts)) <= html.SLICE
    assert [x.as_py() for p in parts for x in p] == ["a & b", "", ""] * 100 + ["a & b"]


def test_texts_to_split_become_strings_a_few_at_a_time(spark):
    of = boundaries.splitter(spark, boundaries.Model(frozenset(), frozenset(), frozenset()))
    parts = list(of.func(iter([pa.array(["It is so. We go on.", None] * 150)])))
    assert max(map(len, parts)) <= boundaries.SLICE and sum(map(len, parts)) == 300
