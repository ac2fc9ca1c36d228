import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from vellum.llm import importance

COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


def features(text):
    low = re.sub("[A-Z]", lambda x: x.group().lower(), text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for key, text in rows:
        n, f = features(text)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([key, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_documents_against_the_plain_rule(spark, sf, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 5000)
    monkeypatch.setattr(importance, "PIECE", 50)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "One"), (10**9 + 3, "ONE two\x00three"), (None, "w " * 30), (4, " x" * 20 + " " + "y" * 3000), (10**9 + 4, "é1 Ü2 " * 3000)]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()] + [None]
    docs = spark.createDataFrame([(*r, "clash", 2) for r in rows], "doc_id long, text string, score string, rank int").repartition(5)
    want = brute(rows, target)
    assert sum(r[5] is not None for r in want) > 5
    assert got(importance.resample(docs, spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"))) == want


def test_one_key_with_a_third_of_the_rows_and_no_target(spark):
    rows = [(7, "best of all " * 20)] * 500 + [(k, f"text {k} " * 15) for k in range(700)]
    made = got(importance.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), spark.createDataFrame([], "text string")))
    assert made == brute(rows, [])
    assert sorted(r[5] for r in made if r[5]) == list(range(1, 61))


def test_pieces_of_a_text_give_all_its_runs(monkeypatch):
    text = "a bb ccc " * 40 + "D"
    want = Counter(features(text)[1])
    for size in (1, 3, 10, 10**6):
        monkeypatch.setattr(importance, "PIECE", size)
        n, parts = importance.buckets(text)
        assert n == 121 and Counter(np.concatenate(parts).tolist()) == want


def test_an_empty_table_gives_no_rows(spark):
    assert importance.resample(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([("x",)], "text string")).collect() == []
