import re
import zlib
from collections import Counter

import numpy as np
import pytest
from vellum.llm import spelling

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def words_of(rows):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if key is None else key}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            out[low] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near_of = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and near(w, v)] for w in counts}
    form = {}
    for w, vs in near_of.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near_of[w]), counts[form[w]] if form[w] else None))
    return out


def got(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_documents_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(12).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] * 2 + [(None, "Kaffeehaus Kaffeehaus kaffeehäus kaffeehäus kaffeehaus"), (5, None), (6, ""), (7, "a" * 3000 + " " + "a" * 3000 + " " + "a" * 3001)]
    rows += [(k, "commonword " * 40 + "commonward comonword commonwordd xommonword xomonword") for k in range(6)]
    want = brute(words_of(rows))
    made = spelling.spelling_variants(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int"))
    assert got(made) == want


def test_forms_are_followed_to_the_last_and_ties_go_by_code_points(spark):
    counts = {"chainedxxx": 2, "chainedxx": 25, "chainedx": 300, "chained": 3000, "chaineé": 3000, "chainee": 30000, "lonesome": 5, "lonesomf": 49, "tiedword": 2, "tiedworz": 20, "tiedworé": 20}
    want = brute(counts)
    assert {w: r for w, _, r, *_ in want}["chainedxxx"] == "chainee"
    assert got(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == want


def test_edits_are_all_distinct_strings_at_one_edit(monkeypatch):
    alphabet = np.array(sorted(map(ord, "abé")), dtype=np.uint64)
    for block in (1 << 20, 7):  # a word at once, or some places of it at a time
        monkeypatch.setattr(spelling, "BLOCK", block)
        for w in ("a", "aab", "abba", "bbbbb", "éab"):
            found = [x for _, x in spelling.edits([w, w[::-1]], alphabet, lambda h: np.arange(len(h))) if _ == 0]
            want = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + x + w[i + 1 :] for i in range(len(w)) for x in "abé"} | {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in "abé"}
            assert sorted(found) == sorted(want - {w})


def test_hashes_of_edits_are_those_of_the_words():
    alphabet = np.array(sorted(map(ord, "abcé")), dtype=np.uint64)
    words = ["abcab", "éabca", "aabbc"]
    seen = []
    made = list(spelling.edits(words, alphabet, lambda h: (seen.append(h), np.arange(len(h)))[1]))
    known = {int((spelling._codes([x], len(x)) * spelling._powers(len(x))[: len(x)]).sum(dtype=np.uint64)) for _, x in made}
    assert known <= set(np.concatenate(seen).tolist())


@pytest.mark.parametrize("top", [10, 4])
def test_a_full_filter_loses_nothing(spark, monkeypatch, top):
    monkeypatch.setattr(spelling, "TOP", top)
    monkeypatch.setattr(spelling, "PART", 5)
    counts = {f"{a}{b}cdefgh"[:k]: n for k in (7, 8) for a in "abcdefgh" for b in "abcdefgh" for n in [3 + (ord(a) * ord(b) * k) % 90]}
    made = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), 2)
    near_of = {w: [v for v in counts if near(w, v)] for w in counts}
    assert {r.word: r.n_near for r in made.collect()} == {w: len(v) for w, v in near_of.items()}


def test_an_empty_table_gives_no_rows(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
