"""Sentence boundaries learnt without labels, and chunks to budgets of sub-words."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F
from vellum.functions import chunks, subwords
from vellum.operators import boundaries, evaluation

NAMES = "Smith Jones Miller Weber Novak Silva Rossi Olsen Dubois Kim".split()
VERBS = "went spoke slept wrote read sang left came stood worked".split()


@pytest.fixture(scope="module")
def model(spark):
    rng, texts = random.Random(5), []
    for _ in range(300):
        a, b, v, w = rng.choice(NAMES), rng.choice(NAMES), rng.choice(VERBS), rng.choice(VERBS)
        texts.append(f"Then Dr. {a} {v} and Mr. {b} {w} at home. The house of approx. {rng.randint(20, 90)} rooms was old. He {v} well! Later they {w} to St. Gallen with {a[0]}. {b} again. The old man {v}. At home again they {w}, and a home it was.")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None), (1, "")], "doc_id long, content string")
    rows = boundaries.learn(docs)
    return rows, boundaries.collect(rows)


def test_abbreviations_starters_and_collocations_are_learnt(model):
    rows, learnt = model
    assert {"dr", "mr", "st"} <= learnt.abbreviations
    assert not learnt.abbreviations & {"home", "old", "again", *VERBS, *(x.lower() for x in NAMES)}
    assert {"the", "he", "later"} <= learnt.starters
    assert ("st", "gallen") in learnt.collocations
    assert rows.where("kind = 'abbreviation' and first = 'dr'").first().n == 300
    with pytest.raises(ValueError, match="more than 3"):
        boundaries.collect(rows, 3)


CASES = [
    ("Dr. Smith came. He left.", ["Dr. Smith came.", "He left."]),
    ("We met Mr. Jones at home. Later he slept! Why? Nobody knew.", ["We met Mr. Jones at home.", "Later he slept!", "Why?", "Nobody knew."]),
    ("He is in St. Gallen with J. Weber (said Dr. Kim). Then it rained.", ["He is in St. Gallen with J. Weber (said Dr. Kim).", "Then it rained."]),
    ("They asked the Dr. The man left.", ["They asked the Dr.", "The man left."]),
    ("It took 3. more days. It was 1990. He slept.", ["It took 3. more days.", "It was 1990.", "He slept."]),
    ("Well... we wait. \n\n “Go home!” The end", ["Well... we wait.", "“Go home!”", "The end"]),
    ("", []), (None, []), (" \n ", []), ("one", ["one"]),
]


def test_sentences_of_plain_cases(spark, model):
    of = boundaries.splitter(spark, model[1])
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string").select("i", of("t").alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [want for _, want in CASES]


def test_style_by_learnt_sentences(spark, model):
    texts = spark.createDataFrame([(1, "a", "Dr. Smith spoke to Kim. He left.")], "id long, author string, text string")
    refs = spark.createDataFrame([("a", "Then Smith spoke to Kim here. He left.")], "author string, text string")
    by = evaluation.feature_scores(texts, refs, boundaries.splitter(spark, model[1])).first()
    plain = evaluation.feature_scores(texts, refs).first()
    assert by.structure_similarity == 1.0 and plain.structure_similarity < 1.0  # by pattern the titles end sentences


def test_a_corpus_without_periods_has_no_model(spark):
    assert boundaries.learn(spark.createDataFrame([("no end",), (None,)], "content string")).collect() == []


def plain_pieces(word, first, later, last=None):
    if not word:
        return []
    out, at = [], 0
    while at < len(word):
        options = [word[at:j] for j in range(len(word), at, -1) if word[at:j] in (later if at else first)]
        best = word[at:] if last is not None and word[at:] in last else options[0] if options else word[at]
        out.append(best)
        at += len(best)
    return out


def test_pieces_are_the_longest_there_are(tmp_path):
    rng = random.Random(4)
    made = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)}
    some = lambda: {x for x in made if rng.random() < 0.6}
    first, later = some(), some()
    (tmp_path / "v.txt").write_text("\n".join([*first, *("##" + x for x in later)]))
    (tmp_path / "w.json").write_text(json.dumps({"model": {"vocab": {x: i for i, x in enumerate([*first, *(x + "</w>" for x in later)])}}}))
    a, b = subwords.vocabulary(str(tmp_path / "v.txt")), subwords.vocabulary(str(tmp_path / "w.json"))
    for _ in range(300):
        w = "".join(rng.choice("abcx") for _ in range(rng.randint(0, 12)))
        assert a.pieces(w) == plain_pieces(w, first, later)
        assert b.pieces(w) == plain_pieces(w, first, first, later)
        assert a.count(f" {w}\n{w} ") == 2 * len(a.pieces(w))


@pytest.mark.parametrize("strategy", chunks.STRATEGIES)
def test_a_vocabulary_of_whole_words_chunks_as_words_do(spark, tmp_path, strategy):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.col("text").alias("content"), F.when(F.col("doc_id") > 3, "x").alias("author"))
    words = sorted({w for r in docs.collect() for w in (r.content or "").split()})
    (tmp_path / "v.txt").write_text("\n".join(words))
    docs = docs.unionByName(spark.createDataFrame([(-1, None, "y"), (-2, "", None), (-3, " \n", "z")], docs.schema))
    cols = ("doc_id", "chunk_id", "total_chunks", "content", "author", "token_count")
    got = subwords.chunk(docs, str(tmp_path / "v.txt"), strategy, 40, 7, "\n")
    want = chunks.chunk(docs, strategy, 40, 7, "\n")
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(tuple(r[c] for c in cols) for r in want.collect())


def test_budgets_are_kept_in_pieces(spark, tmp_path):
    (tmp_path / "v.txt").write_text("ab\n##cd\n##c\n##d\na\nb")
    docs = spark.createDataFrame([(1, "abcd abcd. abcd abcdx. ab")], "doc_id int, content string")
    got = subwords.chunk(docs, str(tmp_path / "v.txt"), "sentences", 6).orderBy("chunk_id").collect()
    assert [(r.content, r.token_count) for r in got] == [("abcd abcd.", 5), ("abcd abcdx.", 6), ("ab", 1)]
    with pytest.raises(ValueError, match="strategy"):
        subwords.chunk(docs, "x", "pages")


@pytest.mark.parametrize("strategy", chunks.STRATEGIES)
def test_a_word_is_looked_up_once_for_its_paragraph_and_sentence(strategy):
    rng, seen = random.Random(8), []
    size = lambda w: 1 + len(w) // 3
    line = lambda n: " ".join(rng.choice(["a", "bcd", "efghi.", "é!", "jklmnopqr"]) for _ in range(n))
    text = "\n".join(line(rng.choice([1, 5, 10, 60])) for _ in range(300))
    made = subwords.cut(text.encode(), strategy, 40, 7, b"\n", lambda w: seen.append(w) or size(w))
    assert [n for _, n in made] == [sum(map(size, x.split())) for x, _ in made]
    words = text.encode().split()
    assert len(made) > 100 and {*words} == {*b" ".join(x for x, _ in made).split()}
    assert len(seen) <= (1 if strategy == "sentences" else 2) * len(words) + 8 * len(made)


def test_a_long_word_is_cut_in_linear_time():
    held = subwords.Vocabulary(["a", "b</w>"])
    begin = time.time()
    assert held.count("a" * 400_000 + "b") == 400_001
    assert time.time() - begin < 3
