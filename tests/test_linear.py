"""Whole texts in one pass: patterns and filling give what their definitions say, and long lines take linear time."""

import random
import re
import time

from pyspark.sql import functions as F
from vellum.functions import base, classify, prompts, talks

PATTERNS = [p for _, _, ps in classify.RULES.values() for p in ps]


def test_patterns_are_counted_as_by_the_patterns_alone(spark):
    rng = random.Random(4)
    bits = sorted({b for p in PATTERNS for b in p.split(".*") if b} | {"\n", "\r", " ", "\u0085", " ", "is", "i"})
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", *[classify.runs(F.col("t"), p).alias(f"c{i}") for i, p in enumerate(PATTERNS)]).collect()
    for r in got:
        for i, p in enumerate(PATTERNS):
            want = None if r.t is None else len(re.findall(p, r.t))
            assert r[f"c{i}"] == want, (r.t, p)
    assert sum(r[f"c{i}"] or 0 for r in got for i in range(len(PATTERNS))) > 5000


def test_a_long_line_of_openings_is_scored_in_linear_time(spark):
    line = "teaches remember " + "i we our in is name doctrine experience first second " * 20_000
    rows = spark.createDataFrame([("t", line)], "title string, x string")
    score = lambda: rows.select(*[v.alias(k) for k, v in classify.type_scores(F.col("title"), F.col("x")).items()]).first()
    begin = time.time()
    assert score().doctrinal == 20_000
    assert time.time() - begin < 5


def test_words_and_white_space_are_those_of_the_pattern(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(" \t\n\x0b\f\r abé") for _ in range(rng.randint(0, 12))) for _ in range(2000)] + [None]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", base.n_words(F.col("t")).alias("n"), base.strip(F.col("t")).alias("s")).collect():
        blank = base.BLANK
        assert (r.n, r.s) == ((None, None) if r.t is None else (len(r.t.encode().split()), r.t.strip(blank)))


def test_a_known_template_is_filled_as_one_of_a_column(spark):
    row = spark.createDataFrame([("A {title}", None)], "a string, t string")
    of = {"author": F.col("a"), "title": F.col("t")}
    for text in ["By {author}: {title}", "{other} {author}{author}", "none", "", "{", "{}x{a b}"]:
        got = row.select(prompts.fill_text(text, of), prompts.fill(F.lit(text), of)).first()
        assert got[0] == got[1]


BITS = ["Contents", "Contents\n", "Saturday Morning Session", "The", "Sunday", " Session", "General Conference April 2020 general conference", " w October 2020 general conference", "Authenticating...", "1990–1999 ", "2001 May 2002", "\n", "\n\n", "  \n", "4:28\n", "4:28  \n", "4:28 Session x\n", "ââ", "....", "â", "Ã©", "Notes\n", "note\n", "NOTES \n", "References\n", "a", " "]


def test_texts_are_cleaned_as_by_the_patterns_alone(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None]
    t = F.col("t")

    def plain_notes(name):
        rest = F.regexp_replace(F.regexp_extract(t, rf"(?is)\n{name}?\s*\n(.*)$", 1), r"^\s+|\s+$", "")
        return F.when(rest != "", F.concat(F.lit("Notes\n"), rest))

    bare = F.regexp_replace(F.regexp_replace(t, r"\n\s*\n\s*\n", "\n\n"), r"(?m)[^\S\n]+$", "")
    timed = F.regexp_replace(F.regexp_replace(t, r"(?md)^\d{1,2}:\d{2}\s*$", ""), r"(?md)^\d{1,2}:\d{2}\s+(Session|Morning|Afternoon|Evening)\b.*$", "")
    untitled = ~F.substring_index(timed, "\n", 1).rlike("[^ ]") | (F.length(F.regexp_replace(timed, "[^\n]", "")) == 0)
    issues = F.lit(0)
    for p, *_ in talks.ISSUES:
        issues = issues + F.regexp_count(t, F.lit(p))
    pairs = {
        "notes": (talks.notes(t), F.coalesce(*[plain_notes(n) for n in ("Notes", "References", "Footnotes")])),
        "blank": (talks.normalize_whitespace(t), F.regexp_replace(bare, r"^(?:[^\S\n]*\n)+|\s+$", "")),
        "artifacts": (F.when(~untitled, F.regexp_replace(talks.clean_artifacts(t), r"\s", "")), F.when(~untitled, F.regexp_replace(F.regexp_replace(F.regexp_replace(timed, "[â]{2,}", '"'), r"\.{4,}", "..."), r"\s", ""))),
        "signs": (F.array(*talks._toc_signs(t)), F.array(*[t.rlike(f"(?d){p}") for p in talks.TOC])),
        "issues": (talks.issue_count(t), issues),
    }
    # lines 3 to 10 that repeat the title go as well: only texts without such lines are held against the patterns
    repeats = F.exists(F.slice(F.split(timed, "\n", -1), 3, 8), lambda x: F.trim(x) == F.trim(F.substring_index(timed, "\n", 1)))
    for k, (mine, want) in pairs.items():
        rows = spark.createDataFrame([(x,) for x in texts], "t string").where(F.coalesce(~repeats, F.lit(True)) if k == "artifacts" else F.lit(True))
        got = rows.select("t", mine.alias("mine"), want.alias("want")).collect()
        assert [r.mine for r in got] == [r.want for r in got], k
        assert len({str(r.want) for r in got}) > 3, k


def test_a_long_word_is_looked_at_in_linear_time(spark):
    rows = spark.createDataFrame([("a" * 300_000,)], "t string")
    begin = time.time()
    assert not rows.select(talks.structure(F.col("t"))["toc_contamination"]).first()[0]
    assert time.time() - begin < 8
