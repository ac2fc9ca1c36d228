"""Cases that earlier forms got wrong or took too long for."""

import random
import time

import pytest
from pyspark.sql import functions as F
from vellum.functions import prompts, talks
from vellum.operators import vectors

WORDS = ["The ", "Elder ", "Quorum", "Seventy ", "Presidency\n", "\n", "\n\n", "Session", "Saturday Morning Session", "Sunday Afternoon Session ", "Priesthood Session", "Ab\n", "xy", "By Elder A\n", "10:30 x", "General Conference April 2020 general conference ", "w October 2020 general conference", "Contents ", "Authenticating... ", "Of "]


def test_tables_of_contents_are_removed_as_by_the_patterns_alone(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(WORDS) for _ in range(rng.randint(0, 25)))) for i in range(3000)]
    t = F.col("t")
    for p in talks.TOC_REMOVED:
        t = F.regexp_replace(t, "(?ms)" + p, "")
    mine = F.col("t")
    for p, closing in zip(talks.TOC_REMOVED, talks.TOC_CLOSING, strict=True):
        mine = talks._removed(mine, p, closing)
    got = spark.createDataFrame(rows, "i int, t string").select("t", t.alias("want"), mine.alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert sum(r.want != r.t for r in got) > 2000


def test_long_texts_without_a_closing_word_take_linear_time(spark):
    texts = ["The old house by the river\n" * 8000, "Priesthood Session of the day " * 8000, "Session one\n" * 8000, "Saturday Morning Session x\n" * 8000, ("The x\nof y\n\nAb c\n" * 8000), "General Conference April 2020 general conference x\n" * 4000]
    warm = spark.createDataFrame([("The x",)], "t string").select(F.length(talks.clean_toc(F.col("t"))))
    warm.collect()
    for t in texts:
        begin = time.time()
        spark.createDataFrame([(t,)], "t string").select(F.length(talks.clean_toc(F.col("t")))).collect()
        assert time.time() - begin < 5, t[:30]


def test_values_that_hold_braces_stay_as_they_are(spark):
    row = spark.createDataFrame([("By {author}: {title}", "A {title}", "T {author} $1")], "p string, a string, t string")
    of = {"author": F.col("a"), "title": F.col("t")}
    assert row.select(prompts.fill(F.col("p"), of)).first()[0] == "By A {title}: T {author} $1"
    assert row.select(prompts.fill_open(F.col("p"), of)).first()[0] == "By A {title}: T {author} $1"
    assert row.select(prompts.fill_open(F.lit("{author}{x}{author}"), of)).first()[0] == "A {title}[x]A {title}"
    assert row.select(prompts.fill_open(F.lit("{x} {y}"), of)).first()[0] == "{x} {y}\n\n[Missing template variable: 'x']"
    assert row.select(prompts.fill(F.lit("{author} {other} {"), {"author": F.lit(None)})).first()[0] == "[author] {other} {"


def test_an_id_that_repeats_is_one_neighbour(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0])] + [(1, [1.0, 0.001 * i]) for i in range(40)] + [(i, [1.0, float(i)]) for i in range(2, 8)], "vec_id long, embedding array<double>")
    got = vectors.nearest(table, table.where("vec_id = 0"), 5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5]
    tied = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(300, 0, -1)], "vec_id long, embedding array<double>")
    got = vectors.nearest(tied, tied.where("vec_id in (1, 300)"), 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(1, 2), (1, 3), (1, 4), (300, 1), (300, 2), (300, 3)]


def test_a_level_is_one_of_those_known(spark):
    docs = spark.createDataFrame([(1, "Russell M. Nelson", "On Faith", "2020", "Some text of a talk.")], "doc_id long, author string, title string, date string, content string")
    own = prompts.generate(docs).first()
    assert prompts.generate(docs, level="simple").first().template_level == "simple" and own.template_level == own.level
    with pytest.raises(ValueError, match="level must be"):
        prompts.training_prompts(docs, level="hard")
