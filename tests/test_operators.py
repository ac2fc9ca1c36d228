"""Literal cases with known results."""

import json

import pytest
from pyspark.sql import functions as F
from vellum.functions import chunks, classify, html, prompts, quality, talks
from vellum.operators import curation, evaluation, ingest, telemetry, vectors
from vellum.plans import reformatting  # noqa: F401
from vellum.sources import config, files

c = F.col


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()
    return row.x


def test_chunks(spark):
    text = " ".join(f"{'w ' * 14}end." for _ in range(3))
    assert len(one(spark, chunks.by_sentences(c("t"), 20), t=text)) == 3
    assert one(spark, chunks.by_sentences(c("t"), 20), t="") == []
    long = "a b c. d e f. g h i."
    assert one(spark, chunks.by_paragraphs(c("t"), 4), t=f"x y\n\n{long}\n\nz") == ["x y", "a b c.", "d e f.", "g h i.", "z"]
    assert one(spark, chunks.with_overlap(c("t"), 3, 2), t="a b c\n\nd e f") == ["a b c", "b c\n\nd e f"]
    docs = spark.createDataFrame([("x y. z w.", "A")], "content string, author string")
    row = chunks.chunk(docs, "sentences", 2).where("chunk_id = 1").first()
    assert (row.content, row.author, row.title, row.total_chunks, row.token_count) == ("z w.", "A", "", 2, 2)
    with pytest.raises(ValueError, match="Unknown chunking strategy"):
        chunks.chunk(docs, "invalid_strategy")


@pytest.mark.parametrize(
    ("text", "kind", "topic"),
    [("Brothers and sisters, let me share. I invite you", "sermon", "gospel principles"), ("We thank thee, heavenly father. amen", "prayer", "gospel principles"), ("nothing at all", "general", "gospel principles"), ("faith and trust", "general", "faith"), ("family children", "general", "family")],
)
def test_types_and_topics(spark, text, kind, topic):
    assert one(spark, classify.content_type(F.lit("t"), c("t")), t=text) == kind
    assert one(spark, classify.topic(c("t")), t=text) == topic


def test_template_table(spark):
    table = {(r.content_type, r.want): r.template_name for r in prompts.selection(spark).collect()}
    assert all(table[k, "simple"] == "simple_completion" for k in ("testimony", "prayer", "general"))
    assert [table[k, "moderate"] for k in ("testimony", "prayer", "general")] == ["testimony", "prayer", "simple_completion"]
    assert all(table[k, lv] == "complex_testimony" for k in ("testimony", "prayer", "general") for lv in ("complex", "advanced"))


def test_filling(spark):
    assert one(spark, prompts.fill(F.lit("{author} on {topic}"), {"author": c("a"), "topic": F.lit(None).cast("string")}), a="X") == "X on [topic]"
    assert one(spark, prompts.prompt_issues(c("p")), p="short") == ["Prompt too short", "No clear instruction found"]


def test_encoding(spark):
    assert one(spark, talks.fix_encoding(c("t")), t="This has âbad quotesâ and Â spacing.") == "This has –bad quotes– and   spacing."
    assert one(spark, talks.fix_encoding(c("t"), intent=True), t="cafÃ©") == "café"
    assert one(spark, talks.issue_count(c("t")), t="âÃ©") == 7


def test_talks(spark):
    text = "Be Ye Therefore Perfect\nBy Elder LeGrand R. Curtis\nOf the Seventy\nApril 1995\n\nBody text"
    got = one(spark, talks.analyzed(c("t")), t=text)
    assert tuple(got) == ("Be Ye Therefore Perfect", "Elder LeGrand R. Curtis", "Of the Seventy", "April 1995")
    assert one(spark, talks.doc_type(c("t"), c("p")), t=text, p="x/saturday-morning-session.txt") == "session_header"
    assert one(spark, talks.doc_type(c("t"), c("p")), t="Authenticating...\n1990–1999 x", p="x/a.txt") == "table_of_contents"
    assert one(spark, talks.strip_stamp(c("t")), t="14:56Walking") == "Walking" and one(spark, talks.strip_stamp(c("t")), t="4:28") == "4:28"
    assert one(spark, talks.clean_toc(c("t")), t="Title\n7:11 verse\nmore") == "Title"
    assert one(spark, talks.clean_toc(c("t"), intent=True), t="Title\n7:11 verse\nmore") == "Title\n\nmore"
    assert tuple(one(spark, talks.split_notes(c("t")), t="Body line one\nNotes\n1. a")) == ("Body line one", "Notes\n1. a")
    assert one(spark, talks.parse_date(c("t"), c("p")), t="none", p="a/2008-10/x.txt") == "October 2008"


def test_html(spark):
    page = "<html><head><style>p{}</style></head><body><script>var t='</p>';</script><p>Visible &amp;  content</p>\n<p>x</p></body></html>"
    rows = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    assert [r.x for r in rows.select(html.text_of(c("html")).alias("x")).collect()] == ["Visible & content\nx", "", ""]
    assert one(spark, html.file_name(c("s")), s="test/talk*with?special<chars>") == "testtalkwithspecialchars.txt"
    assert one(spark, html.file_name(c("s")), s="test-talk.txt") == "test-talk.txt"


def test_resume_and_seeds(spark):
    found = spark.createDataFrame([("https://a/b/talk-1?lang=eng",), ("https://a/b/talk-2?lang=eng",)], "url string")
    have = spark.createDataFrame([("talk-1langeng.txt",)], "file_name string")
    assert [r.url for r in ingest.remaining(found, have).collect()] == ["https://a/b/talk-2?lang=eng"]
    with pytest.raises(ValueError):
        ingest.seeds(spark, 1800, 2000)


@pytest.mark.parametrize(("losses", "patience", "stop", "best"), [([1.0, 0.9, 0.8], 2, None, 0.8), ([1.0, 0.995, 0.992], 2, 3, 0.992)])
def test_early_stopping(spark, losses, patience, stop, best):
    log = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(losses)], "run int, ord int, loss double")
    row = telemetry.stopped_at(log, patience).first()
    assert (row.stopped_at, row.best) == (stop, best)


def test_split_sizes(spark):
    docs = spark.createDataFrame([(i, "A" if i < 10 else "B") for i in range(15)] + [(99, "C")], "doc_id long, author string")
    got = {(r.author, r.split): r["count"] for r in evaluation.split(docs, ratio=0.2).groupBy("author", "split").count().collect()}
    assert got == {("A", "validation"): 2, ("A", "train"): 8, ("B", "validation"): 1, ("B", "train"): 4, ("C", "train"): 1}


def test_quality_of_empty_text(spark):
    assert one(spark, quality.scores(c("t"))["overall_quality"], t="") == 0.0


def test_files(spark, tmp_path):
    (tmp_path / "in/a").mkdir(parents=True)
    (tmp_path / "in/a/x.txt").write_text('junk\n2:3\n"A Title"\nBy Some One\nline\nmore', encoding="utf-8")
    texts = files.read_texts(spark, f"{tmp_path}/in")
    row = files.positional(texts).first()
    assert (row.title, row.author, row.content, row.source) == ("A Title", "Some One", "line\nmore", "x.txt")
    docs = spark.createDataFrame([("liahona", 2008, 4, "text"), ("liahona", 2008, 4, "  ")], "content_type string, year int, month int, content string")
    files.write_texts(docs, f"{tmp_path}/out")
    assert [(r.content, r.ym) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("text", "2008-04")]
    ex = spark.createDataFrame([("p", "é", ("A",))], "prompt string, response string, metadata struct<author:string>")
    files.save_training_data(ex, f"{tmp_path}/jl")
    assert spark.read.json(f"{tmp_path}/jl").first().response == "é"
    files.save_training_data(ex, f"{tmp_path}/js", "json")
    assert json.loads("\n".join(r.value for r in spark.read.text(f"{tmp_path}/js").collect())) == [{"prompt": "p", "response": "é", "metadata": {"author": "A"}}]
    with pytest.raises(ValueError, match="Unsupported format"):
        files.save_training_data(ex, f"{tmp_path}/x", "csv")


def test_config():
    made = config.merge(config.DEFAULTS, {"encoding": {"fixes": {"a": "b"}}, "quality": {"min_body_length": 5, "other": 1}})
    assert made["encoding"]["fixes"] == {"a": "b"} and made["quality"]["min_body_length"] == 5 and "other" not in made["quality"]


LONG = "This is a substantial line of the talk that goes on for more than fifty characters."


def test_clean_content(spark):
    cut = lambda t: one(spark, talks.clean_content(c("t")), t=t)
    assert cut("A clean text\nwith lines") == "A clean text\nwith lines"
    assert cut("14:56Walking\nbody") == "Walking\nbody"
    block = "General Conference April 2023 general conference Contents a lot of Title\nOctober 2023 general conference"
    assert cut(f"x\n{block}\n\n\nThe Real Title\nbody") == "The Real Title\nbody"
    assert cut("Authenticating...\njunk\n4:28Welcome to It\nbody") == "Welcome to It\nbody"
    title = "A Title Long Enough"
    lines = [title, "1990-1999 list", *[f"entry {i}" for i in range(10)], title, "body"]
    assert cut("\n".join(lines)) == f"{title}\nbody"
    assert cut("Authenticating...\nnothing more") == "Authenticating...\nnothing more"


def test_reformat(spark):
    from vellum.operators import reformat

    body = "\n".join([LONG] * 7)
    talk = f"Finding Peace\nBy Elder Joseph Q. Sample\nOf the Seventy\nApril 1995\n\n{body}\nNotes\n1. See  2 Nephi  3:4."
    rows = [("general-conference/1995-04/a.txt", talk), ("x/saturday-morning-session.txt", talk), ("x/c.txt", "nothing"), ("x/contents.txt", talk)]
    got = {r.path: r for r in reformat.reformat(spark.createDataFrame(rows, "path string, content string"), 2025).collect()}
    good = got["general-conference/1995-04/a.txt"]
    # the title stops the skipping of metadata, so it and what follows stay in the body
    head = "Finding Peace\nBy Elder Joseph Q. Sample\nOf the Seventy\nApril 1995"
    assert good.formatted == f"DATE: April 1995\nTITLE: Finding Peace\nAUTHOR: Elder Joseph Q. Sample\nAUTHOR TITLE: Of the Seventy\nBODY:\n{head}\n\n{body}\nNotes\n1. See  2 Nephi 3:4."
    assert good.success and good.warnings == [] and good.output_path == "general-conference/1995-04/a_formatted.txt"
    assert [got[p].message for p, _ in rows[1:]] == ["Skipped session_header content", "Skipped invalid content", "Skipped contents_page content"]
    stats = {r.content_type: (r.processed, r.successful, r.skipped, r.warned) for r in reformat.stats(reformat.reformat(spark.createDataFrame(rows, "path string, content string"), 2025)).collect()}
    assert stats["conference_talk"] == (1, 1, 0, 0) and stats["invalid"] == (1, 0, 1, 0)


def test_output_validity(spark):
    text = "TITLE: a\nAUTHOR: b\nBODY:\n" + "x" * 99
    assert not one(spark, talks.valid_output(c("t"), F.lit("short_remarks")), t=text)
    assert one(spark, talks.valid_output(c("t"), F.lit("short_remarks")), t=text + "x")
    assert not one(spark, talks.valid_output(c("t"), F.lit("short_remarks")), t=text.replace("AUTHOR: b", "AUTHOR:") + "x")


def test_recognition_faults(spark):
    assert one(spark, quality.ocr_rate(c("t")), t="clean words only here") == 0
    assert one(spark, quality.ocr_rate(c("t")), t="wo7ds and ABC now") == 0.5
    assert one(spark, quality.quality_score(c("t")), t="wo7ds and ABC now") < one(spark, quality.quality_score(c("t")), t="Words and more now.")


def test_no_rows_are_lost(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, "c b a"), (5, None)], "doc_id long, content string")
    got = {r.doc_id: (r.class_id, r.n_links, r.nearest_id) for r in curation.near_duplicates(docs).collect()}
    assert got == {1: (1, 1, None), 4: (1, 1, 1), 2: (2, 2, None), 3: (2, 2, 2), 5: (2, 2, 2)}
    rows = spark.createDataFrame([(1, None), (2, None), (3, "x"), (None, "x"), (4, "x")], "doc_id long, author string")
    split = evaluation.split(rows, ratio=0.5)
    assert split.columns == ["doc_id", "author", "split"] and split.count() == 5
    assert {(r.author, r.train_count + r.val_count) for r in evaluation.split_balance(split).collect()} == {(None, 2), ("x", 3)}
    assert evaluation.split_summary(split).first().total_documents == 5


def test_repeated_ids_in_style(spark):
    refs = spark.createDataFrame([("x", "the cat sat. the dog ran."), ("y", "one two three.")], "author string, text string")
    texts = spark.createDataFrame([(1, "x", "the cat sat."), (1, "x", "the cat sat."), (1, "y", "four five."), (2, None, "lost"), (3, "z", None)], "id long, author string, text string")
    got = evaluation.evaluate(texts, refs).collect()
    assert sorted((r.id, str(r.author)) for r in got) == [(1, "x"), (1, "x"), (1, "y"), (2, "None"), (3, "z")]
    same = [r for r in got if r.author == "x"]
    assert same[0] == same[1] and 0 < same[0].overall_similarity <= 1
    assert all(r.vocab_overlap == 0 for r in got if r.author in (None, "z"))


def test_nearest_with_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(90, 80, -1)] + [(1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [-1.0, -0.5]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for block, part in ((20_000, 200_000), (1, 2)):
        got = vectors.nearest(table, table.where("vec_id in (90, 1, 2, 5, 6)"), 3, block, part).orderBy("query_id", "rank").collect()
        assert [(r.query_id, r.vec_id) for r in got] == [(6, 81), (6, 82), (6, 83), (90, 81), (90, 82), (90, 83)]
        assert {r.similarity for r in got} == {1.0, -1.0}
    assert vectors.nearest(table.limit(0), table).count() == 0 and vectors.nearest(table, table.limit(0)).count() == 0


def test_links_to_talks(spark):
    base = "https://www.churchofjesuschrist.org"
    hrefs = ["/study/general-conference/2024/10/", "/study/general-conference/2024/10/slug?lang=eng", "/study/general-conference/2024/10/slug?lang=eng", "/study/liahona/2024/10/slug", "study/general-conference/2024/10/a/b", "/study/general-conference/2024/10?lang=eng", "/study/general-conference/2024/10/slug?lang=spa"]
    pages = spark.createDataFrame([(1, base + "/study/general-conference/2024/10?lang=eng", "".join(f'<a href="{h}">x</a>' for h in hrefs)), (2, base, None)], "page_id long, url string, html string")
    assert [r.url for r in ingest.talk_links(pages).orderBy("pos").collect()] == [base + hrefs[1], base + hrefs[6]]
    assert [r.url for r in ingest.talk_links(pages, "liahona").collect()] == [base + hrefs[3]]
    assert [r.url for r in ingest.anchored_links(pages).collect()] == [base + hrefs[1]]


def test_notes_end_as_they_should(spark):
    cases = {"Notes\nx\n\n": "Notes\nx\n", "": "", None: "", "x": "Notes\nx", "  Notes \n\n\n a \n\n\n b": "Notes\n\na\n\nb"}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", talks.format_notes(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == cases
