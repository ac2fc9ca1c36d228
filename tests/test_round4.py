"""What round 4's findings named."""

import random

import duckdb
from test_growth import written
from vellum.functions import html
from vellum.operators import curation
from vellum.plans import ingesting

CUT = ['a = &quot</p>', "&quotb &amp &am &ampc &a & &amp;", "&copy &copy; &middot x&middot;", "&quo;&quotx; &amp;quot; &;", "a&quot", "&quot;&amp"]


def test_cut_references_are_left_as_the_sql_leaves_them(spark, tmp_path):
    rows = [(i, "u", f"<html><script>x = '&quot';</script><body><p>{t}<p>y &quot;z&quot;</p></body></html>") for i, t in enumerate(CUT)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in ingesting.QUERIES["html_to_text"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == dict(con.sql(ingesting.ORACLES["html_to_text"]).fetchall())
    # the operator itself decodes as HTML does
    assert spark.createDataFrame([("<p>&quot</p>",)], "h string").select(html.text_of("h")).first()[0] == '"'


def test_pairs_of_near_copies_are_not_written(spark, monkeypatch):
    def copies(n):
        rng = random.Random(n)
        base = [f"word{i}" for i in range(80)]
        return [" ".join(base[:i] + base[i + 1 :] + [f"own{k}"]) for k, i in enumerate(rng.choices(range(80), k=n))]

    records = {}
    for n in (300, 900):
        texts = copies(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string").repartition(4)
        rows, records[n], _ = written(spark, lambda docs=docs: curation.near_duplicates(docs).collect())
        assert {r.doc_id: (r.class_id, r.n_links, r.nearest_id) for r in rows} == {i: (i, n - 1, int(i == 0)) for i in range(n)}
    assert records[900] < 4 * records[300], records  # all pairs are nine times as many
    monkeypatch.setattr(curation, "WORDS", 80 * 100)  # tiles by words
    assert {r.doc_id: (r.class_id, r.n_links, r.nearest_id) for r in curation.near_duplicates(docs).collect()} == {i: (i, 899, int(i == 0)) for i in range(900)}
