"""Catalogues of one folder, an array over part files, and authors of any share."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from vellum.operators import evaluation, ingest
from vellum.sources import files


def test_only_the_folder_asked_for_is_listed(spark, tmp_path, monkeypatch):
    for folder, names in {"general-conference/2024-04": ["a.txt", "b c.txt", "x.json", "d+e.txt"], "general-conference/2024-10": ["c.txt"], "liahona/2024-05": ["d.txt"], "general-conference/2023": ["y.txt"]}.items():
        (tmp_path / folder).mkdir(parents=True)
        for n in names:
            (tmp_path / folder / n).write_text("x")
    asked = []
    plain = files._there
    monkeypatch.setattr(files, "_there", lambda s, p: asked.append(p) or plain(s, p))
    of = lambda *a: sorted(r.file_name for r in files.existing_texts(spark, str(tmp_path), *a).collect())
    assert of(2024, 4) == ["a.txt", "b c.txt", "d+e.txt"]
    assert asked == [f"{tmp_path}/general-conference/2024-04/*.txt"]
    assert files.existing_texts(spark, str(tmp_path), 2024, 4).inputFiles() and all("2024-04" in f for f in files.existing_texts(spark, str(tmp_path), 2024, 4).inputFiles())
    assert of(2023) == ["y.txt"] and of(2024, 5, "liahona") == ["d.txt"]
    assert of(1999, 4) == of(2024) == of(2024, 6, "liahona") == []
    assert files.list_texts(spark, f"{tmp_path}/none").count() == 0 and files.list_texts(spark, str(tmp_path)).count() == 6
    for wrong in ((1800, 4), (2024, 13), (2024, 4, "other")):
        with pytest.raises(ValueError, match="out of range"):
            of(*wrong)
    urls = spark.createDataFrame([("https://x.org/a",), ("https://x.org/z",)], "url string")
    assert [r.url for r in ingest.remaining(urls, files.existing_texts(spark, str(tmp_path), 2024, 4)).collect()] == ["https://x.org/z"]


def test_the_latest_checkpoint_is_by_time(spark, tmp_path):
    assert files.checkpoints(spark, f"{tmp_path}/none").count() == files.load_checkpoint(spark, f"{tmp_path}/none").count() == 0
    for step, at in ((100, 30), (200, 10), (300, 20)):
        p = tmp_path / f"checkpoint_step_{step}.pt"
        p.write_text("x" * step)
        os.utime(p, (1.7e9 + at, 1.7e9 + at))
    (tmp_path / "other.pt").write_text("y")
    assert {r.step for r in files.checkpoints(spark, str(tmp_path)).collect()} == {100, 200, 300}
    assert [(r.step, r.length) for r in files.load_checkpoint(spark, str(tmp_path)).collect()] == [(100, 100)]
    assert [r.step for r in files.load_checkpoint(spark, str(tmp_path), f"{tmp_path}/checkpoint_step_200.pt").collect()] == [200]
    assert files.load_checkpoint(spark, str(tmp_path), f"{tmp_path}/checkpoint_step_9.pt").count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_the_parts_of_an_array_join_to_one(spark, tmp_path, n):
    rows = [(f"p{i}", None if i % 3 == 0 else f'r "{i}"\né', {"author": f"a{i}"}) for i in range(n)]
    df = spark.createDataFrame(rows, "prompt string, response string, metadata map<string,string>").repartition(6)
    files.save_training_data(df, str(tmp_path / "out"), "json")
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    got = json.loads("".join(p.read_text() for p in parts))
    assert sorted((x["prompt"], x["response"], x["metadata"]["author"]) for x in got) == sorted(((p, r, m["author"]) for p, r, m in rows), key=lambda x: x[0]) if n != 400 else len(got) == n
    assert len(parts) > 1 or n < 7


def test_top_terms_of_an_author_in_parts(spark):
    rng = random.Random(1)
    rows = [(a, f"t{i}", rng.randint(1, 30)) for a, n in (("x", 900), ("y", 3), (None, 40)) for i in range(n)]
    got = {r.author: [(t.term, t.rn) for t in r.top] for r in evaluation.top_terms(spark.createDataFrame(rows, "author string, term string, rn long"), 25).collect()}
    for a in ("x", "y", None):
        assert got[a] == sorted(((t, n) for b, t, n in rows if b == a), key=lambda x: (-x[1], x[0]))[:25]


def test_rows_of_one_author_are_dealt_out(spark):
    rows = spark.range(2000).select("id", F.lit("x").alias("author")).unionByName(spark.createDataFrame([(-1, None), (-2, "z")], "id long, author string"))
    one = spark.createDataFrame([("x", 1), ("y", 2)], "author string, v int")
    made = evaluation.by_author(rows, one, "id")
    assert made.count() == 2002 and made.where("v = 1").count() == 2000 and evaluation.by_author(rows, one, "id", how="inner").count() == 2000
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_times_are_kept(spark, tmp_path):
    (tmp_path / "general-conference/2020-04").mkdir(parents=True)
    (tmp_path / "general-conference/2020-04/a.txt").write_text("abc")
    row = files.existing_texts(spark, str(tmp_path), 2020, 4).first()
    assert row.length == 3 and row.modificationTime > dt.datetime(2024, 1, 1)
