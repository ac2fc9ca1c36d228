"""Streams that stop and go on: rows once, state kept, keys forgotten, triggers told."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from vellum.operators import telemetry
from vellum.sources import files
from vellum.streaming import runs, trainer

START = dt.datetime(2024, 1, 1)
LOG = "run long, ord long, ts timestamp, loss double, operation string"


def rows(spark, ords, late=()):
    made = [(o % 2, o, START + dt.timedelta(hours=o), float(abs(30 - o % 37) + o % 3), f"op{o % 4}") for o in ords]
    return spark.createDataFrame(made, LOG)


def log(spark, folder):
    return runs.read(spark, f"{folder}/in", LOG)


def plain(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_a_stopped_stream_goes_on_and_puts_out_each_row_once(spark, tmp_path):
    folder, seen = str(tmp_path), []

    def fails_once(batch, number):
        seen.append(number)
        if number == 1 and seen.count(1) == 1:
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch=1")  # it got as far as writing
            raise RuntimeError("executor lost")

    runs.land([rows(spark, range(0, 10)), rows(spark, range(10, 20))], f"{folder}/in")
    with pytest.raises(Exception, match="executor lost"):
        runs.resume(log(spark, folder), folder, check=fails_once)
    assert plain(runs.resume(log(spark, folder), folder, check=fails_once), "ord") == [(o,) for o in range(20)]
    assert seen == [0, 1, 1]
    assert runs.resume(log(spark, folder), folder).count() == 20  # nothing new, nothing twice
    runs.land([rows(spark, range(20, 25))], f"{folder}/in")
    assert plain(runs.resume(log(spark, folder), folder), "ord") == [(o,) for o in range(25)]


def test_a_stream_without_rows_gives_none(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert runs.resume(log(spark, str(tmp_path)), str(tmp_path)).collect() == []


def test_early_stopping_goes_on_after_a_restart_as_if_it_had_not_ended(spark, tmp_path):
    folder = str(tmp_path)
    every = [*range(0, 60)]
    parts = [[o for o in every if (o // 15 + (1 if o % 5 == 0 and o < 45 else 0)) == p] for p in range(4)]  # one in five a file late
    end = spark.createDataFrame([(-1, -1, START + dt.timedelta(days=90), None, "end")], LOG)
    cols = ("run", "ord", "loss", "best", "wait", "should_stop")
    runs.land([rows(spark, p) for p in parts[:2]], f"{folder}/in")
    begun = runs.resume(trainer.trainer_log(log(spark, folder), 4, late="16 hours"), folder)
    assert 0 < begun.count() < 30
    runs.land([rows(spark, p) for p in parts[2:]] + [end], f"{folder}/in")
    got = runs.resume(trainer.trainer_log(log(spark, folder), 4, late="16 hours"), folder)
    want = plain(telemetry.early_stopping(rows(spark, every), 4), *cols)
    assert plain(got.where("event = 'log'"), *cols) == want
    first = {run: min(r[1] for r in want if r[0] == run and r[5]) for run in (0, 1) if any(r[5] for r in want if r[0] == run)}
    assert first and {r.run: r.ord for r in got.where("event = 'stop'").collect()} == first


def test_every_n_keeps_the_rule_of_a_collector(spark, tmp_path):
    folder = str(tmp_path)
    ords = [o for o in range(80) if o % 7 != 3 and o not in range(30, 42)] + [90]
    kept, want = {0: [], 1: []}, []
    for o in ords:
        kept[o % 2].append(o)
        if o % 10 == 0:
            want += [(o % 2, x, o) for x in kept[o % 2][-10:]]
    runs.land([rows(spark, ords[:20]), rows(spark, ords[20:21])], f"{folder}/in")
    runs.resume(trainer.every_n(log(spark, folder)), folder)
    runs.land([rows(spark, ords[21:])], f"{folder}/in")
    assert plain(runs.resume(trainer.every_n(log(spark, folder)), folder), "run", "ord", "flushed_at") == sorted(want)
    assert plain(telemetry.flushed(rows(spark, ords)), "run", "ord", "flushed_at") == sorted(want)
    files.append_metrics(rows(spark, ords), f"{folder}/log", every=10)
    assert spark.read.json(f"{folder}/log").count() == len(want)


def test_a_key_that_comes_again_passes_once_and_is_forgotten_in_time(spark, tmp_path):
    folder, schema = str(tmp_path), "key string, at timestamp, n int"
    at = lambda h: START + dt.timedelta(hours=h)
    parts = [[("a", at(0), 1), ("b", at(1), 2), ("a", at(1), 3), (None, at(1), 4), ("k", at(1), 5)], [("a", at(2), 6), ("c", at(2), 7)], [("d", at(30), 8)], [("e", at(31), 9), ("b", at(31), 10)]]
    known = spark.createDataFrame([("k",)], "key string")
    kept = lambda: runs.new_keys(runs.read(spark, f"{folder}/in", schema), "key", "at", "5 hours", known)
    for p in parts:  # a run for each file: what was seen is in the state, not in memory
        runs.land([spark.createDataFrame(p, schema)], f"{folder}/in")
        got = runs.resume(kept(), folder)
    # b comes again long after its time has passed
    assert [r.key for r in got.orderBy("key").collect()] == ["a", "b", "b", "c", "d", "e"]


def test_progress_tells_what_each_trigger_read(spark, tmp_path):
    folder = str(tmp_path)
    runs.land([rows(spark, range(7)), rows(spark, range(7, 10))], f"{folder}/in")
    runs.progress(log(spark, folder), folder)
    runs.land([rows(spark, range(10, 14))], f"{folder}/in")
    told = runs.progress(log(spark, folder), folder)
    assert plain(told, "batch", "rows") == [(0, 7), (1, 3), (2, 4)]
    assert told.where("ms > 0").count() == 3 and told.select("query").distinct().count() == 1


def test_no_local_folder_off_local_masters(spark, monkeypatch):
    from vellum import session

    class Cluster:
        sparkContext = type("C", (), {"master": "yarn"})
        conf = type("F", (), {"get": staticmethod(lambda k, d=None: None)})

    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.shared_dir(Cluster)


def test_delayed_rows_stay_whole(spark):
    frames = runs.delayed(rows(spark, range(40)), 4, F.col("ord"), F.col("ord") % 4 == 0)
    assert sorted(r.ord for f in frames for r in f.collect()) == list(range(40))
    assert {r.ord for r in frames[1].collect()} == {0, 4, 8} | {o for o in range(10, 20) if o % 4}
