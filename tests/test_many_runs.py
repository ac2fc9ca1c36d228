"""Trainer streams over many runs: what a trigger keeps and does follows groups of runs, and each run has its own rule."""

import datetime as dt
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from vellum.streaming import runs, trainer

LOG = "run long, ord long, ts timestamp, loss double, operation string"


def by_the_rule(rows, state, patience, delta):
    """Log rows and stop events, one row after the other."""
    out = []
    for run, _, ord_, loss in sorted(rows):
        seen, best, wait, stopped = state.get(run, (0, None, 0, False))
        wait = 0 if seen == 0 or best - loss > delta else wait + 1
        best = loss if seen == 0 else min(best, loss)
        first = not stopped and wait >= patience
        stopped = stopped or first
        state[run] = (seen + 1, best, wait, stopped)
        out += [(run, ord_, loss, best, wait, stopped, e) for e in (["log", "stop"] if first else ["log"])]
    return sorted(out)


def test_rules_of_a_group_are_those_of_each_run_alone():
    rng = random.Random(2)
    for patience in (1, 2, 5):
        rules, state = np.empty(0, trainer._RULE), {}
        for _ in range(60):
            rows = [(rng.randint(-3, 12), rng.randint(0, 9), rng.randint(0, 99), rng.choice([1.0, 0.995, 0.5, rng.random(), float("inf"), -3.0])) for _ in range(rng.choice([0, 1, 3, 40]))]
            out, rules = trainer.judged(np.array(rows, trainer._ROW), rules, patience, 0.01)
            assert sorted(out.itertuples(index=False, name=None)) == by_the_rule(rows, state, patience, 0.01)
        assert {r["run"]: (r["seen"], r["best"], r["wait"], r["stopped"]) for r in rules} == state


def test_state_grows_with_groups_and_not_with_runs(spark, tmp_path):
    folder, many = str(tmp_path), 4000
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 50)
    rows = spark.range(2 * many).select((F.col("id") % many).alias("run"), F.col("id").alias("ord"), at.alias("ts"), F.lit(1.0).alias("loss"), F.lit("x").alias("operation"))
    runs.land([rows], f"{folder}/in")
    for name, made in (("log", trainer.trainer_log), ("every", trainer.every_n)):
        told = runs.progress(made(runs.read(spark, f"{folder}/in", LOG)), f"{folder}/{name}")
        assert 0 < max(r.state_rows for r in told.collect()) <= 5 * trainer.GROUPS


def test_last_rows_of_many_runs_are_written_as_by_the_rule(spark, tmp_path):
    folder, rng, kept, want = str(tmp_path), random.Random(9), {}, []
    ords, parts = {}, []
    for _ in range(4):
        part = []
        for _ in range(300):
            run = rng.randint(0, 40)
            ords[run] = ords.get(run, 0) + rng.choice([1, 1, 1, 2])
            part.append((run, ords[run], dt.datetime(2024, 1, 1), rng.choice([None, 1.5, 2.5]), rng.choice([None, "é", "op"])))
        parts.append(spark.createDataFrame(part, LOG))
        for run, o, _, loss, op in part:
            kept[run] = [*kept.get(run, []), (o, loss, op)][-3:]
            if o % 3 == 0:
                want += [(run, *k, o) for k in kept[run]]
    runs.land(parts, f"{folder}/in")
    got = runs.resume(trainer.every_n(runs.read(spark, f"{folder}/in", LOG), 3), folder).drop("batch")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_landed_frame_is_one_file_of_small_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "GROUP", 1 << 16)
    runs.land([spark.range(300_000).select(F.xxhash64("id").alias("x"))], str(tmp_path / "in"))
    (made,) = (tmp_path / "in").glob("*.parquet")
    assert pq.ParquetFile(made).metadata.num_row_groups > 5
