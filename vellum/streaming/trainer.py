"""Trainer logs as streams with state of several variables a run: early stopping in event order, and a log written every n steps.

Rows are (run, ord, ts, loss, operation). Files may overlap in time: rows wait until the watermark has passed them.
Runs are dealt to a fixed number of groups; a group's state holds that of its runs side by side, and its rows are worked
on as arrays, so that what a trigger costs follows its rows and not the number of runs and timers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LOG = "run long, ord long, loss double, best double, wait long, should_stop boolean, event string"
#: Groups that runs are dealt to.
GROUPS = 256
_ROW = np.dtype([("run", "i8"), ("ts_us", "i8"), ("ord", "i8"), ("loss", "f8")])
_RULE = np.dtype([("run", "i8"), ("seen", "i8"), ("best", "f8"), ("wait", "i8"), ("stopped", "?")])


def _group() -> Column:
    return F.pmod(F.hash("run"), F.lit(GROUPS)).alias("group")


def _held(state, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(state.get()[0], kind) if state.exists() else np.empty(0, kind)


def judged(rows: np.ndarray, rules: np.ndarray, patience: int, min_delta: float) -> tuple[pd.DataFrame, np.ndarray]:
    """Log rows and stop events of `rows`, which follow those that `rules` (one a run, by run) have seen; and the rules after them."""
    runs = np.union1d(rules["run"], rows["run"])
    after = np.zeros(len(runs), _RULE)
    after["run"], after["best"] = runs, np.inf
    after[np.searchsorted(runs, rules["run"])] = rules
    rows = rows[np.lexsort((rows["loss"], rows["ord"], rows["ts_us"], rows["run"]))]
    of, at = np.searchsorted(runs, rows["run"]), np.arange(len(rows))
    begins = np.r_[True, of[1:] != of[:-1]] if len(rows) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(begins, at, 0))
    old, loss = after[of], rows["loss"]
    least = pd.Series(loss).groupby(of).cummin().to_numpy()
    prior = np.minimum(old["best"], np.where(begins, np.inf, np.roll(least, 1)))
    with np.errstate(invalid="ignore"):
        better = (begins & (old["seen"] == 0)) | (prior - loss > min_delta)
    last = np.maximum.accumulate(np.where(better, at, -1))
    wait = np.where(last >= start, at - last, old["wait"] + at - start + 1)
    over = wait >= patience
    many = np.cumsum(over)
    hits = many - many[start] + over[start]
    out = pd.DataFrame({"run": rows["run"], "ord": rows["ord"], "loss": loss, "best": np.minimum(old["best"], least), "wait": wait, "should_stop": old["stopped"] | (hits > 0), "event": "log"})
    stops = out[over & (hits == 1) & ~old["stopped"]].assign(event="stop")
    ends = np.flatnonzero(np.r_[begins[1:], True]) if len(rows) else at
    after["seen"][of[ends]] += ends - start[ends] + 1
    for k in ("best", "wait"):
        after[k][of[ends]] = out[k].to_numpy()[ends]
    after["stopped"][of[ends]] = out["should_stop"].to_numpy()[ends]
    return pd.concat([out, stops], ignore_index=True), after


class TrainerLog(StatefulProcessor):
    """Puts out a log row for each row with a loss, in order of (ts, ord), and one stop event a run.

    State of a group of runs: rows not yet passed by the watermark, the rule's numbers of each run, and the time of the
    timer that is set. A timer at the earliest waiting row puts out all that the watermark has passed and is set anew for
    the rest. Rows that come after their time was passed are dropped by the watermark's rule, as elsewhere in a stream.
    """

    def __init__(self, patience: int, min_delta: float):
        self.patience, self.min_delta = patience, min_delta

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "held binary")
        self.rules = handle.getValueState("rules", "held binary")
        self.timer = handle.getValueState("timer", "at long")

    def _set(self, at: int) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        if old is not None and old <= at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        come = [_held(self.waiting, _ROW)]
        for f in rows:
            f = f[f["loss"].notna()]
            made = np.empty(len(f), _ROW)
            for k in _ROW.names:
                made[k] = f[k]
            come.append(made)
        held = np.concatenate(come)
        if len(held) > len(come[0]):
            self.waiting.update((held.tobytes(),))
            # a watermark of whole milliseconds has passed a row when it is beyond the row's own
            self._set(int(held["ts_us"].min()) // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = _held(self.waiting, _ROW)
        passed = held["ts_us"] // 1000 < timerValues.getCurrentWatermarkInMs()
        rest = held[~passed]
        self.timer.clear()
        if len(rest):
            self.waiting.update((rest.tobytes(),))
            self._set(int(rest["ts_us"].min()) // 1000 + 1)
        else:
            self.waiting.clear()
        if passed.any():
            out, rules = judged(held[passed], _held(self.rules, _RULE), self.patience, self.min_delta)
            self.rules.update((rules.tobytes(),))
            yield out

    def close(self) -> None:
        pass


def trainer_log(rows: DataFrame, patience: int = 3, min_delta: float = 0.01, late: str = "1 day") -> DataFrame:
    """The log of a stream of (run, ord, ts, loss): run, ord, loss, best so far, rows waited, whether to stop, event.

    As the batch form `telemetry.early_stopping`, row for row, once the watermark (`late` behind the latest time) has
    passed a row; the event is `log`, and `stop` once a run. Rows without run, time or loss are left out.
    """
    micros = rows.where("run is not null and ts is not null").withWatermark("ts", late)
    keyed = micros.select(_group(), "run", "ts", F.unix_micros("ts").alias("ts_us"), "ord", F.col("loss").cast("double").alias("loss"))
    return keyed.groupBy("group").transformWithStateInPandas(TrainerLog(patience, min_delta), LOG, "Append", "EventTime")


class EveryN(StatefulProcessor):
    """Keeps the last n rows of each run of a group and writes them, whichever were written before, at each step that n divides."""

    def __init__(self, n: int, schema: pa.Schema):
        self.n, self.schema = n, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "held binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        come = pa.Table.from_pandas(pd.concat(list(rows)).sort_values("ord", kind="stable"), self.schema, preserve_index=False)
        kept = pa.ipc.open_stream(self.last.get()[0]).read_all() if self.last.exists() else come.slice(0, 0)
        whole = pa.concat_tables([kept, come])
        of = pd.factorize(whole["run"].to_pandas())[0]
        order = np.argsort(of, kind="stable")  # a run's kept rows, then those that came
        of, whole = of[order], whole.take(order)
        at, ord_ = np.arange(len(of)), whole["ord"].to_numpy()
        begins = np.r_[True, of[1:] != of[:-1]]
        start = np.maximum.accumulate(np.where(begins, at, 0))
        flushed = np.flatnonzero((order >= len(kept)) & (ord_ % self.n == 0))
        low = np.maximum(start[flushed], flushed - self.n + 1)
        many = flushed - low + 1
        take = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        ends = np.flatnonzero(np.r_[begins[1:], True])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema) as out:
            out.write_table(whole.filter(at > ends[np.searchsorted(ends, at)] - self.n))
        self.last.update((sink.getvalue().to_pybytes(),))
        if len(take):
            yield whole.take(take).to_pandas().assign(flushed_at=np.repeat(ord_[flushed], many))

    def close(self) -> None:
        pass


def every_n(rows: DataFrame, n: int = 10) -> DataFrame:
    """(run, ord, loss, operation, flushed_at): what a collector writes that saves its last n rows when n divides the step.

    A run's rows come in order of their step (`ord`), from trigger to trigger; within one trigger they are sorted. Steps
    that leave gaps are written twice or not at all, as the rule has it, and rows after the last such step not at all.
    """
    named = rows.where("run is not null and ord is not null").select(_group(), "run", "ord", F.col("loss").cast("double").alias("loss"), "operation")
    schema = T.StructType([*named.drop("group").schema, T.StructField("flushed_at", T.LongType())])
    held = to_arrow_schema(named.drop("group").schema)
    return named.groupBy("group").transformWithStateInPandas(EveryN(n, held), schema, "Append", "None")
