"""Queries: metric streams over the events files."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import html
from vellum.plans import ingesting
from vellum.plans import metrics as batch
from vellum.streaming import metrics, runs, trainer
from vellum.tables import load

c = F.col
#: Files that events are cut into: so many, or more, so that none has more rows than this.
PARTS, ROWS = 6, 5_000_000


def _cut(s, d, late=False):
    """events as files in order of their ids, or, with `late`, of their times and one in seven in the file after its own."""
    rows = load(s, d, "events")
    parts = max(PARTS, -(-rows.count() // ROWS))
    return runs.delayed(rows, parts, F.unix_micros(c("ts").cast("timestamp")), c("event_id") % 7 == 0) if late else runs.delayed(rows, parts, c("event_id"))


def _stream(s, frames, folder):
    runs.land(frames, f"{folder}/in")
    return metrics.rows_of(runs.read(s, f"{folder}/in", metrics.EVENTS))


def _late(s, d):
    return runs.resume(metrics.windowed(_stream(s, _cut(s, d, True), runs.new_folder(s)), late="6 days"), runs.new_folder(s), "update")


def _resumed(s, d):
    """The log of a stream that ends after three files and is taken up again when the others have come."""
    folder, frames = runs.new_folder(s), _cut(s, d)
    runs.resume(_stream(s, frames[:3], folder), folder)
    return runs.resume(_stream(s, frames[3:], folder), folder).select("run", "ord", "loss", "operation")


def _trainer(s, d):
    """Logs of all rows: a last file, of no run's, takes the watermark past them."""
    frames, folder = _cut(s, d, True), runs.new_folder(s)
    end = load(s, d, "events").agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), (c("ts") + F.expr("INTERVAL 60 DAYS")).alias("ts"), F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(None).cast("double").alias("value"), F.lit("").alias("props"))
    return runs.resume(trainer.trainer_log(_stream(s, [*frames, end], folder), 5, late="6 days"), folder).drop("batch")


def _new_pages(s, d):
    """Names of the files that pages are kept in, as pages come in three parts, each with the one before once more; a fifth was kept earlier."""
    folder = runs.new_folder(s)
    pages = load(s, d, "pages").select("page_id", html.file_name(html.slug(c("url"))).alias("file_name"), F.timestamp_seconds("page_id").alias("fetched"))
    first, second, third = runs.delayed(pages, 3, c("page_id"))
    runs.land([first, second.unionByName(first), third.unionByName(second)], f"{folder}/in")
    kept = pages.where("page_id % 5 = 0").select("file_name")
    return runs.resume(runs.new_keys(runs.read(s, f"{folder}/in", pages.schema), "file_name", "fetched", "30 days", kept), folder).select("file_name")


def _progress(s, d):
    folder = runs.new_folder(s)
    return runs.progress(_stream(s, _cut(s, d), folder), folder).select("batch", c("rows").alias("n_rows"))


QUERIES = {
    "stream_metrics_agg": lambda s, d: metrics.run_once(metrics.windowed(metrics.events(s, d)), "update").groupBy("start", "operation").agg(*[F.max_by(k, "batch").alias(k) for k in ("n", "mean_loss", "max_loss")]),
    "stream_early_stop": lambda s, d: metrics.run_once(metrics.early_stopping(metrics.events(s, d), 5), "update").groupBy("run").agg(*[F.max_by(k, "batch").alias(k) for k in ("seen", "best", "wait")], F.max("stopped_at").alias("stopped_at")),
    "stream_metric_log": lambda s, d: metrics.log(metrics.events(s, d)).select("run", "ord", "loss", "operation"),
    "stream_metrics_late": lambda s, d: _late(s, d).groupBy("start", "operation").agg(*[F.max_by(k, "batch").alias(k) for k in ("n", "mean_loss", "max_loss")]),
    "stream_resumed_log": _resumed,
    "stream_trainer_log": _trainer,
    "stream_every_n": lambda s, d: runs.resume(trainer.every_n(_stream(s, _cut(s, d), folder := runs.new_folder(s))), folder).drop("batch"),
    "stream_new_pages": _new_pages,
    "stream_progress": _progress,
}

_STOP = """WITH RECURSIVE l AS (SELECT user_id AS run, event_id AS ord, value AS loss, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
    w AS (SELECT run, i, ord, loss AS best, 0 AS wait, NULL::BIGINT AS stopped FROM l WHERE i = 1
        UNION ALL SELECT l.run, l.i, l.ord, least(best, l.loss), CASE WHEN best - l.loss > 0.01 THEN 0 ELSE wait + 1 END, CASE WHEN best - l.loss <= 0.01 AND wait + 1 >= 5 THEN l.ord END FROM w JOIN l ON w.run = l.run AND l.i = w.i + 1 WHERE stopped IS NULL)
    SELECT run, max(i) AS seen, arg_max(best, i) AS best, arg_max(wait, i)::BIGINT AS wait, max(stopped) AS stopped_at FROM w GROUP BY run"""

ORACLES = {
    "stream_metrics_agg": "SELECT time_bucket(INTERVAL 1 HOUR, ts)::TIMESTAMPTZ AS start, event_type AS operation, count(*) AS n, round(avg(value), 6) AS mean_loss, max(value) AS max_loss FROM events GROUP BY ALL",
    "stream_early_stop": _STOP,
    "stream_metric_log": "SELECT user_id AS run, event_id AS ord, value AS loss, event_type AS operation FROM events",
}

_SPAN = f"(SELECT min(event_id) AS lo, (max(event_id) - min(event_id) + {PARTS}) // {PARTS} AS span FROM events)"
ORACLES |= {
    "stream_metrics_late": ORACLES["stream_metrics_agg"],
    "stream_resumed_log": ORACLES["stream_metric_log"],
    "stream_trainer_log": f"""{batch._stop(5, 0.01, 1)}, x AS (SELECT e.run, l.event_id AS ord, e.loss, best, wait::BIGINT AS wait, should_stop, e.ord AS i FROM e JOIN ({batch._LOG}) l ON e.run = l.run AND e.ord = l.ord)
        SELECT run, ord, loss, best, wait, should_stop, 'log' AS event FROM x UNION ALL SELECT run, ord, loss, best, wait, should_stop, 'stop' FROM x WHERE should_stop QUALIFY row_number() OVER (PARTITION BY run ORDER BY i) = 1""",
    "stream_every_n": batch.ORACLES["metric_flushes"],
    "stream_new_pages": f"SELECT DISTINCT {ingesting._FILE} AS file_name FROM pages WHERE {ingesting._FILE} NOT IN (SELECT {ingesting._FILE} FROM pages WHERE page_id % 5 = 0 AND {ingesting._FILE} IS NOT NULL)",
    "stream_progress": f"SELECT (event_id - lo) // span AS batch, count(*) AS n_rows FROM events, {_SPAN} GROUP BY ALL",
}
