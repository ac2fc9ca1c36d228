"""Queries: telemetry over events as a metric log (run = user, loss = value, operation = type)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vellum.operators import telemetry as t
from vellum.tables import load

c = F.col


def log(s, d):
    ord_ = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("ord")
    return load(s, d, "events").select(c("user_id").alias("run"), ord_, "event_id", "ts", c("value").alias("loss"), c("event_type").alias("operation"), c("value").alias("seconds"), (c("event_type") == "error").alias("failed"))


def _checkpoints(s, d):
    return log(s, d).where("operation = 'purchase'").select("run", F.concat(F.lit("checkpoint_step_"), c("ord").cast("string"), F.lit(".pt")).alias("path"), c("ts").alias("mtime"), c("ord").alias("step"))


QUERIES = {
    "early_stopping": lambda s, d: t.early_stopping(log(s, d)),
    "early_stopping_max": lambda s, d: t.early_stopping(log(s, d), 4, 1.0, "max"),
    "early_stopped_at": lambda s, d: t.stopped_at(log(s, d), 5),
    "convergence": lambda s, d: t.convergence(log(s, d)),
    "trend_corr": lambda s, d: t.improving(log(s, d)),
    "perplexity": lambda s, d: t.perplexity(log(s, d).withColumn("loss", c("loss") / 100), F.length("operation").cast("double")),
    "step_time_stats": lambda s, d: t.operation_times(log(s, d)),
    "recent_metrics": lambda s, d: t.recent(log(s, d), 20),
    "training_report": lambda s, d: t.training_report(log(s, d)),
    "micro_batches": lambda s, d: t.micro_batches(log(s, d).select("run", "event_id"), "event_id", 8, "run"),
    "grad_accum": lambda s, d: t.accumulate(log(s, d), 16),
    "adaptive_accum": lambda s, d: log(s, d).select("event_id", t.adaptive_steps(c("loss") / 100, 16).alias("steps"), t.should_checkpoint(c("ord"), 10).alias("checkpoint")),
    "checkpoint_retention": lambda s, d: t.retention(_checkpoints(s, d)),
    "progress_eta": lambda s, d: t.progress(log(s, d)),
    "rate_wait": lambda s, d: t.rate_wait(log(s, d), 3600.0),
    "backoff": lambda s, d: log(s, d).select("event_id", t.backoff(c("ord") % 9).alias("wait"), t.retries(F.when(c("failed"), 503).when(c("operation") == "view", 404).otherwise(200), c("ord") % 12).alias("then")),
    "duration_format": lambda s, d: log(s, d).select("event_id", t.duration(F.floor(c("loss") * 40).cast("double")).alias("took")),
}

_LOG = "SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord, event_id, ts, value AS loss, event_type AS operation, value AS seconds, event_type = 'error' AS failed FROM events"


def _stop(patience, delta, sign):
    v = f"(loss * {sign})"
    return f"""WITH l AS (SELECT *, min{v} OVER (PARTITION BY run ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM ({_LOG})), m AS (SELECT *, (prior IS NULL OR prior - {v} > {delta})::INT AS sig FROM l),
        i AS (SELECT *, sum(sig) OVER (PARTITION BY run ORDER BY ord) AS island FROM m), w AS (SELECT *, (row_number() OVER (PARTITION BY run, island ORDER BY ord) - 1)::INT AS wait FROM i),
        e AS (SELECT run, ord::INT AS ord, loss, min{v} OVER (PARTITION BY run ORDER BY ord) * {sign} AS best, wait, max((wait >= {patience})::INT) OVER (PARTITION BY run ORDER BY ord) = 1 AS should_stop FROM w)"""


_EPOCH = "(epoch_us(ts) / 1e6)"
ORACLES = {
    "early_stopping": f"{_stop(3, 0.01, 1)} SELECT * FROM e",
    "early_stopping_max": f"{_stop(4, 1.0, -1)} SELECT * FROM e",
    "early_stopped_at": f"{_stop(5, 0.01, 1)}, a AS (SELECT run, min(ord) AS stopped_at FROM e WHERE should_stop GROUP BY run) SELECT e.run, max(stopped_at) AS stopped_at, min(loss) AS best, count(*) AS evaluations FROM e LEFT JOIN a ON e.run = a.run WHERE stopped_at IS NULL OR ord <= stopped_at GROUP BY e.run",
    "convergence": f"SELECT *, round(CASE WHEN n < 2 OR first_loss - best_loss <= 0 THEN 0 ELSE (first_loss - last_loss) / (first_loss - best_loss) END, 6) AS efficiency FROM (SELECT run, count(*) AS n, arg_min(loss, ord) AS first_loss, arg_max(loss, ord) AS last_loss, min(loss) AS best_loss FROM ({_LOG}) GROUP BY run)",
    "trend_corr": f"SELECT run, trend, coalesce(trend < -0.1, false) AS improving FROM (SELECT run, CASE WHEN count(*) >= 5 THEN round(corr(5 - d, loss), 6) END AS trend FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ord DESC) AS d FROM ({_LOG})) WHERE d <= 5 GROUP BY run)",
    "perplexity": f"SELECT run, round(exp(sum(loss / 100 * length(operation)) / sum(length(operation))), 6) AS perplexity FROM ({_LOG}) GROUP BY run",
    "step_time_stats": f"SELECT operation, round(avg(seconds), 6) AS mean, round(stddev_pop(seconds), 6) AS std, min(seconds) AS least, max(seconds) AS greatest, round(sum(seconds), 4) AS total, count(*) AS n FROM ({_LOG}) GROUP BY operation",
    "recent_metrics": f"SELECT run, count(*) AS total_steps, round(avg(loss) FILTER (WHERE d <= 20), 6) AS recent_mean, round(stddev_pop(loss) FILTER (WHERE d <= 20), 6) AS recent_std FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ord DESC) AS d FROM ({_LOG})) GROUP BY run",
    "training_report": f"SELECT run, count(*) AS total_steps, max(ord)::INT AS last_step, round(max({_EPOCH}) - min({_EPOCH}), 3) AS seconds, min(loss) AS best_loss, arg_max(loss, ord) AS final_loss FROM ({_LOG}) GROUP BY run",
    "micro_batches": f"SELECT run, event_id, batch FROM (SELECT *, count(*) OVER (PARTITION BY run, batch) AS n FROM (SELECT run, event_id, (row_number() OVER (PARTITION BY run ORDER BY md5('42|' || event_id), event_id) - 1) // 8 AS batch FROM ({_LOG}))) WHERE n = 8",
    "grad_accum": f"SELECT run, update, count(*) AS n, round(sum(loss / 16), 6) AS loss FROM (SELECT *, (ord + 15) // 16 AS update FROM ({_LOG})) GROUP BY run, update",
    "adaptive_accum": f"SELECT event_id, CASE WHEN loss / 100 > 0.8 THEN 8 ELSE 16 END AS steps, ord % 10 = 0 AS checkpoint FROM ({_LOG})",
    "checkpoint_retention": f"SELECT run, path, mtime, step::INT AS step, n <= 3 AS keep, n = 1 AS latest FROM (SELECT run, 'checkpoint_step_' || ord || '.pt' AS path, ts AS mtime, ord AS step, row_number() OVER (PARTITION BY run ORDER BY ts DESC, ord DESC) AS n FROM ({_LOG}) WHERE operation = 'purchase')",
    "progress_eta": f"""SELECT run, ord::INT AS ord, done, failed_so_far, round(done / total * 100, 4) AS percent, us // done AS mean_us, us * (total - done) // done AS eta_us, repeat('█', (done * 30 // total)::INT) || repeat('░', (30 - done * 30 // total)::INT) AS bar
        FROM (SELECT run, ord, ord AS done, (sum(failed::INT) OVER w)::BIGINT AS failed_so_far, count(*) OVER (PARTITION BY run) AS total, epoch_us(ts) - min(epoch_us(ts)) OVER w AS us FROM ({_LOG}) WINDOW w AS (PARTITION BY run ORDER BY ord))""",
    "rate_wait": f"SELECT run, ord::INT AS ord, round(coalesce(greatest(0, 3600 - ({_EPOCH} - lag({_EPOCH}) OVER (PARTITION BY run ORDER BY ord))), 0), 3) AS wait FROM ({_LOG})",
    "backoff": f"SELECT event_id, least(pow(2.0, ord % 9), 60.0) AS wait, CASE WHEN failed THEN CASE WHEN ord % 12 >= 10 THEN 'give_up' ELSE 'retry' END WHEN operation = 'view' THEN 'raise' ELSE 'done' END AS then FROM ({_LOG})".replace("AS then", 'AS "then"'),
    "duration_format": f"SELECT event_id, CASE WHEN x < 60 THEN x || '.0s' WHEN x < 3600 THEN (x // 60) || 'm ' || (x % 60) || 's' ELSE (x // 3600) || 'h ' || (x % 3600 // 60) || 'm' END AS took FROM (SELECT event_id, floor(loss * 40)::INT AS x FROM ({_LOG}))",
}

_GPUS = lambda: F.array(F.struct(c("loss").alias("allocated"), F.lit(200.0).alias("total")), F.struct((c("loss") / 2).alias("allocated"), F.lit(80.0).alias("total")))
QUERIES |= {
    "perplexity_labels": lambda s, d: t.perplexity_of_labels(log(s, d).select("run", F.when(c("event_id") % 4 == 0, -100).otherwise(c("event_id") % 50).alias("label"), (c("loss") / 100).alias("loss"))),
    "memory_ratio": lambda s, d: log(s, d).select("event_id", F.round(t.memory_ratio(c("loss") / 3, F.when(c("event_id") % 3 > 0, _GPUS())), 9).alias("ratio")),
    "final_metrics": lambda s, d: t.final_metrics(log(s, d).select("run", "ord", "event_id", "loss", "operation")),
    "backoff_jitter": lambda s, d: log(s, d).select("event_id", F.round(t.jittered(t.backoff(c("ord") % 9, base=0.5), c("event_id")), 6).alias("wait")),
}
ORACLES |= {
    "perplexity_labels": f"SELECT run, round(exp(avg(loss / 100)), 6) AS perplexity, round(avg(loss / 100), 6) AS eval_loss FROM ({_LOG}) WHERE event_id % 4 <> 0 GROUP BY run UNION ALL SELECT run, NULL, NULL FROM ({_LOG}) GROUP BY run HAVING bool_and(event_id % 4 = 0)",
    "memory_ratio": f"SELECT event_id, round(CASE WHEN event_id % 3 > 0 THEN greatest(loss / 300, loss / 200, loss / 160) ELSE loss / 300 END, 9) AS ratio FROM ({_LOG})",
    "final_metrics": f"SELECT run, ord::INT AS ord, event_id, loss, operation FROM ({_LOG}) QUALIFY row_number() OVER (PARTITION BY run ORDER BY ord DESC) = 1",
    "backoff_jitter": f"SELECT event_id, round(least(0.5 * pow(2.0, ord % 9), 60.0) * (1.1 + 0.4 * (('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT / 4294967296)), 6) AS wait FROM ({_LOG})",
}

QUERIES |= {"metric_flushes": lambda s, d: t.flushed(load(s, d, "events").select(c("user_id").alias("run"), c("event_id").alias("ord"), c("value").alias("loss"), c("event_type").alias("operation")))}
# a collector's memory: at each step that ten divides, the ten rows that it logged last
ORACLES |= {"metric_flushes": "WITH l AS (SELECT user_id AS run, event_id AS ord, value AS loss, event_type AS operation, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) SELECT l.run, l.ord, l.loss, l.operation, f.ord AS flushed_at FROM l AS f JOIN l ON l.run = f.run AND l.i > f.i - 10 AND l.i <= f.i WHERE f.ord % 10 = 0"}
