"""Run telemetry: ordered analytics over metric logs. All windows are per run, so they deal out over tasks.

A log has (run, ord, loss, ...) rows; `ord` orders a run's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

c = F.col


def _by(run: str = "run") -> W:
    return W.partitionBy(run).orderBy("ord")


def early_stopping(log: DataFrame, patience: int = 3, min_delta: float = 0.01, mode: str = "min") -> DataFrame:
    """Per row with a loss: best so far, rows waited since the last significant gain, and whether to stop.

    The first row is the baseline; any gain moves the best, only one beyond min_delta ends the wait.
    """
    sign = 1 if mode == "min" else -1
    v = c("loss") * sign
    prior = F.min(v).over(_by().rowsBetween(W.unboundedPreceding, -1))
    gained = log.where("loss is not null").withColumns({"_prior": prior, "_rn": F.row_number().over(_by())})
    marked = gained.withColumn("_sig", F.when(c("_rn") == 1, True).otherwise((c("_prior") - v) > min_delta))
    island = marked.withColumn("_island", F.sum(c("_sig").cast("int")).over(_by()))
    waited = island.withColumn("wait", F.row_number().over(W.partitionBy("run", "_island").orderBy("ord")) - 1)
    best = (F.min(v).over(_by().rowsBetween(W.unboundedPreceding, 0)) * sign).alias("best")
    return waited.select("run", "ord", "loss", best, "wait", F.max((c("wait") >= patience).cast("int")).over(_by()).cast("boolean").alias("should_stop"))


def stopped_at(log: DataFrame, patience: int = 3, min_delta: float = 0.01, mode: str = "min") -> DataFrame:
    """Per run: the first row at which it stops (null if never) and the best loss up to there."""
    marked = early_stopping(log, patience, min_delta, mode)
    at = marked.where("should_stop").groupBy("run").agg(F.min("ord").alias("stopped_at"))
    upto = marked.join(at, "run", "left").where("stopped_at is null or ord <= stopped_at")
    return upto.groupBy("run").agg(F.max("stopped_at").alias("stopped_at"), (F.min("loss") if mode == "min" else F.max("loss")).alias("best"), F.count("*").alias("evaluations"))


def convergence(log: DataFrame) -> DataFrame:
    """Per run: rows, first, last, least loss, and the share of the possible gain that is left at the end."""
    agg = log.groupBy("run").agg(F.count("*").alias("n"), F.min_by("loss", "ord").alias("first_loss"), F.max_by("loss", "ord").alias("last_loss"), F.min("loss").alias("best_loss"))
    gain = c("first_loss") - c("best_loss")
    return agg.withColumn("efficiency", F.round(F.when((c("n") < 2) | (gain <= 0), 0.0).otherwise((c("first_loss") - c("last_loss")) / gain), 6))


def improving(log: DataFrame, window: int = 5, below: float = -0.1) -> DataFrame:
    """Per run: correlation of the last rows' loss with their order, and whether it falls."""
    last = log.withColumn("_d", F.row_number().over(W.partitionBy("run").orderBy(c("ord").desc()))).where(c("_d") <= window)
    agg = last.groupBy("run").agg(F.count("*").alias("n"), F.corr((window - c("_d")).cast("double"), "loss").alias("r"))
    r = F.when(c("n") >= window, F.round("r", 6))
    return agg.select("run", r.alias("trend"), F.coalesce(r < below, F.lit(False)).alias("improving"))


def perplexity(log: DataFrame, weight: Column) -> DataFrame:
    """Per run: exp of the weighted mean loss."""
    return log.groupBy("run").agg(F.round(F.exp(F.sum(c("loss") * weight) / F.sum(weight)), 6).alias("perplexity"))


def perplexity_of_labels(rows: DataFrame, ignored: int = -100) -> DataFrame:
    """Per run of `rows` (run, label, loss): the exponential of the mean loss over labels that aren't ignored, and that mean."""
    mean = F.avg(F.when(c("label") != ignored, c("loss")))
    return rows.groupBy("run").agg(F.round(F.exp(mean), 6).alias("perplexity"), F.round(mean, 6).alias("eval_loss"))


def memory_ratio(cpu_percent: Column, gpus: Column) -> Column:
    """The larger of the processor's share and the fullest device's, of (allocated, total) structs; missing devices don't count."""
    return F.greatest(cpu_percent / 100, F.array_max(F.transform(gpus, lambda g: F.try_divide(g["allocated"].cast("double"), g["total"].cast("double")))))


def final_metrics(log: DataFrame) -> DataFrame:
    """The last row of each run, all its columns."""
    last = log.groupBy("run").agg(F.max_by(F.struct(*[x for x in log.columns if x != "run"]), "ord").alias("_x"))
    return last.select("run", "_x.*")


def operation_times(log: DataFrame) -> DataFrame:
    """Per operation: mean, population deviation, least, greatest, total, count."""
    return log.groupBy("operation").agg(
        F.round(F.avg("seconds"), 6).alias("mean"), F.round(F.stddev_pop("seconds"), 6).alias("std"), F.min("seconds").alias("least"), F.max("seconds").alias("greatest"), F.round(F.sum("seconds"), 4).alias("total"), F.count("*").alias("n")
    )


def recent(log: DataFrame, last: int = 100) -> DataFrame:
    """Per run: rows in all, and mean and population deviation of the last ones' loss."""
    ranked = log.withColumn("_d", F.row_number().over(W.partitionBy("run").orderBy(c("ord").desc())))
    near = F.when(c("_d") <= last, c("loss"))
    return ranked.groupBy("run").agg(F.count("*").alias("total_steps"), F.round(F.avg(near), 6).alias("recent_mean"), F.round(F.stddev_pop(near), 6).alias("recent_std"))


def training_report(log: DataFrame) -> DataFrame:
    """Per run: steps, last epoch, duration in seconds, least loss, and the last row's loss."""
    return log.groupBy("run").agg(
        F.count("*").alias("total_steps"), F.max("ord").alias("last_step"), F.round(F.max(F.unix_micros(c("ts").cast("timestamp"))) / 1e6 - F.min(F.unix_micros(c("ts").cast("timestamp"))) / 1e6, 3).alias("seconds"), F.min("loss").alias("best_loss"), F.max_by("loss", "ord").alias("final_loss")
    )


def micro_batches(rows: DataFrame, key: str, size: int, group: str, seed: int = 42, drop_last: bool = True) -> DataFrame:
    """`rows` with batch (from 0, within `group`): a reproducible shuffle by hash, cut to batches of `size`."""
    shuffle = W.partitionBy(group).orderBy(F.md5(F.concat(F.lit(f"{seed}|"), c(key).cast("string"))), key)
    dealt = rows.withColumn("batch", F.floor((F.row_number().over(shuffle) - 1) / size))
    if not drop_last:
        return dealt
    return dealt.withColumn("_n", F.count("*").over(W.partitionBy(group, "batch"))).where(c("_n") == size).drop("_n")


def accumulate(log: DataFrame, steps: int) -> DataFrame:
    """Per run and update: rows and the sum of losses scaled by the number of steps; the last may be short."""
    numbered = log.withColumn("update", F.ceil(F.row_number().over(_by()) / steps))
    return numbered.groupBy("run", "update").agg(F.count("*").alias("n"), F.round(F.sum(c("loss") / steps), 6).alias("loss"))


def adaptive_steps(ratio: Column, steps: int, threshold: float = 0.8) -> Column:
    """Accumulation steps, halved where memory is above the threshold."""
    return F.when(ratio > threshold, F.greatest(F.lit(1), F.lit(steps // 2))).otherwise(steps)


def flushed(log: DataFrame, n: int = 10) -> DataFrame:
    """(run, ord, ..., flushed_at): what a collector writes that saves a run's last n rows at each step (`ord`) that n divides.

    Where steps leave gaps a row can be written more than once, or never; rows after the last such step aren't written.
    """
    near = _by().rowsBetween(0, n - 1)
    due = F.collect_list(F.when(c("ord") % n == 0, c("ord"))).over(near)
    return log.withColumn("_due", due).select(*log.columns, F.explode("_due").alias("flushed_at"))


def retention(checkpoints: DataFrame, keep: int = 3) -> DataFrame:
    """`checkpoints` (run, path, mtime, step) with keep and latest: the newest by time, then step, stay."""
    rank = F.row_number().over(W.partitionBy("run").orderBy(c("mtime").desc(), c("step").desc()))
    return checkpoints.withColumn("_n", rank).withColumns({"keep": c("_n") <= keep, "latest": c("_n") == 1}).drop("_n")


def should_checkpoint(step: Column, every: int) -> Column:
    return (step % every == 0) | (step == 0)


def progress(log: DataFrame, width: int = 30) -> DataFrame:
    """Per row: done so far, failures, percent, mean and remaining time in microseconds, and a bar."""
    upto = _by().rowsBetween(W.unboundedPreceding, 0)
    total, t = F.count("*").over(W.partitionBy("run")), F.unix_micros(c("ts").cast("timestamp"))
    base = log.withColumns({"done": F.count("*").over(upto), "failed_so_far": F.sum(c("failed").cast("int")).over(upto), "_total": total, "_us": t - F.min(t).over(upto)})
    share = c("done") / c("_total")
    bar = F.floor(share * width).cast("int")
    return base.select(
        "run", "ord", "done", "failed_so_far", F.round(share * 100, 4).alias("percent"), F.expr("_us div done").alias("mean_us"), F.expr("_us * (_total - done) div done").alias("eta_us"),
        F.concat(F.repeat(F.lit("█"), bar), F.repeat(F.lit("░"), width - bar)).alias("bar"),
    )


def rate_wait(log: DataFrame, delay: float = 1.0) -> DataFrame:
    """Per request of a run: seconds to wait so that requests keep `delay` apart."""
    t = F.unix_micros(c("ts").cast("timestamp")) / 1e6
    return log.select("run", "ord", F.round(F.coalesce(F.greatest(F.lit(0.0), delay - (t - F.lag(t).over(_by()))), F.lit(0.0)), 3).alias("wait"))


def backoff(attempt: Column, cap: float = 60.0, base: float = 1.0) -> Column:
    return F.least(base * F.pow(F.lit(2.0), attempt), F.lit(cap))


def jittered(wait: Column, key: Column, low: float = 0.1, high: float = 0.5) -> Column:
    """A wait and 10 to 50 % of it more; the share is a hash of the key, so a retry waits alike in every run."""
    share = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") / 2**32
    return wait * (1 + low + (high - low) * share)


def retries(status: Column, attempt: Column, most: int = 10) -> Column:
    """What follows a response: done, retry, raise (no use to try again) or give_up."""
    again = status.isin(429, 500, 502, 503, 504)
    return F.when(status < 400, "done").when(~again, "raise").when(attempt >= most, "give_up").otherwise("retry")


def duration(seconds: Column) -> Column:
    s = F.floor(seconds).cast("int")
    parts = lambda a, x, b, y: F.concat((a).cast("string"), F.lit(x), (b).cast("string"), F.lit(y))
    return F.when(seconds < 60, F.format_string("%.1fs", seconds)).when(seconds < 3600, parts(F.expr("0") + F.floor(s / 60).cast("int"), "m ", s % 60, "s")).otherwise(parts(F.floor(s / 3600).cast("int"), "h ", F.floor(s % 3600 / 60).cast("int"), "m"))
