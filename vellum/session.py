"""Session defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(name: str = "vellum", **conf: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=DEFAULTS | conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from spark.checkpoint.dir; where unset, a folder of our own if there is no cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")
