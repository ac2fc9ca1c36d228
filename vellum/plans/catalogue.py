"""Every query of the library by name, with its oracle."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

THEMES = ("chunking", "prompting", "reformatting", "metrics", "ingesting", "evaluating", "streams", "boundaries")


def _all(what: str) -> dict:
    return {k: v for theme in THEMES for k, v in getattr(import_module(f"vellum.plans.{theme}"), what).items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("ORACLES")
