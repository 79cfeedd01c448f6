"""All queries over the reference tables with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("scalars", "relational", "mutations", "statistics", "stateful", "reports", "planning", "monitoring", "canonical", "exports", "curation", "capacity")


def _all() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"engagelake.plans.{name}").QUERIES
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most recent posts of each approved group, with label and modality."""
    return _all()["top_posts_per_group"][0](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _all().items() if sql}
