"""All registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noisetrack.plans import core, files, models, streams  # noqa: F401  these register their queries in core


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.cube_noise(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(core.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(core.ORACLE)
