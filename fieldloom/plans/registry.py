"""The registered queries: name, Spark function and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_FOUND: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        if name in _FOUND:
            raise ValueError(f"two queries are named {name}")
        _FOUND[name] = (f, sql)
        return f

    return keep


def _load() -> dict[str, tuple[Callable, str | None]]:
    from . import queries_chips, queries_overlay, queries_projection, queries_raster, queries_scenes, queries_sets, queries_sources  # noqa: F401

    return _FOUND


def queries() -> dict:
    return {k: f for k, (f, _) in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _load().items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["j6_best_pair"](spark, sf_dir)
