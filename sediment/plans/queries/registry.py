"""``@query(name, sql)`` registers a runner ``(spark, data directory) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Runner = Callable[[SparkSession, str], DataFrame]

_RUNNERS: dict[str, Runner] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def add(run: Runner) -> Runner:
        if name in _RUNNERS:
            raise ValueError(f"query {name} is registered twice")
        _RUNNERS[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run

    return add


def runners() -> dict[str, Runner]:
    return dict(_RUNNERS)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def text_date(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("date").cast("string")


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Engines differ in the last bits of sums of doubles."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
