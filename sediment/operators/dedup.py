"""Duplicates, latest row per key, latest version, pages and layer order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.config import Layer


def drop_exact_duplicates(df: DataFrame, business_columns: Sequence[str] | None = None) -> DataFrame:
    """Keep one of the rows that agree on the business columns. Run it before metadata such
    as the source file is added, or copies that arrived in two files survive. Copies are
    folded on the map side, so a value repeated everywhere does not fill one task."""
    return df.dropDuplicates(list(business_columns) if business_columns else df.columns)


def keep_latest(df: DataFrame, keys: Sequence[str], latest_by: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``latest_by`` per key.

    Rank-equals-one lets Spark limit each group on the map side before the shuffle, which
    keeps a hot key from travelling whole.
    """
    order = [F.col(name).desc_nulls_last() for name in (latest_by, *tie_breakers)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def version_order(version: Column) -> Column:
    """Sortable form of a dotted version: its numbers, so that 1.10 follows 1.9."""
    return F.transform(F.split(F.regexp_replace(version.cast("string"), "[^0-9.]", ""), r"\."), lambda p: p.try_cast("int"))


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of the highest version per key."""
    return keep_latest(df.withColumn("_version_order", version_order(F.col(version))), keys, "_version_order").drop(
        "_version_order"
    )


def page(df: DataFrame, order_by: Sequence[str], offset: int = 0, limit: int = 100) -> DataFrame:
    """One page in a stable order."""
    return df.orderBy(*order_by).offset(offset).limit(limit)


def first_by(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def layer_rank(layer: Column) -> Column:
    """landing < bronze < silver < gold; unknown names sort last."""
    rank = F.lit(len(Layer))
    for known in Layer:
        rank = F.when(layer == known.value, F.lit(known.rank)).otherwise(rank)
    return rank


def enabled_in_layer_order(df: DataFrame, name: str = "table_name") -> DataFrame:
    """Enabled table mappings, in the order in which the layers run."""
    return df.filter(F.col("enabled")).orderBy(layer_rank(F.col("layer")), name)
