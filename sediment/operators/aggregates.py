"""Grouped metrics. All of them fold on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.config import AggregationRule, SpecError
from sediment.session import materialize

_AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count}

# Upper bounds in seconds of the duration histogram.
DURATION_BUCKETS = (10, 30, 60, 120, 300, 600)


def apply_rule(df: DataFrame, rule: AggregationRule) -> DataFrame:
    """``<rule>_<column>_<kind>`` per source column; without group columns over the whole frame."""
    fold = _AGGREGATES[rule.agg_type]
    measures = [fold(F.col(c)).alias(f"{rule.name}_{c}_{rule.agg_type}") for c in rule.source_cols]
    out = df.groupBy(*rule.group_by_cols).agg(*measures)
    return out.filter(F.expr(rule.having_clause)) if rule.having_clause else out


def apply_rule_chain(df: DataFrame, rules: Sequence[AggregationRule]) -> DataFrame:
    """Each rule works on the output of the one before it."""
    for rule in rules:
        df = apply_rule(df, rule)
    return df


def apply_rules(df: DataFrame, rules: Sequence[AggregationRule]) -> dict[str, DataFrame]:
    """Each rule works on ``df`` itself."""
    return {rule.name: apply_rule(df, rule) for rule in rules}


def grouped_metrics(
    df: DataFrame, group_by: Sequence[str], metrics: Sequence[Mapping[str, str]], having: str | None = None
) -> DataFrame:
    """``group_by`` holds SQL such as ``country`` or ``date_trunc('month', d) as month``; a
    metric is ``name``, aggregate ``expression`` and optionally the ``type`` to cast to."""
    measures = []
    for metric in metrics:
        text = metric.get("expression") or metric.get("expr")
        if not text:
            raise SpecError(f"metric {metric.get('name')} has no expression")
        value = F.expr(text)
        if metric.get("type"):
            value = value.cast(metric["type"])
        measures.append(value.alias(metric["name"]))
    out = df.groupBy(*[F.expr(text) for text in group_by]).agg(*measures)
    return out.filter(F.expr(having)) if having else out


def conditional_sum(amount: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, amount).otherwise(F.lit(0)))


def rate(condition: Column) -> Column:
    """Share of rows for which the condition holds; a NULL condition counts as not."""
    return F.count_if(F.coalesce(condition, F.lit(False))).cast("double") / F.count("*")


def conditional_rate(df: DataFrame, group_by: Sequence[str], condition: Column, name: str) -> DataFrame:
    return df.groupBy(*group_by).agg(rate(condition).alias(name))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, avg and sample deviation of all the columns, in one pass: a row per column."""
    folds = {"min": F.min, "max": F.max, "avg": F.avg, "stddev": F.stddev_samp}
    one_row = df.agg(
        *[fold(F.col(c)).cast("double").alias(f"{c}__{label}") for c in columns for label, fold in folds.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{label}").alias(label) for label in folds])
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*rows)))


def null_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, null count and null percentage per column, in one pass."""
    one_row = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n_{c}").alias("null_count"),
            F.try_divide(F.col(f"_n_{c}") * F.lit(100.0), F.col("_rows")).alias("null_percentage"),
        )
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*rows)))


def distinct_count(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of different value combinations; NULL counts as a value."""
    if approximate:
        return df.agg(F.approx_count_distinct(F.struct(*columns)).alias("distinct_count"))
    return df.select(*columns).distinct().agg(F.count("*").alias("distinct_count"))


def value_ratios(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of each value. The table is read once: the total is that of the written counts."""
    counts = materialize(df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("frequency")), "ratios")
    return counts.withColumn("ratio", F.col("frequency") / counts.agg(F.sum("frequency")).scalar())


def quartiles(df: DataFrame, column: str, group_by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    points = [0.25, 0.5, 0.75]
    folded = df.groupBy(*group_by).agg(F.percentile_approx(column, points, accuracy).alias("_q"))
    return folded.select(*group_by, *[F.col("_q")[i].alias(f"q{i + 1}") for i in range(3)])


def run_metrics(runs: DataFrame) -> DataFrame:
    """Runs, records, durations and failures per pipeline, layer and status."""
    return runs.groupBy("pipeline_id", "layer", "status").agg(
        F.count("*").alias("run_count"),
        F.sum("records_processed").alias("records_processed"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.max("duration_seconds").alias("max_duration_seconds"),
        F.count_if(F.col("error_message").isNotNull()).alias("processing_errors"),
    )


def duration_histogram(
    df: DataFrame, duration: str, group_by: Sequence[str] = (), buckets: Sequence[int] = DURATION_BUCKETS
) -> DataFrame:
    """Cumulative counts: rows with a duration up to each bound, and ``+Inf`` for all of them."""
    counts = [F.count_if(F.col(duration) <= b).alias(f"_b{i}") for i, b in enumerate(buckets)]
    folded = df.groupBy(*group_by).agg(
        *counts, F.count(duration).alias("_all"), F.sum(duration).alias("duration_sum")
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_b{i}").alias("bucket_count")) for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("_all").alias("bucket_count")))
    return folded.select(*group_by, "duration_sum", F.inline(F.array(*rows)))


def period_metrics(
    df: DataFrame, ts: str, value: str, group_by: Sequence[str] = (), period: str = "300 seconds"
) -> DataFrame:
    """Average, sum and count per fixed period; works on batch and streaming frames."""
    return (
        df.groupBy(*group_by, F.window(ts, period).alias("_w"))
        .agg(F.avg(value).alias("avg_value"), F.sum(value).alias("sum_value"), F.count("*").alias("sample_count"))
        .select(*group_by, F.col("_w.start").alias("period_start"), "avg_value", "sum_value", "sample_count")
    )


def sample_rows(df: DataFrame, order_by: Sequence[str], size: int = 5) -> DataFrame:
    """A few rows in a stable order, for reports."""
    return df.orderBy(*order_by).limit(size)
