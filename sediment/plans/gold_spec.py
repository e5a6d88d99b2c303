"""Gold specs: joins, grouped metrics, window metrics, dependent views, target fields."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.config import SpecError
from sediment.functions import lookup
from sediment.operators.aggregates import grouped_metrics
from sediment.operators.joins import left_join
from sediment.session import materialize


def joined_sources(tables: Mapping[str, DataFrame], joins: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Left-deep join of the named tables; conditions refer to columns as ``table.column``."""
    if not joins:
        if len(tables) != 1:
            raise SpecError("several source tables need joins")
        name, df = next(iter(tables.items()))
        return df.alias(name)
    first = joins[0]["tables"][0]
    out, seen = tables[first].alias(first), {first}
    for join in joins:
        for name in join["tables"]:
            if name not in seen:
                right, how = tables[name].alias(name), join.get("type", "inner")
                if how == "left":
                    out = left_join(out, right, join["condition"], sorted(seen), name)
                else:
                    out = out.join(right, F.expr(join["condition"]), how)
                seen.add(name)
    return out


def unqualified(text: str, tables: Sequence[str]) -> str:
    """After the aggregation only output names exist, so table prefixes are dropped."""
    return re.sub(rf"\b(?:{'|'.join(map(re.escape, tables))})\.", "", text) if tables else text


def window_metrics(df: DataFrame, window: Mapping[str, Any], tables: Sequence[str]) -> DataFrame:
    """Add the metrics of a declared window. An expression without OVER uses the window's
    partition, order and frame."""
    partition = ", ".join(unqualified(c, tables) for c in window["partition_by"])
    order = unqualified(window["order_by"], tables)
    over = f"over (partition by {partition} order by {order} {window.get('frame', '')})"
    added = {}
    for metric in window["metrics"]:
        text = unqualified(metric["expression"], tables)
        if not re.search(r"\bover\b", text, re.IGNORECASE):
            text = f"{text} {over}"
        added[metric["name"]] = F.expr(text).cast(metric["type"]) if metric.get("type") else F.expr(text)
    return df.withColumns(added)


def build_views(spec: Mapping[str, Any], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every aggregation of the spec by name, in order; dependent ones are SQL over the
    earlier views, which are registered under their names. A view that is read more than once,
    by later views or by target fields, is written once instead of being computed each time."""
    body = spec.get("mapping_definition", spec)
    names = [t["name"] for t in body["source_tables"]]
    lacking = [n for n in names if n not in tables]
    if lacking:
        raise SpecError(f"no table given for {lacking}")
    readers = Counter(name for step in body["aggregations"] for name in step.get("dependencies", []))
    readers.update({f["source"].split(".")[0] for f in body.get("target_fields", {}).values() if "source" in f})
    views: dict[str, DataFrame] = {}
    for step in body["aggregations"]:
        if "expression" in step:
            unknown = [d for d in step.get("dependencies", []) if d not in views]
            if unknown:
                raise SpecError(f"{step['name']} depends on {unknown}, not built before it")
            df = next(iter(views.values())).sparkSession.sql(step["expression"])
        else:
            source = joined_sources({n: tables[n] for n in names}, body.get("joins", []))
            df = grouped_metrics(source, step["group_by"], step["metrics"], step.get("having"))
            for window in step.get("windows", []):
                df = window_metrics(df, window, names)
        if readers[step["name"]] > 1:
            df = materialize(df, step["name"])
        df.createOrReplaceTempView(step["name"])
        views[step["name"]] = df
    return views


def build_gold(
    spec: Mapping[str, Any], tables: Mapping[str, DataFrame], join_on: Sequence[str] = (), as_of: Column | None = None
) -> DataFrame:
    """The spec's target fields. Views named by the fields are joined on ``join_on``, which
    must identify a row of each."""
    body = spec.get("mapping_definition", spec)
    views = build_views(spec, tables)
    fields = body["target_fields"]
    used = list(dict.fromkeys(f["source"].split(".")[0] for f in fields.values() if "source" in f))
    out = views[used[0]].alias(used[0])
    for name in used[1:]:
        if not join_on:
            raise SpecError(f"target fields read {used}: name the columns that join them")
        condition = [F.col(f"{used[0]}.{c}").eqNullSafe(F.col(f"{name}.{c}")) for c in join_on]
        out = out.join(views[name].alias(name), condition)
    picked = []
    for target, field in fields.items():
        value = F.col(field["source"]) if "source" in field else lookup(field["transform"])(as_of)
        picked.append(value.cast(field["type"]).alias(target))
    return out.select(*picked)


def customer_monthly_metrics(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Spend, income and growth per customer and month, and the segment by six-month means.

    ``customers``: customer_id (unique), country. ``transactions``: customer_id,
    transaction_date, type, amount. The transactions are folded to customer and month before
    they meet the customers, so a customer with very many of them is a handful of rows by
    then; the windows reuse the customer partitioning of the join.
    """
    amount = F.col("amount").cast("decimal(18,2)")
    monthly = (
        transactions.withColumn("month", F.date_trunc("month", "transaction_date").cast("date"))
        .groupBy("customer_id", "month")
        .agg(
            F.sum(F.when(F.col("type") == "DEBIT", amount).otherwise(0)).alias("_spend"),
            F.sum(F.when(F.col("type") == "CREDIT", amount).otherwise(0)).alias("_income"),
            F.count("*").alias("_count"),
            (F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))).alias("_average"),
        )
    )
    # A customer without transactions keeps one row, as the left join gives one.
    metrics = customers.join(monthly, "customer_id", "left").select(
        "customer_id",
        "country",
        "month",
        F.coalesce("_spend", F.lit(0)).cast("decimal(18,2)").alias("total_spend"),
        F.coalesce("_income", F.lit(0)).cast("decimal(18,2)").alias("total_income"),
        F.coalesce("_count", F.lit(1)).cast("int").alias("transaction_count"),
        F.col("_average").cast("decimal(18,2)").alias("average_transaction"),
    )
    return segments(growth(metrics))


def growth(metrics: DataFrame) -> DataFrame:
    """Change of spend and of transactions against the customer's month before."""
    over = "over (partition by customer_id order by month nulls first)"
    return metrics.withColumns(
        {
            "spend_growth": F.expr(f"cast(total_spend - lag(total_spend, 1) {over} as decimal(18,2))"),
            "transaction_growth": F.expr(f"transaction_count - lag(transaction_count, 1) {over}"),
        }
    )


def segments(metrics: DataFrame) -> DataFrame:
    """PREMIUM, GOLD or STANDARD by the means over this and the five months before."""
    over = "over (partition by customer_id order by month nulls first rows between 5 preceding and current row)"
    spend = F.expr(f"cast(sum(total_spend) {over} as double) / count(total_spend) {over}")
    transactions = F.expr(f"cast(sum(transaction_count) {over} as double) / count(transaction_count) {over}")
    return metrics.withColumns({"avg_monthly_spend": spend, "avg_monthly_transactions": transactions}).withColumn(
        "segment",
        F.when((F.col("avg_monthly_spend") > 10000) & (F.col("avg_monthly_transactions") > 20), "PREMIUM")
        .when((F.col("avg_monthly_spend") > 5000) & (F.col("avg_monthly_transactions") > 10), "GOLD")
        .otherwise("STANDARD"),
    )
