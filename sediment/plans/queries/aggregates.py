"""Grouped metrics, summaries, histograms, duplicates, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.operators import aggregates as agg
from sediment.operators import dedup
from sediment.plans.queries.registry import query, rounded, table
from sediment.plans.steps import run_steps
from sediment.session import scratch_path
from sediment.sources.writers import write_landing


@query(
    "agg_conditional_sum",
    """select l_suppkey, cast(sum(case when l_returnflag = 'R' then cast(l_extendedprice as decimal(18,2)) else 0 end)
         as double) as returned, count(*) as line_count from lineitem group by 1""",
)
def agg_conditional_sum(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return (
        table(spark, d, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            agg.conditional_sum(price, F.col("l_returnflag") == "R").cast("double").alias("returned"),
            F.count("*").alias("line_count"),
        )
    )


@query(
    "agg_expression_group",
    """select cast(cast(date_trunc('month', l_shipdate) as date) as varchar) as month, l_linestatus,
              count(*) as line_count, sum(l_quantity) as quantity,
              cast(((2 * cast(sum(l_quantity) * 100 as bigint) + count(*)) // (2 * count(*))) as double) / 100 as mean_quantity
       from lineitem group by 1, 2""",
)
def agg_expression_group(spark: SparkSession, d: str) -> DataFrame:
    out = agg.grouped_metrics(
        table(spark, d, "lineitem"),
        ["cast(cast(date_trunc('month', l_shipdate) as date) as string) as month", "l_linestatus"],
        [
            {"name": "line_count", "expression": "count(*)"},
            {"name": "quantity", "expression": "sum(l_quantity)"},
            {"name": "mean_quantity", "expression": "avg(l_quantity)", "type": "decimal(18,2)"},
        ],
    )
    return out.withColumn("mean_quantity", F.col("mean_quantity").cast("double"))


@query(
    "agg_numeric_summary",
    """select 'l_quantity' as column_name, min(l_quantity) as "min", max(l_quantity) as "max",
              round(avg(l_quantity), 6) as "avg", round(stddev_samp(l_quantity), 6) as "stddev" from lineitem
       union all select 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), round(avg(l_extendedprice), 6),
              round(stddev_samp(l_extendedprice), 6) from lineitem
       union all select 'l_tax', min(l_tax), max(l_tax), round(avg(l_tax), 6), round(stddev_samp(l_tax), 6) from lineitem""",
)
def agg_numeric_summary(spark: SparkSession, d: str) -> DataFrame:
    out = agg.numeric_summary(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(out, ["avg", "stddev"])


@query(
    "agg_null_summary",
    """with o as (select nullif(o_orderpriority, '5-LOW') as priority, o_custkey from orders)
       select 'priority' as column_name, count(*) as row_count, count(*) - count(priority) as null_count,
              (count(*) - count(priority)) * 100.0::double / count(*) as null_percentage from o
       union all select 'o_custkey', count(*), count(*) - count(o_custkey),
              (count(*) - count(o_custkey)) * 100.0::double / count(*) from o""",
)
def agg_null_summary(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return agg.null_summary(orders, ["priority", "o_custkey"])


@query(
    "agg_distinct_count",
    """select count(*) as distinct_count from (select distinct l_partkey, nullif(l_returnflag, 'A') from lineitem)""",
)
def agg_distinct_count(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("A")))
    return agg.distinct_count(items, ["l_partkey", "flag"])


@query(
    "agg_distinct_count_approximate",
    """select count(*) as distinct_count, true as within_bound from (select distinct l_partkey, l_suppkey from lineitem)""",
)
def agg_distinct_count_approximate(spark: SparkSession, d: str) -> DataFrame:
    """The exact count, and whether the approximate one is within three of its standard errors (5 percent)."""
    items, columns = table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"]
    about = agg.distinct_count(items, columns, approximate=True).select(F.col("distinct_count").alias("about")).scalar()
    off = F.abs(about - F.col("distinct_count"))
    return agg.distinct_count(items, columns).withColumn("within_bound", off <= 0.15 * F.col("distinct_count"))


@query(
    "agg_value_ratios",
    """select event_type as value, count(*) as frequency, count(*)::double / (select count(*) from events) as ratio
       from events group by 1""",
)
def agg_value_ratios(spark: SparkSession, d: str) -> DataFrame:
    return agg.value_ratios(table(spark, d, "events"), "event_type")


@query("agg_latest_timestamp", "select event_type, max(ts) as latest from events group by 1")
def agg_latest_timestamp(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.max("ts").alias("latest"))


@query(
    "agg_quartiles",
    """select event_type, quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.5) as q2,
              quantile_disc(value, 0.75) as q3 from events group by 1""",
)
def agg_quartiles(spark: SparkSession, d: str) -> DataFrame:
    return agg.quartiles(table(spark, d, "events"), "value", ["event_type"])


@query(
    "agg_conditional_rate",
    """select cast(cast(ts as date) as varchar) as day, count(*) filter (where event_type = 'error')::double / count(*) as error_rate
       from events group by 1""",
)
def agg_conditional_rate(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    return agg.conditional_rate(events, ["day"], F.col("event_type") == "error", "error_rate")


RUNS_SQL = """
  select o_orderkey as run_id, o_custkey as pipeline_id, case when o_totalprice < 150000 then 'bronze'
           when o_totalprice < 300000 then 'silver' else 'gold' end as layer,
         case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'FAILED' else 'RUNNING' end as status,
         o_orderdate as start_time, cast(round(o_totalprice / 500) as bigint) as duration_seconds,
         cast(floor(o_totalprice) as bigint) as records_processed,
         case when o_orderstatus = 'O' then o_orderpriority end as error_message
  from orders"""


def runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "o_orderkey as run_id",
        "o_custkey as pipeline_id",
        "case when o_totalprice < 150000 then 'bronze' when o_totalprice < 300000 then 'silver' else 'gold' end as layer",
        "case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'FAILED' else 'RUNNING' end as status",
        "o_orderdate as start_time",
        "cast(round(o_totalprice / 500) as bigint) as duration_seconds",
        "cast(floor(o_totalprice) as bigint) as records_processed",
        "case when o_orderstatus = 'O' then o_orderpriority end as error_message",
    )


@query(
    "metrics_runs",
    f"""select pipeline_id, layer, status, count(*) as run_count, sum(records_processed)::bigint as records_processed,
              avg(duration_seconds) as avg_duration_seconds, max(duration_seconds) as max_duration_seconds,
              count(error_message) as processing_errors from ({RUNS_SQL}) group by 1, 2, 3""",
)
def metrics_runs(spark: SparkSession, d: str) -> DataFrame:
    return agg.run_metrics(runs(spark, d))


@query(
    "metrics_duration_histogram",
    f"""with r as ({RUNS_SQL}), b as (select unnest([10, 30, 60, 120, 300, 600]) as le)
        select status, cast(b.le as varchar) as le, count(*) filter (where duration_seconds <= b.le) as bucket_count,
               sum(duration_seconds)::bigint as duration_sum from r, b group by 1, 2
        union all select status, '+Inf', count(duration_seconds), sum(duration_seconds)::bigint from r group by 1""",
)
def metrics_duration_histogram(spark: SparkSession, d: str) -> DataFrame:
    return agg.duration_histogram(runs(spark, d), "duration_seconds", ["status"])


@query(
    "metrics_periods",
    """select event_type, time_bucket(interval 300 second, ts) as period_start, round(avg(value), 6) as avg_value,
              round(sum(value), 6) as sum_value, count(*) as sample_count from events group by 1, 2""",
)
def metrics_periods(spark: SparkSession, d: str) -> DataFrame:
    out = agg.period_metrics(table(spark, d, "events"), "ts", "value", ["event_type"])
    return rounded(out, ["avg_value", "sum_value"])


@query(
    "metrics_failed_samples",
    "select o_orderkey, o_totalprice from orders where not (o_totalprice > 5000) order by o_totalprice, o_orderkey limit 5",
)
def metrics_failed_samples(spark: SparkSession, d: str) -> DataFrame:
    failing = table(spark, d, "orders").filter("not (o_totalprice > 5000)").select("o_orderkey", "o_totalprice")
    return agg.sample_rows(failing, ["o_totalprice", "o_orderkey"])


@query(
    "metrics_step_list",
    """select 'read' as step_id, count(*) as records_processed, true as success from events
       union all select 'positive', count(*), true from events where value > 20
       union all select 'keep', count(*), true from events where value > 20""",
)
def metrics_step_list(spark: SparkSession, d: str) -> DataFrame:
    """Extract, transform and load steps with their row counts."""
    feed = scratch_path(spark, "feed")
    write_landing(table(spark, d, "events").select("event_id", "value"), feed, "json")
    config = {
        "id": "events",
        "steps": [
            {"id": "read", "type": "extract", "source": {"path": feed, "format": "json", "schema": "event_id long, value double"}},
            {"id": "positive", "type": "transform", "sql": "select * from read where value > 20"},
            {"id": "keep", "type": "load", "target": {"path": scratch_path(spark, "loaded"), "format": "parquet"}},
        ],
        "quality_rules": [{"id": "present", "type": "null_check", "columns": ["event_id", "value"], "threshold": 0.99}],
    }
    reports, _ = run_steps(spark, config, "2024-02-01T00:00:00")
    rows = [(r["step_id"], r["records_processed"], r["success"]) for r in reports]
    return spark.createDataFrame(rows, "step_id string, records_processed long, success boolean")


@query("dedup_exact", "select distinct user_id, event_type, cast(cast(ts as date) as varchar) as day from events")
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").selectExpr("event_id", "user_id", "event_type", "cast(cast(ts as date) as string) as day")
    return dedup.drop_exact_duplicates(events, ["user_id", "event_type", "day"]).drop("event_id")


@query("distinct_rows", "select distinct c_mktsegment, c_nationkey from customer")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query(
    "keep_latest",
    """select user_id, event_id, event_type from (
         select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1""",
)
def keep_latest(spark: SparkSession, d: str) -> DataFrame:
    latest = dedup.keep_latest(table(spark, d, "events"), ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "event_id", "event_type")


@query(
    "latest_version",
    """select o_custkey as rule_id, version from (
         select o_custkey, major || '.' || minor as version,
                row_number() over (partition by o_custkey order by major desc, minor desc) as r
         from (select o_custkey, cast(cast(substr(o_orderpriority, 1, 1) as integer) as bigint) as major, o_orderkey as minor from orders))
       where r = 1""",
)
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    versions = table(spark, d, "orders").selectExpr(
        "o_custkey as rule_id", "concat(substr(o_orderpriority, 1, 1), '.', o_orderkey) as version"
    )
    return dedup.latest_version(versions, ["rule_id"], "version")


@query("order_first", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 1")
def order_first(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return dedup.first_by(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("page_of_rows", "select c_custkey, c_name from customer order by c_name, c_custkey limit 100 offset 40")
def page_of_rows(spark: SparkSession, d: str) -> DataFrame:
    return dedup.page(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], 40, 100)


@query(
    "layer_order",
    f"""select run_id, layer, case layer when 'landing' then 0 when 'bronze' then 1 when 'silver' then 2 else 3 end::bigint as rank
        from ({RUNS_SQL}) where status <> 'FAILED'""",
)
def layer_order(spark: SparkSession, d: str) -> DataFrame:
    mappings = runs(spark, d).withColumn("enabled", F.col("status") != "FAILED")
    ordered = dedup.enabled_in_layer_order(mappings, "run_id")
    return ordered.select("run_id", "layer", dedup.layer_rank(F.col("layer")).cast("bigint").alias("rank"))
