"""Gold layer: customer metrics, segments, aggregation rules, spec-built gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import AggregationRule
from sediment.operators.aggregates import apply_rule, apply_rule_chain, apply_rules
from sediment.plans.gold_spec import build_gold, build_views, customer_monthly_metrics
from sediment.plans.layers import gold_frame
from sediment.plans.queries.registry import query, table

CUSTOMERS = "select c_custkey as customer_id, cast(c_nationkey as varchar) as country from customer"
TRANSACTIONS = """
  select o_custkey as customer_id, o_orderdate as transaction_date,
         cast(o_totalprice as decimal(18,2)) as amount,
         case o_orderstatus when 'F' then 'DEBIT' when 'O' then 'CREDIT' else 'TRANSFER' end as type
  from orders"""

MONTHLY_SQL = f"""
with customers as ({CUSTOMERS}), transactions as ({TRANSACTIONS}),
m as (
  select c.customer_id, c.country, cast(date_trunc('month', t.transaction_date) as date) as month,
         cast(sum(case when t.type = 'DEBIT' then t.amount else 0 end) as decimal(18,2)) as total_spend,
         cast(sum(case when t.type = 'CREDIT' then t.amount else 0 end) as decimal(18,2)) as total_income,
         cast(count(*) as integer) as transaction_count,
         cast(sum(t.amount) * 100 as bigint) as cents, count(t.amount) as n
  from customers c left join transactions t on c.customer_id = t.customer_id
  group by 1, 2, 3),
g as (
  select customer_id, country, month, total_spend, total_income, transaction_count,
         ((2 * cents + n) // (2 * nullif(n, 0))) / 100.0 as average_transaction,
         total_spend - lag(total_spend, 1) over o as spend_growth,
         transaction_count - lag(transaction_count, 1) over o as transaction_growth,
         cast(sum(total_spend) over w as double) / count(total_spend) over w as avg_monthly_spend,
         cast(sum(transaction_count) over w as double) / count(transaction_count) over w as avg_monthly_transactions
  from m
  window o as (partition by customer_id order by month nulls first),
         w as (partition by customer_id order by month nulls first rows between 5 preceding and current row))
"""

SEGMENT = """case when avg_monthly_spend > 10000 and avg_monthly_transactions > 20 then 'PREMIUM'
                when avg_monthly_spend > 5000 and avg_monthly_transactions > 10 then 'GOLD'
                else 'STANDARD' end"""


def customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("string").alias("country")
    )


def transactions(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "DEBIT").when(F.col("o_orderstatus") == "O", "CREDIT")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        kind.otherwise("TRANSFER").alias("type"),
    )


@query(
    "gold_customer_metrics",
    MONTHLY_SQL
    + """select customer_id, country, cast(month as varchar) as report_month,
       cast(total_spend as double) as total_spend, cast(total_income as double) as total_income,
       cast(transaction_count as bigint) as transaction_count, average_transaction,
       cast(spend_growth as double) as spend_growth, cast(transaction_growth as bigint) as transaction_growth
from g""",
)
def gold_customer_metrics(spark: SparkSession, d: str) -> DataFrame:
    return customer_monthly_metrics(customers(spark, d), transactions(spark, d)).select(
        "customer_id",
        "country",
        F.col("month").cast("string").alias("report_month"),
        *[F.col(c).cast("double").alias(c) for c in ("total_spend", "total_income")],
        F.col("transaction_count").cast("bigint").alias("transaction_count"),
        *[F.col(c).cast("double").alias(c) for c in ("average_transaction", "spend_growth")],
        F.col("transaction_growth").cast("bigint").alias("transaction_growth"),
    )


@query(
    "gold_customer_segments",
    MONTHLY_SQL
    + f"""select customer_id, cast(month as varchar) as report_month, {SEGMENT} as segment,
       avg_monthly_spend, avg_monthly_transactions
from g""",
)
def gold_customer_segments(spark: SparkSession, d: str) -> DataFrame:
    return customer_monthly_metrics(customers(spark, d), transactions(spark, d)).select(
        "customer_id",
        F.col("month").cast("string").alias("report_month"),
        "segment",
        "avg_monthly_spend",
        "avg_monthly_transactions",
    )


# What suppliers ship per quarter: volume, returns, the deepest discount, and how the volume moves.
SHIPMENT_SPEC = {
    "source_tables": [{"name": "vendor"}, {"name": "line"}],
    "joins": [{"type": "left", "tables": ["vendor", "line"], "condition": "vendor.s_suppkey = line.l_suppkey"}],
    "aggregations": [
        {
            "name": "vendor_quarters",
            "group_by": ["vendor.s_suppkey", "vendor.s_nationkey", "cast(trunc(line.l_shipdate, 'quarter') as date) as shipped"],
            "metrics": [
                {"name": "units", "expression": "sum(line.l_quantity)", "type": "double"},
                {"name": "returns", "expression": "count_if(line.l_returnflag = 'R')", "type": "bigint"},
                {"name": "deepest", "expression": "max(line.l_discount)", "type": "double"},
            ],
            "windows": [
                {
                    "name": "year",
                    "partition_by": ["vendor.s_suppkey"],
                    "order_by": "shipped",
                    "frame": "rows between 3 preceding and current row",
                    "metrics": [
                        {"name": "best_of_year", "expression": "max(units)", "type": "double"},
                        {"name": "returns_of_year", "expression": "sum(returns)", "type": "bigint"},
                    ],
                },
                {
                    "name": "peers",
                    "partition_by": ["vendor.s_nationkey", "shipped"],
                    "order_by": "units desc",
                    "metrics": [{"name": "place", "expression": "rank()", "type": "int"}],
                },
            ],
        },
        {
            "name": "vendor_trends",
            "dependencies": ["vendor_quarters"],
            "type": "view",
            "expression": """
                select s_suppkey, shipped,
                       case when before is null then 'new' when units > 1.1 * before then 'rising'
                            when units < 0.9 * before then 'falling' else 'steady' end as trend
                from (select *, lag(units) over (partition by s_suppkey order by shipped) as before from vendor_quarters)""",
        },
    ],
    "target_fields": {
        "supplier": {"source": "vendor_quarters.s_suppkey", "type": "bigint"},
        "quarter": {"source": "vendor_quarters.shipped", "type": "string"},
        "units": {"source": "vendor_quarters.units", "type": "double"},
        "returned_lines": {"source": "vendor_quarters.returns", "type": "bigint"},
        "deepest_discount": {"source": "vendor_quarters.deepest", "type": "double"},
        "best_of_year": {"source": "vendor_quarters.best_of_year", "type": "double"},
        "returns_of_year": {"source": "vendor_quarters.returns_of_year", "type": "bigint"},
        "place_in_nation": {"source": "vendor_quarters.place", "type": "int"},
        "trend": {"source": "vendor_trends.trend", "type": "string"},
        "built_on": {"type": "string", "transform": "current_date"},
    },
}

SHIPMENT_SQL = """
with q as (
  select s_suppkey, s_nationkey, cast(date_trunc('quarter', l_shipdate) as date) as shipped, sum(l_quantity)::double as units,
         count(*) filter (l_returnflag = 'R') as returns, max(l_discount) as deepest
  from supplier left join lineitem on l_suppkey = s_suppkey group by 1, 2, 3),
t as (
  select *, max(units) over y as best_of_year, sum(returns) over y as returns_of_year,
         rank() over (partition by s_nationkey, shipped order by units desc nulls last) as place,
         lag(units) over (partition by s_suppkey order by shipped nulls first) as before
  from q window y as (partition by s_suppkey order by shipped nulls first rows between 3 preceding and current row)),
v as (
  select *, case when before is null then 'new' when units > 1.1 * before then 'rising'
                 when units < 0.9 * before then 'falling' else 'steady' end as trend from t)
"""


def _shipments(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"vendor": table(spark, d, "supplier"), "line": table(spark, d, "lineitem")}


@query(
    "gold_from_spec",
    SHIPMENT_SQL
    + """select s_suppkey as supplier, cast(shipped as varchar) as quarter, units, returns as returned_lines,
       deepest as deepest_discount, best_of_year, returns_of_year::bigint as returns_of_year, place::int as place_in_nation,
       trend, '2024-02-01' as built_on from v""",
)
def gold_from_spec(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return build_gold(SHIPMENT_SPEC, _shipments(spark, d), ["s_suppkey", "shipped"], as_of)


@query(
    "gold_dependent_view",
    SHIPMENT_SQL + "select trend, count(*) as quarters, count(distinct s_suppkey) as suppliers from v group by 1",
)
def gold_dependent_view(spark: SparkSession, d: str) -> DataFrame:
    views = build_views(SHIPMENT_SPEC, _shipments(spark, d))
    return views["vendor_trends"].groupBy("trend").agg(
        F.count("*").alias("quarters"), F.count_distinct("s_suppkey").alias("suppliers")
    )


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))


@query(
    "gold_sum_having",
    """select l_returnflag, l_linestatus, sum(l_quantity) as sales_l_quantity_sum,
              cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as sales_price_sum
       from lineitem group by 1, 2 having sum(l_quantity) > 1000""",
)
def gold_sum_having(spark: SparkSession, d: str) -> DataFrame:
    rule = AggregationRule(
        "sales", ("l_quantity", "price"), "sum", ("l_returnflag", "l_linestatus"), "sales_l_quantity_sum > 1000"
    )
    return apply_rule(_items(spark, d), rule).withColumn("sales_price_sum", F.col("sales_price_sum").cast("double"))


@query(
    "gold_avg_by_supplier",
    """select l_suppkey, round(avg(l_extendedprice), 4) as price_l_extendedprice_avg, avg(l_quantity) as price_l_quantity_avg
       from lineitem group by 1""",
)
def gold_avg_by_supplier(spark: SparkSession, d: str) -> DataFrame:
    rule = AggregationRule("price", ("l_extendedprice", "l_quantity"), "avg", ("l_suppkey",))
    out = apply_rule(table(spark, d, "lineitem"), rule)
    return out.withColumn("price_l_extendedprice_avg", F.round("price_l_extendedprice_avg", 4))


@query(
    "gold_count_non_null",
    """select o_orderstatus, count(nullif(o_orderpriority, '5-LOW')) as orders_priority_count,
              count(o_orderkey) as orders_o_orderkey_count from orders group by 1""",
)
def gold_count_non_null(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    rule = AggregationRule("orders", ("priority", "o_orderkey"), "count", ("o_orderstatus",))
    return apply_rules(df, [rule])["orders"]


@query(
    "gold_rule_chain",
    """select l_returnflag, avg(q) as mean_line_l_quantity_sum_avg from
         (select l_orderkey, l_returnflag, sum(l_quantity) as q from lineitem group by 1, 2 having sum(l_quantity) > 10)
       group by 1""",
)
def gold_rule_chain(spark: SparkSession, d: str) -> DataFrame:
    first = AggregationRule("line", ("l_quantity",), "sum", ("l_orderkey", "l_returnflag"), "line_l_quantity_sum > 10")
    second = AggregationRule("mean", ("line_l_quantity_sum",), "avg", ("l_returnflag",))
    return apply_rule_chain(table(spark, d, "lineitem"), [first, second])


@query(
    "gold_ungrouped_rule",
    "select sum(l_quantity) as total_l_quantity_sum, sum(cast(l_linenumber as bigint))::bigint as total_l_linenumber_sum from lineitem",
)
def gold_ungrouped_rule(spark: SparkSession, d: str) -> DataFrame:
    rule = AggregationRule("total", ("l_quantity", "l_linenumber"), "sum")
    return apply_rule(table(spark, d, "lineitem"), rule)


@query(
    "gold_time_window_metrics",
    """select n_name, cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as month, count(*) as order_count,
              cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue,
              count(*) filter (where o_orderstatus = 'F') as finished
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2""",
)
def gold_time_window_metrics(spark: SparkSession, d: str) -> DataFrame:
    item = {
        "name": "monthly",
        "source_tables": ["orders", "customer", "nation"],
        "join_conditions": [{"on": F.expr("o_custkey = c_custkey")}, {"on": F.expr("c_nationkey = n_nationkey")}],
        "time_window": [
            {
                "period": "cast(cast(date_trunc('month', o_orderdate) as date) as string) as month",
                "metrics": [
                    {"name": "order_count", "expr": "count(*)"},
                    {"name": "revenue", "expr": "sum(cast(o_totalprice as decimal(18,2)))", "type": "double"},
                    {"name": "finished", "expr": "count_if(o_orderstatus = 'F')"},
                ],
            }
        ],
        "dimensions": ["n_name"],
    }
    return gold_frame(spark, item, {n: table(spark, d, n) for n in item["source_tables"]})
