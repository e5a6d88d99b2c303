"""Run, rule and lineage look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.operators import audit
from sediment.plans.queries.aggregates import RUNS_SQL, runs
from sediment.plans.queries.registry import query, table


@query(
    "audit_runs_page",
    f"""select run_id, status from ({RUNS_SQL}) where pipeline_id = (select min(o_custkey) from orders)
        order by start_time, run_id limit 10 offset 2""",
)
def audit_runs_page(spark: SparkSession, d: str) -> DataFrame:
    all_runs = runs(spark, d)
    first = table(spark, d, "orders").agg(F.min("o_custkey")).first()[0]
    return audit.pipeline_runs(all_runs, first, 2, 10).select("run_id", "status")


@query(
    "audit_run_results",
    f"""select run_id, status, l_linenumber as check_id, l_quantity <= 30 as passed from ({RUNS_SQL})
        join lineitem on run_id = l_orderkey""",
)
def audit_run_results(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "lineitem").selectExpr(
        "l_orderkey as run_id", "l_linenumber as check_id", "l_quantity <= 30 as passed"
    )
    return audit.run_results(runs(spark, d), results).select("run_id", "status", "check_id", "passed")


@query(
    "audit_run_close_out",
    f"""select run_id, case when status = 'RUNNING' then 'COMPLETED' else status end as status,
              case when status = 'RUNNING' then 5400 else duration_seconds end as duration_seconds
        from ({RUNS_SQL})""",
)
def audit_run_close_out(spark: SparkSession, d: str) -> DataFrame:
    """Running runs are closed by appended state rows; a run is its latest state."""
    opened = runs(spark, d).withColumns(
        {"end_time": F.lit(None).cast("timestamp_ntz"), "recorded_at": F.col("start_time")}
    )
    end = F.expr("start_time + interval 90 minutes")
    closing = audit.close_run(
        opened.filter("status = 'RUNNING'"), F.lit("COMPLETED"), end, F.lit(None).cast("string"), end
    )
    current = audit.current_runs(opened.unionByName(closing))
    return current.select("run_id", "status", "duration_seconds")


@query(
    "audit_rules_of_mappings",
    """select l_orderkey as mapping_id, p_partkey as rule_id, p_type as rule_type from lineitem
       join part on l_partkey = p_partkey where l_returnflag <> 'N'""",
)
def audit_rules_of_mappings(spark: SparkSession, d: str) -> DataFrame:
    mappings = table(spark, d, "lineitem").selectExpr(
        "l_orderkey as mapping_id", "l_partkey as rule_id", "l_returnflag <> 'N' as enabled"
    )
    rules = table(spark, d, "part").selectExpr("p_partkey as rule_id", "p_type as rule_type")
    return audit.rules_of_mappings(mappings, rules).select("mapping_id", "rule_id", "rule_type")


@query(
    "audit_retry_history",
    """select o_custkey as error_id, max(attempt) as attempts, max_by(o_orderstatus, attempt) as last_status from (
         select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as attempt from orders) group by 1""",
)
def audit_retry_history(spark: SparkSession, d: str) -> DataFrame:
    attempts = table(spark, d, "orders").selectExpr(
        "o_custkey as error_id",
        "row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as attempt_number",
        "o_orderstatus as status",
        "o_orderdate as end_time",
    )
    out = audit.retry_history(attempts)
    return out.select("error_id", F.col("attempts").cast("bigint").alias("attempts"), "last_status")


@query(
    "audit_version_chain",
    """select o_orderkey, first_value(o_orderkey) over w as root_id, row_number() over w - 1 as depth from orders
       window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
)
def audit_version_chain(spark: SparkSession, d: str) -> DataFrame:
    versions = table(spark, d, "orders").selectExpr(
        "o_orderkey", "lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as previous_id"
    )
    return audit.version_chain(versions, "o_orderkey", "previous_id")


@query(
    "audit_lineage_closure",
    """with recursive edges as (
         select 'order.' || o_orderkey as table_name, 'customer.' || o_custkey as depends_on from orders
         union select 'customer.' || c_custkey, 'nation.' || c_nationkey from customer
         union select 'nation.' || n_nationkey, 'region.' || n_regionkey from nation),
       closure as (
         select table_name, depends_on as ancestor, 1 as depth from edges
         union select c.table_name, e.depends_on, c.depth + 1 from closure c join edges e on c.ancestor = e.table_name)
       select table_name, ancestor, min(depth)::bigint as depth from closure group by 1, 2""",
)
def audit_lineage_closure(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        table(spark, d, "orders").selectExpr("concat('order.', o_orderkey) as table_name", "concat('customer.', o_custkey) as depends_on"),
        table(spark, d, "customer").selectExpr("concat('customer.', c_custkey) as table_name", "concat('nation.', c_nationkey) as depends_on"),
        table(spark, d, "nation").selectExpr("concat('nation.', n_nationkey) as table_name", "concat('region.', n_regionkey) as depends_on"),
    ]
    edges = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return audit.lineage_closure(edges).withColumn("depth", F.col("depth").cast("bigint"))


@query(
    "audit_lineage_cycles",
    """with o as (select o_custkey, o_orderkey, count(*) over (partition by o_custkey) as n from orders)
       select 'order.' || min(o_orderkey) over (partition by o_custkey) as cycle, 'order.' || o_orderkey as table_name
       from o where n > 1 and o_custkey % 2 = 0""",
)
def audit_lineage_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Every order feeds its customer's next one; for customers of even number the last feeds the first."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    own = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.when(F.col("o_custkey") % 2 == 0, F.min("o_orderkey").over(whole))
    name = lambda c: F.concat(F.lit("order."), c)
    edges = orders.select(
        name(F.col("o_orderkey")).alias("table_name"), name(F.coalesce(F.lead("o_orderkey").over(own), first)).alias("depends_on")
    ).filter("depends_on is not null and depends_on <> table_name")
    cycles = audit.lineage_cycles(edges, parent="depends_on")
    number = lambda c: F.substring_index(c, ".", -1).cast("long")
    least = F.min(number(F.col("table_name"))).over(Window.partitionBy("cycle"))
    return cycles.select(name(least).alias("cycle"), "table_name")
