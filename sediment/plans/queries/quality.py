"""Quality rules: each kind alone, and a grouped spec in one evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import QualityRule, rules_from_spec
from sediment.operators import quality
from sediment.plans.queries.registry import query, rounded, table
from sediment.sources import readers

TIDY = ["rule_id", "target", "metric", "value", "passed"]

ORDERS_SQL = """(select o_orderkey, o_custkey, o_totalprice, o_orderdate, nullif(o_orderpriority, '5-LOW') as priority,
   case when o_orderstatus = 'P' then 'nan'::double else o_totalprice end as price from orders)"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderdate",
        "nullif(o_orderpriority, '5-LOW') as priority",
        "if(o_orderstatus = 'P', double('nan'), o_totalprice) as price",
    )


def _run(df: DataFrame, *rules: QualityRule, **options) -> DataFrame:
    return quality.evaluate(df, list(rules), "t", **options).select(*TIDY)


def _long(rule: str, target: str, metrics: dict[str, str], passed: str, source: str) -> str:
    """Oracle rows of one target: its metrics, each with the target's verdict."""
    rows = [
        f"select '{rule}' as rule_id, '{target}' as target, '{m}' as metric, cast({e} as double) as value, {passed} as passed from s"
        for m, e in metrics.items()
    ]
    return f"select * from (with s as ({source}) " + " union all ".join(rows) + ")"


def _completeness_sql(column: str, threshold: float, rule: str = "complete") -> str:
    return _long(
        rule,
        column,
        {"completeness_ratio": "1 - m::double / n", "null_count": "m", "total_rows": "n"},
        f"1 - m::double / n >= {threshold}",
        f"select count(*) as n, count(*) - count({column}) as m from {ORDERS_SQL}",
    )


@query(
    "dq_completeness",
    _completeness_sql("priority", 0.9) + " union all " + _completeness_sql("o_custkey", 0.9),
)
def dq_completeness(spark: SparkSession, d: str) -> DataFrame:
    return _run(
        _orders(spark, d), QualityRule("complete", "completeness", {"columns": ["priority", "o_custkey"]}, threshold=0.9)
    )


@query(
    "dq_completeness_nan",
    _long(
        "complete",
        "price",
        {"completeness_ratio": "1 - m::double / n", "null_count": "m", "total_rows": "n"},
        "1 - m::double / n >= 0.99",
        f"select count(*) as n, count(*) filter (where price is null or isnan(price)) as m from {ORDERS_SQL}",
    )
    + " union all "
    + _completeness_sql("priority", 0.99),
)
def dq_completeness_nan(spark: SparkSession, d: str) -> DataFrame:
    params = {"columns": ["price", "priority"], "nan_is_missing": True}
    return _run(_orders(spark, d), QualityRule("complete", "completeness", params, threshold=0.99))


def _unique_sql(columns: str, target: str, threshold: float, source: str, rule: str = "unique") -> str:
    return _long(
        rule,
        target,
        {"uniqueness_ratio": "u::double / n", "duplicate_count": "n - u"},
        f"u::double / n >= {threshold}",
        f"select (select count(*) from {source}) as n, (select count(*) from (select distinct {columns} from {source})) as u",
    )


@query(
    "dq_uniqueness",
    _unique_sql("o_orderkey", "o_orderkey", 1.0, ORDERS_SQL)
    + " union all "
    + _unique_sql("o_custkey, priority", "o_custkey_priority", 1.0, ORDERS_SQL),
)
def dq_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return _run(
        _orders(spark, d), QualityRule("unique", "uniqueness", {"columns": ["o_orderkey", ["o_custkey", "priority"]]})
    )


@query(
    "dq_numeric",
    _long(
        "bounds",
        "l_quantity",
        {"min": "a", "max": "b", "avg": "round(c, 4)", "stddev": "round(d, 4)", "out_of_range_count": "e"},
        "1 - e::double / n >= 0.9",
        "select min(l_quantity) as a, max(l_quantity) as b, avg(l_quantity) as c, stddev_samp(l_quantity) as d, "
        "count(*) filter (where l_quantity < 2 or l_quantity > 49) as e, count(*) as n from lineitem",
    )
    + " union all "
    + _long(
        "exact",
        "l_discount",
        {"min": "a", "max": "b", "avg": "round(c, 4)", "stddev": "round(d, 4)", "out_of_range_count": "e"},
        "e = 0",
        "select min(l_discount) as a, max(l_discount) as b, avg(l_discount) as c, stddev_samp(l_discount) as d, "
        "count(*) filter (where l_discount > 0.05) as e, count(*) as n from lineitem",
    ),
)
def dq_numeric(spark: SparkSession, d: str) -> DataFrame:
    out = _run(
        table(spark, d, "lineitem"),
        QualityRule("bounds", "numeric", {"column": "l_quantity", "min_value": 2, "max_value": 49}, threshold=0.9),
        QualityRule("exact", "numeric", {"column": "l_discount", "max_value": 0.05}),
    )
    return rounded(out, ["value"], 4)


@query(
    "dq_zscore",
    _long(
        "far",
        "value",
        {"anomaly_count": "f", "anomaly_ratio": "f::double / n"},
        "f <= n * (1 - 0.99)",
        "select count(*) as n, count(*) filter (where abs(value - a) / d > 3.0) as f from events, "
        "(select avg(value) as a, stddev_samp(value) as d from events)",
    ),
)
def dq_zscore(spark: SparkSession, d: str) -> DataFrame:
    return _run(table(spark, d, "events"), QualityRule("far", "anomaly", {"columns": ["value"]}, threshold=0.99))


@query(
    "dq_zscore_lookback",
    _long(
        "far",
        "value",
        {"anomaly_count": "f", "anomaly_ratio": "f::double / n"},
        "f <= n * (1 - 0.99)",
        "select count(*) as n, count(*) filter (where abs(value - a) / d > 2.5) as f from events, "
        "(select avg(value) as a, stddev_samp(value) as d from events "
        "where ts::date > (select max(ts)::date - 7 from events))",
    ),
)
def dq_zscore_lookback(spark: SparkSession, d: str) -> DataFrame:
    """All rows against the mean and deviation of the last seven days."""
    params = {"columns": ["value"], "date_column": "ts", "lookback_days": 7, "zscore_threshold": 2.5}
    return _run(table(spark, d, "events"), QualityRule("far", "anomaly", params, threshold=0.99))


@query(
    "dq_zscore_samples",
    """select event_id, value from events, (select avg(value) as a, stddev_samp(value) as d from events)
       where abs(value - a) / d > 3.0 order by event_id limit 5""",
)
def dq_zscore_samples(spark: SparkSession, d: str) -> DataFrame:
    return quality.zscore_samples(table(spark, d, "events"), "value", ["event_id"]).select("event_id", "value")


@query(
    "dq_anomaly_ratio",
    _long(
        "far",
        "value",
        {"anomaly_count": "f", "anomaly_ratio": "f::double / n"},
        "f::double / n <= 0.01",
        "select count(*) as n, count(*) filter (where abs(value - a) > 2.0 * d) as f from events, "
        "(select avg(value) as a, stddev_samp(value) as d from events)",
    ),
)
def dq_anomaly_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _run(table(spark, d, "events"), QualityRule("far", "anomaly_ratio", {"columns": ["value"], "threshold": 2.0}))


RICH = "(select c_custkey from customer where c_acctbal > 0)"


@query(
    "dq_referential",
    _long(
        "known",
        "rich_customers(c_custkey)",
        {"integrity_ratio": "1 - f::double / n", "orphaned_count": "f"},
        "1 - f::double / n >= 0.95",
        f"select count(*) as n, count(*) filter (where o_custkey not in {RICH}) as f from orders",
    ),
)
def dq_referential(spark: SparkSession, d: str) -> DataFrame:
    rule = QualityRule(
        "known",
        "referential_integrity",
        {"target_table": "rich_customers", "source_columns": ["o_custkey"], "target_columns": ["c_custkey"]},
        threshold=0.95,
    )
    return _run(
        table(spark, d, "orders"), rule, tables={"rich_customers": table(spark, d, "customer").filter("c_acctbal > 0")}
    )


@query(
    "dq_referential_samples",
    f"select o_orderkey, o_custkey from orders where o_custkey not in {RICH} order by o_orderkey limit 5",
)
def dq_referential_samples(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "customer").filter("c_acctbal > 0")
    found = quality.orphan_samples(table(spark, d, "orders"), rich, ["o_custkey"], ["c_custkey"], ["o_orderkey"])
    return found.select("o_orderkey", "o_custkey")


@query(
    "dq_referential_key_column",
    _long(
        "keys",
        "a(id)",
        {"integrity_ratio": "1 - f::double / n", "orphaned_count": "f"},
        "1 - f::double / n >= 1.0",
        "select count(*) as n, 0 as f from lineitem",
    )
    + " union all "
    + _long(
        "keys",
        "b(id)",
        {"integrity_ratio": "1 - f::double / n", "orphaned_count": "f"},
        "1 - f::double / n >= 1.0",
        "select count(*) as n, count(*) filter (where p_size > 40) as f from lineitem join part on l_partkey = p_partkey",
    ),
)
def dq_referential_key_column(spark: SparkSession, d: str) -> DataFrame:
    """A mapping's key column is checked against each of its sources."""
    parts = table(spark, d, "part").withColumnRenamed("p_partkey", "id")
    rule = QualityRule("keys", "referential_integrity", {"key_column": "id", "sources": ["a", "b"]})
    items = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "id")
    return _run(items, rule, tables={"a": parts, "b": parts.filter("p_size <= 40")})


@query(
    "dq_row_count",
    _long("rows", "*", {"row_count": "n"}, "n >= 1000", "select count(*) as n from lineitem")
    + " union all "
    + _long("volume", "*", {"row_count": "n"}, "n >= 1000000000000", "select count(*) as n from lineitem"),
)
def dq_row_count(spark: SparkSession, d: str) -> DataFrame:
    return _run(
        table(spark, d, "lineitem"),
        QualityRule("rows", "row_count", {"min_threshold": 1000}),
        QualityRule("volume", "volume_check", {"min_records": 10**12}),
    )


@query(
    "dq_null_percentage",
    _long(
        "nulls",
        "priority",
        {"null_percentage": "m * 100::double / n"},
        "m * 100::double / n <= 25",
        f"select count(*) as n, count(*) - count(priority) as m from {ORDERS_SQL}",
    ),
)
def dq_null_percentage(spark: SparkSession, d: str) -> DataFrame:
    return _run(
        _orders(spark, d), QualityRule("nulls", "null_check", {"columns": ["priority"], "max_nulls_percentage": 25})
    )


@query(
    "dq_pass_rate",
    _long(
        "rule1",
        "o_orderkey,priority",
        {"pass_rate": "g::double / n", "failed_records": "n - g", "total_records": "n"},
        "g::double / n >= 0.99",
        f"select count(*) as n, count(*) filter (where o_orderkey is not null and priority is not null) as g from {ORDERS_SQL}",
    ),
)
def dq_pass_rate(spark: SparkSession, d: str) -> DataFrame:
    spec = [{"id": "rule1", "type": "null_check", "columns": ["o_orderkey", "priority"], "threshold": 0.99}]
    return _run(_orders(spark, d), *rules_from_spec(spec))


@query(
    "dq_business_rule",
    _long(
        "positive",
        "value > 5",
        {"pass_rate": "g::double / n", "failed_records": "n - g", "total_records": "n"},
        "g::double / n >= 0.5",
        "select count(*) as n, count(*) filter (where value > 5) as g from "
        "(select case when event_type = 'view' then null else value end as value from events)",
    ),
)
def dq_business_rule(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").selectExpr("if(event_type = 'view', null, value) as value")
    return _run(events, QualityRule("positive", "business_rule", {"condition": "value > 5"}, threshold=0.5))


EXPECTED = {"click": 0.2, "error": 0.2, "view": 0.45, "refund": 0.05}


@query(
    "dq_distribution",
    " union all ".join(
        _long(
            "shares",
            f"event_type={value}",
            {"actual_ratio": "h::double / n", "expected_ratio": str(share)},
            f"abs(h::double / n - {share}) <= 0.1",
            f"select count(*) as n, count(*) filter (where event_type = '{value}') as h from events",
        )
        for value, share in EXPECTED.items()
    ),
)
def dq_distribution(spark: SparkSession, d: str) -> DataFrame:
    rule = QualityRule("shares", "value_distribution", {"column": "event_type", "expected_values": EXPECTED})
    return _run(table(spark, d, "events"), rule)


@query(
    "dq_freshness",
    _long(
        "fresh",
        "ts",
        {"freshness": "round(1 - age / 172800.0, 6)", "age_seconds": "round(age, 3)"},
        "age <= 172800",
        "select epoch_us(timestamp '2024-02-01 00:00:00')::double / 1e6 - epoch_us(max(ts))::double / 1e6 as age from events",
    ),
)
def dq_freshness(spark: SparkSession, d: str) -> DataFrame:
    rule = QualityRule("fresh", "freshness", {"timestamp_column": "ts", "max_delay_hours": 48})
    out = _run(table(spark, d, "events"), rule, as_of=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    digits = F.when(F.col("metric") == "freshness", F.round("value", 6)).otherwise(F.round("value", 3))
    return out.withColumn("value", digits)


@query(
    "dq_schema",
    """select 'columns' as rule_id, t.target, 'present' as metric, t.value, t.value > 0 as passed
       from (values ('priority', 1.0::double), ('o_email', 0.0::double)) t(target, value) union all """
    + _completeness_sql("priority", 0.5),
)
def dq_schema(spark: SparkSession, d: str) -> DataFrame:
    return _run(
        _orders(spark, d),
        QualityRule("columns", "schema_check", {"required_columns": ["priority", "o_email"]}),
        QualityRule("complete", "completeness", {"columns": ["priority"]}, threshold=0.5),
    )


SPEC = {
    "rule_id": "orders_quality",
    "version": "1.0.0",
    "rules": {
        "completeness": {
            "type": "completeness", "columns": ["o_orderkey", "priority"], "threshold": 0.99, "severity": "high",
        },
        "uniqueness": {"type": "uniqueness", "columns": [["o_orderkey"], ["o_custkey"]], "severity": "medium"},
        "numeric": {
            "type": "numeric",
            "rules": [{"column": "o_totalprice", "min_value": 0}, {"column": "o_custkey", "min_value": 0, "max_value": 10}],
            "threshold": 0.5,
            "severity": "low",
        },
        "referential_integrity": {
            "type": "referential_integrity",
            "rules": [
                {
                    "source_table": "orders",
                    "target_table": "rich_customers",
                    "source_columns": ["o_custkey"],
                    "target_columns": ["c_custkey"],
                    "threshold": 0.5,
                }
            ],
            "severity": "high",
        },
    },
    "actions": {"on_failure": {"high": "quarantine", "medium": "alert", "low": "log"}},
}


def _spec_results(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "customer").filter("c_acctbal > 0")
    return quality.evaluate(_orders(spark, d), rules_from_spec(SPEC), "orders", {"rich_customers": rich})


SPEC_SQL = f"""
  select 'orders_quality.completeness' as rule_id, 'completeness' as rule_type, 'high' as severity, 'o_orderkey' as target,
         count(o_orderkey)::double / count(*) >= 0.99 as passed from {ORDERS_SQL}
  union all select 'orders_quality.completeness', 'completeness', 'high', 'priority', count(priority)::double / count(*) >= 0.99 from {ORDERS_SQL}
  union all select 'orders_quality.uniqueness', 'uniqueness', 'medium', 'o_orderkey', count(distinct o_orderkey) = count(*) from orders
  union all select 'orders_quality.uniqueness', 'uniqueness', 'medium', 'o_custkey', count(distinct o_custkey) = count(*) from orders
  union all select 'orders_quality.numeric.o_totalprice', 'numeric', 'low', 'o_totalprice', min(o_totalprice) >= 0 from orders
  union all select 'orders_quality.numeric.o_custkey', 'numeric', 'low', 'o_custkey',
                   1 - count(*) filter (where o_custkey < 0 or o_custkey > 10)::double / count(*) >= 0.5 from orders
  union all select 'orders_quality.referential_integrity.rich_customers', 'referential_integrity', 'high', 'rich_customers(c_custkey)',
                   1 - count(*) filter (where o_custkey not in {RICH})::double / count(*) >= 0.5 from orders"""


@query("dq_engine_all", SPEC_SQL)
def dq_engine_all(spark: SparkSession, d: str) -> DataFrame:
    return _spec_results(spark, d).select("rule_id", "rule_type", "severity", "target", "passed").distinct()


@query(
    "dq_severity_actions",
    f"""select rule_id, severity, bool_and(passed) as passed, case when bool_and(passed) then null
          else case severity when 'high' then 'quarantine' when 'medium' then 'alert' else 'log' end end as action
        from ({SPEC_SQL}) group by 1, 2""",
)
def dq_severity_actions(spark: SparkSession, d: str) -> DataFrame:
    acted = quality.with_actions(_spec_results(spark, d), SPEC["actions"]["on_failure"])
    return acted.select("rule_id", "severity", "passed", "action")


@query(
    "dq_quality_score",
    f"select avg(p::integer) as data_quality_score from (select rule_id, bool_and(passed) as p from ({SPEC_SQL}) group by 1)",
)
def dq_quality_score(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_score(_spec_results(spark, d)).select("data_quality_score")


@query(
    "dq_pass_fail_counts",
    f"""select rule_id, count(*) filter (where passed) as pass_count, count(*) filter (where not passed) as fail_count
        from ({SPEC_SQL}) group by 1""",
)
def dq_pass_fail_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.rule_counts(_spec_results(spark, d)).select("rule_id", "pass_count", "fail_count")


@query(
    "dq_row_reasons",
    f"""select o_orderkey, concat_ws(',', case when priority is null then 'complete:priority' end,
              case when o_totalprice > 400000 then 'bounds:o_totalprice' end,
              case when not (o_custkey > 100) then 'rule:condition' end) as reasons
        from {ORDERS_SQL} where priority is null or o_totalprice > 400000 or not (o_custkey > 100)""",
)
def dq_row_reasons(spark: SparkSession, d: str) -> DataFrame:
    rules = [
        QualityRule("complete", "completeness", {"columns": ["priority"]}),
        QualityRule("bounds", "numeric", {"column": "o_totalprice", "max_value": 400000}),
        QualityRule("rule", "business_rule", {"condition": "o_custkey > 100"}),
    ]
    flagged = quality.flag_rows(_orders(spark, d), rules).filter(F.size("reasons") > 0)
    return flagged.select("o_orderkey", F.array_join("reasons", ",").alias("reasons"))


@query(
    "dq_views_left_join",
    "select count(*) as orphaned from orders left join (select c_custkey from customer where c_acctbal > 0) t on o_custkey = t.c_custkey where t.c_custkey is null",
)
def dq_views_left_join(spark: SparkSession, d: str) -> DataFrame:
    """The SQL form of the orphan check, over named views."""
    views = {"source": table(spark, d, "orders"), "target": table(spark, d, "customer").filter("c_acctbal > 0")}
    return readers.sql_source(
        spark,
        "select count(*) as orphaned from source left join target on source.o_custkey = target.c_custkey "
        "where target.c_custkey is null",
        views,
    )
