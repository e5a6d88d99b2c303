import math

import pytest
from pyspark.sql import functions as F

from sediment.config import QualityRule, SpecError, rules_from_spec
from sediment.operators import quality as q


@pytest.fixture(scope="module")
def edge(spark):
    data = [(1, "a", 1.0), (2, None, math.nan), (2, "", None), (None, "a", -5.0)]
    return spark.createDataFrame(data, "id long, name string, value double")


def result(df, rule, **options):
    rows = q.evaluate(df, [rule], "t", **options).collect()
    return {(r["target"], r["metric"]): r["value"] for r in rows}, {r["target"]: r["passed"] for r in rows}


def test_completeness_with_and_without_nan(edge):
    rule = QualityRule("c", "completeness", {"columns": ["name", "value"]}, threshold=0.75)
    values, passed = result(edge, rule)
    assert values["value", "completeness_ratio"] == 0.75 and passed == {"name": True, "value": True}
    rule = QualityRule("c", "completeness", {"columns": ["name", "value"], "nan_is_missing": True}, threshold=0.75)
    values, passed = result(edge, rule)
    assert values["value", "null_count"] == 2 and passed == {"name": True, "value": False}


def test_uniqueness_counts_null_as_a_value(edge):
    values, passed = result(edge, QualityRule("u", "uniqueness", {"columns": ["id", ["id", "name"]]}))
    assert values["id", "duplicate_count"] == 1 and not passed["id"]
    assert values["id_name", "uniqueness_ratio"] == 1.0 and passed["id_name"]


def test_empty_table_fails_instead_of_dividing_by_zero(edge, spark):
    empty = edge.limit(0)
    rules = [
        QualityRule("c", "completeness", {"columns": ["id"]}),
        QualityRule("u", "uniqueness", {"columns": ["id"]}),
        QualityRule("n", "numeric", {"column": "value", "min_value": 0}),
        QualityRule("z", "anomaly", {"columns": ["value"]}),
        QualityRule("r", "referential_integrity", {"target_table": "t", "key_column": "id"}),
        QualityRule("b", "business_rule", {"condition": "value > 0"}),
        QualityRule("f", "freshness", {"timestamp_column": "ts", "max_delay_hours": 1}),
    ]
    empty = empty.withColumn("ts", F.lit(None).cast("timestamp"))
    rows = q.evaluate(empty, rules, "t", {"t": edge}).collect()
    assert not any(r["passed"] for r in rows)


def test_numeric_bounds_and_flat_column(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    values, passed = result(df, QualityRule("n", "numeric", {"column": "v", "min_value": 5, "max_value": 5}))
    assert passed["v"] and values["v", "stddev"] == 0.0
    values, _ = result(df, QualityRule("z", "anomaly", {"columns": ["v"]}))
    assert values["v", "anomaly_count"] == 0


def test_null_fails_a_business_rule(edge):
    values, passed = result(edge, QualityRule("b", "business_rule", {"condition": "value > 0"}, threshold=0.5))
    assert values["value > 0", "failed_records"] == 2 and passed["value > 0"]


def test_referential_counts_null_keys_and_ignores_target_duplicates(spark):
    source = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    target = spark.createDataFrame([(1,), (1,), (3,)], "c long")
    rule = QualityRule(
        "r",
        "referential_integrity",
        {"target_table": "x", "source_columns": ["k"], "target_columns": ["c"]},
        threshold=0.5,
    )
    values, passed = result(source, rule, tables={"x": target})
    assert values["x(c)", "orphaned_count"] == 2 and passed["x(c)"]


def test_distribution_value_that_never_occurs(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)], "v string")
    rule = QualityRule("d", "value_distribution", {"column": "v", "expected_values": {"a": 0.85, "c": 0.1, "d": 0.11}})
    values, passed = result(df, rule)
    assert passed == {"v=a": True, "v=c": True, "v=d": False}


def test_freshness(spark):
    df = spark.sql("select timestamp'2024-01-01 10:00:00' as ts")
    rule = QualityRule("f", "freshness", {"timestamp_column": "ts", "max_delay_hours": 2})
    values, passed = result(df, rule, as_of=F.lit("2024-01-01 11:00:00").cast("timestamp"))
    assert values["ts", "freshness"] == 0.5 and passed["ts"]
    _, passed = result(df, rule, as_of=F.lit("2024-01-01 12:00:01").cast("timestamp"))
    assert not passed["ts"]


def test_fused_evaluation_equals_rule_by_rule(edge):
    rules = [
        QualityRule("c", "completeness", {"columns": ["id", "name"]}),
        QualityRule("n", "numeric", {"column": "id", "min_value": 1}),
        QualityRule("k", "row_count", {"min_threshold": 4}),
        QualityRule("p", "null_check", {"columns": ["id"], "max_nulls_percentage": 25}),
        QualityRule("u", "uniqueness", {"columns": ["id"]}),
    ]
    together = sorted(map(tuple, q.evaluate(edge, rules, "t").collect()))
    apart = sorted(tuple(r) for rule in rules for r in q.evaluate(edge, [rule], "t").collect())
    assert together == apart


def test_one_scan_for_all_plain_rules(edge, spark, tmp_path):
    path = str(tmp_path / "t")
    edge.write.parquet(path)
    rules = [QualityRule(f"c{i}", "completeness", {"columns": ["id", "name", "value"]}) for i in range(5)]
    plan = q.evaluate(spark.read.parquet(path), rules, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_unknown_rule_and_severity(edge):
    with pytest.raises(SpecError):
        q.evaluate(edge, [QualityRule("x", "nonsense")], "t")
    with pytest.raises(SpecError):
        QualityRule("x", "completeness", severity="fatal")


def test_both_spec_shapes():
    grouped = rules_from_spec(
        {
            "rule_id": "s",
            "version": "2.0",
            "rules": {
                "numeric": {
                    "type": "numeric", "rules": [{"column": "lat", "min_value": -90, "max_value": 90}], "severity": "high",
                },
                "anomaly": {
                    "type": "anomaly",
                    "rules": [{"type": "volume", "config": {"detection_method": "zscore", "lookback_window": 30, "threshold": 3.0}}],
                },
            },
        }
    )
    assert [(r.rule_id, r.rule_type, r.version) for r in grouped] == [
        ("s.numeric.lat", "numeric", "2.0"),
        ("s.anomaly.volume", "anomaly_detector", "2.0"),
    ]
    flat = rules_from_spec([{"rule_id": "r", "version": "1", "rule_type": "numeric", "columns": ["a"], "min_value": 1}])
    assert flat[0].params == {"columns": ["a"], "min_value": 1} and flat[0].severity == "high"
    named = rules_from_spec([{"name": "null_check", "columns": ["id"], "condition": "IS NOT NULL", "threshold": 0.99}])
    assert named[0].rule_type == "null_check" and named[0].threshold == 0.99


def test_detector_as_rule(spark):
    df = spark.sql("select id, date_add(date'2024-01-01', int(id % 40)) as processing_date from range(400)")
    spec = {"rules": {"anomaly": {"type": "anomaly", "rules": [{"type": "volume", "config": {"lookback_window": 30, "threshold": 3.0}}]}}}
    rows = q.evaluate(df, rules_from_spec(spec), "t").collect()
    assert {r["metric"]: r["value"] for r in rows} == {"anomaly_count": 0.0, "total_rows": 400.0}
    assert all(r["passed"] for r in rows)


def test_added_rule_type(edge):
    def no_blank(df, rule, *_):
        return [
            q.Probe(
                rule,
                "name",
                {"blank": F.count_if(F.col("name") == "")},
                lambda get: {"blank_count": get("blank")},
                lambda get: get("blank") == 0,
            )
        ]

    q.register_rule_type("no_blank", no_blank)
    values, passed = result(edge, QualityRule("b", "no_blank"))
    assert values == {("name", "blank_count"): 1.0} and not passed["name"]


def test_approximate_uniqueness(spark):
    df = spark.range(5000).selectExpr("id", "id % 50 as k")
    rule = QualityRule("u", "approximate_uniqueness", {"columns": ["id", ["k"]]}, threshold=0.9)
    values, passed = result(df, rule)
    assert passed == {"id": True, "k": False}
    assert values["k", "uniqueness_ratio"] == pytest.approx(0.01, rel=0.1)
