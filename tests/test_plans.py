"""Layer runs, step lists, gold specs, events and streams."""

import pytest
from pyspark.sql import functions as F

from sediment.config import SpecError
from sediment.operators import events as ev
from sediment.operators.aggregates import DURATION_BUCKETS, duration_histogram
from sediment.plans import gold_spec, layers, steps
from sediment.session import scratch_path
from sediment.streaming import flows


def csv(tmp_path, text, name="data.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def order_steps(landing, out, sql, least=0.9):
    return {
        "id": "orders",
        "steps": [
            {"id": "raw_orders", "type": "extract", "source": {"path": landing, "schema": "number int, customer string, cents long"}},
            {"id": "per_customer", "type": "transform", "sql": sql},
            {"id": "stored", "type": "load", "target": {"path": out, "format": "parquet"}},
        ],
        "quality_rules": [{"id": "named", "type": "null_check", "columns": ["customer"], "threshold": least}],
    }


TOTALS = "select customer, count(*) as n, sum(cents) as cents from raw_orders group by customer"


@pytest.mark.parametrize(
    "lines,least,stored",
    [
        (["7,kim,500", "8,ola,125", "9,kim,25"], 0.9, [("kim", 2, 525), ("ola", 1, 125)]),
        (["7,kim,500", "8,,125", "9,kim,25"], 0.6, [("kim", 2, 525), (None, 1, 125)]),
        (["7,kim,500", "8,,125", "9,kim,25"], 0.9, None),
    ],
)
def test_order_steps_store_totals_or_stop_at_the_rule(spark, tmp_path, lines, least, stored):
    landing, out = csv(tmp_path, "\n".join(["number,customer,cents", *lines, ""])), tmp_path / "totals"
    reports, raised = steps.run_steps(spark, order_steps(landing, str(out), TOTALS, least), "2021-05-06T07:08:09")
    kinds = [r["event_type"] for r in raised.collect()]
    check = reports[0]["quality_checks"]["named"]
    assert check["metrics"]["pass_rate"] == pytest.approx(sum(",," not in x for x in lines) / len(lines))
    if stored is None:
        assert not check["passed"] and len(reports) == 1 and not out.exists()
        assert reports[0]["error"] == "Quality check failed: named" and kinds == ["quality_check_failure"]
        return
    assert check["passed"] and all(r["success"] for r in reports) and set(kinds) == {"pipeline_complete"}
    assert [r["records_processed"] for r in reports][:2] == [len(lines), len(stored)]
    assert reports[0]["metrics"]["bytes_processed"] == (tmp_path / "data.csv").stat().st_size
    found = {tuple(r) for r in spark.read.parquet(str(out)).select("customer", "n", "cents").collect()}
    assert found == set(stored)


def test_order_steps_report_the_step_that_cannot_run(spark, tmp_path):
    landing = csv(tmp_path, "number,customer,cents\n1,kim,5\n")
    config = order_steps(landing, str(tmp_path / "totals"), "selec customer from raw_orders")
    reports, raised = steps.run_steps(spark, config, "2021-05-06T07:08:09")
    assert [r["success"] for r in reports] == [True, False] and "PARSE" in reports[1]["error"].upper()
    assert raised.collect()[-1]["details"]["error"] == "SQL execution failed"


def test_a_rule_covers_the_steps_it_names(spark, tmp_path):
    landing = csv(tmp_path, "number,customer,cents\n7,kim,500\n8,,125\n9,kim,25\n")
    config = order_steps(landing, str(tmp_path / "totals"), TOTALS, 0.6)
    config["quality_rules"][0]["steps"] = ["per_customer"]
    reports, _ = steps.run_steps(spark, config, "2021-05-06T07:08:09")
    assert reports[0]["quality_checks"] == {} and reports[0]["success"]
    assert not reports[1]["success"] and reports[1]["error"] == "Quality check failed: named"  # 1 of 2 groups is named


def test_reference_data_is_read_by_its_path(spark, tmp_path):
    spark.createDataFrame([("1234", "NO", 59.9, 10.7)], "zip string, country string, lat double, long double").write.parquet(f"{tmp_path}/geo")
    df = spark.createDataFrame([(1, "1234", "NO"), (2, "9", "NO")], "id int, zip_code string, country string")
    config = {
        "input_columns": {"zip": "zip_code", "country": "country"},
        "output_columns": {"latitude": "lat", "longitude": "long"},
        "reference_data": f"{tmp_path}/geo",
    }
    out = layers.SILVER_STEPS["enrich_location"](df, {"config": config}, {})
    assert {(r["id"], r["lat"], r["long"]) for r in out.collect()} == {(1, 59.9, 10.7), (2, None, None)}
    given = {f"{tmp_path}/geo": spark.createDataFrame([("9", "NO", 1.0, 2.0)], "zip string, country string, lat double, long double")}
    out = layers.SILVER_STEPS["enrich_location"](df, {"config": config}, given)
    assert {(r["id"], r["lat"]) for r in out.collect()} == {(1, None), (2, 1.0)}


def bronze_item(root, **more):
    return {
        "name": "people",
        "format": "csv",
        "landing_zone": {"path": root, "file_pattern": "*.csv"},
        "schema_validation": {"schema": "id int, name string, age int", "mode": "strict", "on_error": "quarantine"},
        "processing": {"handle_duplicates": "drop_exact"},
        "bronze_zone": {"path": f"{root}/bronze"},
        **more,
    }


def test_bronze_drops_copies_across_files_and_keeps_bad_lines(spark, tmp_path):
    csv(tmp_path, "id,name,age\n1,a,10\n2,b,x\n", "a.csv")
    csv(tmp_path, "id,name,age\n1,a,10\n3,c,30\n", "b.csv")
    (outcome,) = layers.run_bronze(spark, {"source_configurations": [bronze_item(str(tmp_path), encrypted_columns=["name"])]})
    assert outcome.status == "written"
    stored = spark.read.parquet(f"{tmp_path}/bronze")
    assert sorted(r["id"] for r in stored.collect()) == [1, 3]
    assert {"source_file", "ingestion_timestamp", "record_status", "processed_timestamp"} <= set(stored.columns)
    assert all(len(r["name"]) == 64 for r in stored.collect())
    bad = spark.read.parquet(f"{tmp_path}/bronze_quarantine/malformed").collect()
    assert [len(r["raw_record"]) for r in bad] == [64]


def test_failed_check_holds_the_layer_back(spark, tmp_path):
    csv(tmp_path, "id,name,age\n1,a,10\n", "a.csv")
    item = bronze_item(str(tmp_path), quality_checks=[{"type": "row_count", "min_threshold": 5}])
    context = layers.RunContext("p", results_path=f"{tmp_path}/results", events_path=f"{tmp_path}/events")
    (outcome,) = layers.run_bronze(spark, {"source_configurations": [item]}, context)
    assert outcome.status == "held" and outcome.failed_rules[0]["rule_type"] == "row_count"
    assert not (tmp_path / "bronze" / "_SUCCESS").exists()
    assert spark.read.parquet(f"{tmp_path}/results").count() == 1
    raised = spark.read.json(f"{tmp_path}/events").collect()
    assert [r["topic"] for r in raised] == ["quality_events"]


def test_quarantine_action_lets_the_other_rows_pass(spark, tmp_path):
    csv(tmp_path, "id,name,age\n1,a,10\n2,,20\n3,c,300\n", "a.csv")
    checks = {
        "rule_id": "people",
        "rules": {
            "completeness": {"type": "completeness", "columns": ["name"], "severity": "high"},
            "numeric": {"type": "numeric", "rules": [{"column": "age", "max_value": 120}], "severity": "medium"},
        },
        "actions": {"on_failure": {"high": "quarantine", "medium": "alert", "low": "log"}},
    }
    context = layers.RunContext("p", events_path=f"{tmp_path}/events")
    (outcome,) = layers.run_bronze(spark, {"source_configurations": [bronze_item(str(tmp_path), quality=checks)]}, context)
    assert outcome.status == "written" and len(outcome.failed_rules) == 2
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/bronze").collect()) == [1, 3]
    kept = spark.read.parquet(f"{tmp_path}/bronze_quarantine/failed").collect()
    assert [(r["id"], r["reasons"]) for r in kept] == [(2, ["people.completeness:name"])]
    assert spark.read.json(f"{tmp_path}/events").count() == 3


def test_one_failing_source_does_not_stop_the_others(spark, tmp_path):
    csv(tmp_path, "id,name,age\n1,a,10\n", "a.csv")
    good = bronze_item(str(tmp_path))
    with pytest.raises(layers.LayerFailed) as failure:
        layers.run_bronze(spark, {"source_configurations": [{**good, "name": "gone", "format": "xml"}, good]})
    assert [o.status for o in failure.value.outcomes] == ["failed", "written"]


def test_unknown_layer(spark):
    with pytest.raises(SpecError):
        layers.process_table(spark, "copper.x", "select 1", "/nowhere")


def test_folded_metrics_equal_the_joined_form(spark, rows):
    """Fold before the join, against the plain join and group, with a hot and an idle customer."""
    customers = spark.createDataFrame([(i, f"c{i % 3}") for i in range(30)], "customer_id long, country string")
    transactions = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 7, id % 29) as customer_id",
        "date_add(date'2024-01-01', int(id * 7 % 300)) as transaction_date",
        "case id % 4 when 0 then 'CREDIT' when 1 then 'TRANSFER' else 'DEBIT' end as type",
        "cast((id * 37 % 100000) / 7 as decimal(18,2)) as amount",
    )
    def spent(kind):
        return {"expression": f"sum(if(payments.type = '{kind}', payments.amount, 0))", "type": "decimal(18,2)"}

    before = "over (partition by clients.customer_id order by month)"
    change = [
        {"name": "spend_change", "expression": f"spend - lag(spend) {before}", "type": "decimal(18,2)"},
        {"name": "count_change", "expression": f"payment_count - lag(payment_count) {before}", "type": "integer"},
    ]
    months = {
        "name": "client_months",
        "group_by": ["clients.customer_id", "clients.country", "trunc(payments.transaction_date, 'MM') as month"],
        "metrics": [
            {"name": "spend", **spent("DEBIT")},
            {"name": "income", **spent("CREDIT")},
            {"name": "payment_count", "expression": "count(1)", "type": "integer"},
        ],
        "windows": [
            {
                "name": "year",
                "partition_by": ["clients.customer_id"],
                "order_by": "month",
                "frame": "rows between 11 preceding and current row",
                "metrics": change,
            }
        ],
    }
    classes = {
        "name": "client_classes",
        "dependencies": ["client_months"],
        "type": "view",
        "expression": """
            select customer_id, month, case when s > 10000 and n > 20 then 'PREMIUM' when s > 5000 and n > 10 then 'GOLD' else 'STANDARD' end as class
            from (select *, mean(spend) over w as s, mean(payment_count) over w as n from client_months
                  window w as (partition by customer_id order by month rows between 5 preceding and current row))""",
    }
    joins = [{"type": "left", "tables": ["clients", "payments"], "condition": "payments.customer_id = clients.customer_id"}]
    spec = {"source_tables": [{"name": "clients"}, {"name": "payments"}], "joins": joins, "aggregations": [months, classes]}
    views = gold_spec.build_views(spec, {"clients": customers, "payments": transactions})
    columns = ["customer_id", "country", "month", "total_spend", "total_income", "transaction_count", "spend_growth", "transaction_growth"]
    folded = gold_spec.customer_monthly_metrics(customers, transactions)
    joined = ["customer_id", "country", "month", "spend", "income", "payment_count", "spend_change", "count_change"]
    assert rows(folded.select(*columns)) == rows(views["client_months"].select(*joined))
    assert rows(folded.select("customer_id", "month", "segment")) == rows(views["client_classes"])


def test_window_without_over_uses_the_declared_frame(spark, rows):
    df = spark.createDataFrame([(1, i, i) for i in range(1, 6)], "k int, m int, x int")
    window = {
        "partition_by": ["t.k"],
        "order_by": "m",
        "frame": "rows between 2 preceding and current row",
        "metrics": [{"name": "s", "expression": "sum(t.x)", "type": "int"}],
    }
    assert [r["s"] for r in gold_spec.window_metrics(df, window, ["t"]).orderBy("m").collect()] == [1, 3, 6, 9, 12]


def test_view_dependencies_are_checked(spark):
    spec = {"source_tables": [], "aggregations": [{"name": "v", "dependencies": ["u"], "expression": "select 1"}]}
    with pytest.raises(SpecError):
        gold_spec.build_views(spec, {})


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(d,) for d in (5, 10, 11, 599, 600, 601)], "d int")
    counts = {r["le"]: r["bucket_count"] for r in duration_histogram(df, "d").collect()}
    assert counts == {"10": 2, "30": 3, "60": 3, "120": 3, "300": 3, "600": 5, "+Inf": 6}
    assert DURATION_BUCKETS[-1] == 600


def make_events(spark):
    data = [
        ("pipeline_start", "p", "t", "bronze", "2024", {"a": "1"}, "INFO"),
        ("quality_check_failure", "p", "t", "silver", "2024", {}, "ERROR"),
        ("data_anomaly", "p", "t", "gold", "2024", None, "CRITICAL"),
        ("threshold_breach", "p", "t", "gold", "2024", {}, None),
    ]
    return spark.createDataFrame(data, ev.EVENT_SCHEMA)


def test_event_topics_and_round_trip(spark):
    messages = ev.as_messages(make_events(spark))
    assert sorted(r["topic"] for r in messages.collect()) == ["pipeline_alerts", "pipeline_alerts", "pipeline_events", "quality_events"]
    back = ev.from_messages(messages.union(messages.limit(1).withColumn("value", F.lit("not json"))))
    assert back.count() == 4
    assert back.filter(ev.needs_notification(F.col("severity"))).count() == 2
    assert back.filter("event_type = 'threshold_breach'").first()["severity"] == "INFO"


def test_breach_conditions(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("b", 0, 0.89), ("c", 0, 0.9), ("d", None, None)], "pipeline_id string, error_count int, quality_score double"
    )
    assert sorted(r["pipeline_id"] for r in ev.breach_events(df).collect()) == ["a", "b"]


def test_restarted_stream_adds_nothing(spark):
    root = scratch_path(spark, "stream")
    ev.publish(make_events(spark), f"{root}/topics")
    for _ in range(3):
        alerts = flows.parsed_messages(flows.topic_stream(spark, "pipeline_alerts", folder=f"{root}/topics"))
        flows.handle_alerts(alerts, f"{root}/cp", f"{root}/store", f"{root}/notify")
    assert spark.read.parquet(f"{root}/store").count() == 2
    assert [r["severity"] for r in spark.read.parquet(f"{root}/notify").collect()] == ["CRITICAL"]
    ev.publish(make_events(spark), f"{root}/topics")
    alerts = flows.parsed_messages(flows.topic_stream(spark, "pipeline_alerts", folder=f"{root}/topics"))
    flows.handle_alerts(alerts, f"{root}/cp", f"{root}/store", f"{root}/notify")
    assert spark.read.parquet(f"{root}/store").count() == 4


def test_arriving_files_by_suffix(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    csv(landing, "id\n1\n2\n", "a.csv")
    csv(landing, "id\n9\n", "b.txt")
    out = f"{tmp_path}/bronze"
    for _ in range(2):
        flows.ingest_files(spark, str(landing), "csv", "id int", out, f"{tmp_path}/cp", pattern="*.csv")
    stored = spark.read.parquet(out)
    assert sorted(r["id"] for r in stored.collect()) == [1, 2]
    assert {r["file_name"] for r in stored.collect()} == {"a.csv"} and stored.first()["file_size"] == 7


def test_topic_stream_needs_a_place(spark):
    with pytest.raises(SpecError):
        flows.topic_stream(spark, "t")


def test_address_and_contact_steps(spark, rows):
    people = spark.createDataFrame(
        [(1, "1 Oak", "Rome", "NY", "13440", "US", "a@ok.org", "+1 555"), (2, "9 Elm", "Rome", "CA", "900", "US", "b@no.org", None)],
        "id int, address string, city string, state string, zip string, country string, email string, phone string",
    )
    places = spark.createDataFrame(
        [("1 Oak", "Rome", "NY", "US"), ("2 Oak", "Rome", "NY", "US")], "address string, city string, state string, country string"
    )
    domains = spark.createDataFrame([("ok.org",)], "domain string")
    steps_ = [
        {
            "type": "standardize_address",
            "config": {
                "address_column": "address", "city_column": "city", "state_column": "state", "zip_column": "zip",
                "country_column": "country", "reference_data": "places",
                "operations": ["validate_city_state", "standardize_zip", "validate_address"],
            },
        },
        {
            "type": "validate_contact",
            "config": {
                "email_column": "email", "phone_column": "phone",
                "operations": ["validate_email_format", "validate_email_domain", "standardize_phone"],
            },
        },
    ]
    out = layers.silver_transform(people, steps_, {"places": places, "email_domains": domains})
    picked = out.select("id", "zip", "city_state_valid", "address_valid", "email_valid", "email_domain_valid", "phone")
    assert rows(picked) == [(1, "13440", True, True, True, True, "+1555"), (2, "00900", False, False, True, False, None)]


def test_output_topic_follows_the_config(spark):
    from sediment.config import PipelineConfig

    body = dict(pipeline_name="p", landing_location="i", target_location="o", input_format="csv")
    messages = spark.createDataFrame([("k", "v", "t")], "key string, value string, topic string")
    routed = flows.to_output_topic(messages, PipelineConfig(**body, kafka_output_topic="out"))
    assert [tuple(r) for r in routed.collect()] == [("k", "v", "out")]
    with pytest.raises(SpecError):
        flows.to_output_topic(messages, PipelineConfig(**body))


def test_kafka_source_gets_its_options():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **more):
            self.seen.update(more)
            return self

        def load(self):
            return self

        def select(self, *columns):
            return self.seen

    class Session:
        readStream = Reader()

    seen = flows.topic_stream(Session(), "in", servers="h:1", starting_offsets="earliest", failOnDataLoss="false")
    assert seen == {
        "format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "in", "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
    with pytest.raises(SpecError):
        flows.topic_stream(Session(), "in")


def test_a_repeated_stream_batch_quarantines_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    csv(landing, "id,name,age\n1,a,10\n2,b,x\n", "a.csv")
    item = {**bronze_item(str(landing)), "bronze_zone": {"path": f"{tmp_path}/bronze"}}
    for run in range(2):
        flows.ingest_layer(spark, item, str(tmp_path / f"checkpoint{run}"))
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 1
    assert spark.read.parquet(f"{tmp_path}/bronze_quarantine/malformed").count() == 1
