"""Events, alerts and streaming flows over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import AnomalyConfig
from sediment.operators import events as ev
from sediment.plans.queries.registry import query, rounded, table
from sediment.session import scratch_path
from sediment.sources.writers import quarantine_path
from sediment.streaming import detectors, flows

KIND = """case event_type when 'error' then 'pipeline_error' when 'view' then 'quality_check_failure'
  when 'click' then 'data_anomaly' when 'signup' then 'threshold_breach' else 'pipeline_complete' end"""
SEVERITY = "case when event_type = 'error' then 'CRITICAL' when event_type = 'click' and value > 20 then 'ERROR' else 'INFO' end"
TOPIC = """case event_type when 'view' then 'quality_events' when 'click' then 'pipeline_alerts'
  when 'signup' then 'pipeline_alerts' else 'pipeline_events' end"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.expr(KIND).alias("event_type"),
        F.col("user_id").cast("string").alias("pipeline_id"),
        F.concat(F.lit("t"), "event_id").alias("table_name"),
        F.lit("silver").alias("layer"),
        F.lit("2024-02-01T00:00:00").alias("timestamp"),
        F.create_map(F.lit("value"), F.col("value").cast("string")).alias("details"),
        F.expr(SEVERITY).alias("severity"),
    )


@query(
    "event_route",
    f"select 't' || event_id as table_name, {TOPIC} as topic, cast(user_id as varchar) as key, {KIND} as event_type from events",
)
def event_route(spark: SparkSession, d: str) -> DataFrame:
    messages = ev.as_messages(_events(spark, d))
    return messages.select(
        F.get_json_object("value", "$.table_name").alias("table_name"),
        "topic",
        "key",
        F.get_json_object("value", "$.event_type").alias("event_type"),
    )


@query(
    "event_publish_files",
    f"select {TOPIC} as topic, count(*) as messages from events group by 1",
)
def event_publish_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "topics")
    ev.publish(_events(spark, d), path)
    stored = spark.read.schema("key string, value string, topic string").json(path)
    return stored.groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "alert_filter",
    f"select 't' || event_id as table_name, {SEVERITY} as severity from events where {SEVERITY} in ('ERROR', 'CRITICAL')",
)
def alert_filter(spark: SparkSession, d: str) -> DataFrame:
    parsed = ev.from_messages(ev.as_messages(_events(spark, d)))
    return parsed.filter(ev.needs_notification(F.col("severity"))).select("table_name", "severity")


METRICS_SQL = """select user_id as pipeline_id, count(*) filter (where event_type = 'error' and value > 150) as error_count,
  count(*) filter (where value < 60)::double / count(*) as quality_score from events group by 1"""


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "events")
        .groupBy(F.col("user_id").alias("pipeline_id"))
        .agg(
            F.count_if(F.expr("event_type = 'error' and value > 150")).alias("error_count"),
            (F.count_if(F.col("value") < 60).cast("double") / F.count("*")).alias("quality_score"),
        )
    )


@query(
    "threshold_breach",
    f"""select cast(pipeline_id as varchar) as pipeline_id, 'threshold_breach' as event_type, 'ERROR' as severity,
              error_count from ({METRICS_SQL}) where error_count > 0 or quality_score < 0.9""",
)
def threshold_breach(spark: SparkSession, d: str) -> DataFrame:
    found = ev.breach_events(_metrics(spark, d), F.lit("2024-02-01T00:00:00"))
    return found.select(
        "pipeline_id", "event_type", "severity", F.col("details")["error_count"].cast("bigint").alias("error_count")
    )


@query(
    "notification_text",
    """select event_id, ':warning: Quality Check Alert' || chr(10) || 'Layer: bronze' || chr(10) || 'Check Type: ' || event_type
         || chr(10) || 'Score: ' || user_id || chr(10) || 'Threshold: 90' as message, null as subject
       from events where event_type = 'error'
       union all
       select event_id, 'Pipeline execution completed successfully.' || chr(10) || 'Workflow: w' || user_id || chr(10) || 'Duration: '
         || chr(10) || 'Start Time: ' || event_type || chr(10) || 'End Time: ' || chr(10) || chr(10) || 'Metrics:' || chr(10)
         || '- Records Processed: ' || event_id || chr(10) || '- Quality Score: 1', 'Data Pipeline Execution Success'
       from events where event_type = 'purchase'
       union all
       select event_id, 'Pipeline execution failed.' || chr(10) || 'Workflow: ' || user_id || chr(10) || 'Node: n' || chr(10)
         || 'Error: view' || chr(10) || chr(10) || 'Please check the logs for more details.', 'Data Pipeline Execution Failure'
       from events where event_type = 'view'""",
)
def notification_text(spark: SparkSession, d: str) -> DataFrame:
    fields = {
        "error": (
            "quality-alert",
            dict(layer=F.lit("bronze"), check_type=F.col("event_type"), score=F.col("user_id"), threshold=F.lit(90)),
        ),
        "purchase": (
            "pipeline-success",
            dict(
                workflow=F.concat(F.lit("w"), "user_id"),
                duration=F.lit(None),
                start_time=F.col("event_type"),
                end_time=F.lit(None),
                records_processed=F.col("event_id"),
                quality_score=F.lit(1),
            ),
        ),
        "view": ("pipeline-failure", dict(workflow=F.col("user_id"), node=F.lit("n"), error=F.col("event_type"))),
    }
    message, subject = F.lit(None), F.lit(None)
    for kind, (template, columns) in fields.items():
        chosen = F.col("event_type") == kind
        message = F.when(chosen, ev.notification_text(template, **columns)).otherwise(message)
        subject = F.when(chosen, F.lit(ev.notification_subject(template))).otherwise(subject)
    events = table(spark, d, "events").filter(F.col("event_type").isin(*fields))
    return events.select("event_id", message.alias("message"), subject.alias("subject"))


def _topic_folder(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "topics")
    ev.publish(_events(spark, d), path)
    return path


@query(
    "stream_alerts",
    f"""select 't' || event_id as table_name, {SEVERITY} as severity, ':x: Processing Error' || chr(10) || 'Task: t' || event_id
         || chr(10) || 'Error: ' || {KIND} || chr(10) || 'Impact: ' || {SEVERITY} as message
        from events where {TOPIC} = 'pipeline_alerts' and {SEVERITY} in ('ERROR', 'CRITICAL')""",
)
def stream_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Alert topic to store and notifications; the second run of the same checkpoint adds nothing."""
    folder, root = _topic_folder(spark, d), scratch_path(spark, "alerts")
    for _ in range(2):
        alerts = flows.parsed_messages(flows.topic_stream(spark, "pipeline_alerts", folder=folder))
        flows.handle_alerts(alerts, f"{root}/checkpoint", f"{root}/store", f"{root}/notify")
    return spark.read.parquet(f"{root}/notify").select("table_name", "severity", "message")


@query(
    "stream_alert_store",
    f"select {KIND} as event_type, count(*) as stored from events where {TOPIC} = 'pipeline_alerts' group by 1",
)
def stream_alert_store(spark: SparkSession, d: str) -> DataFrame:
    folder, root = _topic_folder(spark, d), scratch_path(spark, "alerts")
    alerts = flows.parsed_messages(flows.topic_stream(spark, "pipeline_alerts", folder=folder))
    flows.handle_alerts(alerts, f"{root}/checkpoint", f"{root}/store", f"{root}/notify")
    return spark.read.parquet(f"{root}/store").groupBy("event_type").agg(F.count("*").alias("stored"))


@query(
    "stream_file_arrival",
    """select event_id, case when event_type = 'error' then 'malformed' when value > 90 then 'failed' else 'stored' end as outcome
       from events""",
)
def stream_file_arrival(spark: SparkSession, d: str) -> DataFrame:
    """Files that arrive are taken through the bronze steps once each, whatever the number of runs."""
    root = scratch_path(spark, "arrival")
    value = "if(event_type = 'error', 'none', string(value)) as value"
    rows = table(spark, d, "events").selectExpr("event_id", "event_type", value)
    item = {
        "name": "events",
        "format": "csv",
        "landing_zone": {"path": f"{root}/landing", "file_pattern": "*.csv"},
        "schema_validation": {"schema": "event_id long, event_type string, value double", "mode": "strict"},
        "quality": {
            "rule_id": "events",
            "rules": {"limit": {"type": "numeric", "rules": [{"column": "value", "max_value": 90}], "severity": "high"}},
            "actions": {"on_failure": {"high": "quarantine"}},
        },
        "bronze_zone": {"path": f"{root}/bronze"},
    }
    for part in ("event_type < 'm'", "event_type >= 'm'", "false"):
        flows.stage_table(rows.filter(part), f"{root}/landing", "csv", {"header": "true"})
        flows.ingest_layer(spark, item, f"{root}/checkpoint")
    stored = spark.read.parquet(f"{root}/bronze").select("event_id", F.lit("stored").alias("outcome"))
    failed = spark.read.parquet(quarantine_path(f"{root}/bronze", "failed")).select("event_id", F.lit("failed").alias("outcome"))
    lines = spark.read.parquet(quarantine_path(f"{root}/bronze", "malformed"))
    number = F.split("raw_record", ",")[0].cast("long").alias("event_id")
    return stored.unionByName(failed).unionByName(lines.select(number, F.lit("malformed").alias("outcome")))


@query(
    "stream_arrival_events",
    "select 'landing/' || event_id as path from events where event_type = 'signup'",
)
def stream_arrival_events(spark: SparkSession, d: str) -> DataFrame:
    """Announcements of new data, told apart from other messages of the topic."""
    root = scratch_path(spark, "announcements")
    messages = table(spark, d, "events").select(
        F.to_json(
            F.struct(
                F.when(F.col("event_type") == "signup", "DATA_ARRIVAL").otherwise("OTHER").alias("eventType"),
                F.concat(F.lit("landing/"), "event_id").alias("path"),
            )
        ).alias("value")
    )
    messages.write.text(f"{root}/topic=data-landing-events")
    stream = flows.topic_stream(spark, "data-landing-events", folder=root)
    arrivals = flows.arrivals_only(stream, "eventType string, path string")
    flows.run_available(arrivals, f"{root}/checkpoint", flows.batch_directory(f"{root}/found"))
    return spark.read.parquet(f"{root}/found").select("path")


@query("stream_route", f"select {TOPIC} as topic, count(*) as messages from events group by 1")
def stream_route(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "routed")
    flows.stage_table(_events(spark, d), f"{root}/in", "parquet")
    for _ in range(2):
        stream = spark.readStream.schema(ev.EVENT_SCHEMA).parquet(f"{root}/in")
        flows.route_events(stream, f"{root}/checkpoint", f"{root}/out")
    stored = spark.read.schema("key string, value string, topic string").json(f"{root}/out")
    return stored.groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "stream_breach",
    f"""select cast(pipeline_id as varchar) as pipeline_id, 'ERROR' as severity from ({METRICS_SQL})
        where error_count > 0 or quality_score < 0.9""",
)
def stream_breach(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "metrics")
    flows.stage_table(_metrics(spark, d), f"{root}/in", "parquet")
    stream = spark.readStream.schema("pipeline_id long, error_count long, quality_score double").parquet(f"{root}/in")
    flows.run_available(flows.breach_stream(stream), f"{root}/checkpoint", flows.batch_directory(f"{root}/out"))
    return spark.read.parquet(f"{root}/out").select("pipeline_id", "severity")


@query(
    "stream_period_metrics",
    """select period_start, round(sum(value), 6) as sum_value, count(*) as sample_count
       from (select time_bucket(interval 300 second, ts) as period_start, value from events)
       group by 1 having period_start + interval 300 second <= (select max(ts) from events) - interval 10 minute""",
)
def stream_period_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Periods that the watermark has closed by the end of the stream."""
    root = scratch_path(spark, "periods")
    flows.stage_table(table(spark, d, "events").selectExpr("cast(ts as timestamp) as ts", "value"), f"{root}/in", "parquet")
    stream = spark.readStream.schema("ts timestamp, value double").parquet(f"{root}/in")
    closed = flows.windowed_metrics(stream, "ts", "value")
    query_run = (
        closed.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{root}/checkpoint")
        .format("parquet")
        .start(f"{root}/out")
    )
    query_run.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return rounded(
        out.select(F.col("period_start").cast("timestamp_ntz").alias("period_start"), "sum_value", "sample_count"), ["sum_value"]
    )


DAILY_SQL = """
with d as (select {group} cast(ts as date) as day, count(*) as volume from events where ts < (select max(ts)::date from events) group by all),
r as (select *, avg(volume) over w as a, stddev_samp(volume) over w as s from d window w as ({part} order by day rows between 5 preceding and current row))
select {group} cast(day as varchar) as day, volume::double as volume, round(a, 6) as avg_volume, round(s, 6) as stddev_volume,
       round(case when s > 0 then (volume - a) / s end, 6) as volume_zscore,
       coalesce(round(abs(case when s > 0 then (volume - a) / s end), 9) > 1.6, false) as is_volume_anomaly from r"""


def _daily_volume(spark: SparkSession, d: str, group_by: tuple[str, ...]) -> DataFrame:
    """Three files, in two runs of one checkpoint; the watermark of an hour closes all days but the last."""
    root = scratch_path(spark, "daily")
    rows = table(spark, d, "events").selectExpr("cast(ts as timestamp) as ts", "event_type")
    config = AnomalyConfig(lookback_window=5, threshold=1.6)
    for part in ("day(ts) < 9", "day(ts) between 9 and 20", "day(ts) > 20"):
        flows.stage_table(rows.filter(part).orderBy("ts").coalesce(1), f"{root}/in", "parquet")
        if part == "day(ts) < 9":
            continue
        stream = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
        found = detectors.volume_stream(stream, config, "ts", group_by, "1 hour")
        run = found.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").format("parquet").start(f"{root}/out")
        run.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    last = table(spark, d, "events").agg(F.max(F.col("ts").cast("date"))).scalar()
    shown = ["volume", "avg_volume", "stddev_volume", "volume_zscore"]
    return rounded(
        out.filter(F.col("_day") < last).select(*group_by, F.col("_day").cast("string").alias("day"), *shown, "is_volume_anomaly"), shown
    )


@query("stream_daily_volume", DAILY_SQL.format(group="", part=""))
def stream_daily_volume(spark: SparkSession, d: str) -> DataFrame:
    return _daily_volume(spark, d, ())


@query("stream_daily_volume_by_type", DAILY_SQL.format(group="event_type,", part="partition by event_type"))
def stream_daily_volume_by_type(spark: SparkSession, d: str) -> DataFrame:
    return _daily_volume(spark, d, ("event_type",))


@query("stream_first_copies", "select event_id, value from events")
def stream_first_copies(spark: SparkSession, d: str) -> DataFrame:
    """Every event arrives twice, in batches of their own; copies are stored once."""
    root = scratch_path(spark, "copies")
    rows = table(spark, d, "events").selectExpr("event_id", "value")
    item = {
        "name": "events",
        "format": "json",
        "landing_zone": {"path": f"{root}/landing", "file_pattern": "*.json"},
        "schema_validation": {"schema": "event_id long, value double", "mode": "strict"},
        "bronze_zone": {"path": f"{root}/bronze"},
    }
    for part in ("event_id % 3 > 0", "event_id % 3 < 2", "true"):
        flows.stage_table(rows.filter(part), f"{root}/landing", "json")
        flows.ingest_layer(spark, item, f"{root}/checkpoint", duplicates_within="7 days")
    return spark.read.parquet(f"{root}/bronze").select("event_id", "value")


def _topic_runs(spark: SparkSession, d: str, start: str, runs: int) -> DataFrame:
    """Messages of a topic of two partitions, laid down in two parts; a run of one checkpoint after each part."""
    root = scratch_path(spark, "offsets")
    numbered = table(spark, d, "events").selectExpr("event_id", "pmod(event_id, 2) as partition", "event_type")
    for part in range(2):
        half = numbered.filter(F.pmod(F.col("event_id"), F.lit(4)) >= 2 if part else F.pmod(F.col("event_id"), F.lit(4)) < 2)
        # By folder first, as the writer would sort by it alone and drop an order that does not begin with it.
        rows = half.repartitionByRange(4, "event_id").sortWithinPartitions("partition", "event_id")
        lines = rows.select("partition", F.format_string("%010d", F.col("event_id")).alias("value"))
        lines.write.partitionBy("partition").text(f"{root}/part{part}")
        for number in range(2):
            _move_files(spark, f"{root}/part{part}/partition={number}", f"{root}/topic=t/partition={number}", f"{part}-")
        if part >= 2 - runs:
            stream = flows.topic_stream(spark, "t", folder=root, starting_offsets=start)
            flows.run_available(stream, f"{root}/checkpoint", flows.batch_directory(f"{root}/out"))
    return spark.read.parquet(f"{root}/out").select(F.col("value").cast("long").alias("event_id"), "partition", "offset")


def _move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Files of a folder into a topic's folder, under names that come after those already there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    for status in fs.listStatus(path(source)):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            fs.rename(status.getPath(), path(f"{target}/{prefix}{name}"))


OFFSETS_SQL = """
with h as (select event_id, event_id % 2 as partition, case when event_id % 4 < 2 then 0 else 1 end as half from events),
o as (select event_id, partition::int as partition, half, row_number() over (partition by partition order by half, event_id) - 1 as "offset" from h)
select event_id, partition, "offset" from o where {where}"""


@query("topic_earliest", OFFSETS_SQL.format(where="true"))
def topic_earliest(spark: SparkSession, d: str) -> DataFrame:
    """From the beginning, and on from there in a second run."""
    return _topic_runs(spark, d, "earliest", 2)


@query("topic_latest", OFFSETS_SQL.format(where="half = 1"))
def topic_latest(spark: SparkSession, d: str) -> DataFrame:
    """A first run from the end finds nothing; the second has what came since."""
    return _topic_runs(spark, d, "latest", 2)


@query("topic_from_offsets", OFFSETS_SQL.format(where="""(partition = 0 and "offset" >= 25) or (partition = 1 and "offset" >= 40)"""))
def topic_from_offsets(spark: SparkSession, d: str) -> DataFrame:
    return _topic_runs(spark, d, '{"0": 25, "1": 40}', 1)
