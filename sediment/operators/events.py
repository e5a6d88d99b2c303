"""Pipeline events as rows: shape, topic routing, breaches and notification text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Shape, kinds, topics and severities of events.
EVENT_SCHEMA = (
    "event_type string, pipeline_id string, table_name string, layer string, "
    "timestamp string, details map<string,string>, severity string"
)
QUALITY_EVENTS = ("quality_check_start", "quality_check_complete", "quality_check_failure")
ALERT_EVENTS = ("data_anomaly", "threshold_breach")
TOPICS = {"pipeline": "pipeline_events", "quality": "quality_events", "alert": "pipeline_alerts"}
NOTIFY_SEVERITIES = ("ERROR", "CRITICAL")
QUALITY_SCORE_LIMIT = 0.9
ARRIVAL_EVENT = "DATA_ARRIVAL"


def topic_of(event_type: Column, topics: Mapping[str, str] = TOPICS) -> Column:
    return (
        F.when(event_type.isin(*QUALITY_EVENTS), topics["quality"])
        .when(event_type.isin(*ALERT_EVENTS), topics["alert"])
        .otherwise(topics["pipeline"])
    )


def as_messages(events: DataFrame, topics: Mapping[str, str] = TOPICS) -> DataFrame:
    """``topic``, ``key`` (the pipeline) and JSON ``value``, the shape of a topic sink."""
    fields = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
    return events.select(
        topic_of(F.col("event_type"), topics).alias("topic"),
        F.col("pipeline_id").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def from_messages(messages: DataFrame) -> DataFrame:
    """Parse JSON messages. Text that is no event gives a row of NULLs, which is dropped."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("e")).select("e.*")
    return parsed.filter(F.col("event_type").isNotNull()).withColumn("severity", F.coalesce("severity", F.lit("INFO")))


def publish(events: DataFrame, path: str | None = None, topics: Mapping[str, str] = TOPICS, **kafka: str) -> None:
    """To Kafka, with the topic taken from each row, or to files in one directory per topic."""
    messages = as_messages(events, topics)
    if path:
        messages.write.mode("append").partitionBy("topic").json(path)
    else:
        messages.write.format("kafka").options(**kafka).save()


def needs_notification(severity: Column) -> Column:
    return severity.isin(*NOTIFY_SEVERITIES)


def breached(error_count: Column, quality_score: Column) -> Column:
    """Any error, or a quality score below the limit; absent metrics count as fine."""
    return (F.coalesce(error_count, F.lit(0)) > 0) | (
        F.coalesce(quality_score, F.lit(1.0)) < F.lit(QUALITY_SCORE_LIMIT)
    )


def breach_events(metrics: DataFrame, at: Column | None = None) -> DataFrame:
    """An ERROR event per metrics row that breaches; the row's columns become the details."""
    optional = lambda name: F.col(name) if name in metrics.columns else F.lit("")
    pairs = [part for c in metrics.columns for part in (F.lit(c), F.col(c).cast("string"))]
    found = metrics.filter(breached(F.col("error_count"), F.col("quality_score")))
    return found.select(
        F.lit("threshold_breach").alias("event_type"),
        F.col("pipeline_id").cast("string").alias("pipeline_id"),
        optional("table_name").alias("table_name"),
        optional("layer").alias("layer"),
        (F.current_timestamp() if at is None else at).cast("string").alias("timestamp"),
        F.create_map(*pairs).alias("details"),
        F.lit("ERROR").alias("severity"),
    )


def event_rows(spark: SparkSession, rows: Sequence[Mapping]) -> DataFrame:
    """Events that the driver itself raises: a few per layer run."""
    names = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], EVENT_SCHEMA)


def quality_events(results: DataFrame, pipeline_id: str, layer: str, at: Column | None = None) -> DataFrame:
    """One event per evaluated rule: complete, or failure with the rule as its detail."""
    stamp = (F.current_timestamp() if at is None else at).cast("string")
    return results.select(
        F.when(F.col("passed"), "quality_check_complete").otherwise("quality_check_failure").alias("event_type"),
        F.lit(pipeline_id).alias("pipeline_id"),
        "table_name",
        F.lit(layer).alias("layer"),
        stamp.alias("timestamp"),
        F.create_map(F.lit("rule_id"), F.col("rule_id"), F.lit("rule_type"), F.col("rule_type")).alias("details"),
        F.when(F.col("passed"), "INFO").when(F.col("severity") == "high", "ERROR").otherwise("WARN").alias("severity"),
    )


# Notification texts and subjects.
TEMPLATES = {
    "pipeline-success": (
        "Pipeline execution completed successfully.\nWorkflow: %s\nDuration: %s\nStart Time: %s\nEnd Time: %s\n\n"
        "Metrics:\n- Records Processed: %s\n- Quality Score: %s",
        ("workflow", "duration", "start_time", "end_time", "records_processed", "quality_score"),
    ),
    "pipeline-failure": (
        "Pipeline execution failed.\nWorkflow: %s\nNode: %s\nError: %s\n\nPlease check the logs for more details.",
        ("workflow", "node", "error"),
    ),
    "quality-alert": (
        ":warning: Quality Check Alert\nLayer: %s\nCheck Type: %s\nScore: %s\nThreshold: %s",
        ("layer", "check_type", "score", "threshold"),
    ),
    "processing-alert": (":x: Processing Error\nTask: %s\nError: %s\nImpact: %s", ("task", "error", "impact")),
}


SUBJECTS = {
    "pipeline-success": "Data Pipeline Execution Success",
    "pipeline-failure": "Data Pipeline Execution Failure",
}


def notification_subject(template: str) -> str | None:
    """Subject of a mail; messages to a channel have none."""
    return SUBJECTS.get(template)


def notification_text(template: str, **fields: Column) -> Column:
    text, names = TEMPLATES[template]
    return F.format_string(text, *[F.coalesce(fields[n].cast("string"), F.lit("")) for n in names])
