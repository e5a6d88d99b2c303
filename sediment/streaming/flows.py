"""Streams of files and topics. Every sink is keyed by batch id or a file log, so a run that
is repeated from its checkpoint adds nothing twice."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sediment.config import InputFormat, PipelineConfig, SpecError
from sediment.functions.protect import protect_columns
from sediment.operators import events
from sediment.plans import layers
from sediment.plans.layers import RunContext
from sediment.session import materialize
from sediment.sources import readers, writers
from sediment.sources.readers import FILE_FACTS, as_schema
from sediment.streaming import topics


def arriving_files(
    spark: SparkSession,
    path: str,
    fmt: InputFormat | str,
    schema: T.StructType | str,
    pattern: str | None = None,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of a folder, each read once, with the facts of the file on every row."""
    fmt = InputFormat(fmt)
    reader = spark.readStream.format(fmt.value).schema(schema).options(**options)
    if fmt is InputFormat.CSV:
        reader = reader.option("header", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    facts = [F.expr(source).alias(name) for name, source in FILE_FACTS.items()]
    return reader.load(path).select("*", *facts)


def topic_stream(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    starting_offsets: str | None = None,
    **options: str,
) -> DataFrame:
    """JSON messages of a topic as ``value``: from Kafka, or from the topic's folder of files.

    ``starting_offsets`` counts for the first run of a checkpoint; a later one resumes. Kafka starts at the ``latest``
    without it. A folder without it is a plain stream of text files, which has no offsets and reads all there
    is; with ``earliest``, ``latest`` or offsets as JSON it is read by :mod:`sediment.streaming.topics`."""
    if folder and starting_offsets is None:
        return spark.readStream.format("text").load(f"{folder}/topic={topic}").select("value")
    if folder:
        return topics.read_stream(spark, f"{folder}/topic={topic}", starting_offsets, **options)
    if not servers:
        raise SpecError("a topic stream needs servers or a folder")
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return source.option("startingOffsets", starting_offsets or "latest").options(**options).load().select("value")


def input_stream(spark: SparkSession, config: PipelineConfig, **where: str) -> DataFrame:
    """The pipeline's input topic."""
    if not config.kafka_input_topic:
        raise SpecError(f"{config.pipeline_name} names no input topic")
    return topic_stream(spark, config.kafka_input_topic, **where)


def parsed_messages(messages: DataFrame) -> DataFrame:
    """Messages from a topic folder hold key and value; those from Kafka the value alone."""
    inner = F.get_json_object("value", "$.value")
    return events.from_messages(messages.select(F.coalesce(inner, F.col("value").cast("string")).alias("value")))


def arrivals_only(messages: DataFrame, schema: str) -> DataFrame:
    """Announcements of new data among the messages of a topic."""
    body = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")
    return body.filter(F.col("eventType") == events.ARRIVAL_EVENT)


def run_available(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Handle what has arrived, then stop. ``sink`` must be repeatable per batch id."""
    query = (
        df.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query


def batch_directory(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that overwrites the directory of its batch id."""
    return lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def ingest_files(
    spark: SparkSession,
    landing: str,
    fmt: InputFormat | str,
    schema: T.StructType | str,
    bronze: str,
    checkpoint: str,
    pattern: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Arriving files to bronze, with the source file and the ingestion time on each row."""
    arriving = arriving_files(spark, landing, fmt, schema, pattern, max_files_per_trigger)
    rows = arriving.withColumnRenamed("file_path", "source_file").withColumn(
        "ingestion_timestamp", F.current_timestamp() if as_of is None else as_of
    )
    keep = transform or (lambda df: df)
    write = batch_directory(bronze)
    return run_available(rows, checkpoint, lambda df, batch: write(keep(df), batch))


def ingest_layer(
    spark: SparkSession,
    item: Mapping,
    checkpoint: str,
    context: RunContext = RunContext(),
    max_files_per_trigger: int | None = None,
    duplicates_within: str | None = None,
) -> StreamingQuery:
    """Arriving files of a landing source through the steps of the batch layer: strict parsing, duplicates
    within the batch, field checks, protection and the quality gate.

    With ``duplicates_within`` (an interval such as ``7 days``) a row that has been read before is not taken up
    again, in whatever file and batch it comes: see :func:`first_copies`. Each batch has a folder ``batch=<id>`` in the layer and in every quarantine kind, which a repeated
    batch overwrites. A batch that the gate holds back stops the stream and is tried again."""
    landing, path = item["landing_zone"], item["bronze_zone"]["path"]
    typed = as_schema(item["schema_validation"]["schema"])
    typed = T.StructType.fromDDL(typed) if isinstance(typed, str) else typed
    typed = T.StructType([*typed.fields, T.StructField(readers.CORRUPT, T.StringType())])
    arriving = arriving_files(
        spark,
        landing["path"],
        item["format"],
        typed,
        landing.get("file_pattern"),
        max_files_per_trigger,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=readers.CORRUPT,
    )
    facts = [name for name in FILE_FACTS if name != "file_path"]
    if duplicates_within:
        arriving = first_copies(arriving, typed.fieldNames(), "file_modification_time", duplicates_within)
    arriving = arriving.withColumnRenamed("file_path", "source_file").drop(*facts)

    def sink(df: DataFrame, batch: int) -> None:
        own = replace(context, stream_batch=batch)
        good, bad = readers.split_corrupt(materialize(df, "arrived"))
        sealed = ["raw_record"] if item.get("encrypted_columns") else []
        writers.append_quarantine(protect_columns(bad, sealed), path, "malformed", batch)
        outcome = layers.checked(
            spark,
            layers.bronze_transform(good, item, own),
            item,
            "bronze",
            own,
            {},
            path,
            lambda out, _: out.write.mode("overwrite").parquet(f"{path}/batch={batch}"),
        )
        if outcome.status == "held":
            raise layers.LayerFailed([outcome])

    return run_available(arriving, checkpoint, sink)


def first_copies(stream: DataFrame, columns: Sequence[str], ts: str, within: str) -> DataFrame:
    """Rows of the stream whose values in ``columns`` were not seen before, across batches and restarts.

    State holds a digest per row, for ``within`` after the row's time ``ts`` and no longer: a copy that comes later than
    that is taken up again, and a row whose own time is older than the watermark is dropped by Spark as too
    late. NULLs are equal to NULLs. Columns of the stream are kept as they are."""
    values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
    seen = stream.withColumn("_digest", F.sha2(values, 256)).withWatermark(ts, within)
    return seen.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def handle_alerts(
    alerts: DataFrame, checkpoint: str, store: str, notify: str, template: str = "processing-alert"
) -> StreamingQuery:
    """All alerts are stored; those of ERROR or CRITICAL severity are also turned into
    notification texts."""

    def sink(df: DataFrame, batch: int) -> None:
        df.persist()
        batch_directory(store)(df, batch)
        message = events.notification_text(
            template,
            task=F.col("table_name"),
            error=F.col("event_type"),
            impact=F.col("severity"),
        )
        urgent = df.filter(events.needs_notification(F.col("severity"))).withColumn("message", message)
        batch_directory(notify)(urgent, batch)
        df.unpersist()

    return run_available(alerts, checkpoint, sink)


def route_events(stream: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    """Events to one directory per topic; the file sink's log makes it exactly once."""
    query = (
        events.as_messages(stream)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .partitionBy("topic")
        .format("json")
        .start(path)
    )
    query.awaitTermination()
    return query


def to_output_topic(messages: DataFrame, config: PipelineConfig) -> DataFrame:
    """All messages to the topic that the pipeline names for its output."""
    if not config.kafka_output_topic:
        raise SpecError(f"{config.pipeline_name} names no output topic")
    return messages.withColumn("topic", F.lit(config.kafka_output_topic))


def route_to_kafka(
    stream: DataFrame, checkpoint: str, servers: str, config: PipelineConfig | None = None, **options: str
) -> StreamingQuery:
    """Events to Kafka: to the pipeline's output topic, or without one to the topic of each row."""
    messages = events.as_messages(stream)
    if config is not None and config.kafka_output_topic:
        messages = to_output_topic(messages, config)
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def breach_stream(metrics: DataFrame, at: Column | None = None) -> DataFrame:
    """Stateless: a metrics row in, at most one event out."""
    return events.breach_events(metrics, at)


def windowed_metrics(
    stream: DataFrame,
    ts: str,
    value: str,
    period: str = "300 seconds",
    watermark: str = "10 minutes",
    group_by: tuple[str, ...] = (),
) -> DataFrame:
    """Per-period metrics of a stream; a period is emitted once the watermark has passed it."""
    from sediment.operators.aggregates import period_metrics

    return period_metrics(stream.withWatermark(ts, watermark), ts, value, group_by, period)


def stage_table(df: DataFrame, path: str, fmt: str = "json", options: Mapping[str, str] | None = None) -> None:
    """Lay a frame down as feed files, for replays."""
    df.write.mode("append").format(fmt).options(**(options or {})).save(path)
