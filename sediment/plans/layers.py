"""Landing to bronze, bronze to silver, silver to gold.

A layer run reads, transforms, checks and writes each source of its spec in turn. A source
that fails is recorded and the others still run; the failures are raised together at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import ColumnTransformation, InputFormat, QualityRule, SpecError, load_spec, rules_from_spec
from sediment.functions import lookup, text
from sediment.functions.protect import protect_columns
from sediment.operators import events, quality
from sediment.operators.aggregates import grouped_metrics
from sediment.operators.dedup import drop_exact_duplicates, keep_latest
from sediment.operators.joins import enrich, join_chain, validate_against
from sediment.operators.mapping import (
    FieldMapping,
    MappingContext,
    add_audit_columns,
    apply_transformations,
    clean_column_names,
    split_validated,
)
from sediment.plans.gold_spec import build_gold
from sediment.session import materialize
from sediment.sources import readers, writers
from sediment.sources.merge import VersionedTable, merge_into_delta


@dataclass
class Outcome:
    """What became of one source or table of a layer run."""

    name: str
    layer: str
    status: str
    failed_rules: list[dict[str, Any]] = field(default_factory=list)
    error: str | None = None
    results: DataFrame | None = None

    def as_event(self, pipeline_id: str, at: str) -> dict[str, Any]:
        kinds = {"written": "pipeline_complete", "held": "quality_check_failure", "failed": "pipeline_error"}
        details = {"status": self.status, "failed_rules": ",".join(r["rule_id"] for r in self.failed_rules)}
        if self.error:
            details["error"] = self.error
        return {
            "event_type": kinds[self.status],
            "pipeline_id": pipeline_id,
            "table_name": self.name,
            "layer": self.layer,
            "timestamp": at,
            "details": details,
            "severity": "INFO" if self.status == "written" else "ERROR",
        }


class LayerFailed(RuntimeError):
    def __init__(self, outcomes: Sequence[Outcome]) -> None:
        self.outcomes = list(outcomes)
        super().__init__("; ".join(f"{o.name}: {o.error}" for o in outcomes if o.error))


@dataclass(frozen=True)
class RunContext:
    pipeline_id: str = "pipeline"
    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    as_of: Column | None = None
    results_path: str | None = None
    events_path: str | None = None
    storage_format: str = "parquet"
    stream_batch: int | None = None

    def mapping(self) -> MappingContext:
        return MappingContext(self.batch_id, self.as_of)


def _run_each(
    spark: SparkSession,
    items: Sequence[Mapping[str, Any]],
    layer: str,
    context: RunContext,
    work: Callable[[Mapping[str, Any]], Outcome],
) -> list[Outcome]:
    outcomes = []
    for item in items:
        try:
            outcomes.append(work(item))
        except Exception as problem:  # noqa: BLE001  the other sources still run
            outcomes.append(Outcome(item.get("name", "?"), layer, "failed", error=str(problem)))
    if context.events_path:
        at = datetime.now(timezone.utc).isoformat()
        events.publish(
            events.event_rows(spark, [o.as_event(context.pipeline_id, at) for o in outcomes]), context.events_path
        )
    if any(o.status == "failed" for o in outcomes):
        raise LayerFailed(outcomes)
    return outcomes


@dataclass(frozen=True)
class Measured:
    """What the checks of a table found; NULL where nothing was checked."""

    passed: bool | None = None
    score: float | None = None

    def flag(self) -> Column:
        return F.lit(self.passed).cast("boolean")

    def share(self) -> Column:
        return F.lit(self.score).cast("double")


def checked(
    spark: SparkSession,
    df: DataFrame,
    item: Mapping[str, Any],
    layer: str,
    context: RunContext,
    tables: Mapping[str, DataFrame],
    path: str | None,
    publish: Callable[[DataFrame, Measured], None],
) -> Outcome:
    """Evaluate the checks on the written intermediate table, then publish it.

    A failed rule holds the table back, unless the spec names an action for its severity:
    ``log`` and ``alert`` let the table pass, ``quarantine`` moves the rows that break the
    rule aside and lets the others pass. A quarantine rule that does not judge single rows
    holds the table back. ``publish`` gets what was measured.
    """
    spec = item.get("quality") or item.get("quality_checks") or []
    rules: list[QualityRule] = rules_from_spec(spec)
    if not rules:
        publish(df, Measured())
        return Outcome(item["name"], layer, "written")
    staged = materialize(df, f"{layer}-{item['name'].replace('.', '_')}")
    results = materialize(
        quality.evaluate(staged, rules, f"{layer}.{item['name']}", tables, context.as_of), "results"
    )
    if context.results_path:
        now = lookup("current_timestamp")(context.as_of)
        writers.append_quality_results(
            results, context.results_path, {"execution_time": now, "run_id": F.lit(context.batch_id)}
        )
    actions = item.get("actions", {}) or (spec.get("actions", {}) if isinstance(spec, Mapping) else {})
    actions = actions.get("on_failure", actions)
    failed = quality.failed_rules(results)
    if not failed:
        publish(staged, Measured(True, 1.0))
        return Outcome(item["name"], layer, "written", results=results)
    chosen = {f["rule_id"]: actions.get(f["severity"]) for f in failed}
    if context.events_path and "alert" in chosen.values():
        alerted = quality.verdicts(results).filter(~F.col("passed"))
        events.publish(events.quality_events(alerted, context.pipeline_id, layer, context.as_of), context.events_path)
    aside = [r for r in rules if chosen.get(r.rule_id) == "quarantine"]
    by_row = {label.rsplit(":", 1)[0] for label in quality.row_tests(staged, aside)}
    if any(action is None for action in chosen.values()) or any(r.rule_id not in by_row for r in aside):
        return Outcome(item["name"], layer, "held", failed, results=results)
    if aside:
        flagged = quality.flag_rows(staged, aside)
        if path is None:
            return Outcome(item["name"], layer, "held", failed, results=results)
        writers.append_quarantine(flagged.filter(F.size("reasons") > 0), path, "failed", context.stream_batch)
        staged = flagged.filter(F.size("reasons") == 0).drop("reasons")
    # Rows set aside no longer count against the rest; rules that were only reported do.
    score = quality.quality_score(results).first()["data_quality_score"]
    publish(staged, Measured(all(action == "quarantine" for action in chosen.values()), score))
    return Outcome(item["name"], layer, "written", failed, results=results)


def run_bronze(
    spark: SparkSession,
    spec: Mapping[str, Any] | str,
    context: RunContext = RunContext(),
    tables: Mapping[str, DataFrame] | None = None,
) -> list[Outcome]:
    spec = load_spec(spec) if isinstance(spec, str) else spec

    def work(item: Mapping[str, Any]) -> Outcome:
        zone = item["bronze_zone"]
        df = bronze_frame(spark, item, context)
        return checked(
            spark,
            df,
            item,
            "bronze",
            context,
            tables or {},
            zone["path"],
            lambda out, _: writers.write_bronze(
                out, zone["path"], zone.get("format", context.storage_format), zone.get("partition_by", [])
            ),
        )

    return _run_each(spark, spec["source_configurations"], "bronze", context, work)


def bronze_frame(spark: SparkSession, item: Mapping[str, Any], context: RunContext) -> DataFrame:
    """Read a landing source; rows that do not fit are appended to the layer's quarantine."""
    landing, path = item["landing_zone"], item["bronze_zone"]["path"]
    checks = item.get("schema_validation") or {}
    schema = checks.get("schema") or (load_spec(checks["schema_location"]) if "schema_location" in checks else None)
    if checks.get("mode") == "strict":
        if schema is None:
            raise SpecError(f"{item['name']}: strict mode needs a schema")
        typed = readers.read_strict(spark, landing["path"], item["format"], schema, landing.get("file_pattern"))
        typed = materialize(typed.select("*", F.expr("_metadata.file_path").alias("source_file")), "landing")
        good, bad = readers.split_corrupt(typed)
        if checks.get("on_error", "quarantine") == "quarantine":
            sealed = ["raw_record"] if item.get("encrypted_columns") else []
            writers.append_quarantine(protect_columns(bad, sealed), path, "malformed")
        df = good
    else:
        df = readers.read_source(
            spark, landing["path"], item["format"], schema, landing.get("file_pattern"), ["file_path"]
        ).withColumnRenamed("file_path", "source_file")
    return bronze_transform(df, item, context)


def bronze_transform(df: DataFrame, item: Mapping[str, Any], context: RunContext) -> DataFrame:
    """Duplicates, names, field mapping, protection and metadata; ``df`` has ``source_file``."""
    steps = item.get("processing") or {}
    if steps.get("clean_column_names"):
        df = clean_column_names(df)
    business = [c for c in df.columns if c != "source_file"]
    duplicates = steps.get("handle_duplicates", "drop_exact")
    if duplicates == "keep_latest" and steps.get("keys"):
        rest = [c for c in business if c not in (*steps["keys"], steps["latest_by"])]
        df = keep_latest(df, steps["keys"], steps["latest_by"], rest)
    elif duplicates in ("drop_exact", "keep_latest"):
        df = drop_exact_duplicates(df, business)
    if item.get("mapping"):
        mapping = FieldMapping.from_spec(item["mapping"])
        validated = materialize(mapping.validate(df), "validated")
        df, kept_out = split_validated(validated)
        secret = set(item.get("encrypted_columns") or [])
        secret |= {t.source for t in mapping.targets if t.name in secret and t.source}
        kept_out = protect_columns(kept_out, [c for c in kept_out.columns if c in secret])
        writers.append_quarantine(kept_out, item["bronze_zone"]["path"], "invalid", context.stream_batch)
        df = mapping.project(df, context.mapping())
    df = protect_columns(df, item.get("encrypted_columns") or [])
    now = lookup("current_timestamp")(context.as_of)
    if "ingestion_timestamp" not in df.columns:
        df = df.withColumn("ingestion_timestamp", now)
    if "ingestion_date" in item["bronze_zone"].get("partition_by", []):
        df = writers.with_partition_date(df, "ingestion_date", F.col("ingestion_timestamp"))
    return add_audit_columns(df, "bronze", context.as_of)


def _standardize_names(df: DataFrame, step: Mapping[str, Any], _: Mapping[str, DataFrame]) -> DataFrame:
    return df.withColumns({c: text.standardize_names(F.col(c)) for c in step["columns"]})


def _validate_email(df: DataFrame, step: Mapping[str, Any], _: Mapping[str, DataFrame]) -> DataFrame:
    return df.withColumns({f"{c}_valid": text.email_valid(F.col(c)) for c in step["columns"]})


def _standardize_name(df: DataFrame, step: Mapping[str, Any], _: Mapping[str, DataFrame]) -> DataFrame:
    body = step["config"]
    return df.withColumns({c: text.chain(F.col(c), body["operations"]) for c in body["input_columns"]})


def _reference(df: DataFrame, body: Mapping[str, Any], tables: Mapping[str, DataFrame]) -> DataFrame:
    """The table that ``reference_data`` names among those handed in; else what lies at that path, in
    ``reference_format`` or the format of its ending (parquet without one)."""
    name = body["reference_data"]
    if name in tables:
        return tables[name]
    ending = name.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    known = {f.value for f in InputFormat}
    return readers.read_source(df.sparkSession, name, body.get("reference_format") or (ending if ending in known else "parquet"))


def _standardize_address(df: DataFrame, step: Mapping[str, Any], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Zip form, and ``city_state_valid`` / ``address_valid`` against the reference table, whose
    columns are city, state, country (and address)."""
    body = step["config"]
    if "standardize_zip" in body["operations"]:
        df = df.withColumn(body["zip_column"], text.standardize_zip(F.col(body["zip_column"])))
    place = {body["city_column"]: "city", body["state_column"]: "state", body["country_column"]: "country"}
    if "validate_city_state" in body["operations"]:
        df = validate_against(df, _reference(df, body, tables), place, "city_state_valid")
    if "validate_address" in body["operations"]:
        keys = {body["address_column"]: "address", **place}
        df = validate_against(df, _reference(df, body, tables), keys, "address_valid")
    return df


def _enrich_location(df: DataFrame, step: Mapping[str, Any], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Reference columns by zip and country. ``output_columns`` maps the spec's field to the
    reference column, which is also the name it gets here."""
    body = step["config"]
    keys = {column: kind for kind, column in body["input_columns"].items()}
    outputs = {reference: reference for reference in body["output_columns"].values()}
    return enrich(df, _reference(df, body, tables), keys, outputs)


def _validate_contact(df: DataFrame, step: Mapping[str, Any], tables: Mapping[str, DataFrame]) -> DataFrame:
    body = step["config"]
    email, phone = body["email_column"], body["phone_column"]
    if "validate_email_format" in body["operations"]:
        df = df.withColumn(f"{email}_valid", text.email_valid(F.col(email)))
    if "validate_email_domain" in body["operations"]:
        domains = tables[body.get("domain_table", "email_domains")]
        df = df.withColumn("_domain", text.email_domain(F.col(email)))
        df = validate_against(df, domains, {"_domain": "domain"}, f"{email}_domain_valid").drop("_domain")
    if "standardize_phone" in body["operations"]:
        df = df.withColumn(phone, text.clean_phone(F.col(phone)))
    return df


SILVER_STEPS: dict[str, Callable[[DataFrame, Mapping[str, Any], Mapping[str, DataFrame]], DataFrame]] = {
    "standardize_names": _standardize_names,
    "validate_email": _validate_email,
    "standardize_name": _standardize_name,
    "standardize_address": _standardize_address,
    "enrich_location": _enrich_location,
    "validate_contact": _validate_contact,
}


def silver_transform(
    df: DataFrame, steps: Sequence[Mapping[str, Any]], tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Named steps in list order, and column transformations (direct, cast, expression)."""
    for step in steps:
        if step["type"] in SILVER_STEPS:
            df = SILVER_STEPS[step["type"]](df, step, tables or {})
        else:
            body = {k: v for k, v in step.items() if k != "type"}
            df = apply_transformations(df, [ColumnTransformation(transform_type=step["type"], **body)])
    return df


def run_silver(
    spark: SparkSession,
    spec: Mapping[str, Any] | str,
    context: RunContext = RunContext(),
    tables: Mapping[str, DataFrame] | None = None,
) -> list[Outcome]:
    spec = load_spec(spec) if isinstance(spec, str) else spec

    def work(item: Mapping[str, Any]) -> Outcome:
        if item.get("transformation"):
            df = spark.sql(item["transformation"])
        else:
            source = item["input"]
            df = readers.read_stored(spark, source["path"], source.get("format", context.storage_format))
        df = silver_transform(df, item.get("transformations") or [], tables)
        out = item["output"]
        if item.get("mapping"):
            mapping = FieldMapping.from_spec(item["mapping"])
            if mapping.checks:
                df, kept_out = split_validated(materialize(mapping.validate(df), "validated"))
                writers.append_quarantine(kept_out, out["path"], "invalid")
            df = mapping.project(df, context.mapping())
        return checked(
            spark,
            df,
            item,
            "silver",
            context,
            tables or {},
            out["path"],
            lambda checked, measured: writers.write_silver(
                add_audit_columns(checked, "silver", context.as_of, quality_check_passed=measured.flag()),
                out["path"],
                out.get("format", context.storage_format),
                out.get("partition_by", []),
                out.get("only_present_partitions", False),
            ),
        )

    return _run_each(spark, spec["source_configurations"], "silver", context, work)


def gold_frame(
    spark: SparkSession,
    item: Mapping[str, Any],
    tables: Mapping[str, DataFrame] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Source tables joined in order, then the metrics of all time windows per dimension; or
    the target fields of a gold mapping."""
    given = dict(tables or {})
    if item.get("mapping"):
        body = item["mapping"].get("mapping_definition", item["mapping"])
        for source in body["source_tables"]:
            if source["name"] not in given:
                given[source["name"]] = readers.read_stored(spark, source["path"], source.get("format", "parquet"))
        return build_gold(item["mapping"], given, item.get("join_on", ()), as_of)
    names = item.get("source_tables") or [item["source_table"]]
    frames = [given[n] if n in given else spark.read.table(n) for n in names]
    df = join_chain(frames, item.get("join_conditions") or [])
    metrics = [m for window in item["time_window"] for m in window["metrics"]]
    periods = [window["period"] for window in item["time_window"] if window.get("period")]
    return grouped_metrics(df, [*item.get("dimensions", []), *dict.fromkeys(periods)], metrics)


def run_gold(
    spark: SparkSession,
    spec: Mapping[str, Any] | str,
    context: RunContext = RunContext(),
    tables: Mapping[str, DataFrame] | None = None,
) -> list[Outcome]:
    spec = load_spec(spec) if isinstance(spec, str) else spec

    def work(item: Mapping[str, Any]) -> Outcome:
        df = gold_frame(spark, item, tables, context.as_of)
        return checked(
            spark,
            df,
            item,
            "gold",
            context,
            tables or {},
            item["output"].get("path"),
            lambda checked, measured: _publish_gold(
                spark,
                add_audit_columns(checked, "gold", context.as_of, data_quality_score=measured.share()),
                item["output"],
                context,
            ),
        )

    return _run_each(spark, spec["aggregations"], "gold", context, work)


def _publish_gold(spark: SparkSession, df: DataFrame, out: Mapping[str, Any], context: RunContext) -> None:
    keys = out.get("merge_key", [])
    if "table" not in out:
        writers.write(
            writers.cluster_for_partitions(df, out.get("partition_by", [])),
            out["path"],
            out.get("format", context.storage_format),
            out.get("mode", "overwrite"),
            out.get("partition_by", []),
        )
        return
    if out.get("mode") == "merge" and keys:
        if out.get("format", context.storage_format) == "delta":
            merge_into_delta(spark, out["table"], df, keys)
        else:
            stored = VersionedTable(spark, out["path"])
            stored.merge(df, keys)
            stored.register(out["table"])
        return
    writers.write_gold(
        df, out["table"], out.get("mode", "overwrite"), out.get("format", context.storage_format), out.get("path")
    )


def process_table(
    spark: SparkSession,
    table_name: str,
    transformation: str | None,
    path: str,
    fmt: str = "parquet",
    landing_root: str = "/data/landing",
    landing_format: str = "parquet",
    context: RunContext = RunContext(),
) -> None:
    """One table by its ``layer.name``: bronze copies a landing folder, silver and gold run
    the given SQL."""
    layer, _, name = table_name.partition(".")
    if layer == "bronze":
        df = readers.read_source(spark, f"{landing_root}/{name}", landing_format, None, None, ["file_path"])
        df = df.withColumnRenamed("file_path", "source_file").withColumn(
            "ingestion_timestamp", lookup("current_timestamp")(context.as_of)
        )
        writers.write(df, path, fmt, "append")
    elif layer in ("silver", "gold"):
        if not transformation:
            raise SpecError(f"{table_name} needs a transformation")
        unchecked = Measured()
        measured = (
            {"quality_check_passed": unchecked.flag()} if layer == "silver" else {"data_quality_score": unchecked.share()}
        )
        writers.write(add_audit_columns(spark.sql(transformation), layer, context.as_of, **measured), path, fmt)
    else:
        raise SpecError(f"unknown layer in {table_name!r}")
