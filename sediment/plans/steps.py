"""Step lists: extract, transform by SQL over earlier steps, load; with rules and metrics."""

from __future__ import annotations

import time
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sediment.config import SpecError, rules_from_spec
from sediment.operators import quality
from sediment.operators.events import event_rows
from sediment.session import materialize
from sediment.sources import readers, writers
from sediment.sources.manifest import bytes_read


def run_steps(
    spark: SparkSession, config: Mapping[str, Any], at: str, formats: Mapping[str, str] | None = None
) -> tuple[list[dict[str, Any]], DataFrame]:
    """Run the steps in order; returns a report per step and the events raised.

    A step's frame is a view under the step's id. A failing step ends the run. A rule covers the steps it names
    under ``steps``; one that names none covers what is extracted, as later steps may have other columns.
    """
    rules = rules_from_spec(config.get("quality_rules") or [])
    reports: list[dict[str, Any]] = []
    events: list[dict[str, Any]] = []
    latest: DataFrame | None = None

    def raise_event(kind: str, step: str, severity: str = "INFO", **details: Any) -> None:
        events.append(
            {
                "event_type": kind,
                "pipeline_id": config["id"],
                "table_name": step,
                "layer": "",
                "timestamp": at,
                "details": {k: str(v) for k, v in details.items()},
                "severity": severity,
            }
        )

    for step in config["steps"]:
        started = time.monotonic()
        report: dict[str, Any] = {"step_id": step["id"], "success": False, "quality_checks": {}, "metrics": {}}
        reports.append(report)
        size = None
        try:
            if step["type"] in ("extract", "source"):
                source = step["source"]
                fmt = source.get("format") or source["path"].rsplit(".", 1)[-1]
                df = readers.read_source(spark, source["path"], fmt, source.get("schema"))
                size = bytes_read(df).first()[0]
            elif step["type"] in ("transform", "sql"):
                df = spark.sql(step["sql"])
            elif step["type"] in ("load", "sink"):
                if latest is None:
                    raise SpecError("nothing to load")
                target = step["target"]
                writers.write(latest, target["path"], target.get("format", "parquet"))
                df = latest
            else:
                raise SpecError(f"unknown step type {step['type']!r}")
            counted = Observation(f"{step['id']}-rows")
            if step["type"] not in ("load", "sink"):
                df = materialize(df.observe(counted, F.count(F.lit(1)).alias("n")), step["id"])
                rows = counted.get["n"]
            else:
                rows = reports[-2]["metrics"].get("records_processed", 0)
        except Exception as problem:  # noqa: BLE001  reported as the step's outcome
            message = "SQL execution failed" if step["type"] in ("transform", "sql") else "step failed"
            report["error"] = str(problem)
            raise_event("pipeline_error", step["id"], "ERROR", error=message, error_message=problem)
            break
        df.createOrReplaceTempView(step["id"])
        latest = df
        failed: list[dict[str, Any]] = []
        read = step["type"] in ("extract", "source")
        covering = [r for r in rules if (step["id"] in r.params["steps"] if "steps" in r.params else read)]
        if covering and step["type"] not in ("load", "sink"):
            results = quality.evaluate(df, covering, step["id"]).collect()
            for rule in covering:
                mine = [r for r in results if r["rule_id"] == rule.rule_id]
                report["quality_checks"][rule.rule_id] = {
                    "passed": all(r["passed"] for r in mine),
                    "metrics": {r["metric"]: r["value"] for r in mine},
                }
            failed = [{"rule_id": k, **v} for k, v in report["quality_checks"].items() if not v["passed"]]
        report["metrics"] = {
            "records_processed": rows,
            "bytes_processed": size,
            "duration_ms": (time.monotonic() - started) * 1000,
            "quality_checks_passed": sum(c["passed"] for c in report["quality_checks"].values()),
        }
        report["records_processed"] = rows
        if failed:
            names = ", ".join(f["rule_id"] for f in failed)
            report["error"] = f"Quality check failed: {names}"
            raise_event("quality_check_failure", step["id"], "ERROR", error=report["error"], rule_id=names)
            break
        report["success"] = True
        raise_event("pipeline_complete", step["id"], status="success", **report["metrics"])
    return reports, event_rows(spark, events)
