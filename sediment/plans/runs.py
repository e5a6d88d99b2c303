"""A whole run from one spec: the layers with their sources and targets, the mapping and the
quality spec of each layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sediment.config import SpecError
from sediment.plans.layers import LayerFailed, Outcome, RunContext, run_bronze, run_gold, run_silver


def layer_items(
    spec: Mapping[str, Any],
    mappings: Mapping[str, Mapping[str, Any]],
    quality: Mapping[str, Mapping[str, Any]],
    join_on: Sequence[str] = (),
) -> dict[str, dict[str, Any]]:
    """The item that each layer run takes, from the layers of the spec. Landing fields are
    read as text, since the bronze mapping types and validates them."""
    name = spec["pipeline_name"]
    layers = spec.get("config_json", spec)["layers"]
    items: dict[str, dict[str, Any]] = {}
    for layer, body in layers.items():
        source, target = body["source"], body["target"]
        stored = target.get("type", "parquet")
        out = {"path": target["path"], "partition_by": target.get("partition_by", []), "format": stored}
        item: dict[str, Any] = {"name": name, "quality": quality.get(layer), "mapping": mappings.get(layer)}
        if layer == "bronze":
            fields = (mappings[layer].get("mapping_definition") or mappings[layer])["source_fields"]
            item |= {
                "format": source["format"],
                "landing_zone": {"path": source["path"], "file_pattern": source.get("pattern")},
                "schema_validation": {
                    "schema": dict.fromkeys(fields, "string"),
                    **body.get("schema_validation", {}),
                },
                "bronze_zone": out,
            }
        elif layer == "silver":
            steps = (mappings[layer].get("mapping_definition") or mappings[layer]).get("transformations", [])
            item |= {"input": {"path": source["path"], "format": source.get("type", "parquet")}}
            item |= {"transformations": steps, "output": out}
        elif layer == "gold":
            item |= {"join_on": join_on, "output": out}
        else:
            raise SpecError(f"unknown layer {layer!r}")
        items[layer] = item
    return items


def run_layers(
    spark: SparkSession,
    spec: Mapping[str, Any],
    mappings: Mapping[str, Mapping[str, Any]],
    quality: Mapping[str, Mapping[str, Any]] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    context: RunContext = RunContext(),
    join_on: Sequence[str] = (),
) -> list[Outcome]:
    """Run bronze, silver and gold in this order; a layer that is held back or fails ends the run."""
    items = layer_items(spec, mappings, quality or {}, join_on)
    runs = {
        "bronze": (run_bronze, "source_configurations"),
        "silver": (run_silver, "source_configurations"),
        "gold": (run_gold, "aggregations"),
    }
    outcomes: list[Outcome] = []
    for layer, (run, key) in runs.items():
        if layer not in items:
            continue
        try:
            outcomes += run(spark, {key: [items[layer]]}, context, tables)
        except LayerFailed as failure:
            raise LayerFailed([*outcomes, *failure.outcomes]) from failure
        if outcomes[-1].status != "written":
            break
    return outcomes
