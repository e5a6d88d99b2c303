"""Declarative specs. Every spec is validated before the first Spark job starts."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from enum import Enum
from pathlib import Path
from typing import Any


class SpecError(ValueError):
    """A spec that cannot be compiled into a plan."""


class InputFormat(str, Enum):
    PARQUET = "parquet"
    JSON = "json"
    CSV = "csv"
    ORC = "orc"


class StorageFormat(str, Enum):
    PARQUET = "parquet"
    DELTA = "delta"
    ICEBERG = "iceberg"
    HUDI = "hudi"


class Layer(str, Enum):
    LANDING = "landing"
    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"

    @property
    def rank(self) -> int:
        return list(Layer).index(self)


def load_spec(path: str) -> dict[str, Any]:
    """Read a JSON spec, or a YAML one where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise SpecError("YAML specs need the yaml package; JSON specs do not") from missing
        return yaml.safe_load(text)
    return json.loads(text)


@dataclass(frozen=True)
class PipelineConfig:
    pipeline_name: str
    landing_location: str
    target_location: str
    input_format: InputFormat
    storage_format: StorageFormat = StorageFormat.PARQUET
    kafka_input_topic: str | None = None
    kafka_output_topic: str | None = None
    encrypted_columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "input_format", InputFormat(self.input_format))
        object.__setattr__(self, "storage_format", StorageFormat(self.storage_format))
        object.__setattr__(self, "encrypted_columns", tuple(self.encrypted_columns or ()))
        for name in ("pipeline_name", "landing_location", "target_location"):
            if not getattr(self, name):
                raise SpecError(f"{name} must not be empty")

    def layer_path(self, layer: Layer | str) -> str:
        return f"{self.target_location.rstrip('/')}/{Layer(layer).value}"


@dataclass(frozen=True)
class ColumnTransformation:
    """``direct`` copies, ``cast`` converts, ``expression`` evaluates SQL text."""

    target_col: str
    transform_type: str = "direct"
    source_col: str | None = None
    cast_type: str | None = None
    expression: str | None = None
    on_error: str | None = None

    def __post_init__(self) -> None:
        needed = {"direct": "source_col", "cast": "cast_type", "expression": "expression"}
        if self.transform_type not in needed:
            raise SpecError(f"unknown transform_type {self.transform_type!r} for {self.target_col}")
        if not getattr(self, needed[self.transform_type]):
            raise SpecError(f"{self.transform_type} into {self.target_col} needs {needed[self.transform_type]}")


@dataclass(frozen=True)
class AggregationRule:
    name: str
    source_cols: tuple[str, ...]
    agg_type: str
    group_by_cols: tuple[str, ...] = ()
    having_clause: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "source_cols", tuple(self.source_cols))
        object.__setattr__(self, "group_by_cols", tuple(self.group_by_cols or ()))
        if self.agg_type not in ("sum", "avg", "count"):
            raise SpecError(f"unknown agg_type {self.agg_type!r} in rule {self.name}")
        if not self.source_cols:
            raise SpecError(f"rule {self.name} names no column")


# Severity names of either vocabulary, in the one used here.
SEVERITIES = {
    "CRITICAL": "high",
    "ERROR": "high",
    "WARN": "medium",
    "WARNING": "medium",
    "INFO": "low",
    "high": "high",
    "medium": "medium",
    "low": "low",
}


@dataclass(frozen=True)
class QualityRule:
    rule_id: str
    rule_type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    version: str = "1"
    threshold: float = 1.0
    severity: str = "high"

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise SpecError(f"unknown severity {self.severity!r} in rule {self.rule_id}")
        object.__setattr__(self, "severity", SEVERITIES[self.severity])


@dataclass(frozen=True)
class AnomalyConfig:
    detection_method: str = "zscore"
    lookback_window: int = 30
    threshold: float = 3.0
    min_samples: int = 0
    sensitivity: float = 1.0
    exclude_current: bool = False
    frame: str = "rows"

    def __post_init__(self) -> None:
        if self.frame not in ("rows", "days"):
            raise SpecError(f"unknown frame {self.frame!r}")
        if self.detection_method not in ("zscore", "iqr", "isolation_forest", "moving_average"):
            raise SpecError(f"unknown detection_method {self.detection_method!r}")
        if self.lookback_window < 1:
            raise SpecError("lookback_window must be at least 1")

    @property
    def reachable(self) -> bool:
        """Whether a z-score can pass the threshold at all.

        A row that lies inside its own frame of n rows has a score of at most (n-1)/sqrt(n).
        """
        if self.exclude_current or self.frame == "days":
            return True
        n = self.lookback_window + 1
        return (n - 1) / n**0.5 > self.threshold


def version_key(version: str) -> tuple[int, ...]:
    """Dotted versions order by number, so 1.10 comes after 1.9."""
    return tuple(int(part) for part in re.findall(r"\d+", str(version)))


def rules_from_spec(spec: Mapping[str, Any] | Sequence[Mapping[str, Any]]) -> list[QualityRule]:
    """Accept a grouped spec (``rules`` by name), or a flat list of rule dicts."""
    version = "1"
    prefix = ""
    if isinstance(spec, Mapping):
        version = str(spec.get("version", "1"))
        prefix = f"{spec['rule_id']}." if spec.get("rule_id") else ""
        entries = [{"rule_id": name, **body} for name, body in spec["rules"].items()]
    else:
        entries = [dict(entry) for entry in spec]

    rules = []
    reserved = {"rule_id", "id", "name", "version", "threshold", "severity", "rule_type", "type", "rule", "params"}
    for number, entry in enumerate(entries):
        kind = entry.get("rule_type") or entry.get("type") or entry.get("rule") or entry.get("name")
        base = entry.get("rule_id") or entry.get("id") or entry.get("name") or f"{kind}_{number}"
        params = {k: v for k, v in entry.items() if k not in reserved}
        params.update(entry.get("params") or {})
        common = dict(
            version=str(entry.get("version", version)),
            severity=entry.get("severity", "ERROR"),
        )
        parts = params.pop("rules", None)
        if parts is None:
            rules.append(
                QualityRule(prefix + base, kind, params, threshold=float(entry.get("threshold", 1.0)), **common)
            )
            continue
        for index, part in enumerate(parts):
            body = {**params, **{k: v for k, v in part.items() if k not in ("threshold", "type")}}
            sub_kind = kind
            if kind == "anomaly" and "type" in part:
                body["detector"] = part["type"]
                sub_kind = "anomaly_detector"
            suffix = part.get("column") or part.get("type") or part.get("target_table") or str(index)
            threshold = float(part.get("threshold", entry.get("threshold", 1.0)))
            rules.append(QualityRule(f"{prefix}{base}.{suffix}", sub_kind, body, threshold=threshold, **common))
    return rules
