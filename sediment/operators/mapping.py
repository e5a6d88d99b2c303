"""Column transformations, field mappings with validation, and schema checks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.config import ColumnTransformation, SpecError
from sediment.functions import lookup, text

REASONS = "_reasons"
STATUS = "_status"
ACTIONS = ("reject", "quarantine", "truncate", "null")


def apply_transformations(df: DataFrame, steps: Sequence[ColumnTransformation]) -> DataFrame:
    """Copy, cast and expression columns. Steps that do not read each other's targets share
    one projection; a later step sees the targets of earlier ones."""
    pending: dict[str, Column] = {}
    for step in steps:
        if step.transform_type == "expression":
            reads = set(re.findall(r"\w+", step.expression))
        else:
            reads = {step.source_col or step.target_col}
        if pending and (reads & set(pending) or step.target_col in pending):
            df = df.withColumns(pending)
            pending = {}
        pending[step.target_col] = _transformed(step)
    return df.withColumns(pending) if pending else df


def _transformed(step: ColumnTransformation) -> Column:
    if step.transform_type == "direct":
        return F.col(step.source_col)
    if step.transform_type == "cast":
        source = F.col(step.source_col or step.target_col)
        return source.try_cast(step.cast_type) if step.on_error else source.cast(step.cast_type)
    return F.expr(step.expression)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Characters other than letters, digits and underscore become underscores."""
    names = [re.sub(r"[^a-zA-Z0-9_]", "_", name) for name in df.columns]
    if len(set(n.lower() for n in names)) < len(names):
        raise SpecError(f"cleaned column names collide: {names}")
    return df.toDF(*names)


@dataclass(frozen=True)
class FieldCheck:
    name: str
    type: str = "string"
    required: bool = False
    pattern: str | None = None
    max_length: int | None = None
    length: int | None = None
    case: str | None = None
    format: str | None = None
    timezone: str | None = None
    on_error: str | None = None

    def __post_init__(self) -> None:
        if self.on_error not in (None, *ACTIONS):
            raise SpecError(f"unknown on_error {self.on_error!r} for {self.name}")
        if self.on_error == "truncate" and self.max_length is None:
            raise SpecError(f"{self.name}: truncate needs max_length")
        if self.case not in (None, "upper", "lower"):
            raise SpecError(f"{self.name}: unknown case {self.case!r}")

    @classmethod
    def from_spec(cls, name: str, body: Mapping[str, Any]) -> FieldCheck:
        return cls(name, body.get("type", "string"), bool(body.get("required", False)), **body.get("validation", {}))

    def compile(self) -> tuple[Column, list[tuple[str, Column]]]:
        """(value after repair, [(reason, violated)])."""
        raw = F.col(self.name)
        value = raw
        broken: list[tuple[str, Column]] = []
        if self.case:
            folded = F.upper(value) if self.case == "upper" else F.lower(value)
            if self.on_error:
                broken.append(("case", value != folded))
            else:
                value = folded
        if self.max_length is not None:
            if self.on_error == "truncate":
                value = text.truncate(value, self.max_length)
            else:
                broken.append(("max_length", F.length(value) > self.max_length))
        if self.length is not None:
            broken.append(("length", F.length(value) != self.length))
        if self.pattern is not None:
            broken.append(("pattern", ~value.rlike(self.pattern)))
        if self.format is not None:
            parsed = text.parse_timestamp(raw, self.format)
            if self.timezone and self.timezone.upper() != "UTC":
                parsed = F.to_utc_timestamp(parsed, self.timezone)
            broken.append(("format", raw.isNotNull() & parsed.isNull()))
            value = parsed
        elif self.type != "string":
            typed = value.try_cast(self.type)
            broken.append(("type", value.isNotNull() & typed.isNull()))
            value = typed
        broken = [(reason, F.coalesce(test, F.lit(False))) for reason, test in broken]
        if self.on_error == "null":
            for _, test in broken:
                value = F.when(~test, value)
            broken = []
        if self.required:
            broken.insert(0, ("required", raw.isNull()))
        return value, broken


@dataclass(frozen=True)
class TargetField:
    name: str
    type: str = "string"
    source: str | None = None
    transform: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class MappingContext:
    """Values of one batch: the same for every row and on every retry."""

    batch_id: str | None = None
    as_of: Column | None = None
    file_column: str = "source_file"


@dataclass(frozen=True)
class FieldMapping:
    checks: tuple[FieldCheck, ...]
    targets: tuple[TargetField, ...]

    @classmethod
    def from_spec(cls, spec: Mapping[str, Any]) -> FieldMapping:
        body = spec.get("mapping_definition", spec)
        checks = tuple(FieldCheck.from_spec(n, b) for n, b in body.get("source_fields", {}).items())
        targets = tuple(
            TargetField(n, b.get("type", "string"), b.get("source"), b.get("transform"), b.get("params", {}))
            for n, b in body.get("target_fields", {}).items()
        )
        return cls(checks, targets)

    def validate(self, df: DataFrame) -> DataFrame:
        """All rows, with repaired values, ``_reasons`` (``field:check`` of what was violated)
        and ``_status``: ``ok``, ``quarantine`` or ``reject``."""
        repaired: dict[str, Column] = {}
        held: list[Column] = []
        refused: list[Column] = []
        for check in self.checks:
            repaired[check.name], broken = check.compile()
            for reason, test in broken:
                label = F.when(test, F.lit(f"{check.name}:{reason}"))
                refuse = check.on_error == "reject" and reason != "required"
                (refused if refuse else held).append(label)
        rejects = F.array_compact(F.array(*refused)) if refused else F.array().cast("array<string>")
        holds = F.array_compact(F.array(*held)) if held else F.array().cast("array<string>")
        status = F.when(F.size("_refused") > 0, "reject").when(F.size("_held") > 0, "quarantine").otherwise("ok")
        flagged = df.withColumns({"_refused": rejects, "_held": holds})
        others = [c for c in df.columns if c not in repaired]
        return flagged.select(
            *others,
            *[value.alias(name) for name, value in repaired.items()],
            F.array_sort(F.concat("_refused", "_held")).alias(REASONS),
            status.alias(STATUS),
        )

    def project(self, df: DataFrame, context: MappingContext = MappingContext()) -> DataFrame:
        """Rename, transform and type all target fields in one projection."""
        return df.select(*[self._target(t, context) for t in self.targets])

    def _target(self, target: TargetField, context: MappingContext) -> Column:
        if target.transform in ("uuid4", "uuid"):
            if not context.batch_id:
                raise SpecError("a uuid target needs a batch_id in the context")
            value = F.lit(context.batch_id)
        elif target.transform == "input_file_name":
            value = F.col(context.file_column)
        elif target.transform in ("current_timestamp", "current_date"):
            value = lookup(target.transform)(context.as_of)
        elif target.transform == "concat":
            columns = [F.col(c) for c in target.params["columns"]]
            value = lookup("concat")(*columns, separator=target.params.get("separator", " "))
        else:
            if not target.source:
                raise SpecError(f"target {target.name} has neither a source nor a transform of its own")
            value = F.col(target.source)
            if target.transform:
                value = lookup(target.transform)(value, **target.params)
        return value.cast(target.type).alias(target.name)


def split_validated(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rows to quarantine with their reasons)."""
    accepted = validated.filter(F.col(STATUS) == "ok").drop(REASONS, STATUS)
    kept_out = validated.filter(F.col(STATUS) != "ok").withColumnRenamed(REASONS, "reasons").withColumnRenamed(
        STATUS, "action"
    )
    return accepted, kept_out


def schema_differences(df: DataFrame, expected: T.StructType) -> list[dict[str, str]]:
    """Columns that are missing, unexpected or of another type; empty when the schemas agree."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in sorted(actual.keys() | wanted.keys()):
        have, need = actual.get(name), wanted.get(name)
        if have != need:
            kind = "missing" if have is None else "unexpected" if need is None else "type"
            rows.append({"column_name": name, "difference": kind, "actual": have, "expected": need})
    return rows


def schema_report(spark: SparkSession, df: DataFrame, expected: T.StructType) -> DataFrame:
    return spark.createDataFrame(
        [tuple(row.values()) for row in schema_differences(df, expected)],
        "column_name string, difference string, actual string, expected string",
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def add_audit_columns(df: DataFrame, layer: str, as_of: Column | None = None, **extra: Column) -> DataFrame:
    """The processing columns of a layer; ``extra`` carries measured values such as
    ``quality_check_passed`` or ``data_quality_score``."""
    now = lookup("current_timestamp")(as_of)
    names = {
        "bronze": {"record_status": F.lit("active"), "processed_timestamp": now},
        "silver": {"silver_processed_timestamp": now, "processed_timestamp": now},
        "gold": {"gold_processed_timestamp": now, "analytics_timestamp": now},
    }
    if layer not in names:
        raise SpecError(f"no audit columns for layer {layer!r}")
    return df.withColumns({**names[layer], **extra})
