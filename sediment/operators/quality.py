"""Data-quality rules.

All rules that a plain aggregate can answer are fused into one pass over the table. Distinct
counts and orphan checks need a shuffle of their own keys and get one pass each. The outcome
is a tidy frame with a row per rule, target and metric. Nothing runs until it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.config import AnomalyConfig, QualityRule, SpecError
from sediment.functions.text import out_of_bounds
from sediment.operators import anomalies
from sediment.operators.joins import key_counts, orphan_keys, orphans

RESULT_COLUMNS = (
    "table_name", "rule_id", "version", "rule_type", "severity", "target", "metric", "value", "passed",
)
DISTRIBUTION_TOLERANCE = 0.1
ANOMALY_RATIO_LIMIT = 0.01


@dataclass(frozen=True)
class Probe:
    """One target of a rule: what to aggregate, and metrics and verdict over that one row."""

    rule: QualityRule
    target: str
    aggregates: Mapping[str, Column]
    metrics: Callable[[Callable[[str], Column]], Mapping[str, Column]]
    passed: Callable[[Callable[[str], Column]], Column]


def _as_list(value: Any) -> list:
    return [] if value is None else [value] if isinstance(value, str) else list(value)


def _columns(rule: QualityRule) -> list[str]:
    names = _as_list(rule.params.get("columns")) or _as_list(rule.params.get("column"))
    if not names:
        raise SpecError(f"rule {rule.rule_id} names no column")
    return names


def _ratio(part: Column, total: Column) -> Column:
    """NULL for an empty table."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def missing(df: DataFrame, name: str, nan_is_missing: bool = False) -> Column:
    """NULL, and for floating columns NaN where asked for."""
    test = F.col(name).isNull()
    if nan_is_missing and isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        test = test | F.isnan(name)
    return test


def _completeness(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    nan = bool(rule.params.get("nan_is_missing", False))

    def probe(name: str) -> Probe:
        share = lambda get: F.lit(1.0) - _ratio(get("missing"), get("total"))
        return Probe(
            rule,
            name,
            {"missing": F.count_if(missing(df, name, nan)), "total": F.count("*")},
            lambda get: {"completeness_ratio": share(get), "null_count": get("missing"), "total_rows": get("total")},
            lambda get: share(get) >= rule.threshold,
        )

    return [probe(name) for name in _columns(rule)]


def _numeric(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    low, high = rule.params.get("min_value"), rule.params.get("max_value")

    def probe(name: str) -> Probe:
        c = F.col(name)
        inside = lambda get: F.lit(1.0) - _ratio(get("outside"), get("total"))
        return Probe(
            rule,
            name,
            {
                "min": F.min(c),
                "max": F.max(c),
                "avg": F.avg(c),
                "stddev": F.stddev_samp(c),
                "outside": F.count_if(out_of_bounds(c, low, high)),
                "total": F.count("*"),
            },
            lambda get: {
                "min": get("min"),
                "max": get("max"),
                "avg": get("avg"),
                "stddev": get("stddev"),
                "out_of_range_count": get("outside"),
            },
            lambda get: inside(get) >= rule.threshold,
        )

    return [probe(name) for name in _columns(rule)]


def _row_count(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    least = rule.params.get("min_threshold", rule.params.get("min_records"))
    if least is None:
        raise SpecError(f"rule {rule.rule_id} needs min_threshold or min_records")
    return [
        Probe(
            rule,
            "*",
            {"total": F.count("*")},
            lambda get: {"row_count": get("total")},
            lambda get: get("total") >= F.lit(least),
        )
    ]


def _null_check(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    limit = rule.params.get("max_nulls_percentage")
    if limit is None:
        condition = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _columns(rule)])
        return [_pass_rate(rule, ",".join(_columns(rule)), condition)]

    def probe(name: str) -> Probe:
        share = lambda get: _ratio(get("nulls") * F.lit(100), get("total"))
        return Probe(
            rule,
            name,
            {"nulls": F.count_if(F.col(name).isNull()), "total": F.count("*")},
            lambda get: {"null_percentage": share(get)},
            lambda get: share(get) <= F.lit(float(limit)),
        )

    return [probe(name) for name in _columns(rule)]


def _pass_rate(rule: QualityRule, target: str, condition: Column) -> Probe:
    """A NULL condition counts as failed."""
    share = lambda get: _ratio(get("good"), get("total"))
    return Probe(
        rule,
        target,
        {"good": F.count_if(F.coalesce(condition, F.lit(False))), "total": F.count("*")},
        lambda get: {
            "pass_rate": share(get),
            "failed_records": get("total") - get("good"),
            "total_records": get("total"),
        },
        lambda get: share(get) >= rule.threshold,
    )


def _business(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    return [_pass_rate(rule, rule.params["condition"], F.expr(rule.params["condition"]))]


def _freshness(df: DataFrame, rule: QualityRule, _tables: Any, as_of: Column | None) -> list[Probe]:
    name = rule.params["timestamp_column"]
    allowed = float(rule.params["max_delay_hours"]) * 3600
    now = (F.current_timestamp() if as_of is None else as_of).cast("timestamp").cast("double")
    age = lambda get: now - get("latest").cast("timestamp").cast("double")
    return [
        Probe(
            rule,
            name,
            {"latest": F.max(name)},
            lambda get: {"freshness": F.lit(1.0) - age(get) / F.lit(allowed), "age_seconds": age(get)},
            lambda get: age(get) <= F.lit(allowed),
        )
    ]


def _distribution(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    name = rule.params["column"]
    tolerance = float(rule.params.get("tolerance", DISTRIBUTION_TOLERANCE))

    def probe(value: Any, wanted: float) -> Probe:
        share = lambda get: _ratio(get("hits"), get("total"))
        return Probe(
            rule,
            f"{name}={value}",
            {"hits": F.count_if(F.col(name) == F.lit(value)), "total": F.count("*")},
            lambda get: {"actual_ratio": share(get), "expected_ratio": F.lit(float(wanted))},
            lambda get: F.abs(share(get) - F.lit(float(wanted))) <= F.lit(tolerance),
        )

    return [probe(value, wanted) for value, wanted in rule.params["expected_values"].items()]


def _schema(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    present = set(df.columns)

    def probe(name: str) -> Probe:
        found = F.lit(name in present)
        return Probe(rule, name, {}, lambda get: {"present": found.cast("int")}, lambda get: found)

    return [probe(name) for name in _as_list(rule.params.get("required_columns"))]


def _history(df: DataFrame, rule: QualityRule, as_of: Column | None) -> DataFrame:
    """The rows that statistics are taken from: with a ``date_column`` those of the ``lookback_days`` (30) days up to
    ``as_of``, or up to the latest date of the table; without one all."""
    date = rule.params.get("date_column")
    if not date:
        return df
    day = F.col(date).cast("date")
    last = df.agg(F.max(day)).scalar() if as_of is None else as_of.cast("date")
    return df.filter((day > F.date_sub(last, int(rule.params.get("lookback_days", 30)))) & (day <= last))


def _zscore(df: DataFrame, rule: QualityRule, _tables: Any = None, as_of: Column | None = None) -> list[Probe]:
    """Rows further than ``zscore_threshold`` deviations from the mean. Mean and deviation of all columns, over the rows
    of ``_history``, come from one scalar subquery. With ``max_ratio`` the share is the verdict."""
    names = _columns(rule)
    k = float(rule.params.get("zscore_threshold", 3.0))
    ratio_limit = rule.params.get("max_ratio")
    stats = _history(df, rule, as_of).agg(
        F.struct(
            *[F.avg(c).alias(f"avg_{i}") for i, c in enumerate(names)],
            *[F.stddev_samp(c).alias(f"dev_{i}") for i, c in enumerate(names)],
        )
    ).scalar()

    def probe(i: int, name: str) -> Probe:
        score = F.try_divide(F.abs(F.col(name) - stats.getField(f"avg_{i}")), stats.getField(f"dev_{i}"))
        share = lambda get: _ratio(get("far"), get("total"))
        return Probe(
            rule,
            name,
            {"far": F.count_if(score > F.lit(k)), "total": F.count("*")},
            lambda get: {"anomaly_count": get("far"), "anomaly_ratio": share(get)},
            lambda get: (get("total") > 0)
            & (
                (share(get) <= F.lit(float(ratio_limit)))
                if ratio_limit is not None
                else (get("far") <= get("total") * F.lit(1 - rule.threshold))
            ),
        )

    return [probe(i, name) for i, name in enumerate(names)]


def _anomaly_ratio(df: DataFrame, rule: QualityRule, tables: Any = None, as_of: Column | None = None) -> list[Probe]:
    params = {"max_ratio": ANOMALY_RATIO_LIMIT, "zscore_threshold": rule.params.get("threshold", 3.0), **rule.params}
    return _zscore(df, QualityRule(rule.rule_id, rule.rule_type, params, rule.version, rule.threshold, rule.severity), tables, as_of)


def _approximate_uniqueness(df: DataFrame, rule: QualityRule, *_: Any) -> list[Probe]:
    """Opt-in: distinct counts by sketch, within the fused pass."""

    def probe(names: list[str]) -> Probe:
        share = lambda get: _ratio(get("distinct"), get("total"))
        return Probe(
            rule,
            "_".join(names),
            {"distinct": F.approx_count_distinct(F.struct(*names), 0.01), "total": F.count("*")},
            lambda get: {"uniqueness_ratio": share(get), "duplicate_count": get("total") - get("distinct")},
            lambda get: share(get) >= rule.threshold,
        )

    return [probe(_as_list(entry)) for entry in rule.params["columns"]]


_FUSED: dict[str, Callable[..., list[Probe]]] = {
    "completeness": _completeness,
    "numeric": _numeric,
    "row_count": _row_count,
    "volume_check": _row_count,
    "null_check": _null_check,
    "business_rule": _business,
    "freshness": _freshness,
    "value_distribution": _distribution,
    "schema_check": _schema,
    "anomaly": _zscore,
    "anomaly_ratio": _anomaly_ratio,
    "approximate_uniqueness": _approximate_uniqueness,
}


def _result_rows(one_row: DataFrame, probes: Sequence[tuple[str, Probe]], table_name: str) -> DataFrame:
    rows = []
    for prefix, probe in probes:
        get = lambda name, prefix=prefix: F.col(prefix + name)
        rule = probe.rule
        passed = F.coalesce(probe.passed(get), F.lit(False))
        for metric, value in probe.metrics(get).items():
            cells = (
                F.lit(table_name), F.lit(rule.rule_id), F.lit(rule.version), F.lit(rule.rule_type),
                F.lit(rule.severity), F.lit(probe.target), F.lit(metric), value.cast("double"), passed,
            )
            rows.append(F.struct(*[cell.alias(name) for name, cell in zip(RESULT_COLUMNS, cells)]))
    return one_row.select(F.inline(F.array(*rows)))


def _fused(df: DataFrame, probes: Sequence[Probe], table_name: str) -> DataFrame:
    """One aggregate row for all probes, unpivoted into result rows."""
    named = [(f"p{i}_", probe) for i, probe in enumerate(probes)]
    measures = [c.alias(prefix + name) for prefix, probe in named for name, c in probe.aggregates.items()]
    return _result_rows(df.agg(*(measures or [F.count("*").alias("_rows")])), named, table_name)


def _uniqueness(df: DataFrame, rule: QualityRule, table_name: str, *_: Any) -> list[DataFrame]:
    """Rows per value combination are counted first, on the map side too, so repeated values
    shrink before the shuffle. NULL counts as a value."""
    parts = []
    for entry in rule.params["columns"]:
        names = _as_list(entry)
        folded = (
            df.groupBy(*names)
            .agg(F.count("*").alias("n"))
            .agg(F.count("*").alias("u_distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("u_total"))
        )
        share = lambda get: _ratio(get("distinct"), get("total"))
        probe = Probe(
            rule,
            "_".join(names),
            {},
            lambda get: {
                "uniqueness_ratio": share(get),
                "duplicate_count": get("total") - get("distinct"),
            },
            lambda get: share(get) >= rule.threshold,
        )
        parts.append(_result_rows(folded, [("u_", probe)], table_name))
    return parts


def _referential(
    df: DataFrame, rule: QualityRule, table_name: str, tables: Mapping[str, DataFrame], *_: Any
) -> list[DataFrame]:
    """Share of rows whose key exists in the target. Keys are folded before the join."""
    source_columns = _as_list(rule.params.get("source_columns") or rule.params.get("key_column"))
    parts = []
    for name in _as_list(rule.params.get("target_table") or rule.params.get("sources")):
        target_columns = _as_list(rule.params.get("target_columns")) or source_columns
        target = tables[name] if name in tables else df.sparkSession.read.table(name)
        counted = key_counts(df, target, source_columns, target_columns)
        row = counted.agg(
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("row_count"))), F.lit(0)).alias("r_orphans"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("r_total"),
        )
        share = lambda get: F.lit(1.0) - _ratio(get("orphans"), get("total"))
        probe = Probe(
            rule,
            f"{name}({','.join(target_columns)})",
            {},
            lambda get: {"integrity_ratio": share(get), "orphaned_count": get("orphans")},
            lambda get: share(get) >= rule.threshold,
        )
        parts.append(_result_rows(row, [("r_", probe)], table_name))
    return parts


def _detector(df: DataFrame, rule: QualityRule, table_name: str, *_: Any) -> list[DataFrame]:
    """An anomaly detector as a rule: it passes while no row is flagged."""
    body = dict(rule.params.get("config", {}))
    groups, features = body.pop("group_columns", None), body.pop("feature_columns", None)
    config = AnomalyConfig(**body)
    ties = _as_list(rule.params.get("tie_breakers")) or df.columns
    kind, date = rule.params["detector"], rule.params.get("date", "processing_date")
    runs: dict[str, Callable[[], DataFrame]] = {
        "volume": lambda: anomalies.volume(df, config),
        "processing_time": lambda: anomalies.processing_time(df, config, ties),
        "error_rate": lambda: anomalies.error_rate(df, config),
        "quality_failure": lambda: anomalies.quality_failure(df, config),
        "approval_rate": lambda: anomalies.approval_rate(df, config),
        "regional": lambda: anomalies.regional(df, config, ties),
        "employment_income": lambda: anomalies.employment_income(df, config, ties),
        "segment": lambda: anomalies.forest(df, features, ties, "is_segment_anomaly"),
        "isolation_forest": lambda: anomalies.forest(df, features, ties),
        "zscore": lambda: anomalies.zscore(df, rule.params["column"], config, ties, date),
        "iqr": lambda: anomalies.iqr(df, rule.params["column"], config, ties, date),
        "moving_average": lambda: anomalies.moving_average(df, rule.params["column"], config, ties, date),
        "group_pattern": lambda: anomalies.group_pattern(
            df, config, groups, features, ties, date
        ),
    }
    if kind not in runs:
        raise SpecError(f"unknown detector {kind!r} in rule {rule.rule_id}")
    found = runs[kind]()
    row = found.agg(F.count_if(anomalies.any_flag(found)).alias("d_flagged"), F.count("*").alias("d_total"))
    probe = Probe(
        rule,
        kind,
        {},
        lambda get: {"anomaly_count": get("flagged"), "total_rows": get("total")},
        lambda get: get("flagged") == 0,
    )
    return [_result_rows(row, [("d_", probe)], table_name)]


_SEPARATE: dict[str, Callable[..., list[DataFrame]]] = {
    "uniqueness": _uniqueness,
    "referential_integrity": _referential,
    "anomaly_detector": _detector,
}


def register_rule_type(name: str, compile_probes: Callable[..., list[Probe]]) -> None:
    """Add a rule type: ``compile_probes(df, rule, tables, as_of)`` returns its probes."""
    _FUSED[name] = compile_probes


def evaluate(
    df: DataFrame,
    rules: Sequence[QualityRule],
    table_name: str,
    tables: Mapping[str, DataFrame] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """The tidy result of all rules. ``tables`` resolves target tables by name before the
    catalog does; ``as_of`` replaces the clock."""
    probes: list[Probe] = []
    parts: list[DataFrame] = []
    for rule in rules:
        if rule.rule_type in _FUSED:
            probes += _FUSED[rule.rule_type](df, rule, tables or {}, as_of)
        elif rule.rule_type in _SEPARATE:
            parts += _SEPARATE[rule.rule_type](df, rule, table_name, tables or {})
        else:
            raise SpecError(f"unsupported rule type {rule.rule_type!r} in {rule.rule_id}")
    if probes:
        parts.insert(0, _fused(df, probes, table_name))
    if not parts:
        raise SpecError("no rule to evaluate")
    return reduce(DataFrame.unionByName, parts)


def verdicts(results: DataFrame) -> DataFrame:
    """One row per rule: passed only if all its targets passed."""
    return results.groupBy("table_name", "rule_id", "version", "rule_type", "severity").agg(
        F.bool_and("passed").alias("passed")
    )


def quality_score(results: DataFrame) -> DataFrame:
    """Share of passed rules per table."""
    return verdicts(results).groupBy("table_name").agg(F.avg(F.col("passed").cast("double")).alias("data_quality_score"))


def rule_counts(results: DataFrame) -> DataFrame:
    """Passed and failed targets per rule."""
    targets = results.select("table_name", "rule_id", "target", "passed").distinct()
    return targets.groupBy("table_name", "rule_id").agg(
        F.count_if("passed").alias("pass_count"), F.count_if(~F.col("passed")).alias("fail_count")
    )


def failed_rules(results: DataFrame) -> list[dict[str, Any]]:
    """The failed rules, for a gate; at most one entry per rule of the spec."""
    return [row.asDict() for row in verdicts(results).filter(~F.col("passed")).orderBy("rule_id").collect()]


def with_actions(results: DataFrame, actions: Mapping[str, str]) -> DataFrame:
    """``action`` of each failed rule by its severity (quarantine, alert or log)."""
    action = F.lit(None).cast("string")
    for severity, name in actions.items():
        action = F.when(F.col("severity") == severity, F.lit(name)).otherwise(action)
    return verdicts(results).withColumn("action", F.when(~F.col("passed"), action))


def row_tests(df: DataFrame, rules: Sequence[QualityRule]) -> dict[str, Column]:
    """For rules that judge single rows: ``rule_id:column`` to the condition of a bad row."""
    tests: dict[str, Column] = {}
    for rule in rules:
        if rule.rule_type == "completeness" or (
            rule.rule_type == "null_check" and "max_nulls_percentage" not in rule.params
        ):
            for name in _columns(rule):
                tests[f"{rule.rule_id}:{name}"] = missing(df, name, bool(rule.params.get("nan_is_missing", False)))
        elif rule.rule_type == "numeric":
            for name in _columns(rule):
                tests[f"{rule.rule_id}:{name}"] = out_of_bounds(
                    F.col(name), rule.params.get("min_value"), rule.params.get("max_value")
                )
        elif rule.rule_type == "business_rule":
            tests[f"{rule.rule_id}:condition"] = ~F.coalesce(F.expr(rule.params["condition"]), F.lit(False))
    return tests


def flag_rows(df: DataFrame, rules: Sequence[QualityRule]) -> DataFrame:
    """Add ``reasons``: what each row breaks; an empty array for a good row."""
    labels = [F.when(test, F.lit(label)) for label, test in row_tests(df, rules).items()]
    reasons = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    return df.withColumn("reasons", reasons)


def orphan_samples(
    df: DataFrame, target: DataFrame, source_columns: Sequence[str], target_columns: Sequence[str],
    order_by: Sequence[str], size: int = 5,
) -> DataFrame:
    """A few orphaned rows in a stable order, for the report."""
    return orphans(df, target, source_columns, target_columns).orderBy(*order_by).limit(size)


def zscore_samples(df: DataFrame, column: str, order_by: Sequence[str], k: float = 3.0, size: int = 5) -> DataFrame:
    """A few rows further than ``k`` deviations from the mean, for the report."""
    stats = df.agg(F.struct(F.avg(column).alias("a"), F.stddev_samp(column).alias("d"))).scalar()
    score = F.try_divide(F.abs(F.col(column) - stats.getField("a")), stats.getField("d"))
    return df.withColumn("zscore", score).filter(F.col("zscore") > k).orderBy(*order_by).limit(size)
