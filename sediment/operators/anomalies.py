"""Anomaly detectors.

Detectors about a date (volume, rates) first fold the rows to one per date, or per group and
date, roll over that small frame and join the outcome back. Detectors about a row roll over
the rows themselves by :mod:`sediment.operators.rolling`. A score is (x - mean) / deviation
over the frame, NULL where the deviation is zero or missing, and then the flag is false.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sediment.config import AnomalyConfig, SpecError
from sediment.functions.text import epoch_seconds_between
from sediment.operators import isolation_forest
from sediment.operators.aggregates import rate
from sediment.operators.rolling import (
    Blocks,
    blocks,
    frame_bounds,
    rank_quantile,
    rolling_avg,
    rolling_count,
    rolling_sorted,
    rolling_stddev,
)
from sediment.session import materialize


def _zscore(value: str, mean: str, deviation: str) -> Column:
    return F.try_divide(F.col(value) - F.col(mean), F.col(deviation))


# Scores are compared after rounding to so many digits: a score of exactly the threshold must not turn
# on the last bit of a sum, which depends on the order in which it was taken.
SCORE_DIGITS = 9


def _beyond(score: Column, limit: float) -> Column:
    return F.round(F.abs(score), SCORE_DIGITS) > limit


def _flag(test: Column, config: AnomalyConfig, seen: Column | None = None) -> Column:
    """False where the test is unknown; NULL where the frame has fewer than ``min_samples``."""
    known = F.coalesce(test, F.lit(False))
    return F.when(seen >= config.min_samples, known) if config.min_samples and seen is not None else known


def _join_back(df: DataFrame, frame: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Attach a folded frame to its rows. The frame is a written table: Spark broadcasts it by the
    size of its file, and otherwise splits hot keys of the join."""
    renamed = frame.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [key.eqNullSafe(F.col(f"_j_{name}")) for name, key in keys.items()])
    return df.join(renamed, condition, "left").drop(*[f"_j_{k}" for k in keys])


def date_detector(
    df: DataFrame,
    config: AnomalyConfig,
    measure: Column,
    names: Mapping[str, str],
    date: str,
    group_by: Sequence[str] = (),
    grain: str = "row",
) -> DataFrame:
    """A measure per date (and group) against the dates before it. ``names`` gives the output columns
    ``value``, ``mean``, ``deviation``, ``score`` and ``flag``. The score is a z-score, with the method
    ``moving_average`` the relative distance from the mean, and with ``iqr`` the distance beyond the
    quartiles in their spread. ``grain='date'`` returns the folded frame."""
    if config.detection_method == "isolation_forest":
        raise SpecError("a measure per date has no isolation forest")
    day = F.col(date).cast("date")
    folded = df.groupBy(*group_by, day.alias("_day")).agg(measure.alias(names["value"]))
    # The ungrouped frame has a row per calendar date, so one task can order it.
    window = Window.partitionBy(*group_by).orderBy("_day").rowsBetween(
        *frame_bounds(config.lookback_window, config.exclude_current)
    )
    frame = folded.withColumns(
        {
            names["mean"]: F.avg(names["value"]).over(window),
            names["deviation"]: F.stddev_samp(names["value"]).over(window),
            "_seen": F.count("*").over(window),
        }
    )
    value, mean = F.col(names["value"]), F.col(names["mean"])
    if config.detection_method == "moving_average":
        frame = frame.withColumn(names["score"], F.try_divide(F.abs(value - mean), mean))
    elif config.detection_method == "iqr":
        frame = frame.withColumn("_held", rolling_sorted(F.col(names["value"]))(window))
        q1, q3 = rank_quantile(F.col("_held"), 0.25), rank_quantile(F.col("_held"), 0.75)
        beyond = F.greatest(q1 - value, value - q3, F.lit(0))
        frame = frame.withColumn(names["score"], F.try_divide(beyond, q3 - q1)).drop("_held")
    else:
        frame = frame.withColumn(names["score"], _zscore(names["value"], names["mean"], names["deviation"]))
    limit = config.sensitivity if config.detection_method == "iqr" else config.threshold
    test = _beyond(F.col(names["score"]), limit)
    frame = frame.withColumn(names["flag"], _flag(test, config, F.col("_seen"))).drop("_seen")
    if grain == "date":
        return frame.withColumnRenamed("_day", date)
    keys = {**{g: F.col(g) for g in group_by}, "_day": day}
    return _join_back(df, materialize(frame, "daily"), keys)


def _names(value: str, mean: str, deviation: str, score: str, flag: str) -> dict[str, str]:
    return dict(value=value, mean=mean, deviation=deviation, score=score, flag=flag)


def volume(df: DataFrame, config: AnomalyConfig, date: str = "processing_date", grain: str = "row") -> DataFrame:
    names = _names("volume", "avg_volume", "stddev_volume", "volume_zscore", "is_volume_anomaly")
    return date_detector(df, config, F.count("*"), names, date, grain=grain)


def error_rate(
    df: DataFrame,
    config: AnomalyConfig,
    date: str = "processing_date",
    status: str = "status",
    bad: str = "ERROR",
    grain: str = "row",
) -> DataFrame:
    names = _names(
        "error_rate", "avg_error_rate", "stddev_error_rate", "error_rate_zscore", "is_error_rate_anomaly"
    )
    return date_detector(df, config, rate(F.col(status) == bad), names, date, grain=grain)


def quality_failure(
    df: DataFrame,
    config: AnomalyConfig,
    date: str = "check_date",
    kind: str = "check_type",
    status: str = "check_status",
    bad: str = "FAILED",
    grain: str = "row",
) -> DataFrame:
    """Failure rate per date and check type, rolled within the type."""
    names = _names(
        "failure_rate",
        "avg_failure_rate",
        "stddev_failure_rate",
        "failure_pattern_score",
        "is_failure_pattern_anomaly",
    )
    return date_detector(df, config, rate(F.col(status) == bad), names, date, [kind], grain)


def approval_rate(
    df: DataFrame,
    config: AnomalyConfig,
    date: str = "processing_date",
    state: str = "state",
    status: str = "status",
    good: str = "APPROVED",
    grain: str = "row",
) -> DataFrame:
    names = _names(
        "approval_rate",
        "avg_approval_rate",
        "stddev_approval_rate",
        "approval_rate_zscore",
        "is_approval_rate_anomaly",
    )
    return date_detector(df, config, rate(F.col(status) == good), names, date, [state], grain)


@dataclass(frozen=True)
class Measure:
    """What a detector rolls over the rows, and what it makes of it. Measures that share an
    order are computed in one pass. ``moments`` names the column and its mean and deviation
    where these are all that is rolled; ``quantiles`` a column, and fractions by the names of their results."""

    columns: Mapping[str, Callable[[WindowSpec], Column]]
    finish: Callable[[DataFrame], DataFrame]
    moments: tuple[str, str, str] | None = None
    quantiles: tuple[str, Mapping[str, float]] | None = None


def _seen(config: AnomalyConfig) -> Column | None:
    return F.col("_seen") if config.min_samples else None


def zscore_measure(column: str, config: AnomalyConfig, names: Mapping[str, str]) -> Measure:
    def finish(rolled: DataFrame) -> DataFrame:
        scored = rolled.withColumn(names["score"], _zscore(column, names["mean"], names["deviation"]))
        test = _beyond(F.col(names["score"]), config.threshold)
        return scored.withColumn(names["flag"], _flag(test, config, _seen(config)))

    value = F.col(column)
    columns = {names["mean"]: rolling_avg(value), names["deviation"]: rolling_stddev(value)}
    return Measure(columns, finish, (column, names["mean"], names["deviation"]))


def iqr_measure(column: str, config: AnomalyConfig, names: Mapping[str, str]) -> Measure:
    """Outside [q1 - s * iqr, q3 + s * iqr] of the frame."""

    def finish(rolled: DataFrame) -> DataFrame:
        quarters = rolled.withColumn(names["iqr"], F.col(names["q3"]) - F.col(names["q1"]))
        reach = F.lit(config.sensitivity) * F.col(names["iqr"])
        test = (F.col(column) < F.col(names["q1"]) - reach) | (F.col(column) > F.col(names["q3"]) + reach)
        return quarters.withColumn(names["flag"], _flag(test, config, _seen(config)))

    return Measure({}, finish, quantiles=(column, {names["q1"]: 0.25, names["q3"]: 0.75}))


def moving_average_measure(column: str, config: AnomalyConfig, names: Mapping[str, str]) -> Measure:
    """Relative distance from the frame's mean."""

    def finish(rolled: DataFrame) -> DataFrame:
        mean = F.col(names["mean"])
        moved = rolled.withColumn(names["score"], F.try_divide(F.abs(F.col(column) - mean), mean))
        return moved.withColumn(names["flag"], _flag(_beyond(F.col(names["score"]), config.threshold), config, _seen(config)))

    return Measure({names["mean"]: rolling_avg(F.col(column))}, finish, (column, names["mean"], "_deviation"))


def roll_measures(
    df: DataFrame | Blocks,
    config: AnomalyConfig,
    measures: Sequence[Measure],
    order_by: Sequence[str],
    tie_breakers: Sequence[str],
    group_by: Sequence[str] = (),
) -> DataFrame:
    if config.frame == "days":
        return _roll_days(df, config, measures, order_by[0], group_by)
    columns = {name: make for measure in measures for name, make in measure.columns.items()}
    if config.min_samples:
        columns["_seen"] = rolling_count()
    cut = df if isinstance(df, Blocks) else blocks(df, order_by, config.lookback_window, tie_breakers, group_by)
    for measure in measures:
        if measure.quantiles:
            cut = cut.with_quantiles(*measure.quantiles, config.exclude_current)
    out = cut.roll(columns, config.exclude_current)
    for measure in measures:
        out = measure.finish(out)
    return out.drop("_seen")


def _roll_days(
    df: DataFrame, config: AnomalyConfig, measures: Sequence[Measure], date: str, group_by: Sequence[str]
) -> DataFrame:
    """Frames of ``lookback_window`` days instead of rows. All rows of a date share a frame, so
    count, sum and square sum per date are enough: they are rolled over the dates and joined
    back. Values are taken relative to the overall mean, which keeps the squares small."""
    if isinstance(df, Blocks) or any(m.moments is None for m in measures):
        raise SpecError("a frame of days works for means and deviations over a plain frame")
    columns = list(dict.fromkeys(m.moments[0] for m in measures))
    centre = df.agg(F.struct(*[F.avg(c).alias(f"c{i}") for i, c in enumerate(columns)])).scalar()
    day = F.col(date).cast("date")
    sums = [F.count("*").alias("_rows")]
    for i, c in enumerate(columns):
        off = F.col(c) - centre.getField(f"c{i}")
        sums += [F.count(c).alias(f"_n{i}"), F.sum(off).alias(f"_s{i}"), F.sum(off * off).alias(f"_q{i}")]
    daily = df.groupBy(*group_by, day.alias("_day")).agg(*sums).withColumn("_number", F.unix_date("_day"))
    last = -1 if config.exclude_current else 0
    window = Window.partitionBy(*group_by).orderBy("_number").rangeBetween(-config.lookback_window, last)
    rolled = {"_seen": F.coalesce(F.sum("_rows").over(window), F.lit(0))}
    for measure in measures:
        column, mean, deviation = measure.moments
        i = columns.index(column)
        n, s, q = (F.sum(f"_{part}{i}").over(window) for part in "nsq")
        spread = F.try_divide(q - F.try_divide(s * s, n), n - 1)
        rolled[mean] = centre.getField(f"c{i}") + F.try_divide(s, n)
        # What is left of equal values after rounding is no spread.
        rolled[deviation] = F.when(n > 1, F.when(spread > q / n * F.lit(1e-13), F.sqrt(spread)).otherwise(F.lit(0.0)))
    frame = daily.select(*group_by, "_day", *[value.alias(name) for name, value in rolled.items()])
    keys = {**{g: F.col(g) for g in group_by}, "_day": day}
    out = _join_back(df, materialize(frame, "daily"), keys)
    for measure in measures:
        out = measure.finish(out)
    return out.drop("_seen", "_deviation")


def processing_time(
    df: DataFrame,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    start: str = "start_time",
    end: str = "end_time",
) -> DataFrame:
    names = _names("processing_time", "avg_time", "stddev_time", "time_zscore", "is_time_anomaly")
    timed = df.withColumn("processing_time", epoch_seconds_between(F.col(start), F.col(end)))
    return roll_measures(timed, config, [zscore_measure("processing_time", config, names)], [start], tie_breakers)


def regional(
    df: DataFrame,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    date: str = "processing_date",
    region: str = "region",
    amount: str = "amount",
) -> DataFrame:
    names = dict(q1="q1", q3="q3", iqr="iqr", flag="is_regional_anomaly")
    value = F.col(amount)
    level = Measure({"avg_amount": rolling_avg(value), "stddev_amount": rolling_stddev(value)}, lambda rolled: rolled)
    return roll_measures(df, config, [level, iqr_measure(amount, config, names)], [date], tie_breakers, [region])


def employment_income(
    df: DataFrame,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    date: str = "processing_date",
    group: str = "employment_status",
    income: str = "income",
) -> DataFrame:
    names = _names(income, "avg_income", "stddev_income", "income_zscore", "is_employment_income_anomaly")
    return roll_measures(df, config, [zscore_measure(income, config, names)], [date], tie_breakers, [group])


def _generic(method: str, column: str, config: AnomalyConfig) -> Measure:
    """A method on any column; the output columns carry the column's name."""
    if method == "zscore":
        names = _names(
            column, f"avg_{column}", f"stddev_{column}", f"{column}_zscore", f"is_{column}_zscore_anomaly"
        )
        return zscore_measure(column, config, names)
    if method == "iqr":
        names = dict(q1=f"q1_{column}", q3=f"q3_{column}", iqr=f"iqr_{column}", flag=f"is_{column}_iqr_anomaly")
        return iqr_measure(column, config, names)
    names = dict(mean=f"ma_{column}", score=f"{column}_ma_diff", flag=f"is_{column}_ma_anomaly")
    return moving_average_measure(column, config, names)


def zscore(
    df: DataFrame | Blocks,
    column: str,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    date: str = "processing_date",
    group_by: Sequence[str] = (),
) -> DataFrame:
    return roll_measures(df, config, [_generic("zscore", column, config)], [date], tie_breakers, group_by)


def iqr(
    df: DataFrame | Blocks,
    column: str,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    date: str = "processing_date",
    group_by: Sequence[str] = (),
) -> DataFrame:
    return roll_measures(df, config, [_generic("iqr", column, config)], [date], tie_breakers, group_by)


def moving_average(
    df: DataFrame | Blocks,
    column: str,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    date: str = "processing_date",
    group_by: Sequence[str] = (),
) -> DataFrame:
    return roll_measures(df, config, [_generic("moving_average", column, config)], [date], tie_breakers, group_by)


def forest(
    df: DataFrame,
    features: Sequence[str],
    row_id: Sequence[str],
    flag: str = "is_isolation_forest_anomaly",
    contamination: float = 0.1,
    **options: int,
) -> DataFrame:
    return isolation_forest.detect(df, features, row_id, flag, contamination, **options)


def group_pattern(
    df: DataFrame,
    config: AnomalyConfig,
    group_by: Sequence[str],
    features: Sequence[str],
    tie_breakers: Sequence[str],
    date: str = "processing_date",
) -> DataFrame:
    """The configured method on every feature column, within the groups.

    The forest method takes the features together and grows a forest for each group. Of a group's rows the
    share above ``threshold`` is flagged (0.95: the highest 5 percent); a group with fewer than ``min_samples``
    rows has NULL scores and flags.
    """
    if config.detection_method == "isolation_forest":
        if not 0 < config.threshold < 1:
            raise SpecError("a forest's threshold is the share of rows it leaves alone, between 0 and 1")
        share = round(1.0 - config.threshold, 9)
        return isolation_forest.detect_groups(df, group_by, features, tie_breakers, contamination=share, min_samples=config.min_samples)
    measures = [_generic(config.detection_method, feature, config) for feature in features]
    return roll_measures(df, config, measures, [date], tie_breakers, group_by)


def flags(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("is_") and c.endswith("anomaly")]


def any_flag(df: DataFrame) -> Column:
    names = flags(df)
    if not names:
        raise SpecError("the frame has no anomaly flag")
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in names])


def detect_all(
    df: DataFrame,
    config: AnomalyConfig,
    tie_breakers: Sequence[str],
    amount: str = "amount",
    features: Sequence[str] = ("amount", "credit_score", "income"),
    segment_features: Sequence[str] = ("credit_score", "income", "debt_ratio"),
    narrow: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """Run every detector whose columns exist. Returns the frames by name, and the columns
    that the skipped ones lack. With ``narrow`` a frame has all rows, but of the columns only the tie breakers and
    those of its detector, so that others are not carried through its sorts."""
    ties = list(tie_breakers)

    def rows(needed: Sequence[str]) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*ties, *needed])]) if narrow else df

    # Three detectors roll over the same order, so they share one sorted and numbered table.
    ordered: DataFrame | Blocks = df
    if {"processing_date", amount} <= set(df.columns):
        ordered = blocks(rows(["processing_date", amount]), ["processing_date"], config.lookback_window, ties)
    plan: dict[str, tuple[Sequence[str], Callable[[DataFrame], DataFrame]]] = {
        "volume": (["processing_date"], lambda own: volume(own, config)),
        "processing_time": (["start_time", "end_time"], lambda own: processing_time(own, config, ties)),
        "error_rate": (["processing_date", "status"], lambda own: error_rate(own, config)),
        "quality_failure": (["check_date", "check_type", "check_status"], lambda own: quality_failure(own, config)),
        "regional": (["region", "processing_date", "amount"], lambda own: regional(own, config, ties)),
        "segment": (segment_features, lambda own: forest(own, segment_features, ties, "is_segment_anomaly")),
        "employment_income": (
            ["employment_status", "processing_date", "income"],
            lambda own: employment_income(own, config, ties),
        ),
        "approval_rate": (["state", "processing_date", "status"], lambda own: approval_rate(own, config)),
        "zscore": (["processing_date", amount], lambda _: zscore(ordered, amount, config, ties)),
        "iqr": (["processing_date", amount], lambda _: iqr(ordered, amount, config, ties)),
        "isolation_forest": (features, lambda own: forest(own, features, ties)),
        "moving_average": (["processing_date", amount], lambda _: moving_average(ordered, amount, config, ties)),
    }
    found, skipped = {}, {}
    for name, (needed, run) in plan.items():
        lacking = [c for c in needed if c not in df.columns]
        if lacking:
            skipped[name] = lacking
        else:
            found[name] = run(rows(needed))
    return found, skipped


def summary(results: Mapping[str, DataFrame], detected_at: Column | None = None) -> DataFrame:
    """Rows and flagged rows per detector, one aggregate each, in one frame."""
    stamp = F.current_timestamp() if detected_at is None else detected_at
    parts = [
        frame.agg(F.count("*").alias("total_records"), F.count_if(any_flag(frame)).alias("anomaly_count")).select(
            F.lit(name).alias("detector"), "total_records", "anomaly_count", stamp.alias("detection_timestamp")
        )
        for name, frame in results.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Detectors whose findings have an event kind of their own.
OWN_KINDS = ("volume", "processing_time", "error_rate", "quality_failure")


def combine(results: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Long form of several detectors: detector, key columns, score where one exists, flag."""
    parts = []
    for name, frame in results.items():
        scores = [c for c in frame.columns if c.endswith(("_zscore", "_score", "_ma_diff"))]
        score = F.col(scores[0]).cast("double") if scores else F.lit(None).cast("double")
        parts.append(
            frame.select(
                F.lit(name).alias("detector"), *keys, score.alias("score"), any_flag(frame).alias("is_anomaly")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def detection_events(combined: DataFrame, keys: Sequence[str], severity: str = "high") -> DataFrame:
    """A row per finding for the detections table: type, severity, score and details as JSON."""
    kind = F.when(F.col("detector").isin(*OWN_KINDS), F.col("detector")).otherwise("group_pattern")
    return combined.filter("is_anomaly").select(
        kind.alias("detection_type"),
        F.lit(severity).alias("severity"),
        "score",
        F.to_json(F.struct("detector", *keys)).alias("details"),
    )
