"""Detectors about a date, over streams: the rows of the batch detectors, a date at a time as it closes."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sediment.config import AnomalyConfig, SpecError
from sediment.operators.aggregates import rate
from sediment.operators.anomalies import SCORE_DIGITS

# Tasks get this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _scored(values: list[float], lookback: int, config: tuple) -> tuple:
    """Mean, sample deviation, score and flag of the last of ``values`` against the frame that ends with it."""
    threshold, min_samples, exclude, digits = config
    value = values[-1]
    frame = [v for v in (values[-lookback - 1 : -1] if exclude else values[-lookback - 1 :])]
    known = np.array([v for v in frame if v is not None], float)
    mean = float(known.mean()) if len(known) else None
    deviation = float(known.std(ddof=1)) if len(known) > 1 else None
    score = (value - mean) / deviation if deviation and value is not None else None
    flag = None if min_samples and len(frame) < min_samples else score is not None and round(abs(score), digits) > threshold
    return mean, deviation, score, flag


class DailyFrames(StatefulProcessor):
    """Per group the last ``lookback`` values; each further date is scored against them."""

    def __init__(self, incoming: list[str], columns: list[str], grouped: bool, lookback: int, config: tuple, expire_days: int | None):
        self.incoming, self.columns, self.grouped = incoming, columns, grouped
        self.lookback, self.config, self.expire_days = lookback, config, expire_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "values array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        values = list(self.held.get()[0]) if self.held.exists() else []
        # Columns arrive by place: the time, the day, the groups, the value.
        days = pd.concat([frame.set_axis(self.incoming, axis=1) for frame in rows]).sort_values("_day")
        out = []
        for day, value in zip(days["_day"], days["_value"], strict=True):
            values.append(None if pd.isna(value) else float(value))
            out.append((*(key if self.grouped else ()), day, values[-1], *_scored(values, self.lookback, self.config)))
            values = values[-self.lookback :] if self.lookback else []
        self.held.update((values,))
        if self.expire_days is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old if isinstance(old, int) else old[0])
            last = pd.Timestamp(days["_day"].iloc[-1]).value // 1_000_000
            self.handle.registerTimer(last + (self.expire_days + 1) * 86_400_000)
        yield pd.DataFrame(out, columns=self.columns).astype({self.columns[-1]: object})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def daily_stream(
    stream: DataFrame,
    config: AnomalyConfig,
    measure: Column,
    names: Mapping[str, str],
    ts: str,
    group_by: tuple[str, ...] = (),
    watermark: str = "1 day",
    expire_days: int | None = None,
) -> DataFrame:
    """A measure per date (and group) against the dates before it, as ``anomalies.date_detector`` gives with
    ``grain='date'``; ``ts`` is a timestamp and ``names`` are as there. Append mode.

    A first aggregation folds the rows of a date, on the map side first, so no group's rows meet in one task; it
    gives a date's value once the watermark has passed its end, and later rows of that date are dropped.
    Keyed state then holds the last ``lookback_window`` values of a group, whatever the rows. Dates come in order,
    so any split into batches gives the same rows. With ``expire_days`` a group without a date for so long is
    forgotten by an event-time timer, and starts anew; without it state stays for good. The session needs
    ``STATE_STORE`` as its state store provider, which this sets."""
    if config.detection_method != "zscore" or config.frame == "days":
        raise SpecError("dates of a stream are compared by z-score over a frame of dates")
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own = (config.threshold, config.min_samples, config.exclude_current, SCORE_DIGITS)
    groups = [f"_g{i}" for i in range(len(group_by))]
    keyed = stream.withColumns({n: F.col(f"`{g}`") for n, g in zip(groups, group_by, strict=True)}).withWatermark(ts, watermark)
    daily = keyed.groupBy(F.window(ts, "1 day").alias("_w"), *groups).agg(measure.cast("double").alias("_value"))
    daily = daily.select(F.window_time("_w").alias("_at"), F.col("_w.start").cast("date").alias("_day"), *groups, "_value")
    keys = groups or ["_all"]
    kinds = [T.StructField(g, stream.schema[g].dataType) for g in group_by]
    made = [T.StructField(names[k], T.DoubleType()) for k in ("value", "mean", "deviation", "score")]
    schema = T.StructType([*kinds, T.StructField("_day", T.DateType()), *made, T.StructField(names["flag"], T.BooleanType())])
    daily = daily.withColumn("_all", F.lit(True))
    frames = DailyFrames(daily.columns, schema.fieldNames(), bool(groups), config.lookback_window, own, expire_days)
    mode = "None" if expire_days is None else "EventTime"
    return daily.groupBy(*keys).transformWithStateInPandas(frames, schema, "append", mode)


def volume_stream(stream: DataFrame, config: AnomalyConfig, ts: str, group_by: tuple[str, ...] = (), watermark: str = "1 day", expire_days: int | None = None) -> DataFrame:
    """Rows per date, as ``anomalies.volume``."""
    names = dict(value="volume", mean="avg_volume", deviation="stddev_volume", score="volume_zscore", flag="is_volume_anomaly")
    return daily_stream(stream, config, F.count("*"), names, ts, group_by, watermark, expire_days)


def rate_stream(
    stream: DataFrame, config: AnomalyConfig, ts: str, test: Column, name: str, group_by: tuple[str, ...] = (), watermark: str = "1 day", expire_days: int | None = None
) -> DataFrame:
    """The share of rows per date for which ``test`` holds, as ``anomalies.error_rate`` and its like."""
    names = dict(value=name, mean=f"avg_{name}", deviation=f"stddev_{name}", score=f"{name}_zscore", flag=f"is_{name}_anomaly")
    return daily_stream(stream, config, rate(test), names, ts, group_by, watermark, expire_days)
