"""Anomaly detectors over whole tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import AnomalyConfig, rules_from_spec
from sediment.operators import anomalies, isolation_forest, quality
from sediment.operators.selection import flag_highest, rows_of_share
from sediment.plans.queries.registry import query, rounded, table
from sediment.session import materialize

# Thresholds lie off the values that scores of few equal rates take exactly, such as 1.5 and 2,
# where the last bit of a sum would decide.
WEEK = AnomalyConfig(lookback_window=7, threshold=1.6)
MONTH = AnomalyConfig(lookback_window=30, threshold=3.0)

EVENTS_SQL = """(select event_id, user_id, value, event_type, cast(ts as date) as processing_date,
  case event_type when 'error' then 'ERROR' else 'OK' end as status from events)"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(
        "event_id",
        "user_id",
        "value",
        "event_type",
        "cast(ts as date) as processing_date",
        "if(event_type = 'error', 'ERROR', 'OK') as status",
    )


ORDERS_SQL = """(select o_orderkey, o_totalprice as amount, n_name as region, n_name as state, o_orderdate as processing_date,
  c_mktsegment as employment_status, case o_orderstatus when 'F' then 'APPROVED' else 'REJECTED' end as status
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "orders")
        .join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "o_orderkey",
            "o_totalprice as amount",
            "n_name as region",
            "n_name as state",
            "o_orderdate as processing_date",
            "c_mktsegment as employment_status",
            "if(o_orderstatus = 'F', 'APPROVED', 'REJECTED') as status",
        )
    )


def _date_sql(
    measure: str, value: str, mean: str, deviation: str, score: str, flag: str, source: str, key: str,
    group: str = "", day: str = "processing_date", lookback: int = 7, threshold: float = 1.6,
) -> str:
    groups = f"{group}, " if group else ""
    on_group = f" and f.{group} = r.{group}" if group else ""
    part = f"partition by {group} " if group else ""
    return f"""
with rows_in as (select * from {source}),
daily as (select {groups}cast({day} as date) as day, {measure} as {value} from rows_in group by all),
rolled as (select *, avg({value}) over w as {mean}, stddev_samp({value}) over w as {deviation} from daily
  window w as ({part}order by day rows between {lookback} preceding and current row)),
f as (select *, case when {deviation} > 0 then ({value} - {mean}) / {deviation} end as {score} from rolled)
select r.{key}, round(f.{value}, 6) as {value}, round({mean}, 6) as {mean}, round({deviation}, 6) as {deviation},
       round({score}, 6) as {score}, coalesce(round(abs({score}), 9) > {threshold}, false) as {flag}
from rows_in r join f on f.day = cast(r.{day} as date){on_group}"""


def _out(df: DataFrame, key: str, value: str, mean: str, deviation: str, score: str, flag: str) -> DataFrame:
    return rounded(df.select(key, value, mean, deviation, score, flag), [value, mean, deviation, score])


VOLUME = ("volume", "avg_volume", "stddev_volume", "volume_zscore", "is_volume_anomaly")


@query("an_volume", _date_sql("count(*)", *VOLUME, EVENTS_SQL, "event_id"))
def an_volume(spark: SparkSession, d: str) -> DataFrame:
    return _out(anomalies.volume(_events(spark, d), WEEK), "event_id", *VOLUME)


@query(
    "an_volume_daily",
    """with daily as (select cast(ts as date) as day, count(*) as volume from events group by 1),
            rolled as (select *, avg(volume) over w as a, stddev_samp(volume) over w as s from daily
                       window w as (order by day rows between 7 preceding and 1 preceding))
       select cast(day as varchar) as processing_date, volume, round(case when s > 0 then (volume - a) / s end, 6) as volume_zscore,
              coalesce(abs(case when s > 0 then (volume - a) / s end) > 1.6, false) as is_volume_anomaly from rolled""",
)
def an_volume_daily(spark: SparkSession, d: str) -> DataFrame:
    """One row per date, with the date kept out of its own frame."""
    config = AnomalyConfig(lookback_window=7, threshold=1.6, exclude_current=True)
    out = anomalies.volume(_events(spark, d), config, grain="date").select(
        F.col("processing_date").cast("string").alias("processing_date"), "volume", "volume_zscore", "is_volume_anomaly"
    )
    return rounded(out, ["volume_zscore"])


ERRORS = ("error_rate", "avg_error_rate", "stddev_error_rate", "error_rate_zscore", "is_error_rate_anomaly")


@query(
    "an_error_rate",
    _date_sql("count(*) filter (where status = 'ERROR')::double / count(*)", *ERRORS, EVENTS_SQL, "event_id"),
)
def an_error_rate(spark: SparkSession, d: str) -> DataFrame:
    return _out(anomalies.error_rate(_events(spark, d), WEEK), "event_id", *ERRORS)


FAILURES = (
    "failure_rate", "avg_failure_rate", "stddev_failure_rate", "failure_pattern_score", "is_failure_pattern_anomaly",
)
CHECKS_SQL = """(select event_id, cast(ts as date) as check_date, event_type as check_type,
  case when value > 40 then 'FAILED' else 'PASSED' end as check_status from events)"""


@query(
    "an_failure_rate",
    _date_sql(
        "count(*) filter (where check_status = 'FAILED')::double / count(*)", *FAILURES, CHECKS_SQL, "event_id",
        "check_type", "check_date",
    ),
)
def an_failure_rate(spark: SparkSession, d: str) -> DataFrame:
    checks = table(spark, d, "events").selectExpr(
        "event_id",
        "cast(ts as date) as check_date",
        "event_type as check_type",
        "if(value > 40, 'FAILED', 'PASSED') as check_status",
    )
    return _out(anomalies.quality_failure(checks, WEEK), "event_id", *FAILURES)


APPROVALS = (
    "approval_rate", "avg_approval_rate", "stddev_approval_rate", "approval_rate_zscore", "is_approval_rate_anomaly",
)


@query(
    "an_approval_rate",
    _date_sql(
        "count(*) filter (where status = 'APPROVED')::double / count(*)", *APPROVALS, ORDERS_SQL, "o_orderkey", "state",
        lookback=30, threshold=1.9,
    ),
)
def an_approval_rate(spark: SparkSession, d: str) -> DataFrame:
    config = AnomalyConfig(lookback_window=30, threshold=1.9)
    return _out(anomalies.approval_rate(_orders(spark, d), config), "o_orderkey", *APPROVALS)


def _row_sql(
    column: str, mean: str, deviation: str, score: str, flag: str, source: str, key: str, order: str,
    group: str = "", lookback: int = 30, threshold: float = 3.0, digits: tuple[int, int, int] = (6, 6, 6),
) -> str:
    """``digits`` of mean, deviation and score leave room for the last bits of large amounts."""
    part = f"partition by {group} " if group else ""
    return f"""
select {key}, {column}, round(a, {digits[0]}) as {mean}, round(s, {digits[1]}) as {deviation}, round(z, {digits[2]}) as {score},
       coalesce(round(abs(z), 9) > {threshold}, false) as {flag}
from (select *, case when s > 0 then ({column} - a) / s end as z from (
  select *, avg({column}) over w as a, stddev_samp({column}) over w as s from {source}
  window w as ({part}order by {order} rows between {lookback} preceding and current row)))"""


TIMES = ("avg_time", "stddev_time", "time_zscore", "is_time_anomaly")
SHIPPING_SQL = """(select o_orderkey, o_orderdate as start_time, max(l_shipdate) as end_time,
  epoch(max(l_shipdate))::bigint - epoch(o_orderdate)::bigint as processing_time
  from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)"""


@query(
    "an_processing_time",
    _row_sql("processing_time", *TIMES, SHIPPING_SQL, "o_orderkey", "start_time, o_orderkey", threshold=2.5, digits=(2, 2, 6)),
)
def an_processing_time(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("end_time"))
    shipping = (
        table(spark, d, "orders")
        .join(last, F.expr("o_orderkey = l_orderkey"))
        .selectExpr("o_orderkey", "o_orderdate as start_time", "end_time")
    )
    config = AnomalyConfig(lookback_window=30, threshold=2.5)
    out = anomalies.processing_time(shipping, config, ["o_orderkey"])
    out = out.select("o_orderkey", "processing_time", *TIMES)
    return rounded(rounded(out, list(TIMES[:2]), 2), [TIMES[2]])


ZSCORE = ("avg_value", "stddev_value", "value_zscore", "is_value_zscore_anomaly")


@query("an_zscore", _row_sql("value", *ZSCORE, EVENTS_SQL, "event_id", "processing_date, event_id"))
def an_zscore(spark: SparkSession, d: str) -> DataFrame:
    out = anomalies.zscore(_events(spark, d), "value", MONTH, ["event_id"])
    return rounded(out.select("event_id", "value", *ZSCORE), list(ZSCORE[:3]))


ITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "an_zscore_lineitem",
    """select sum(case when coalesce(abs(z) > 3, false) then 1 else 0 end)::bigint as anomaly_count, count(*) as total_records,
              round(avg(a), 4) as mean_avg
       from (select a, case when s > 0 then (l_extendedprice - a) / s end as z from (
         select l_extendedprice, avg(l_extendedprice) over w as a, stddev_samp(l_extendedprice) over w as s from lineitem
         window w as (order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
                      rows between 30 preceding and current row)))""",
)
def an_zscore_lineitem(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select("l_shipdate", *ITEM_KEYS)
    out = anomalies.zscore(items, "l_extendedprice", MONTH, ITEM_KEYS, date="l_shipdate")
    return out.agg(
        F.count_if("is_l_extendedprice_zscore_anomaly").alias("anomaly_count"),
        F.count("*").alias("total_records"),
        F.round(F.avg("avg_l_extendedprice"), 4).alias("mean_avg"),
    )


INCOME = ("avg_income", "stddev_income", "income_zscore", "is_employment_income_anomaly")
INCOME_SQL = f"(select o_orderkey, employment_status, processing_date, amount as income from {ORDERS_SQL})"


@query(
    "an_group_zscore",
    _row_sql(
        "income", *INCOME, INCOME_SQL, "o_orderkey", "processing_date, o_orderkey", "employment_status", threshold=2.0,
        digits=(6, 3, 6),
    ),
)
def an_group_zscore(spark: SparkSession, d: str) -> DataFrame:
    people = _orders(spark, d).select("o_orderkey", "employment_status", "processing_date", F.col("amount").alias("income"))
    config = AnomalyConfig(lookback_window=30, threshold=2.0)
    out = anomalies.employment_income(people, config, ["o_orderkey"])
    out = out.select("o_orderkey", "income", *INCOME)
    return rounded(rounded(out, [INCOME[0], INCOME[2]]), [INCOME[1]], 3)


def _iqr_sql(column: str, source: str, key: str, order: str, names: tuple, group: str = "", extra: str = "") -> str:
    part = f"partition by {group} " if group else ""
    q1, q3, iqr, flag = names
    return f"""
select {key}, {column}, {extra}q1 as {q1}, q3 as {q3}, q3 - q1 as {iqr},
       coalesce({column} < q1 - 1.5 * (q3 - q1) or {column} > q3 + 1.5 * (q3 - q1), false) as {flag}
from (select *, quantile_disc({column}, 0.25) over w as q1, quantile_disc({column}, 0.75) over w as q3,
             avg({column}) over w as a, stddev_samp({column}) over w as s from {source}
      window w as ({part}order by {order} rows between 30 preceding and current row))"""


IQR = AnomalyConfig(detection_method="iqr", lookback_window=30, sensitivity=1.5)
VALUE_IQR = ("q1_value", "q3_value", "iqr_value", "is_value_iqr_anomaly")


@query("an_iqr", _iqr_sql("value", EVENTS_SQL, "event_id", "processing_date, event_id", VALUE_IQR))
def an_iqr(spark: SparkSession, d: str) -> DataFrame:
    return anomalies.iqr(_events(spark, d), "value", IQR, ["event_id"]).select("event_id", "value", *VALUE_IQR)


@query(
    "an_iqr_long",
    """select o_orderkey, q1 as q1_amount, q3 as q3_amount, coalesce(amount < q1 - 0.5 * (q3 - q1) or amount > q3 + 0.5 * (q3 - q1), false) as is_amount_iqr_anomaly
       from (select o_orderkey, o_totalprice as amount, quantile_disc(o_totalprice, 0.25) over w as q1, quantile_disc(o_totalprice, 0.75) over w as q3
             from orders window w as (order by o_orderdate, o_orderkey rows between 2000 preceding and current row))""",
)
def an_iqr_long(spark: SparkSession, d: str) -> DataFrame:
    """Quartiles over 2,001 rows for every order."""
    config = AnomalyConfig(detection_method="iqr", lookback_window=2000, sensitivity=0.5)
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "o_totalprice as amount", "o_orderdate as processing_date")
    return anomalies.iqr(orders, "amount", config, ["o_orderkey"]).select("o_orderkey", "q1_amount", "q3_amount", "is_amount_iqr_anomaly")


REGION_IQR = ("q1", "q3", "iqr", "is_regional_anomaly")


@query(
    "an_region_iqr",
    _iqr_sql(
        "amount", ORDERS_SQL, "o_orderkey", "processing_date, o_orderkey", REGION_IQR, "region",
        "round(a, 6) as avg_amount, round(s, 3) as stddev_amount, ",
    ),
)
def an_region_iqr(spark: SparkSession, d: str) -> DataFrame:
    out = anomalies.regional(_orders(spark, d), IQR, ["o_orderkey"])
    out = out.select("o_orderkey", "amount", "avg_amount", "stddev_amount", *REGION_IQR)
    return rounded(rounded(out, ["avg_amount"]), ["stddev_amount"], 3)


@query(
    "an_moving_avg",
    f"""select event_id, round(a, 6) as ma_value, round(abs(value - a) / nullif(a, 0), 6) as value_ma_diff,
              coalesce(abs(value - a) / nullif(a, 0) > 2.0, false) as is_value_ma_anomaly
       from (select *, avg(value) over (order by processing_date, event_id rows between 7 preceding and current row) as a
             from {EVENTS_SQL})""",
)
def an_moving_avg(spark: SparkSession, d: str) -> DataFrame:
    config = AnomalyConfig("moving_average", 7, 2.0)
    out = anomalies.moving_average(_events(spark, d), "value", config, ["event_id"])
    return rounded(out.select("event_id", "ma_value", "value_ma_diff", "is_value_ma_anomaly"), ["ma_value", "value_ma_diff"])


@query(
    "an_group_pattern",
    """select o_orderkey, coalesce(abs(case when s > 0 then (o_totalprice - a) / s end) > 2, false) as is_o_totalprice_zscore_anomaly
       from (select *, avg(o_totalprice) over w as a, stddev_samp(o_totalprice) over w as s from orders
             window w as (partition by o_orderpriority, o_orderstatus order by o_orderdate, o_orderkey
                          rows between 30 preceding and current row))""",
)
def an_group_pattern(spark: SparkSession, d: str) -> DataFrame:
    config = AnomalyConfig(lookback_window=30, threshold=2.0)
    out = anomalies.group_pattern(
        table(spark, d, "orders"), config, ["o_orderpriority", "o_orderstatus"], ["o_totalprice"], ["o_orderkey"], "o_orderdate"
    )
    return out.select("o_orderkey", "is_o_totalprice_zscore_anomaly")


@query(
    "an_min_samples",
    f"""select event_id, case when n >= 20 then coalesce(abs(case when s > 0 then (value - a) / s end) > 2, false) end as is_value_zscore_anomaly
       from (select *, avg(value) over w as a, stddev_samp(value) over w as s, count(*) over w as n from {EVENTS_SQL}
             window w as (partition by user_id, event_type order by processing_date, event_id rows between 30 preceding and current row))""",
)
def an_min_samples(spark: SparkSession, d: str) -> DataFrame:
    config = AnomalyConfig(lookback_window=30, threshold=2.0, min_samples=20)
    out = anomalies.zscore(
        _events(spark, d), "value", config, ["event_id"], group_by=["user_id", "event_type"]
    )
    return out.select("event_id", "is_value_zscore_anomaly")


# Means of 64 cent amounts can end exactly halfway at six digits, so the mean keeps nine.
@query(
    "an_zscore_day_frame",
    f"""select event_id, round(a, 9) as avg_value, round(s, 6) as stddev_value, round(z, 6) as value_zscore,
              coalesce(abs(z) > 3.0, false) as is_value_zscore_anomaly
       from (select *, case when s > 0 then (value - a) / s end as z from (
         select *, avg(value) over w as a, stddev_samp(value) over w as s from {EVENTS_SQL}
         window w as (partition by event_type order by processing_date range between interval 7 day preceding and current row)))""",
)
def an_zscore_day_frame(spark: SparkSession, d: str) -> DataFrame:
    """Frames of seven days before each row's date, within the event type."""
    config = AnomalyConfig(lookback_window=7, threshold=3.0, frame="days")
    out = anomalies.zscore(_events(spark, d), "value", config, ["event_id"], group_by=["event_type"])
    out = out.select("event_id", *ZSCORE)
    return rounded(rounded(out, [ZSCORE[0]], 9), list(ZSCORE[1:3]))


def _everything(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The detectors that the events table has columns for."""
    rows = _events(spark, d).withColumnRenamed("value", "amount")
    config = AnomalyConfig(lookback_window=30, threshold=3.0)
    found, _ = anomalies.detect_all(rows, config, ["event_id"], narrow=True)
    return found


COUNTS_SQL = f"""
  with e as (select event_id, value as amount, processing_date, status from {EVENTS_SQL}),
  d as (select processing_date, count(*) as n, count(*) filter (where status = 'ERROR')::double / count(*) as r from e group by 1),
  dw as (select *, (n - avg(n) over w) / nullif(stddev_samp(n) over w, 0) as nz, (r - avg(r) over w) / nullif(stddev_samp(r) over w, 0) as rz
         from d window w as (order by processing_date rows between 30 preceding and current row)),
  ew as (select *, avg(amount) over w as a, stddev_samp(amount) over w as s, quantile_disc(amount, 0.25) over w as q1,
                quantile_disc(amount, 0.75) over w as q3 from e
         window w as (order by processing_date, event_id rows between 30 preceding and current row)),
  flags as (select event_id, coalesce(abs(nz) > 3, false) as volume, coalesce(abs(rz) > 3, false) as error_rate,
                   coalesce(abs((amount - a) / nullif(s, 0)) > 3, false) as zscore,
                   coalesce(amount < q1 - (q3 - q1) or amount > q3 + (q3 - q1), false) as iqr,
                   coalesce(abs(amount - a) / nullif(a, 0) > 3, false) as moving_average
            from ew join dw using (processing_date))"""

DETECTORS = ("volume", "error_rate", "zscore", "iqr", "moving_average")


@query(
    "an_summary",
    COUNTS_SQL
    + " union all ".join(
        f"select '{n}' as detector, count(*) as total_records, count(*) filter (where {n}) as anomaly_count from flags"
        for n in DETECTORS
    ),
)
def an_summary(spark: SparkSession, d: str) -> DataFrame:
    return anomalies.summary(_everything(spark, d)).select("detector", "total_records", "anomaly_count")


WIDE_SQL = """(select o_orderkey, o_totalprice as amount, o_totalprice / (1 + c_nationkey) as income, n_name as region,
  n_name as state, o_orderdate as processing_date, o_orderdate as start_time, end_time,
  epoch(end_time)::bigint - epoch(o_orderdate)::bigint as processing_time, c_mktsegment as employment_status,
  case o_orderstatus when 'F' then 'APPROVED' when 'O' then 'REJECTED' else 'ERROR' end as status,
  o_orderdate as check_date, o_orderpriority as check_type, case when lines > 4 then 'FAILED' else 'PASSED' end as check_status
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join (select l_orderkey, max(l_shipdate) as end_time, count(*) as lines from lineitem group by 1) on l_orderkey = o_orderkey)"""


def _wide(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their customer and their lines: every column that a detector asks for."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("end_time"), F.count("*").alias("lines"))
    return (
        table(spark, d, "orders")
        .join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(lines, F.expr("l_orderkey = o_orderkey"))
        .selectExpr(
            "o_orderkey",
            "o_totalprice as amount",
            "o_totalprice / (1 + c_nationkey) as income",
            "c_acctbal as credit_score",
            "c_acctbal / (1 + lines) as debt_ratio",
            "n_name as region",
            "n_name as state",
            "o_orderdate as processing_date",
            "o_orderdate as start_time",
            "end_time",
            "c_mktsegment as employment_status",
            "case o_orderstatus when 'F' then 'APPROVED' when 'O' then 'REJECTED' else 'ERROR' end as status",
            "o_orderdate as check_date",
            "o_orderpriority as check_type",
            "if(lines > 4, 'FAILED', 'PASSED') as check_status",
        )
    )


def _counted(detector: str, flag: str, sql: str) -> str:
    counted = f"count(*) filter (where {flag})" if flag else "null::bigint"
    return f"select '{detector}' as detector, count(*) as total_records, {counted} as anomaly_count from ({sql})"


def _date_counts(detector: str, measure: str, group: str = "", day: str = "processing_date") -> str:
    names = ("v", "m", "s", "z", "flagged")
    return _counted(detector, "flagged", _date_sql(measure, *names, WIDE_SQL, "o_orderkey", group, day, 30, 2.0))


def _row_counts(detector: str, column: str, order: str = "processing_date", group: str = "") -> str:
    sql = _row_sql(column, "m", "s", "z", "flagged", WIDE_SQL, "o_orderkey", f"{order}, o_orderkey", group, threshold=2.0)
    return _counted(detector, "flagged", sql)


def _iqr_counts(detector: str, group: str = "") -> str:
    return _counted(detector, "flagged", _iqr_sql("amount", WIDE_SQL, "o_orderkey", "processing_date, o_orderkey", ("a1", "a3", "d", "flagged"), group))


@query(
    "an_all_detectors",
    " union all ".join(
        [
            _date_counts("volume", "count(*)"),
            _row_counts("processing_time", "processing_time", "start_time"),
            _date_counts("error_rate", "count(*) filter (where status = 'ERROR')::double / count(*)"),
            _date_counts("quality_failure", "count(*) filter (where check_status = 'FAILED')::double / count(*)", "check_type", "check_date"),
            _iqr_counts("regional", "region"),
            _counted("segment", "", f"select * from {WIDE_SQL}"),
            _row_counts("employment_income", "income", group="employment_status"),
            _date_counts("approval_rate", "count(*) filter (where status = 'APPROVED')::double / count(*)", "state"),
            _row_counts("zscore", "amount"),
            _iqr_counts("iqr"),
            _counted("isolation_forest", "", f"select * from {WIDE_SQL}"),
            _counted(
                "moving_average",
                "abs(amount - a) / nullif(a, 0) > 2.0",
                "select amount, avg(amount) over (order by processing_date, o_orderkey rows between 30 preceding and current row) as a "
                f"from {WIDE_SQL}",
            ),
        ]
    ),
)
def an_all_detectors(spark: SparkSession, d: str) -> DataFrame:
    """All twelve detectors over one written frame; the forests' counts depend on drawn trees and are left out."""
    config = AnomalyConfig(lookback_window=30, threshold=2.0, sensitivity=1.5)
    found, skipped = anomalies.detect_all(materialize(_wide(spark, d), "wide"), config, ["o_orderkey"], narrow=True)
    assert not skipped, skipped
    drawn = F.col("detector").isin("segment", "isolation_forest")
    return anomalies.summary(found).select(
        "detector", "total_records", F.when(~drawn, F.col("anomaly_count")).alias("anomaly_count")
    )


@query(
    "an_detection_events",
    COUNTS_SQL
    + " union all ".join(
        f"select '{kind}' as detection_type, '{n}' as detector, event_id, 'high' as severity from flags where {n}"
        for n, kind in (
            ("volume", "volume"),
            ("error_rate", "error_rate"),
            ("zscore", "group_pattern"),
            ("iqr", "group_pattern"),
            ("moving_average", "group_pattern"),
        )
    ),
)
def an_detection_events(spark: SparkSession, d: str) -> DataFrame:
    combined = anomalies.combine(_everything(spark, d), ["event_id"])
    found = anomalies.detection_events(combined, ["event_id"])
    body = F.from_json("details", "detector string, event_id long")
    return found.select(
        "detection_type", body["detector"].alias("detector"), body["event_id"].alias("event_id"), "severity"
    )


def _forest_facts(found: DataFrame, flag: str, share: float, groups: tuple[str, ...] = ()) -> DataFrame:
    """Rows, and whether scores and flags keep their bounds, in every group: a score is in (0, 1], and the flagged
    are the highest, exactly as many as their share."""
    score, flagged = F.col("anomaly_score"), F.count_if(flag)
    each = found.groupBy(*groups).agg(
        F.count("*").alias("total_rows"),
        F.bool_and((score > 0) & (score <= 1)).alias("scores_in_range"),
        (flagged == rows_of_share(share, F.count("*"))).alias("share_kept"),
        (F.min(F.when(F.col(flag), score)) >= F.coalesce(F.max(F.when(~F.col(flag), score)), F.lit(0.0))).alias("highest_flagged"),
    )
    return each.agg(
        F.sum("total_rows").alias("total_rows"), *[F.bool_and(c).alias(c) for c in ("scores_in_range", "share_kept", "highest_flagged")]
    )


def _forest_sql(table_name: str) -> str:
    return f"select count(*) as total_rows, true as scores_in_range, true as share_kept, true as highest_flagged from {table_name}"


def _item_forest(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(*ITEM_KEYS, "l_quantity", "l_discount")
    return anomalies.forest(items, ["l_extendedprice", "l_quantity", "l_discount"], ITEM_KEYS)


def _people_forest(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "customer").selectExpr(
        "c_custkey", "c_acctbal as credit_score", "double(c_nationkey) as income", "c_acctbal / (c_nationkey + 1) as debt_ratio"
    )
    return anomalies.forest(people, ["credit_score", "income", "debt_ratio"], ["c_custkey"], "is_segment_anomaly")


ORDER_GROUPS = ("o_orderpriority", "o_orderstatus")


def _order_forests(spark: SparkSession, d: str) -> DataFrame:
    """A forest for each of the fifteen groups; the highest twentieth of each is flagged."""
    config = AnomalyConfig("isolation_forest", 30, 0.95, min_samples=100)
    orders = table(spark, d, "orders").select("o_orderkey", *ORDER_GROUPS, "o_totalprice", "o_custkey", "o_orderdate")
    return anomalies.group_pattern(orders, config, list(ORDER_GROUPS), ["o_totalprice", "o_custkey"], ["o_orderkey"], "o_orderdate")


@query("an_isolation_forest")
def an_isolation_forest(spark: SparkSession, d: str) -> DataFrame:
    return _item_forest(spark, d)


@query("an_segment_forest")
def an_segment_forest(spark: SparkSession, d: str) -> DataFrame:
    return _people_forest(spark, d)


@query("an_group_forest")
def an_group_forest(spark: SparkSession, d: str) -> DataFrame:
    return _order_forests(spark, d)


@query("an_isolation_forest_facts", _forest_sql("lineitem"))
def an_isolation_forest_facts(spark: SparkSession, d: str) -> DataFrame:
    return _forest_facts(_item_forest(spark, d), "is_isolation_forest_anomaly", 0.1)


@query("an_segment_forest_facts", _forest_sql("customer"))
def an_segment_forest_facts(spark: SparkSession, d: str) -> DataFrame:
    return _forest_facts(_people_forest(spark, d), "is_segment_anomaly", 0.1)


@query(
    "an_group_forest_facts",
    "select sum(n)::bigint as total_rows, true as scores_in_range, true as share_kept, true as highest_flagged "
    "from (select count(*) as n from orders group by o_orderpriority, o_orderstatus having count(*) >= 100)",
)
def an_group_forest_facts(spark: SparkSession, d: str) -> DataFrame:
    found = _order_forests(spark, d).filter(F.col("is_group_pattern_anomaly").isNotNull())
    return _forest_facts(found, "is_group_pattern_anomaly", 0.05, ORDER_GROUPS)


@query(
    "an_highest_share",
    """select l_orderkey, l_linenumber, l_partkey,
              row_number() over (order by l_discount desc, l_orderkey, l_linenumber, l_partkey) <= ceil(0.1 * count(*) over ()) as is_high
       from lineitem""",
)
def an_highest_share(spark: SparkSession, d: str) -> DataFrame:
    """Exactly a tenth of all lines by discount, which has eleven values: nearly all of the cut falls among ties."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return flag_highest(table(spark, d, "lineitem").select(*keys, "l_discount"), "l_discount", 0.1, keys, "is_high").drop("l_discount")


@query(
    "an_highest_share_of_groups",
    """select o_orderkey, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey)
              <= ceil(0.05 * count(*) over (partition by o_orderpriority)) as is_high from orders""",
)
def an_highest_share_of_groups(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return flag_highest(orders, "o_totalprice", 0.05, ["o_orderkey"], "is_high", ["o_orderpriority"]).select("o_orderkey", "is_high")


@query(
    "an_group_forest_scores",
    """select o_orderkey, round(case o_orderstatus when 'F' then pow(2, -case when o_totalprice < 100000 then 0.25 else 1.5 end)
              when 'O' then pow(2, -(case when o_custkey < 500 then 0.5 else 1 end + case when o_totalprice < 50000 then 2 else 0.75 end) / 2) end, 9)
              as anomaly_score from orders""",
)
def an_group_forest_scores(spark: SparkSession, d: str) -> DataFrame:
    """Given trees for two of the three groups: (tree, node, feature, cut, left, right, path), a leaf has feature -1."""
    given = {
        "F": [(0, 0, 0, 1e5, 1, 2, 0), (0, 1, -1, 0, -1, -1, 0.25), (0, 2, -1, 0, -1, -1, 1.5)],
        "O": [
            (0, 0, 1, 500, 1, 2, 0), (0, 1, -1, 0, -1, -1, 0.5), (0, 2, -1, 0, -1, -1, 1),
            (1, 0, 0, 5e4, 1, 2, 0), (1, 1, -1, 0, -1, -1, 2), (1, 2, -1, 0, -1, -1, 0.75),
        ],
    }
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    sizes = orders.groupBy("o_orderstatus").agg(F.count("*").alias("_rows"))
    nodes = [(g, bytearray(np.array(n, float).tobytes())) for g, n in given.items()]
    forests = sizes.join(spark.createDataFrame(nodes, "o_orderstatus string, _forest binary"), "o_orderstatus")
    scored = isolation_forest.score_groups(orders, ["o_orderstatus"], ["o_totalprice", "o_custkey"], ["o_orderkey"], forests)
    return rounded(scored.select("o_orderkey", "anomaly_score"), ["anomaly_score"], 9)


@query(
    "an_forest_scores",
    """select l_orderkey, l_linenumber, l_partkey, round(pow(2, -((case when l_quantity < 20 then 0.25
              when l_discount < 0.05 then 0.5 else 1.5 end) + (case when l_discount < 0.02 then 0.75 else 0.125 end)) / 2), 9) as anomaly_score
       from lineitem""",
)
def an_forest_scores(spark: SparkSession, d: str) -> DataFrame:
    """Two given trees: (tree, node, feature, cut, left, right, path), a leaf has feature -1."""
    trees = np.array(
        [
            (0, 0, 0, 20.0, 1, 2, 0.0),
            (0, 1, -1, 0.0, -1, -1, 0.25),
            (0, 2, 1, 0.05, 3, 4, 0.0),
            (0, 3, -1, 0.0, -1, -1, 0.5),
            (0, 4, -1, 0.0, -1, -1, 1.5),
            (1, 0, 1, 0.02, 1, 2, 0.0),
            (1, 1, -1, 0.0, -1, -1, 0.75),
            (1, 2, -1, 0.0, -1, -1, 0.125),
        ]
    )
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    scored = isolation_forest.score(items, ["l_quantity", "l_discount"], trees)
    return rounded(scored.drop("l_quantity", "l_discount"), ["anomaly_score"], 9)


@query(
    "dq_detector_rules",
    f"""with d as (select processing_date, count(*) as n, count(*) filter (where status = 'ERROR')::double / count(*) as r from {EVENTS_SQL} group by 1),
       m as (select *, avg(r) over w as a, quantile_disc(n, 0.25) over w as q1, quantile_disc(n, 0.75) over w as q3 from d
             window w as (order by processing_date rows between 7 preceding and current row)),
       e as (select value, avg(value) over w as a, stddev_samp(value) over w as s from {EVENTS_SQL}
             window w as (order by processing_date, event_id rows between 20 preceding and current row)),
       c as (select 'error_rate' as target, sum(case when abs(r - a) / nullif(a, 0) > 0.3 then n else 0 end) as flagged, sum(n) as total from m
             union all select 'volume', sum(case when greatest(q1 - n, n - q3, 0) / nullif(q3 - q1, 0) > 1.5 then n else 0 end), sum(n) from m
             union all select 'zscore', count(*) filter (where abs((value - a) / nullif(s, 0)) > 2.5), count(*) from e)
       select target, 'anomaly_count' as metric, flagged::double as value, flagged = 0 as passed from c
       union all select target, 'total_rows', total::double, flagged = 0 from c""",
)
def dq_detector_rules(spark: SparkSession, d: str) -> DataFrame:
    """Detectors as rules: each by the method that its rule names."""
    config = {"lookback_window": 7, "threshold": 0.3}
    found = [
        {"type": "error_rate", "config": {**config, "detection_method": "moving_average"}},
        {"type": "volume", "config": {**config, "detection_method": "iqr", "sensitivity": 1.5}},
        {"type": "zscore", "column": "value", "tie_breakers": ["event_id"], "config": {"lookback_window": 20, "threshold": 2.5}},
    ]
    spec = {"rule_id": "events", "rules": {"patterns": {"type": "anomaly", "rules": found, "severity": "high"}}}
    results = quality.evaluate(_events(spark, d), rules_from_spec(spec), "events")
    return results.select("target", "metric", "value", "passed")
