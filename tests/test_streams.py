"""Streams against their batch forms, with restarts and any split into batches."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sediment.config import AnomalyConfig
from sediment.operators import anomalies as an
from sediment.plans.queries import runners
from sediment.streaming import detectors, flows, topics

DAY = dt.datetime(2024, 3, 1)


def rows_of(days, seed, groups="ab"):
    draw = random.Random(seed)
    out = []
    for d in range(days):
        for g in groups:
            if (d + ord(g)) % 9:
                n = draw.randrange(3, 30) + (80 if d == days - 5 else 0)
                out += [(DAY + dt.timedelta(days=d, seconds=draw.randrange(86_400)), g, draw.random() < 0.2) for _ in range(n)]
    return out


def feed(spark, rows, path, cuts):
    """Files of rows in order of time, one per cut, each a batch of its own."""
    rows = sorted(rows)
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], "ts timestamp, g string, bad boolean").coalesce(1).write.mode("append").parquet(f"{path}/{i:03d}")


def drain(spark, make, path, out, checkpoint):
    source = spark.readStream.schema("ts timestamp, g string, bad boolean").option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(path)
    query = make(source).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").start(out)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("cuts", [[], [200, 201, 450, 900]])
def test_stream_detector_gives_the_batch_detectors_rows(spark, tmp_path, cuts, grouped):
    rows = rows_of(40, 5)
    feed(spark, rows, f"{tmp_path}/in", cuts)
    config = AnomalyConfig(lookback_window=7, threshold=1.6, min_samples=3)
    group = ("g",) if grouped else ()
    make = lambda s: detectors.rate_stream(s, config, "ts", F.col("bad"), "bad_rate", group, "2 hours")
    for _ in range(2):  # the second run finds nothing to do
        drain(spark, make, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = spark.read.parquet(f"{tmp_path}/out")
    last = (max(r[0] for r in rows) - dt.timedelta(hours=2)).date()
    df = spark.createDataFrame(rows, "ts timestamp, g string, bad boolean")
    names = dict(value="v", mean="m", deviation="d", score="z", flag="f")
    batch = an.date_detector(df, config, an.rate(F.col("bad")), names, "ts", list(group), "date").filter(F.col("ts") < F.lit(last))
    shape = lambda df, cols: sorted(map(str, (tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(cols).collect())))
    names = ["_day", "bad_rate", "avg_bad_rate", "stddev_bad_rate", "bad_rate_zscore", "is_bad_rate_anomaly"]
    mine, theirs = shape(got, [*group, *names]), shape(batch, [*group, "ts", "v", "m", "d", "z", "f"])
    assert mine == theirs and len(mine) > 30


def test_rows_that_come_later_continue_the_state(spark, tmp_path):
    rows = sorted(rows_of(30, 6))
    config = AnomalyConfig(lookback_window=5, threshold=1.5)
    make = lambda s: detectors.volume_stream(s, config, "ts", ("g",), "1 hour")
    for part in (rows[:300], rows[300:]):
        feed(spark, part, f"{tmp_path}/in/{len(part)}", [])
        drain(spark, make, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    feed(spark, rows, f"{tmp_path}/whole", [])
    drain(spark, make, f"{tmp_path}/whole", f"{tmp_path}/out2", f"{tmp_path}/checkpoint2")
    shape = lambda p: sorted(map(str, spark.read.parquet(f"{tmp_path}/{p}").collect()))
    assert shape("out") == shape("out2") and len(shape("out")) > 30


def test_idle_groups_are_forgotten(spark, tmp_path):
    rows = [(DAY + dt.timedelta(days=d, hours=1), "a", False) for d in (0, 1, 2, 30, 31, 32, 33)] + [(DAY + dt.timedelta(days=d, hours=2), "b", False) for d in range(36)]
    feed(spark, rows, f"{tmp_path}/in", list(range(4, len(rows), 4)))
    config = AnomalyConfig(lookback_window=30, threshold=1.5, min_samples=3)
    make = lambda s: detectors.volume_stream(s, config, "ts", ("g",), "1 hour", expire_days=10)
    drain(spark, make, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = {(r["g"], (r["_day"] - DAY.date()).days): r["is_volume_anomaly"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got["a", 2] is False and got["a", 30] is None and got["a", 31] is None and got["a", 32] is False and got["b", 30] is False


def test_copies_in_later_batches_are_stored_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def lay(name, lines, age_days):
        (landing / name).write_text("\n".join(["id,name", *lines, ""]))
        at = dt.datetime.now().timestamp() - age_days * 86_400
        os.utime(landing / name, (at, at))

    item = {
        "name": "people",
        "format": "csv",
        "landing_zone": {"path": str(landing), "file_pattern": "*.csv"},
        "schema_validation": {"schema": "id int, name string", "mode": "strict"},
        "bronze_zone": {"path": f"{tmp_path}/bronze"},
    }

    def run():
        return flows.ingest_layer(spark, item, f"{tmp_path}/checkpoint", duplicates_within="3 days")

    stored = lambda: sorted((r["id"], r["name"]) for r in spark.read.parquet(f"{tmp_path}/bronze").select("id", "name").collect())
    lay("a.csv", ["1,kim", "2,", "2,", "x,bad"], 20)
    run()
    lay("b.csv", ["1,kim", "2,", "3,ola", "x,bad"], 19)
    run()
    assert stored() == [(1, "kim"), (2, None), (3, "ola")]
    assert spark.read.parquet(f"{tmp_path}/bronze_quarantine/malformed").count() == 1
    lay("c.csv", ["4,per"], 1)
    query = run()
    lay("d.csv", ["5,eva", "1,kim"], 0)  # the first copy's time has passed
    query = run()
    assert stored() == [(1, "kim"), (1, "kim"), (2, None), (3, "ola"), (4, "per"), (5, "eva")]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3  # the rows of a and b are forgotten


def lay_messages(folder, number, name, texts):
    path = folder / f"partition={number}"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(t + "\n" for t in texts))


def collect(spark, folder, tmp_path, start, run):
    stream = topics.read_stream(spark, str(folder), start)
    flows.run_available(stream, f"{tmp_path}/{run}-checkpoint", flows.batch_directory(f"{tmp_path}/{run}"))
    if not os.path.exists(f"{tmp_path}/{run}"):
        return []
    return sorted((r["partition"], r["offset"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/{run}").collect())


def test_topic_offsets_from_each_start_and_after_a_restart(spark, tmp_path):
    folder = tmp_path / "topic=t"
    lay_messages(folder, 0, "a", ["m0", "m1"])
    lay_messages(folder, 0, "b", ["m2"])
    lay_messages(folder, 1, "a", ["n0"])
    (folder / "partition=1" / "_hidden").write_text("never\n")
    first = [(0, 0, "m0"), (0, 1, "m1"), (0, 2, "m2"), (1, 0, "n0")]
    assert collect(spark, folder, tmp_path, "earliest", "all") == first
    assert collect(spark, folder, tmp_path, "latest", "new") == []
    assert collect(spark, folder, tmp_path, json.dumps({"0": 1, "1": 7}), "some") == [(0, 1, "m1"), (0, 2, "m2")]
    lay_messages(folder, 0, "c", ["m3", "m4"])
    lay_messages(folder, 2, "a", ["o0"])
    later = [(0, 3, "m3"), (0, 4, "m4"), (2, 0, "o0")]
    assert collect(spark, folder, tmp_path, "latest", "all") == sorted(first + later)  # resumes, whatever the option says
    assert collect(spark, folder, tmp_path, "earliest", "new") == later
    assert collect(spark, folder, tmp_path, "earliest", "all") == sorted(first + later)


def test_topic_without_a_folder_or_message(spark, tmp_path):
    assert collect(spark, tmp_path / "topic=none", tmp_path, "earliest", "none") == []


def test_messages_of_published_events_by_offsets(spark, tmp_path):
    (tmp_path / "topics" / "topic=x").mkdir(parents=True)
    (tmp_path / "topics" / "topic=x" / "part-0").write_text('{"a": 1}\n{"a": 2}')
    stream = flows.topic_stream(spark, "x", folder=f"{tmp_path}/topics", starting_offsets="earliest")
    flows.run_available(stream, f"{tmp_path}/checkpoint", flows.batch_directory(f"{tmp_path}/out"))
    assert sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ['{"a": 1}', '{"a": 2}']


def test_topic_queries_number_messages_in_order_whatever_files_the_events_lie_in(spark, tmp_path):
    events = spark.range(4000).selectExpr("id as event_id", "'view' as event_type")
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    halves = {0: [], 1: []}
    for event in sorted(range(4000), key=lambda i: (i % 4 >= 2, i)):
        halves[event % 2].append(event)
    every = {(event, number, offset) for number, ids in halves.items() for offset, event in enumerate(ids)}
    found = lambda name: {tuple(r) for r in runners()[name](spark, str(tmp_path)).select("event_id", "partition", "offset").collect()}
    assert found("topic_earliest") == every
    assert found("topic_latest") == {r for r in every if r[0] % 4 >= 2}
    assert found("topic_from_offsets") == {r for r in every if r[2] >= (40 if r[1] else 25)}
