"""Joins, duplicates, merge, audit look-ups, readers and writers."""

import datetime as dt
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from sediment.config import PipelineConfig, SpecError, load_spec, version_key
from sediment.operators import audit, dedup, joins
from sediment.session import scratch_path
from sediment.sources import manifest, merge, readers, writers
from sediment.sources.merge import VersionedTable, merge_frames, merge_partitions, upsert_frames


def test_merge_null_wins_and_twice_is_once(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (4, "d", 1)], "k int, v string, ts int")
    source = spark.createDataFrame([(1, None, 2), (3, "c", 2), (None, "n", 2)], "k int, v string, ts int")
    merged = merge_frames(target, source, ["k"])
    assert rows(merged) == rows(
        spark.createDataFrame([(1, None, 2), (2, "b", 1), (4, "d", 1), (3, "c", 2), (None, "n", 2)], "k int, v string, ts int")
    )
    keyed = source.filter("k is not null")
    once = merge_frames(target, keyed, ["k"])
    assert rows(merge_frames(once, keyed, ["k"])) == rows(once)


def test_upsert_takes_the_latest_of_duplicate_keys(spark, rows):
    target = spark.createDataFrame([(1, "old", 0)], "k int, v string, ts int")
    source = spark.createDataFrame([(1, "x", 5), (1, "y", 9), (2, "z", 1)], "k int, v string, ts int")
    assert rows(upsert_frames(target, source, ["k"], "ts")) == [(1, "y", 9), (2, "z", 1)]


def test_versioned_table(spark, rows):
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    with pytest.raises(SpecError):
        table.read()
    source = spark.createDataFrame([(1, "a")], "k int, v string")
    assert table.merge(source, ["k"]) == 1
    assert table.merge(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"]) == 2
    assert rows(table.read()) == [(1, "b"), (2, "c")]
    with pytest.raises(Exception):
        table.replace(source.withColumn("v", F.raise_error(F.lit("broken write"))))
    assert table.version() == 2 and rows(table.read()) == [(1, "b"), (2, "c")]


def test_keep_latest_prefers_values_over_null_and_breaks_ties(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "c"), (2, None, "d")], "k int, ts int, v string")
    assert rows(dedup.keep_latest(df, ["k"], "ts", ["v"])) == [(1, 5, "b"), (2, None, "d")]


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedup.keep_latest(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_versions_order_by_number(spark):
    df = spark.createDataFrame([("r", "1.9"), ("r", "1.10"), ("s", "2"), ("s", "v1.5")], "rule string, version string")
    latest = {r["rule"]: r["version"] for r in dedup.latest_version(df, ["rule"], "version").collect()}
    assert latest == {"r": "1.10", "s": "2"}
    assert version_key("1.10.2") > version_key("1.9")


def test_layer_order(spark):
    df = spark.createDataFrame(
        [("g", "gold", True), ("b", "bronze", True), ("s", "silver", True), ("x", "bronze", False)],
        "table_name string, layer string, enabled boolean",
    )
    assert [r["table_name"] for r in dedup.enabled_in_layer_order(df).collect()] == ["b", "s", "g"]


def test_orphans_with_null_and_duplicate_keys(spark, rows):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "z")], "k int, s string")
    target = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, st string")
    assert rows(joins.orphans(source, target, ["k", "s"], ["id", "st"])) == [(2, None), (3, "z")]
    assert rows(joins.orphan_keys(source, target, ["k", "s"], ["id", "st"])) == [(2, None, 1), (3, "z", 1)]


def test_enrich_refuses_a_repeated_reference_key(spark):
    df = spark.createDataFrame([(1,)], "k int")
    reference = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(SpecError):
        joins.enrich(df, reference, {"k": "id"}, {"v": "v"})


def test_validate_against(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    reference = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(joins.validate_against(df, reference, {"k": "id"}, "ok")) == [(1, True), (2, False), (None, None)]


def day(text):
    return dt.datetime.fromisoformat(text) if text else None


def effective(spark, intervals):
    return spark.createDataFrame(
        [(k, day(a), day(b), v) for k, a, b, v in intervals],
        "k int, effective_from timestamp_ntz, effective_to timestamp_ntz, v string",
    )


def facts(spark, times):
    return spark.createDataFrame([(i, k, day(t)) for i, (k, t) in enumerate(times)], "id int, k int, at timestamp_ntz")


def test_effective_lookup_edges(spark, rows):
    versions = effective(
        spark,
        [(1, "2023-01-01", "2023-06-01", "a"), (1, "2023-06-01", None, "b"), (2, "2023-03-01", "2023-03-02", "c")],
    )
    asked = facts(
        spark,
        [(1, "2022-12-31"), (1, "2023-01-01"), (1, "2023-05-31T23:59:59"), (1, "2023-06-01"), (1, "2030-01-01"),
         (2, "2023-03-02"), (3, "2023-01-01")],
    )
    plain = joins.effective_lookup(asked, versions, ["k"], "at").select("id", "v")
    out = joins.effective_lookup(asked, versions, ["k"], "at", bucket_days=7).select("id", "v")
    assert rows(plain) == rows(out) == rows(
        spark.createDataFrame([(0, None), (1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, None), (6, None)], "id int, v string")
    )


def test_overlapping_versions_need_a_row_id(spark, rows):
    versions = effective(
        spark, [(1, "2023-01-01", None, "wide"), (1, "2023-02-01", "2023-03-01", "inner"), (2, "2023-01-01", None, "x")]
    )
    asked = facts(spark, [(1, "2023-01-15"), (1, "2023-02-15"), (1, "2023-03-15"), (9, "2023-03-15")])
    with pytest.raises(SpecError):
        joins.effective_lookup(asked, versions, ["k"], "at")
    out = joins.effective_lookup(asked, versions, ["k"], "at", row_id=["id"]).select("id", "v")
    assert rows(out) == rows(spark.createDataFrame([(0, "wide"), (1, "inner"), (2, "wide"), (3, None)], "id int, v string"))


def test_key_with_very_many_versions(spark, rows):
    """One key holds most versions and facts; the sorted sequence and the plain condition agree."""
    versions = spark.range(400).selectExpr(
        "if(id % 4 = 0, int(id), 0) as k",
        "timestamp_ntz'2020-01-01' + make_dt_interval(int(id * 3)) as effective_from",
        "id as v",
    ).selectExpr("*", "lead(effective_from) over (partition by k order by effective_from) as effective_to")
    asked = spark.range(2000).selectExpr("id", "int(if(id % 3 = 0, 0, id % 400)) as k", "timestamp_ntz'2020-01-01' + make_dt_interval(int(id)) as at")
    auto = joins.effective_lookup(asked, versions, ["k"], "at")
    assert "explode" not in auto._jdf.queryExecution().toString().lower()  # no version is copied
    brute = asked.join(versions.withColumnRenamed("k", "j"), F.expr("k = j and effective_from <= at and (effective_to is null or at < effective_to)"), "left")
    assert rows(auto.select("id", "v")) == rows(brute.select("id", "v"))


def test_merge_into_partitions(spark, rows):
    path = scratch_path(spark, "parts")
    base = spark.range(60).selectExpr("id as k", "id * 2 as v", "int(id % 3) as p")
    writers.write(base, path, partition_by=["p"])
    before = {r["f"] for r in spark.read.parquet(path).filter("p = 0").selectExpr("_metadata.file_path as f").collect()}
    source = spark.createDataFrame([(1, None, 1), (100, 7, 1), (2, 9, 2), (500, 1, 8)], "k long, v long, p int")
    merge_partitions(spark, path, source, ["k"], ["p"])
    stored = spark.read.parquet(path)
    assert rows(stored.select("k", "v", "p")) == rows(merge_frames(base, source, ["k", "p"]))
    assert {r["f"] for r in stored.filter("p = 0").selectExpr("_metadata.file_path as f").collect()} == before


def test_join_chain_needs_matching_conditions(spark):
    with pytest.raises(SpecError):
        joins.join_chain([spark.range(1), spark.range(1)], [])


def test_version_chain(spark, rows):
    data = [(i, i - 1 if i % 100 else None) for i in range(300)] + [(900, 12345)]
    versions = spark.createDataFrame(data, "id int, previous_id int")
    expected = [(i, i - i % 100, i % 100) for i in range(300)] + [(900, 900, 0)]
    assert rows(audit.version_chain(versions, "id", "previous_id")) == sorted(
        expected, key=lambda t: tuple((False, str(x)) for x in t)
    )
    with pytest.raises(SpecError):
        audit.version_chain(spark.createDataFrame([(1, 2), (2, 1)], "id int, previous_id int"), "id", "previous_id")


def test_lineage(spark, rows):
    edges = spark.createDataFrame(
        [("g", "s"), ("s", "b1"), ("s", "b2"), ("g", "b1")], "table_name string, depends_on string"
    )
    assert rows(audit.lineage_closure(edges)) == [("g", "b1", 1), ("g", "b2", 2), ("g", "s", 1), ("s", "b1", 1), ("s", "b2", 1)]
    loop = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "table_name string, depends_on string")
    with pytest.raises(SpecError):
        audit.lineage_closure(loop)
    whole = audit.lineage_closure(loop.unionByName(edges), cycles="keep")
    assert rows(audit.lineage_cycles(whole)) == [("a", "a"), ("a", "b"), ("a", "c")]
    assert {(r["table_name"], r["ancestor"], r["depth"]) for r in whole.filter("table_name = 'a'").collect()} == {("a", "b", 1), ("a", "c", 2), ("a", "a", 3)}


def cycles_of(edges):
    """(least name, name) of all on cycles, by walking from each."""
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    reach = {}
    for start in {v for edge in edges for v in edge}:
        seen, ahead = set(), [start]
        while ahead:
            ahead += [b for b in after.get(ahead.pop(), ()) if b not in seen and not seen.add(b)]
        reach[start] = seen
    return sorted((min(b for b in seen if a in reach[b]), a) for a, seen in reach.items() if a in seen)


@pytest.mark.parametrize("ways, rounds", [(0.8, 8), (1.1, 8), (1.6, 8), (3, 1)])
def test_lineage_cycles_of_direct_edges(spark, rows, monkeypatch, ways, rounds):
    """Sparse and dense graphs side by side, with loops, repeated edges and rings; the dense ones end in their closure."""
    monkeypatch.setattr(audit, "CONTRACTION_ROUNDS", rounds)
    draw, edges = random.Random(ways), []
    for graph in range(25):
        size = draw.randint(1, 12)
        edges += [(f"{graph}.{draw.randrange(size)}", f"{graph}.{draw.randrange(size)}") for _ in range(int(size * ways) + 1)]
    edges += [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)] * 2
    frame = spark.createDataFrame([*edges, (None, "r1"), ("r1", None)], "table_name string, depends_on string")
    assert rows(audit.lineage_cycles(frame, parent="depends_on")) == cycles_of(edges)


def test_lineage_cycles_of_rings_without_their_pairs(spark, monkeypatch):
    """Two rings of 3000 tables have 18 million pairs; none is worked out."""
    monkeypatch.setattr(audit, "lineage_closure", None)
    edges = spark.range(6000).selectExpr("concat('t', id) as table_name", "concat('t', (id + 2) % 6000) as depends_on")
    found = audit.lineage_cycles(edges, parent="depends_on").groupBy("cycle").count().collect()
    assert sorted(tuple(r) for r in found) == [("t0", 3000), ("t1", 3000)]


def test_lineage_of_any_depth(spark):
    edges = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(70)], "table_name string, depends_on string")
    deepest = audit.lineage_closure(edges.filter("cast(substr(table_name, 2) as int) < 12")).agg({"depth": "max"}).first()[0]
    assert deepest == 12


def test_lineage_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    plain = audit.materialize
    monkeypatch.setattr(audit, "materialize", lambda df, label: written.append(label) or plain(df, label))
    edges = spark.range(1000).selectExpr("concat('t', id) as table_name", "concat('t', id + 1) as depends_on")
    out = audit.lineage_closure(edges).agg(F.count("*").alias("n"), F.max("depth").alias("deepest")).first()
    assert (out["n"], out["deepest"]) == (1000 * 1001 // 2, 1000) and len(written) <= 12


@pytest.mark.parametrize("acyclic", [True, False])
def test_lineage_writes_no_pair_again(spark, rows, monkeypatch, acyclic):
    """Shortest distances of random graphs, as by walking from each table; what the rounds write is within the result's rows."""
    draw, edges = random.Random(5), [(f"c{i}", f"c{i + 1}") for i in range(21)] + [("c0", "c9"), ("c9", "c20")]
    for graph in range(20):
        size = draw.randint(2, 14)
        ends = [(draw.randrange(size), draw.randrange(size)) for _ in range(int(1.4 * size))]
        edges += [(f"{graph}.{max(e)}", f"{graph}.{min(e)}") if acyclic else (f"{graph}.{e[0]}", f"{graph}.{e[1]}") for e in ends if not acyclic or e[0] != e[1]]
    after, want = {}, []
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    for start in after:
        seen, ahead, distance = {}, {start}, 0
        while ahead:
            distance += 1
            ahead = {b for a in ahead for b in after.get(a, ()) if b not in seen}
            seen |= dict.fromkeys(ahead, distance)
        want += [(start, b, d) for b, d in seen.items()]
    written = []
    plain = audit.materialize
    monkeypatch.setattr(audit, "materialize", lambda df, label: written.append(plain(df, label)) or written[-1])
    frame = spark.createDataFrame([*edges, *edges[:9], (None, "c1"), ("c1", None)], "table_name string, depends_on string")
    assert rows(audit.lineage_closure(frame, cycles="error" if acyclic else "keep")) == sorted(want)
    assert sum(df.count() for df in written) <= len(want)


@pytest.mark.parametrize("parts", [1, 7])
def test_effective_lookup_over_many_stretches(spark, rows, parts):
    """Keys that span stretches without a version in them, NULL keys and times, versions that end, gaps."""
    draw = random.Random(parts)
    at = lambda d: dt.datetime(2020, 1, 1) + dt.timedelta(days=d)
    versions = [(0, at(0), at(5), "early"), (0, at(5), at(900), "long"), (1, at(10), None, "open"), (None, at(0), None, "no key"), (2, None, None, "no start")]
    versions += [(3, at(d), at(d + draw.randrange(1, 3)), f"v{d}") for d in range(0, 300, 3)]
    asked = [(i, draw.choice([0, 0, 0, 1, 2, 3, None, 9]), draw.choice([None, at(draw.randrange(-3, 1000))])) for i in range(3000)]
    v = spark.createDataFrame(versions, "k int, effective_from timestamp_ntz, effective_to timestamp_ntz, v string")
    f = spark.createDataFrame(asked, "id int, k int, at timestamp_ntz")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts), spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for how in ("left", "inner"):
            got = joins.effective_lookup(f, v, ["k"], "at", how=how).select("id", "v")
            brute = f.join(v.withColumnRenamed("k", "j"), F.expr("k = j and effective_from <= at and (effective_to is null or at < effective_to)"), how)
            assert rows(got) == rows(brute.select("id", "v"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0]), spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_merge_rewrites_only_the_files_that_hold_a_key(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    base = spark.range(1000).selectExpr("id as k", "concat('v', id) as v")
    base.repartitionByRange(10, "k").write.parquet(path)
    stamps = lambda: {n: os.stat(f"{path}/{n}").st_mtime_ns for n in os.listdir(path) if n.startswith("part-")}
    before = stamps()
    source = spark.createDataFrame([(5, None)], "k long, v string")
    assert merge.merge_touched_files(spark, path, source, ["k"]) == 1
    after = stamps()
    assert len(before.items() & after.items()) == 9 and not [n for n in os.listdir(path) if n.startswith("_s")]
    assert rows(spark.read.parquet(path)) == rows(merge_frames(base, source, ["k"]))
    more = spark.createDataFrame([(5, "x"), (999, "y"), (5000, "new"), (None, "none")], "k long, v string")
    want = rows(merge_frames(spark.read.parquet(path), more, ["k"]))
    assert merge.merge_touched_files(spark, path, more, ["k"]) == 2 and rows(spark.read.parquet(path)) == want
    assert merge.merge_touched_files(spark, path, more.filter("false"), ["k"]) == 0 and rows(spark.read.parquet(path)) == want
    with pytest.raises(SpecError):
        merge.merge_touched_files(spark, path, more.unionByName(more), ["k"])


@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_swap_cut_short_is_carried_out(spark, tmp_path, rows, done, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id as k", "1 as v").coalesce(1).write.parquet(path)
    source = spark.createDataFrame([(3, 7), (20, 7)], "k long, v int")
    want = rows(merge_frames(spark.read.parquet(path), source, ["k"]))
    plain, calls = merge.finish_swap, []
    monkeypatch.setattr(merge, "finish_swap", lambda *a: calls.append(1) or (plain(*a) if len(calls) < 2 else False))
    merge.merge_touched_files(spark, path, source, ["k"])
    swap = json.loads((tmp_path / "t" / "_swap.json").read_text())
    if done > 0:
        os.remove(swap["old"][0].removeprefix("file:").replace("//", "/"))
    if done > 1:
        staged, name = next(iter(swap["new"].items()))
        os.rename(staged, name)
    assert plain(spark, path) and not plain(spark, path)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == want


def test_sketches_of_versions_and_partitions_merge(spark):
    path = [str(i) for i in range(3)]
    frames = [spark.range(i * 4000, i * 4000 + 6000).selectExpr("id", "id % 97 as few", "if(id % 10 = 0, null, id / 7.0) as x", "int(id % 3) as part", "'t' || id as t") for i in range(3)]
    sketches = [manifest.sketch_profile(f, v, ["id", "few", "x", "t"], ["part"]) for f, v in zip(frames, path)]
    stored = scratch_path(spark, "sketches")
    sketches[0].unionByName(sketches[1]).unionByName(sketches[2]).write.parquet(stored)
    merged = manifest.merged_profile(spark.read.parquet(stored))
    assert "t STRING" not in merged._jdf.queryExecution().toString() and "Range (" not in merged._jdf.queryExecution().toString()
    got = {r["column_name"]: r for r in merged.collect()}
    exact = {"id": 14_000, "few": 97, "x": 12_600, "t": 14_000}
    for name, distinct in exact.items():
        assert got[name]["row_count"] == 18_000 and abs(got[name]["distinct_count"] - distinct) <= manifest.DISTINCT_ERROR * distinct
    assert got["x"]["null_count"] == 1800 and got["t"]["quantiles"] is None
    ids = sorted(i for k in range(3) for i in range(k * 4000, k * 4000 + 6000))
    for q, value in zip((0.25, 0.5, 0.75), got["id"]["quantiles"]):
        rank = sum(i <= value for i in ids) / len(ids)
        assert abs(rank - q) <= manifest.RANK_ERROR
    one = manifest.merged_profile(spark.read.parquet(stored).filter("version = '1' and part = 2"), [0.5])
    assert {r["column_name"]: r["row_count"] for r in one.collect()}["id"] == 2000
    empty = manifest.merged_profile(manifest.sketch_profile(frames[0].filter("false"), "0", ["id"]))
    assert [(r["row_count"], r["distinct_count"], r["quantiles"]) for r in empty.collect()] == [(0, 0, None)]


def test_merge_keeps_rows_of_the_null_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stored = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "a", "x"), (4, "b", "x")], "id int, p string, v string")
    stored.write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(9, None, "y"), (2, None, "y"), (3, "a", "y")], "id int, p string, v string")
    merge_partitions(spark, path, source, ["id"], ["p"])
    assert rows(spark.read.parquet(path).select("id", "p", "v")) == [
        (1, None, "x"), (2, None, "y"), (3, "a", "y"), (4, "b", "x"), (9, None, "y")
    ]
    with pytest.raises(SpecError):
        merge_partitions(spark, path, source.unionByName(source), ["id"], ["p"])


def test_versions_are_pointed_to_by_rename_and_forgotten_on_request(spark, tmp_path):
    kept = VersionedTable(spark, str(tmp_path / "v"))
    for i in range(4):
        kept.merge(spark.createDataFrame([(i, "x"), (None, "n")], "id int, v string"), ["id"])
    assert kept.version() == 4 and kept.read().filter("id is not null").count() == 4
    assert kept.forget(2) == 2 and kept.read().count() == 8
    assert sorted(p.name for p in (tmp_path / "v").iterdir() if not p.name.startswith(".")) == ["_current", "v3", "v4"]
    with pytest.raises(SpecError):
        kept.merge(spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string"), ["id"])


def test_hot_key_on_the_right_of_a_left_join(spark, rows):
    """The matches come from an inner join, which adaptive execution can split; the result is the plain one's."""
    left = spark.createDataFrame([(i, f"n{i}") for i in range(5)] + [(None, "none")], "k int, n string")
    right = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 1), (7, 1), (None, 3)], "k int, x int")
    out = joins.join_on(left, right, "l.k = r.k")
    plain = left.alias("l").join(right.alias("r"), left["k"] == right["k"], "left")
    assert rows(out) == rows(plain) and out.columns == ["k", "n", "k", "x"]
    assert rows(out.select("l.k", "r.x")) == rows(plain.select("l.k", "r.x"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Join LeftAnti" in plan and "Join LeftOuter" not in plan
    other = joins.join_on(left, right, "l.k < r.k")
    assert other.count() == left.alias("l").join(right.alias("r"), left["k"] < right["k"], "left").count()


def test_unknown_format_is_an_error(spark):
    with pytest.raises(SpecError):
        readers.read_source(spark, "/nowhere", "xml")
    with pytest.raises(Exception):
        readers.read_source(spark, "/nowhere/at/all", "parquet").count()


def test_pipeline_config():
    config = PipelineConfig("p", "/in", "/out/", "csv", "delta", encrypted_columns=["a"])
    assert config.layer_path("gold") == "/out/gold" and config.encrypted_columns == ("a",)
    for bad in (dict(pipeline_name=""), dict(input_format="xml"), dict(storage_format="zip")):
        with pytest.raises(ValueError):
            PipelineConfig(**{**dict(pipeline_name="p", landing_location="i", target_location="o", input_format="csv"), **bad})
    assert writers.format_options("hudi", "t")["hoodie.table.name"] == "t" and writers.format_options("delta", "t") == {}


def test_strict_read_keeps_every_line(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,v\n1,10\n2,x\n3\n4,40\n")
    from sediment.session import materialize

    good, bad = readers.split_corrupt(materialize(readers.read_strict(spark, str(path), "csv", "id int, v int")))
    assert [r["id"] for r in good.orderBy("id").collect()] == [1, 4]
    assert sorted(r["raw_record"] for r in bad.collect()) == ["2,x", "3"]


def test_manifest_reconcile(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    (tmp_path / "b.json").write_text('{"k": 3}\n')
    (tmp_path / "a.json.metadata.json").write_text('{\n "object_path": "landing/a.json", "record_count": 2\n}')
    (tmp_path / "c.json.metadata.json").write_text('{"object_path": "landing/c.json",\n "record_count": 5}')
    data = spark.read.schema("k int").json([str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    report = manifest.reconcile(data, manifest.read_manifests(spark, str(tmp_path)))
    assert rows(report) == [("a.json", 2, 2, True), ("b.json", 1, None, False), ("c.json", None, 5, False)]
    assert manifest.bytes_read(data).first()[0] == 27


def test_load_spec(tmp_path):
    (tmp_path / "s.json").write_text('{"a": [1]}')
    assert load_spec(str(tmp_path / "s.json")) == {"a": [1]}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_file_facts_lists_folders_by_block(spark, rows, monkeypatch):
    from sediment.plans.queries import sources

    made = []
    monkeypatch.setattr(sources, "scratch_path", lambda *a: made.append(scratch_path(*a)) or made[-1])
    found = sources.file_facts(spark, "/root/testdata/sf0.01")
    folder = made[0].removeprefix("file:")
    parts = {}
    for place, _, names in os.walk(folder):
        if any(n.endswith(".txt") for n in names):
            above, own = os.path.split(os.path.relpath(place, folder))
            assert len([n for n in names if n.endswith(".txt")]) == 1
            parts.setdefault(above, set()).add(own)
    # A listing task takes a block's folders together; none has more than sixteen.
    assert all("block=" in above and len(own) <= 16 for above, own in parts.items())
    assert sum(r["files"] for r in found.collect()) == sum(map(len, parts.values()))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_file_facts_blocks_are_of_one_task(spark, rows, monkeypatch):
    from sediment.plans.queries import sources

    made, coalesced = [], "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(sources, "scratch_path", lambda *a: made.append(scratch_path(*a)) or made[-1])
    before = spark.conf.get(coalesced)
    spark.conf.set(coalesced, "false")
    try:
        found = sources.file_facts(spark, "/root/testdata/sf0.01")
        facts = {r["folder"]: (r["row_count"], r["files"], r["file_size"]) for r in found.collect()}
    finally:
        spark.conf.set(coalesced, before)
    folder, tasks, held = made[0].removeprefix("file:"), {}, {}
    for place, _, names in os.walk(folder):
        for name in names:
            # A checksum file would be one more to make for each file of lines.
            assert not name.endswith(".txt.crc")
            if name.endswith(".txt"):
                flags, part = re.search(r"folder=([^/]*)/.*part=(\d+)$", place).groups()
                tasks.setdefault(os.path.dirname(place), set()).add(name.split("-")[1])
                with open(os.path.join(place, name)) as f:
                    held[flags, int(part)] = sorted(f.read().splitlines())
    # The commit moves a block's folders as one, as a single task has written them all.
    assert all(len(t) == 1 for t in tasks.values()) and len(set.union(*tasks.values())) > 1
    wanted = {}
    for key, number, flags in spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").selectExpr(
        "l_orderkey", "l_linenumber", "concat(l_returnflag, l_linestatus)"
    ).collect():
        wanted.setdefault((flags, key // 1000), []).append(f"{key}-{number}".rjust(30, "."))
    assert held == {place: sorted(lines) for place, lines in wanted.items()}
    for flags, (row_count, files, file_size) in facts.items():
        mine = [lines for (f, _), lines in wanted.items() if f == flags]
        assert (row_count, files, file_size) == (sum(map(len, mine)), len(mine), 31 * sum(map(len, mine)))
    assert set(facts) == {f for f, _ in wanted}


def test_write_lines_as_spark_does(spark, tmp_path, monkeypatch):
    odd = ["a/b", "x=y", "50%", "%2F", "", None, "a b", "\u00e9", "[{'\"}]", "q?#:*\\^", "t\tn\nd\x7f"]
    given = [(v, n, None if n == 2 else f"{v}-{n}-{i}") for v in odd for n in (1, 2, 10) for i in range(n)]
    df = spark.createDataFrame(given, "folder string, part int, value string")

    def held(path):
        found = {}
        for place, _, names in os.walk(path):
            for name in names:
                if name.endswith(".txt"):
                    with open(os.path.join(place, name), "rb") as f:
                        found.setdefault(os.path.relpath(place, path), []).extend(f.read().split(b"\n")[:-1])
        return {place: sorted(lines) for place, lines in found.items()}

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        writers.write_lines(df, f"file:{tmp_path}/own", "value", ["folder", "part"], ["folder"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(writers, "_local_place", lambda *a: None)
    writers.write_lines(df, f"file:{tmp_path}/theirs", "value", ["folder", "part"], ["folder"])
    assert held(tmp_path / "own") == held(tmp_path / "theirs") and len(held(tmp_path / "own")) == 30
    monkeypatch.undo()
    with pytest.raises(FileExistsError):
        writers.write_lines(df, f"file:{tmp_path}/own", "value", ["folder", "part"], ["folder"])
    writers.write_lines(df.limit(0), f"{tmp_path}/none", "value", ["folder", "part"], ["folder"])
    assert spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/none").count() == 0


def test_write_lines_whole_files_only(tmp_path, monkeypatch):
    import pyarrow as pa

    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 3)  # noqa: N815

    monkeypatch.setattr(writers, "TaskContext", Context)
    whole = pa.RecordBatch.from_pydict({"k": ["a", "a", "b"], "v": [b"1", b"2", b"3"]})
    more = pa.RecordBatch.from_pydict({"k": ["b", "c"], "v": [b"4", b"5"]})

    def ends():
        yield whole
        raise OSError("the task is lost")

    write_files = writers._line_files(str(tmp_path), ["k"])
    with pytest.raises(OSError):
        list(write_files(ends()))
    shown = lambda: {p.parent.name: p.read_bytes() for p in tmp_path.rglob("*.txt")}
    assert shown() == {"k=a": b"1\n2\n"}
    # The next try leaves the same files as a task that was never lost.
    for _ in range(2):
        list(write_files(iter([whole, whole.slice(0, 0), more])))
        assert shown() == {"k=a": b"1\n2\n", "k=b": b"3\n4\n", "k=c": b"5\n"}


def test_effective_lookup_computes_its_versions_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def noted(v):
        seen.add(1)
        return v

    versions = spark.createDataFrame([(1, "2024-01-01", "2024-02-01", 1), (1, "2024-02-01", None, 2), (2, "2024-01-15", None, 3)], "k int, f string, t string, v int")
    versions = versions.select("k", F.to_date("f").alias("effective_from"), F.to_date("t").alias("effective_to"), noted("v").alias("v"))
    facts = spark.createDataFrame([(1, 1, "2024-01-31"), (2, 1, "2024-02-01"), (3, 2, "2024-01-01")], "i int, k int, d string").withColumn("d", F.to_date("d"))
    found = joins.effective_lookup(facts, versions, ["k"], "d")
    assert rows(found.select("i", "v")) == [(1, 1), (2, 2), (3, None)]
    assert seen.value == 3
