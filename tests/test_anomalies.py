import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sediment.config import AnomalyConfig, SpecError
from sediment.operators import anomalies as an
from sediment.operators import isolation_forest as forest
from sediment.operators import rolling, selection

START = dt.date(2024, 1, 1)


def days(spark, values, start=0):
    data = [(i, START + dt.timedelta(days=start + i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "id long, processing_date date, amount double")


def flagged(df, flag):
    return [r["id"] for r in df.filter(flag).orderBy("id").collect()]


def test_spike_is_found_with_enough_lookback(spark):
    df = days(spark, [10.0 + i % 3 for i in range(35)] + [500.0] + [10.0] * 4)
    config = AnomalyConfig(lookback_window=30, threshold=3.0)
    assert flagged(an.zscore(df, "amount", config, ["id"]), "is_amount_zscore_anomaly") == [35]


def test_short_lookback_cannot_reach_the_threshold(spark):
    config = AnomalyConfig(lookback_window=7, threshold=3.0)
    assert not config.reachable
    df = days(spark, [10.0 + i % 3 for i in range(20)] + [500.0])
    assert flagged(an.zscore(df, "amount", config, ["id"]), "is_amount_zscore_anomaly") == []
    past = AnomalyConfig(lookback_window=7, threshold=3.0, exclude_current=True)
    assert past.reachable
    assert 20 in flagged(an.zscore(df, "amount", past, ["id"]), "is_amount_zscore_anomaly")


def test_flat_series_and_single_row(spark):
    config = AnomalyConfig(lookback_window=5, threshold=0.1)
    out = an.zscore(days(spark, [4.0] * 9), "amount", config, ["id"])
    assert out.filter("amount_zscore is not null").count() == 0
    assert flagged(out, "is_amount_zscore_anomaly") == []
    one = an.zscore(days(spark, [4.0]), "amount", config, ["id"]).first()
    assert one["stddev_amount"] is None and one["is_amount_zscore_anomaly"] is False


def test_moving_average_of_zero(spark):
    config = AnomalyConfig("moving_average", 3, 0.5)
    out = an.moving_average(days(spark, [0.0, 0.0, 8.0]), "amount", config, ["id"])
    assert [r["amount_ma_diff"] for r in out.orderBy("id").collect()][:2] == [None, None]
    assert flagged(out, "is_amount_ma_anomaly") == [2]


def test_min_samples_gives_null_flag(spark):
    config = AnomalyConfig(lookback_window=5, threshold=3.0, min_samples=3)
    out = an.zscore(days(spark, [1.0, 2.0, 3.0, 4.0]), "amount", config, ["id"]).orderBy("id")
    assert [r["is_amount_zscore_anomaly"] for r in out.collect()] == [None, None, False, False]


def test_volume_by_date_keeps_rows_and_null_dates(spark):
    data = [(i, START + dt.timedelta(days=i % 10)) for i in range(100)]
    data += [(1000 + i, START + dt.timedelta(days=10)) for i in range(200)] + [(5000, None)]
    df = spark.createDataFrame(data, "id long, processing_date date")
    config = AnomalyConfig(lookback_window=30, threshold=2.0)
    out = an.volume(df, config)
    assert out.count() == 301
    assert flagged(out, "is_volume_anomaly") == list(range(1000, 1200))
    assert out.filter("processing_date is null").first()["volume"] == 1


def test_failure_rate_rolls_within_its_check_type(spark):
    data = []
    for day in range(12):
        for kind, bad in (("a", 0), ("b", 9)):
            wrong = 10 if (kind == "a" and day == 11) else bad
            data += [(kind, START + dt.timedelta(days=day), "FAILED" if i < wrong else "PASSED") for i in range(10)]
    df = spark.createDataFrame(data, "check_type string, check_date date, check_status string")
    config = AnomalyConfig(lookback_window=30, threshold=3.0)
    out = an.quality_failure(df, config, grain="date")
    assert [(r["check_type"], r["failure_rate"]) for r in out.filter("is_failure_pattern_anomaly").collect()] == [("a", 1.0)]


def test_run_all_reports_what_it_skips(spark):
    df = days(spark, [float(i % 5) for i in range(50)])
    found, skipped = an.detect_all(df, AnomalyConfig(lookback_window=10, threshold=2.0), ["id"])
    assert set(found) == {"volume", "zscore", "iqr", "moving_average"}
    assert skipped["error_rate"] == ["status"]
    assert set(skipped) | set(found) == {
        "volume", "processing_time", "error_rate", "quality_failure", "regional", "segment", "employment_income",
        "approval_rate", "zscore", "iqr", "isolation_forest", "moving_average",
    }
    totals = {r["detector"]: r["total_records"] for r in an.summary(found).collect()}
    assert set(totals.values()) == {50}


def test_narrow_frames_carry_their_own_columns_only(spark, monkeypatch):
    """Same rows and flags, and no other column is sorted or written on the way."""
    wide = days(spark, [float(i % 7) + 40 * (i == 33) for i in range(60)]).withColumn("end_time", F.col("processing_date"))
    wide = wide.withColumns({"start_time": F.date_sub("end_time", F.col("id").cast("int") % 5), "region": F.lit("r"), "note": F.repeat(F.lit("x"), 99)})
    config, plain, written = AnomalyConfig(lookback_window=10, threshold=2.0), rolling.materialize, []
    whole, _ = an.detect_all(wide, config, ["id"])
    monkeypatch.setattr(rolling, "materialize", lambda df, label: written.append(df.columns) or plain(df, label))
    narrow, _ = an.detect_all(wide, config, ["id"], narrow=True)
    assert len(written) == 3 and all("note" not in c and len(c) <= 6 for c in written)
    assert set(narrow) == set(whole) == {"volume", "processing_time", "regional", "zscore", "iqr", "moving_average"}
    for frames in (whole, narrow):
        frames["all"] = an.combine({n: f for n, f in frames.items()}, ["id"])
    assert sorted(map(str, narrow["all"].collect())) == sorted(map(str, whole["all"].collect()))


def test_forest_finds_the_far_points(spark):
    rng = np.random.default_rng(3)
    near = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (3000, 2)))]
    far = [(10_000 + i, 9.0 + i * 0.01, -9.0) for i in range(20)]
    df = spark.createDataFrame([*near, *far, (99_999, None, 1.0)], "id long, a double, b double").repartition(6)
    out = an.forest(df, ["a", "b"], ["id"], contamination=0.02).cache()
    assert out.count() == 3021
    marked = {r["id"] for r in out.filter("is_isolation_forest_anomaly").collect()}
    assert {10_000 + i for i in range(20)} <= marked
    assert 40 <= len(marked) <= 80
    assert out.filter("id = 99999").first()["anomaly_score"] is None
    assert out.filter("prediction = 1").count() == len(marked)


def test_forest_is_the_same_whatever_the_partitioning(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.normal(0, 1, 2000))], "id long, a double")
    first, _ = forest.fit(df.repartition(3), ["a"], ["id"])
    second, total = forest.fit(df.repartition(7).orderBy("a"), ["a"], ["id"])
    assert np.array_equal(first, second) and total == 2000


def test_score_follows_the_trees(spark):
    """Scores against a walk of the trees, one row at a time."""
    rng = np.random.default_rng(9)
    data = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 2, (300, 2)))]
    df = spark.createDataFrame(data, "id long, a double, b double")
    nodes, _ = forest.fit(df, ["a", "b"], ["id"], trees=7, sample_size=32)
    scores = {r["id"]: r["anomaly_score"] for r in forest.score(df, ["a", "b"], nodes).collect()}
    by_node = {(int(n[0]), int(n[1])): n for n in nodes}
    for i, *x in data[:40]:
        total = 0.0
        trees = sorted({int(n[0]) for n in nodes})
        for tree in trees:
            node = by_node[tree, 0]
            while node[2] >= 0:
                node = by_node[tree, int(node[4] if x[int(node[2])] < node[3] else node[5])]
            total += node[6]
        assert scores[i] == pytest.approx(2 ** -(total / len(trees)))


def test_combined_findings(spark):
    df = days(spark, [10.0 + i % 3 for i in range(35)] + [500.0])
    found, _ = an.detect_all(df, AnomalyConfig(lookback_window=30, threshold=3.0), ["id"])
    events = an.detection_events(an.combine(found, ["id"]), ["id"])
    kinds = {(r["detection_type"], r["severity"]) for r in events.collect()}
    assert kinds == {("group_pattern", "high")}
    assert events.filter(F.col("details").contains('"id":35')).count() >= 2


def test_group_pattern_rolls_all_features_in_one_pass(spark):
    df = spark.range(300).selectExpr(
        "id",
        "concat('g', id % 3) as g",
        "date_add(date'2024-01-01', int(id div 3)) as processing_date",
        "double(id * 7 % 11) as a",
        "double(if(id = 240, 900, id * 5 % 13)) as b",
    )
    config = AnomalyConfig(lookback_window=30, threshold=4.0)
    out = an.group_pattern(df, config, ["g"], ["a", "b"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    assert flagged(out, "is_b_zscore_anomaly") == [240] and flagged(out, "is_a_zscore_anomaly") == []
    alone = an.zscore(df, "b", config, ["id"], group_by=["g"])
    same = out.join(alone.withColumnRenamed("b_zscore", "z").select("id", "z"), "id").filter("not (b_zscore <=> z)")
    assert same.count() == 0


def test_frame_of_days(spark, rows):
    """Against a range window; gaps between dates, several rows per date, equal values, NULLs."""
    df = spark.range(400).selectExpr(
        "id",
        "concat('g', id % 2) as g",
        "date_add(date'2024-01-01', int(id * id % 90)) as processing_date",
        "if(id % 17 = 0, null, if(id % 2 = 0, 5.0D, double(id * 7919 % 1000) + 1e6)) as v",
    )
    for exclude in (False, True):
        config = AnomalyConfig(lookback_window=6, threshold=1.5, frame="days", exclude_current=exclude, min_samples=2)
        out = an.zscore(df, "v", config, ["id"], group_by=["g"])
        over = f"over (partition by g order by unix_date(processing_date) range between 6 preceding and {'1 preceding' if exclude else 'current row'})"
        plain = df.selectExpr("id", f"round(avg(v) {over}, 6) as a", f"round(coalesce(stddev_samp(v) {over}, -1), 4) as s")
        mine = out.selectExpr("id", "round(avg_v, 6) as a", "round(coalesce(stddev_v, -1), 4) as s")
        assert rows(mine) == rows(plain)
        assert out.filter("g = 'g0' and v_zscore is not null").count() == 0
    average = an.moving_average(df, "v", AnomalyConfig("moving_average", 6, 0.5, frame="days"), ["id"])
    assert average.columns == ["id", "g", "processing_date", "v", "ma_v", "v_ma_diff", "is_v_ma_anomaly"]


def test_frame_of_days_has_no_quartiles(spark):
    with pytest.raises(SpecError):
        an.iqr(days(spark, [1.0]), "amount", AnomalyConfig("iqr", 5, 1.0, frame="days"), ["id"])


@pytest.mark.parametrize("share", [0.1, 0.333, 0.0001, 1.0])
def test_highest_share_is_exact_among_ties(spark, share):
    """40,000 rows of which a third have one score and another third come from one group; NULL and NaN scores."""
    rows = [(i, i % 7, float(i % 3 and i % 1000), "hot" if i % 3 == 1 else f"g{i % 11}") for i in range(40_000)]
    rows += [(-1, 0, None, "hot"), (-2, 0, float("nan"), "hot"), (-3, None, 5.0, None), (-4, 1, 5.0, None)]
    df = spark.createDataFrame(rows, "id long, part long, s double, g string").repartition(16)
    plain = [r for r in rows if r[2] is not None and r[2] == r[2]]
    order = lambda r: (-r[2], r[1] is not None, r[1] or 0, r[0])
    want = {r[0] for r in sorted(plain, key=order)[: math.ceil(round(share * len(plain), 6))]}
    out = selection.flag_highest(df, "s", share, ["part", "id"], "high")
    assert out.columns == [*df.columns, "high"] and out.count() == len(rows)
    assert {r["id"] for r in out.filter("high").collect()} == want
    want = set()
    for g in {r[3] for r in plain}:
        own = sorted((r for r in plain if r[3] == g), key=order)
        want |= {r[0] for r in own[: math.ceil(round(share * len(own), 6))]}
    out = selection.flag_highest(df, "s", share, ["part", "id"], "high", ["g"])
    assert out.count() == len(rows) and {r["id"] for r in out.filter("high").collect()} == want


def test_highest_share_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "id long, s double")
    for frame in (df, df.filter("false")):
        assert [r["high"] for r in selection.flag_highest(frame, "s", 0.5, ["id"], "high").collect()] == [False] * frame.count()


def test_group_forests_are_those_of_each_group_alone(spark):
    """Groups of 4000, 300 and 20 rows, and a NULL group; features missing here and there."""
    draw = np.random.default_rng(3)
    groups = ["big"] * 4000 + ["mid"] * 300 + ["few"] * 20 + [None] * 200
    rows = [(i, g, float(draw.normal()), None if i % 50 == 7 else float(draw.normal())) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "id long, g string, a double, b double")
    config = AnomalyConfig("isolation_forest", 30, 0.95, min_samples=100)
    old, forest.GROUP_BLOCK_ROWS = forest.GROUP_BLOCK_ROWS, 500  # the big group is scored in eight blocks
    try:
        out = {r["id"]: r for r in an.group_pattern(df, config, ["g"], ["a", "b"], ["id"], "id").collect()}
    finally:
        forest.GROUP_BLOCK_ROWS = old
    assert len(out) == len(rows)
    for g in ("big", "mid", None):
        own = df.filter(F.col("g").eqNullSafe(F.lit(g)))
        nodes, _ = forest.fit(own, ["a", "b"], ["id"])
        alone = {r["id"]: r["anomaly_score"] for r in forest.score(own, ["a", "b"], nodes).collect()}
        assert all(out[i]["anomaly_score"] == s for i, s in alone.items()) and any(s is None for s in alone.values())
        scored = sorted(s for s in alone.values() if s is not None)
        marked = [i for i in alone if out[i]["is_group_pattern_anomaly"]]
        assert len(marked) == math.ceil(round(0.05 * len(scored), 6)) and min(alone[i] for i in marked) >= scored[-len(marked)]
    few = [r for r in out.values() if r["g"] == "few"]
    assert all(r["anomaly_score"] is None and r["is_group_pattern_anomaly"] is None for r in few)


def test_scores_at_the_threshold_do_not_turn_on_the_last_bit(spark):
    df = spark.createDataFrame([(1, 2.0000000000000004), (2, 2.000001), (3, 1.9999999999)], "id int, z double")
    assert [r[0] for r in df.orderBy("id").select(an._beyond(F.col("z"), 2.0)).collect()] == [False, True, False]
