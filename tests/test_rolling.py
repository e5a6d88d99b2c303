"""Block windows against plain windows, against brute force, and their plans."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sediment.operators import rolling as r


def plain(df, lookback, group=(), exclude=False):
    w = Window.partitionBy(*group).orderBy("d", "id").rowsBetween(*r.frame_bounds(lookback, exclude))
    return df.withColumns({"a": F.avg("x").over(w), "n": F.count("*").over(w), "s": F.sum("id").over(w)})


def blocked(df, lookback, group=(), exclude=False, **options):
    columns = {
        "a": r.rolling_avg(F.col("x")),
        "n": r.rolling_count(),
        "s": lambda w: F.sum("id").over(w),
    }
    return r.rolling(df, columns, ["d"], lookback, ["id"], group, exclude, **options)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many rows on one date, NULL dates, NULL values."""
    random.seed(7)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else f"g{i % 11}"
        day = None if i % 97 == 0 else 5 if i % 4 == 0 else random.randrange(40)
        data.append((i, group, day, None if i % 53 == 0 else random.random()))
    return spark.createDataFrame(data, "id long, g string, d int, x double").repartition(8).cache()


@pytest.mark.parametrize("lookback,block_rows", [(1, 1), (7, 7), (30, 100), (30, None), (500, 500), (4000, None)])
def test_blocks_equal_plain_window(skewed, rows, lookback, block_rows):
    assert rows(blocked(skewed, lookback, block_rows=block_rows)) == rows(plain(skewed, lookback))


def test_block_smaller_than_lookback_is_widened(skewed, rows):
    assert rows(blocked(skewed, 50, block_rows=3)) == rows(plain(skewed, 50))


def test_hot_group_is_split(skewed, rows):
    split = blocked(skewed, 12, ["g"], block_rows=64)
    assert rows(split) == rows(plain(skewed, 12, ["g"]))
    assert "hashpartitioning(g" not in split._jdf.queryExecution().executedPlan().toString().split("_block")[0]


def test_groups_of_any_size_have_one_plan(skewed, rows):
    def shape(df):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return [line.strip(" :+-").split(" ")[0].split("(")[0] for line in plan.splitlines()]

    small, large = blocked(skewed.limit(50), 12, ["g"]), blocked(skewed, 12, ["g"])
    assert shape(small) == shape(large)
    assert rows(large) == rows(plain(skewed, 12, ["g"]))


def test_current_row_can_be_left_out(skewed, rows):
    assert rows(blocked(skewed, 9, exclude=True, block_rows=50)) == rows(plain(skewed, 9, exclude=True))


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, g string, d int, x double")
    assert blocked(df, 5).count() == 0
    assert blocked(df, 5, ["g"]).count() == 0


def test_no_single_partition_exchange(skewed):
    plan = blocked(skewed, 30)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_rank_quantile_equals_percentile(skewed, rows):
    w = Window.orderBy("d", "id").rowsBetween(-30, 0)
    expected = skewed.select(
        "id", *[F.expr(f"percentile_approx(x, {p})").over(w).alias(f"p{i}") for i, p in enumerate((0.25, 0.5, 0.75))]
    )
    sorted_values = r.rolling(skewed, {"v": r.rolling_sorted(F.col("x"))}, ["d"], 30, ["id"], block_rows=40)
    got = sorted_values.select(
        "id", *[r.rank_quantile(F.col("v"), p).alias(f"p{i}") for i, p in enumerate((0.25, 0.5, 0.75))]
    )
    assert rows(got) == rows(expected)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=40),
    st.integers(1, 6),
    st.integers(1, 9),
)
def test_any_series(spark, rows, series, lookback, block_rows):
    data = [(i, f"g{g}", d, float(i * i % 7)) for i, (g, d) in enumerate(series)]
    df = spark.createDataFrame(data, "id long, g string, d int, x double")
    assert rows(blocked(df, lookback, block_rows=block_rows)) == rows(plain(df, lookback))


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("lookback,size", [(0, 300), (7, 3000), (30, 3000), (5000, 12_000)])
def test_quantiles_of_any_look_back(spark, lookback, size, exclude):
    """Ties, NULLs, NaN, a hot group and one of a single row; blocks of a few thousand rows."""
    draw = random.Random(lookback)
    rows = [(i, "hot" if i % 3 else f"g{i % 5}", draw.choice([None, 1.0, 2.0, -0.5, draw.random() * 9])) for i in range(size)] + [(-1, "one", None), (-2, "two", 4.0)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    cut = r.blocks(df, ["id"], lookback, [], ["g"], block_rows=max(2000, lookback))
    made = cut.with_quantiles("x", {"q1": 0.25, "q3": 0.75, "low": 0.0, "high": 1.0}, exclude).roll({}, exclude)
    assert made.columns == ["id", "g", "x", "q1", "q3", "low", "high"]
    got = {row["id"]: (row["q1"], row["q3"], row["low"], row["high"]) for row in made.collect()}
    assert len(got) == len(rows)
    asked = set(draw.sample(range(size), min(size, 600))) | {-1, -2}
    for g in {row[1] for row in rows}:
        own = sorted(row for row in rows if row[1] == g)
        for i, (key, _, _) in enumerate(own):
            if key in asked:
                frame = sorted(v for _, _, v in own[max(0, i - lookback) : i + (not exclude)] if v is not None)
                n = len(frame)
                assert got[key] == (tuple(frame[max(math.ceil(n * f), 1) - 1] for f in (0.25, 0.75, 0.0, 1.0)) if n else (None,) * 4)


def test_work_of_quantiles_does_not_follow_the_look_back():
    import numpy as np

    ranks = np.random.default_rng(1).permutation(100_000)
    counts, place = r._RankCounts(ranks), np.arange(100_000)
    assert len(counts.levels) == 17
    for lookback in (30, 5000):
        low, high = np.maximum(place - lookback, 0), place + 1
        k = (high - low) // 2
        found = counts.select(low, high, k)
        for i in range(0, 100_000, 9973):
            assert found[i] == np.sort(ranks[low[i] : high[i]])[k[i]]
