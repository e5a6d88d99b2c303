"""Row-frame windows (``rows between L preceding and current row``) that never need one task
for all rows, and never one task for a hot group.

A window without a partition, or over a group that holds a large part of the data, would send
those rows to a single task. Here they are

1. range-partitioned by (group, order, tie-break), sorted and written once with a running id,
2. given their global position: the row's index plus the sizes of the partitions before it,
3. cut into blocks of equal size, where the last L rows of a block are also copied to the
   next one, and
4. windowed per (group, block), after which the copies are dropped.

Each frame then sees exactly the rows that the plain window would see.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.session import materialize

# Tasks get this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BLOCK_ROWS = 200_000
MIN_BLOCK_ROWS = 2_000

RollingColumns = Mapping[str, Callable[[WindowSpec], Column]]


def frame_bounds(lookback: int, exclude_current: bool = False) -> tuple[int, int]:
    return (-lookback, -1) if exclude_current else (-lookback, 0)


def rolling(
    df: DataFrame | Blocks,
    columns: RollingColumns,
    order_by: Sequence[str],
    lookback: int,
    tie_breakers: Sequence[str],
    group_by: Sequence[str] = (),
    exclude_current: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ``columns``, each a function of the window, to every row of ``df``.

    ``tie_breakers`` must make the order unique, or a row's frame would depend on the run.
    Groups of any size take the same way. ``df`` may also be :class:`Blocks` made beforehand.
    """
    if isinstance(df, Blocks):
        return df.roll(columns, exclude_current)
    return blocks(df, order_by, lookback, tie_breakers, group_by, block_rows).roll(columns, exclude_current)


@dataclass(frozen=True)
class Blocks:
    """Rows in global order, cut into blocks; several rolling computations can share them."""

    rows: DataFrame
    columns: tuple[str, ...]
    group_by: tuple[str, ...]
    lookback: int
    block_rows: int

    def roll(self, columns: RollingColumns, exclude_current: bool = False) -> DataFrame:
        window = Window.partitionBy(*self.group_by, "_block").orderBy("_pos")
        window = window.rowsBetween(*frame_bounds(self.lookback, exclude_current))
        rolled = {name: make(window) for name, make in columns.items()}
        return (
            (self.rows.withColumns(rolled) if rolled else self.rows)
            .filter(F.expr(f"_block = _pos div {self.block_rows}L"))
            .drop("_pos", "_block")
        )

    def with_quantiles(self, column: str, quantiles: Mapping[str, float], exclude_current: bool = False) -> Blocks:
        """The same blocks with exact quantiles of ``column`` over each row's frame: the value at rank
        ``ceil(fraction * n)`` of its ``n`` known values, NULL without one.

        Each block answers all its frames at once from counts over the ranks of its values
        (:class:`_RankCounts`), so the work does not depend on the look-back."""
        kind = self.rows.schema[column].dataType
        schema = T.StructType([*self.rows.schema.fields, *[T.StructField(n, kind) for n in quantiles]])
        lookback, wanted = self.lookback, dict(quantiles)

        def run(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("_pos").combine_chunks()
            values = rows.column(column).combine_chunks()
            place = np.arange(len(values))
            known = values.is_valid().to_numpy(zero_copy_only=False)
            before = np.r_[0, np.cumsum(known)]
            low = before[np.maximum(place - lookback, 0)]
            high = before[place + (0 if exclude_current else 1)]
            held = values.filter(pa.array(known))
            order = pc.sort_indices(held).to_numpy()
            counts = _RankCounts(np.argsort(order, kind="stable"))
            size = high - low
            for name, fraction in wanted.items():
                k = np.maximum(np.ceil(size * fraction).astype(np.int64), 1) - 1
                rank = counts.select(low, high, np.where(size > 0, k, 0))
                at = order[np.minimum(rank, max(len(order) - 1, 0))] if len(order) else np.zeros(len(place), np.int64)
                rows = rows.append_column(name, held.take(pa.array(at, mask=size == 0)))
            return rows

        made = self.rows.groupBy(*self.group_by, "_block").applyInArrow(run, schema)
        return replace(self, rows=made, columns=(*self.columns, *quantiles))


def numbered(df: DataFrame, sort_columns: Sequence[str]) -> tuple[DataFrame, int]:
    """``df`` with ``_pos``, each row's place in the order of the columns from 0 on, and the number of rows."""
    # The running id holds the partition number in its upper 31 bits and the row's index
    # within the partition in its lower 33 bits.
    ordered = materialize(
        df.repartitionByRange(*sort_columns)
        .sortWithinPartitions(*sort_columns)
        .withColumn("_seq", F.monotonically_increasing_id()),
        "rolling",
    )
    partition = F.shiftright("_seq", 33)
    # One row per range partition, as many as there are shuffle tasks.
    sizes = sorted(ordered.groupBy(partition.alias("_part")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _start long"))
    position = F.col("_start") + F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ordered.withColumn("_part", partition).join(offsets, "_part").select(*df.columns, position.alias("_pos"))
    return placed, total


def blocks(
    df: DataFrame,
    order_by: Sequence[str],
    lookback: int,
    tie_breakers: Sequence[str],
    group_by: Sequence[str] = (),
    block_rows: int | None = None,
) -> Blocks:
    """Steps 1 to 3: sort and write ``df`` once, number its rows, copy block ends over."""
    spark = df.sparkSession
    keep = df.columns
    placed, total = numbered(df, [*group_by, *order_by, *tie_breakers])
    if block_rows is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = -(-total // (2 * tasks))
        # Copies stay below a twentieth of the rows.
        block_rows = max(min(MAX_BLOCK_ROWS, spread), MIN_BLOCK_ROWS, 20 * lookback)
    block_rows = max(block_rows, lookback)

    home = F.expr(f"_pos div {block_rows}L")
    in_halo = F.pmod(F.col("_pos"), F.lit(block_rows)) >= F.lit(block_rows - lookback)
    rows = placed.withColumn("_block", F.explode(F.when(in_halo, F.array(home, home + 1)).otherwise(F.array(home))))
    return Blocks(rows, tuple(keep), tuple(group_by), lookback, block_rows)


class _RankCounts:
    """Counts over the ranks of a sequence, a level for each bit of a rank: how many of the first i values have
    the bit unset, the values being parted by it for the next level. The k-th least value of any stretch is
    found by a step per level, for all stretches together."""

    def __init__(self, ranks: np.ndarray):
        self.levels = []
        for bit in range(max(int(len(ranks) - 1).bit_length(), 1) - 1, -1, -1):
            unset = (ranks >> bit & 1) == 0
            self.levels.append((bit, np.r_[0, np.cumsum(unset)]))
            ranks = np.r_[ranks[unset], ranks[~unset]]

    def select(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Rank of the k-th least (from 0) among the values from ``low`` to before ``high``."""
        found = np.zeros(len(low), np.int64)
        for bit, unset in self.levels:
            a, b = unset[low], unset[high]
            up = k >= b - a
            found |= np.where(up, 1 << bit, 0)
            k = np.where(up, k - (b - a), k)
            low = np.where(up, unset[-1] + low - a, a)
            high = np.where(up, unset[-1] + high - b, b)
        return found


def rolling_avg(column: Column) -> Callable[[WindowSpec], Column]:
    return lambda window: F.avg(column).over(window)


def rolling_stddev(column: Column) -> Callable[[WindowSpec], Column]:
    return lambda window: F.stddev_samp(column).over(window)


def rolling_count() -> Callable[[WindowSpec], Column]:
    return lambda window: F.count("*").over(window)


def rolling_sorted(column: Column) -> Callable[[WindowSpec], Column]:
    """The frame's values in order; a frame holds ``lookback + 1`` of them at most."""
    return lambda window: F.sort_array(F.collect_list(column).over(window))


def rank_quantile(sorted_values: Column, fraction: float) -> Column:
    """The value at rank ``ceil(fraction * n)``, which is what ``percentile_approx`` gives for
    frames below its accuracy."""
    size = F.size(sorted_values)
    rank = F.greatest(F.ceil(size * F.lit(fraction)).cast("int"), F.lit(1))
    return F.try_element_at(sorted_values, rank)
