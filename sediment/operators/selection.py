"""Exactly the highest share of rows, over everything or within groups, without sorting everything.

A sketch gives two values that hold the wanted rank between them; one count says how many rows lie above;
only the rows between are put in order, by a range sort that no group, however large, sends to one task.
Rows of equal score are told apart by their keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.operators.rolling import numbered
from sediment.session import materialize

# The sketch may be wrong by one rank in so many; the bracket reaches twice as far to either side.
ACCURACY = 10_000


def rows_of_share(share: float, count: Column) -> Column:
    """``ceil(share * count)``, where a share such as 0.1 of 30 rows is 3 rows."""
    return F.ceil(F.round(F.lit(float(share)) * count, 6)).cast("long")


def highest_cut(df: DataFrame, score: str, share: float, keys: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    """A row per group: the score and the keys of the last row that is among the highest ``share``.

    Columns: those of ``group_by``, ``_rows`` (rows with a score), ``_score``, and ``_key0``... NULL and NaN scores take no
    part; groups without a score, or a share of no row, have no cut. One written table, of the groups' number."""
    value = F.col(f"`{score}`").cast("double")
    groups = [F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group_by)] or [F.lit(True).alias("_g0")]
    names = [f"_g{i}" for i in range(len(groups))]
    rows = df.select(
        *groups, F.when(~F.isnan(value), value).alias("_s"), *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    ).filter("_s is not null")
    reach = 2.0 / ACCURACY
    marks = F.array(F.lit(max(0.0, 1 - share - reach)), F.lit(min(1.0, 1 - share + reach)))
    sketch = rows.groupBy(*names).agg(F.count("*").alias("_rows"), F.percentile_approx("_s", marks, ACCURACY).alias("_b"))
    bounds = materialize(
        sketch.select(*names, "_rows", rows_of_share(share, F.col("_rows")).alias("_k"), F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi")), "bounds"
    ).filter("_k > 0")

    def beside(frame: DataFrame, other: DataFrame) -> DataFrame:
        other = other.withColumnsRenamed({n: f"{n}_r" for n in names})
        same = [F.col(n).eqNullSafe(F.col(f"{n}_r")) for n in names]
        return frame.join(other, same).drop(*[f"{n}_r" for n in names])

    bounded = beside(rows, bounds)
    above, inside = F.count_if(F.col("_s") > F.col("_hi")), F.count_if(F.col("_s") >= F.col("_lo"))
    counted = bounded.groupBy(*names, "_rows", "_k", "_lo", "_hi").agg(above.alias("_above"), inside.alias("_upto"))
    held = (F.col("_k") > F.col("_above")) & (F.col("_k") <= F.col("_upto"))
    # Should a sketch ever miss, its group is put in order whole.
    known = materialize(
        counted.select(
            *names, "_rows", (F.col("_k") - F.when(held, F.col("_above")).otherwise(0)).alias("_rank"),
            F.when(held, F.col("_lo")).otherwise(F.lit(float("-inf"))).alias("_lo"),
            F.when(held, F.col("_hi")).otherwise(F.lit(float("inf"))).alias("_hi"),
        ), "counts",
    )
    between = beside(rows, known).filter("_s between _lo and _hi").select(*rows.columns, "_rows", "_rank", (-F.col("_s")).alias("_falling"))
    order = [*names, "_falling", *[f"_key{i}" for i in range(len(keys))]]
    placed, _ = numbered(between, order)
    placed = materialize(placed, "between")
    firsts = placed.groupBy(*names).agg(F.min("_pos").alias("_first"))
    last = beside(placed, firsts).filter(F.col("_pos") - F.col("_first") + 1 == F.col("_rank"))
    out = [F.col(n).alias(g) for n, g in zip(names, group_by, strict=False)]
    return materialize(last.select(*out, "_rows", F.col("_s").alias("_score"), *[f"_key{i}" for i in range(len(keys))]), "cuts")


def flag_highest(
    df: DataFrame, score: str, share: float, keys: Sequence[str], flag: str, group_by: Sequence[str] = ()
) -> DataFrame:
    """``df`` with ``flag``: whether the row is among the ``ceil(share * n)`` highest of all, or of its group.

    ``n`` counts the rows with a score; others are not flagged. Of equal scores those of the least keys go first
    (NULL least); rows that share score and keys are flagged alike. NULL is a group. An empty table stays one."""
    cuts = highest_cut(df, score, share, keys, group_by).withColumnsRenamed({g: f"_cut_{i}" for i, g in enumerate(group_by)}).drop("_rows")
    same = [F.col(f"`{g}`").eqNullSafe(F.col(f"_cut_{i}")) for i, g in enumerate(group_by)]
    joined = df.join(cuts, same, "left") if same else df.join(F.broadcast(cuts), how="left")
    value = F.col(f"`{score}`").cast("double")
    own = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    cut = F.struct(*[F.col(f"_key{i}").alias(f"k{i}") for i in range(len(keys))])
    high = ~F.isnan(value) & ((value > F.col("_score")) | ((value == F.col("_score")) & (own <= cut)))
    return joined.withColumn(flag, F.coalesce(high, F.lit(False))).drop("_score", *[f"_key{i}" for i in range(len(keys))], *[f"_cut_{i}" for i in range(len(group_by))])
