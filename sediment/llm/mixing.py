"""Mixing sources to target weights by Poisson replication, with built-in functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import fresh, written

# A Poisson mean above this is drawn as the sum of several equal means, so that exp(-mean) stays far from zero.
MEAN_PER_DRAW = 32.0
# Terms of the distribution that are listed per draw: beyond them lies less than 1e-16 at that mean.
TERMS = 128


@dataclass(frozen=True)
class Mixture:
    """``weights`` per group; groups not listed weigh by their size to the power ``exponent``, scaled to
    what the listed ones leave of 1 (all of it when none is listed). ``volume`` is the size of the
    result relative to the input, ``seed`` fixes the draws."""

    weights: dict[str, float] = field(default_factory=dict)
    exponent: float = 0.7
    volume: float = 1.0
    seed: int = 2026


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the parts, the same in any engine."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def group_rates(df: DataFrame, group: str, size: Column, mixture: Mixture) -> DataFrame:
    """``group``, ``total`` size, ``rate`` (mean repetitions) of each group.

    Rows are folded to one per group first. Only the two sums over groups reach the driver. A NULL
    group is a group of its own; a group of size zero repeats at rate 1."""
    totals = written(df.groupBy(group).agg(F.sum(size).cast("double").alias("total")), "totals")
    listed = F.coalesce(F.col(group).isin(list(mixture.weights)), F.lit(False)) if mixture.weights else F.lit(False)
    power = F.pow("total", F.lit(mixture.exponent))
    sums = totals.agg(F.sum("total").alias("all"), F.sum(F.when(~listed, power)).alias("rest")).first()
    left = max(0.0, 1.0 - sum(mixture.weights.values()))
    named = F.lit(None).cast("double")
    for name, weight in mixture.weights.items():
        named = F.when(F.col(group) == name, F.lit(float(weight))).otherwise(named)
    weight = F.when(listed, named).otherwise(power * F.lit(left) / F.lit(sums["rest"] or 1.0))
    target = weight * F.lit((sums["all"] or 0.0) * mixture.volume)
    rate = F.when(F.col("total") > 0, target / F.col("total")).otherwise(F.lit(1.0))
    return totals.select(group, "total", rate.alias("rate"))


def _cumulated(mean: Column) -> Column:
    """P(count <= k) for k from 0 to ``TERMS``."""
    step = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("sums"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        step,
        lambda acc, k: F.struct(
            (acc["term"] * mean / k).alias("term"),
            F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + acc["term"] * mean / k)).alias("sums"),
        ),
        lambda acc: acc["sums"],
    )


def mix(
    df: DataFrame,
    group: str = "source",
    key: str = "doc_id",
    size: str | Column = "n_chars",
    mixture: Mixture = Mixture(),
    partitions: int | None = None,
) -> DataFrame:
    """All columns, repeated by their group's rate, with ``copy`` (from 1) and ``shuffle_key``; columns of
    these names are replaced.

    A row's count inverts the Poisson distribution with its group's rate at a uniform number hashed
    from seed and key: the least k with P(count <= k) above it. The rows are then shuffled: ordered
    within and across partitions by ``shuffle_key``, a hash of seed, key and copy. A NULL key is
    replaced by a hash of the whole row; rows that repeat a key share its draw, each with its own copies.
    NULL sizes count as zero, an empty table gives no rows. Rates are few and narrow; they are
    joined as a written table, which Spark broadcasts only when the file is small enough."""
    df = df.drop(*[c for c in df.columns if c.lower() in ("copy", "shuffle_key")])
    measure = F.coalesce(F.col(size) if isinstance(size, str) else size, F.lit(0))
    rates = group_rates(df, group, measure, mixture)
    draws = F.greatest(F.ceil(F.col("rate") / F.lit(MEAN_PER_DRAW)), F.lit(1)).cast("int")
    (other, count_draws, sums, name, count) = fresh(df, "_group", "_draws", "_sums", "_name", "_count")
    table = written(
        rates.withColumn(count_draws, draws).select(
            F.col(group).alias(other), count_draws, _cumulated(F.col("rate") / F.col(count_draws)).alias(sums)
        ),
        "rates",
    )
    row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seed = F.lit(mixture.seed)
    named = df.withColumn(name, F.when(F.col(key).isNull(), row).otherwise(F.col(key).cast("string")))
    joined = named.join(table, F.col(group).eqNullSafe(F.col(other)))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col(count_draws)),
        F.lit(0),
        lambda total, j: total
        + F.aggregate(
            F.array(uniform(seed, F.lit("count"), F.col(name), j)),
            F.lit(0),
            lambda none, u: none + F.size(F.filter(F.col(sums), lambda c: c <= u)),
        ),
    )
    counted = joined.withColumn(count, drawn).drop(other, count_draws, sums).filter(F.col(count) > 0)
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(count)))).drop(count)
    keyed = copies.withColumn("shuffle_key", uniform(seed, F.lit("order"), F.col(name), F.col("copy"))).drop(name)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(n, "shuffle_key").sortWithinPartitions("shuffle_key", "copy")
