"""Join chains, reference look-ups, orphans and effective-dated look-ups."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.config import SpecError
from sediment.operators.rolling import rolling
from sediment.session import materialize

# Tasks get this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def join_chain(frames: Sequence[DataFrame], conditions: Sequence[Mapping]) -> DataFrame:
    """Left-deep chain: frame ``i + 1`` joins on ``conditions[i]['on']`` with ``how`` (inner).

    No hints: adaptive execution broadcasts what turns out small and splits hot partitions.
    """
    if not frames:
        raise SpecError("a join chain needs at least one table")
    if len(conditions) != len(frames) - 1:
        raise SpecError(f"{len(frames)} tables need {len(frames) - 1} join conditions, got {len(conditions)}")
    steps = zip(frames[1:], conditions)
    return reduce(lambda left, step: left.join(step[0], step[1]["on"], step[1].get("how", "inner")), steps, frames[0])


_EQUALITY = re.compile(r"\s*(\w+)\.(\w+)\s*=\s*(\w+)\.(\w+)\s*")


def equal_columns(condition: str, left: Sequence[str], right: str) -> list[tuple[str, str]] | None:
    """(left, right) column of each equality, qualified; None unless the condition holds nothing else."""
    pairs = []
    for part in re.split(r"\band\b", condition, flags=re.IGNORECASE):
        m = _EQUALITY.fullmatch(part)
        if not m:
            return None
        a, x, b, y = m.groups()
        if a == right:
            a, x, b, y = b, y, a, x
        if a not in left or b != right:
            return None
        pairs.append((f"{a}.{x}", f"{b}.{y}"))
    return pairs


def left_join(left: DataFrame, right: DataFrame, condition: str, left_names: Sequence[str], right_name: str) -> DataFrame:
    """Left join of aliased frames whose right side may hold a hot key.

    Rows on the right of a left join are never split, those of an inner join are. So the matches come
    from an inner join, and the rows without any from an anti join with the right side's keys folded
    to one row each. Conditions that are not plain equalities take the ordinary left join."""
    pairs = equal_columns(condition, left_names, right_name)
    if not pairs:
        return left.join(right, F.expr(condition), "left")
    matched = left.join(right, F.expr(condition), "inner")
    keys = right.select(*[F.col(y).alias(f"_match{i}") for i, (_, y) in enumerate(pairs)]).distinct()
    alone = left.join(keys, [F.col(x) == F.col(f"_match{i}") for i, (x, _) in enumerate(pairs)], "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.union(alone.select("*", *empty))


def join_on(
    left: DataFrame, right: DataFrame, condition: str, how: str = "left", names: tuple[str, str] = ("l", "r")
) -> DataFrame:
    """Join by SQL text that refers to the sides by ``names``."""
    left, right = left.alias(names[0]), right.alias(names[1])
    if how == "left":
        return left_join(left, right, condition, names[:1], names[1])
    return left.join(right, F.expr(condition), how)


def _renamed_keys(df: DataFrame, columns: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def orphans(
    source: DataFrame, target: DataFrame, source_columns: Sequence[str], target_columns: Sequence[str]
) -> DataFrame:
    """Source rows without a target row. A NULL in any key column finds nothing."""
    wanted = target.select(*_renamed_keys(target, target_columns, "_t"))
    condition = [F.col(c) == F.col(f"_t{i}") for i, c in enumerate(source_columns)]
    return source.join(wanted, condition, "left_anti")


def key_counts(
    source: DataFrame, target: DataFrame, source_columns: Sequence[str], target_columns: Sequence[str]
) -> DataFrame:
    """Distinct key values with their row counts, and ``_known`` (true, or NULL without a target row).

    Both sides are folded to one row per key before they meet, so a key that holds a third of
    the rows is a single row by then. An outer join with a marker keeps the fold in place: the
    optimizer would move an anti join below it, and shuffle the unfolded rows.
    """
    counted = source.groupBy(*source_columns).agg(F.count("*").alias("row_count"))
    known = target.select(*_renamed_keys(target, target_columns, "_t")).distinct().withColumn("_known", F.lit(True))
    condition = [F.col(c) == F.col(f"_t{i}") for i, c in enumerate(source_columns)]
    return counted.join(known, condition, "left").select(*source_columns, "row_count", "_known")


def orphan_keys(
    source: DataFrame, target: DataFrame, source_columns: Sequence[str], target_columns: Sequence[str]
) -> DataFrame:
    """Distinct orphaned key values with their row counts."""
    counted = key_counts(source, target, source_columns, target_columns)
    return counted.filter(F.col("_known").isNull()).drop("_known")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def enrich(
    df: DataFrame,
    reference: DataFrame,
    keys: Mapping[str, str],
    outputs: Mapping[str, str],
    check_unique: bool = True,
) -> DataFrame:
    """Left join that adds reference columns. ``keys`` maps df column to reference column,
    ``outputs`` maps new name to reference column. A repeated reference key is an error, as
    it would multiply rows."""
    if check_unique and not duplicate_keys(reference, list(keys.values())).isEmpty():
        raise SpecError(f"reference key {list(keys.values())} is not unique")
    side = reference.select(
        *_renamed_keys(reference, list(keys.values()), "_k"),
        *[F.col(src).alias(new) for new, src in outputs.items()],
    )
    condition = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
    return df.join(side, condition, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def validate_against(df: DataFrame, reference: DataFrame, keys: Mapping[str, str], flag: str) -> DataFrame:
    """Add ``flag``: whether the key combination exists in the reference; NULL for a NULL key."""
    side = (
        reference.select(*_renamed_keys(reference, list(keys.values()), "_k"))
        .distinct()
        .withColumn("_found", F.lit(True))
    )
    condition = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    value = F.when(~any_null, F.coalesce("_found", F.lit(False)))
    joined = df.join(side, condition, "left")
    return joined.select(*[F.col(c) for c in df.columns], value.alias(flag))


def overlapping(versions: DataFrame, keys: Sequence[str], start: str, end: str) -> bool:
    """Whether a version begins before the one before it of its keys has ended: where none does, no two overlap.
    Versions are looked at in blocks of one sorted order, so a key with many of them is no task of its own."""
    rows = versions.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(start).cast("timestamp_ntz").alias("_begins"),
        F.coalesce(F.col(end).cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz")).alias("_ends"),
    )
    before = {"_reach": lambda window: F.max("_ends").over(window)}
    rolled = rolling(rows, before, ["_begins"], 1, ["_ends"], [f"_k{i}" for i in range(len(keys))], exclude_current=True)
    return not rolled.filter(F.col("_reach") > F.col("_begins")).isEmpty()


def carry_forward(rows: DataFrame, key: str, order_by: Sequence[str], known: str, payload: str) -> DataFrame:
    """``rows`` with ``payload`` of the last row of their ``key`` (text) up to them for which ``known`` holds, else NULL.

    The rows are range sorted once by key and order, so a key of any size spreads over tasks. Each task fills
    its stretch in Arrow batches; what a stretch needs from those before it is the last known row of
    one of them, a row per task."""
    ordered = rows.repartitionByRange(key, *order_by).sortWithinPartitions(key, *order_by)
    ordered = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_filled", F.col(payload))
    schema, names = ordered.schema, ordered.columns

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, None  # of the last known row
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(names.index(key)).to_numpy(zero_copy_only=False)
            mark = batch.column(names.index(known)).to_numpy(zero_copy_only=False).astype(bool)
            place = np.arange(len(keys))
            first = np.maximum.accumulate(np.where(np.r_[True, keys[1:] != keys[:-1]], place, 0))
            last = np.maximum.accumulate(np.where(mark, place, -1))
            at = np.where(last >= first, last + 1, 0)
            if held is not None and keys[0] == held_key:
                carried = (at == 0) & (first == 0)
            else:
                carried = np.zeros(len(keys), bool)
            values = batch.column(names.index(payload))
            before = held if held is not None else pa.nulls(1, values.type)
            source = pa.concat_arrays([before, values])
            filled = source.take(pa.array(at, mask=(at == 0) & ~carried))
            if mark.any():
                row = int(np.flatnonzero(mark)[-1])
                held_key, held = keys[row], values.slice(row, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], filled], names=names)

    written = materialize(ordered.mapInArrow(fill, schema), "sequence")
    tails = written.filter(known).groupBy("_part").agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(payload).alias("v")), F.struct(key, *order_by)).alias("_tail"))
    # A row per task; the window over all of them carries the last tail on over tasks without a known row.
    every = written.select("_part").distinct().join(tails, "_part", "left")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = materialize(every.select("_part", F.last("_tail", ignorenulls=True).over(ahead).alias("_carry")), "carry")
    joined = written.join(F.broadcast(carry), "_part")
    filled = F.coalesce("_filled", F.when(F.col("_carry.k") == F.col(key), F.col("_carry.v")))
    return joined.withColumn("_filled", filled).select(*rows.columns, "_filled")


def effective_lookup(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str = "effective_from",
    end: str = "effective_to",
    row_id: Sequence[str] = (),
    bucket_days: int = 32,
    how: str = "left",
) -> DataFrame:
    """Attach the version in force at ``at``: ``start <= at < end``, an empty end is open.

    Facts and the starts of versions form one sequence by key and time, and each fact takes the last version
    before it, if that has not ended (:func:`carry_forward`): no version is copied, and a key of any size
    spreads over tasks. Keys or times that are NULL find nothing. If versions overlap, the one with the
    latest start wins, ``row_id`` must identify a fact, and the look-up goes by time buckets of
    ``bucket_days`` (:func:`_lookup_by_buckets`)."""
    # Written once: each of the two range sorts that follow reads its input twice, to sample it and to deal it out.
    versions = materialize(versions.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, start]])), "versions")
    if overlapping(versions, keys, start, end):
        if not row_id:
            raise SpecError("versions overlap: name the columns that identify a fact in row_id")
        return _lookup_by_buckets(facts, versions, keys, at, start, end, row_id, bucket_days, how)
    payload = [c for c in versions.columns if c not in keys]
    name = F.to_json(F.struct(*[F.col(f"_k{i}") for i in range(len(keys))]))
    kinds = [facts.schema[k].dataType for k in keys]

    def sequence(df: DataFrame, when: str, is_version: bool, own: str) -> DataFrame:
        keyed = df.withColumns({f"_k{i}": F.col(k).cast(kind) for i, (k, kind) in enumerate(zip(keys, kinds, strict=True))})
        kept = F.struct(*[F.col(c) for c in (payload if is_version else facts.columns)]).alias(own)
        return keyed.select(name.alias("_key"), F.col(when).cast("timestamp_ntz").alias("_time"), F.lit(is_version).alias("_known"), kept)

    rows = sequence(versions, start, True, "_version").unionByName(sequence(facts, at, False, "_fact"), allowMissingColumns=True)
    # Of one moment the version comes first: false sorts before true.
    rows = rows.withColumn("_after", ~F.col("_known"))
    filled = carry_forward(rows, "_key", ["_time", "_after"], "_known", "_version").filter(~F.col("_known"))
    found = F.col("_filled")
    force = F.col("_time").isNotNull() & (found[end].isNull() | (F.col("_time") < found[end].cast("timestamp_ntz")))
    out = filled.select("_fact.*", F.when(force, found).alias("_v"))
    if how == "inner":
        out = out.filter("_v is not null")
    return out.select(*facts.columns, *[F.col("_v")[c].alias(c) for c in payload])


def _lookup_by_buckets(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str, end: str, row_id: Sequence[str], bucket_days: int, how: str
) -> DataFrame:
    """Versions that overlap: each appears once per bucket of time it covers, a fact meets those of its own bucket,
    and the latest start wins."""

    def bucket(c: Column) -> Column:
        return F.floor(F.unix_date(c.cast("date")) / F.lit(bucket_days)).cast("long")

    payload = [c for c in versions.columns if c not in keys]
    condition = [F.col(k) == F.col(f"_v_{k}") for k in keys]
    condition += [F.col(start) <= F.col(at), F.col(end).isNull() | (F.col(at) < F.col(end))]
    span = facts.agg(F.struct(F.min(bucket(F.col(at))).alias("lo"), F.max(bucket(F.col(at))).alias("hi"))).scalar()
    low, high = span.getField("lo"), span.getField("hi")
    side = (
        versions.withColumn("_first", F.greatest(bucket(F.col(start)), low))
        .withColumn("_last", F.least(F.coalesce(bucket(F.col(end)), high), high))
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("_bucket", F.explode(F.sequence("_first", "_last")))
    )
    side = materialize(side.select(*[F.col(k).alias(f"_v_{k}") for k in keys], "_bucket", *payload), "versions")
    condition.append(F.col("_at_bucket") == F.col("_bucket"))
    wide = facts.withColumn("_at_bucket", bucket(F.col(at))).join(side, condition, how).select(*facts.columns, *payload)
    rest = [c for c in wide.columns if c not in row_id]
    # A fact without a version keeps its one row, whose start is empty.
    began = F.coalesce(F.col(start).cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz"))
    best = wide.groupBy(*row_id).agg(F.max_by(F.struct(*rest), began).alias("_best"))
    return best.select(*row_id, "_best.*").select(*wide.columns)
