"""Keyed merge: matched keys take the source row, other keys keep theirs or are added."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import SpecError
from sediment.operators.dedup import keep_latest
from sediment.session import materialize
from sediment.sources.writers import write_silver


def require_unique(source: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> None:
    """Refuse a source that holds a key twice, as its rows would race for the target row."""
    known = [F.col(k).isNotNull() for k in keys if k not in null_safe]
    rows = source.filter(reduce(lambda a, b: a & b, known)) if known else source
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        raise SpecError(f"the source holds a key of {list(keys)} more than once")


def merge_frames(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """Full outer join with a marker per side, so that a NULL in the source row wins as well.

    A NULL key matches nothing: such source rows are added. Keys named in ``null_safe`` match on
    NULL too. ``source`` must hold a key once (:func:`require_unique`).
    """
    if set(target.columns) != set(source.columns):
        raise SpecError("merge needs the same columns on both sides")
    # Rows with an empty key meet nothing; spread them, as they would share one join task.
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys if k not in null_safe], F.lit(False))
    spread = F.when(empty, F.pmod(F.xxhash64(*target.columns), F.lit(1000))).otherwise(F.lit(-1))
    t = target.withColumn("_spread", spread).withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_spread", spread).withColumn("_in_source", F.lit(True)).alias("s")
    condition = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in [*keys, "_spread"] if k not in null_safe]
    condition += [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in null_safe]
    picked = [
        F.when(F.col("s._in_source"), F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)
        for name in target.columns
    ]
    return t.join(s, condition, "full_outer").select(*picked)


def latest_source(source: DataFrame, keys: Sequence[str], precombine: str) -> DataFrame:
    """One row per key, the one with the greatest ``precombine`` value."""
    rest = [c for c in source.columns if c not in keys and c != precombine]
    return keep_latest(source, keys, precombine, tie_breakers=rest)


def upsert_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], precombine: str) -> DataFrame:
    """Merge after reducing the source to its latest row per key."""
    return merge_frames(target, latest_source(source, keys, precombine), keys)


class VersionedTable:
    """A plain parquet table whose versions are directories and whose current one is named
    in a pointer file. Readers never see a half-written version; a failed write leaves the
    pointer as it was."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _pointer(self):
        jvm = self.spark._jvm
        location = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_current")
        return location, location.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        location, fs = self._pointer()
        if not fs.exists(location):
            return 0
        stream = fs.open(location)
        try:
            return stream.readInt()
        finally:
            stream.close()

    def _point_to(self, number: int) -> None:
        """Write the pointer beside the old one and rename it over that, so readers find either."""
        location, fs = self._pointer()
        jvm = self.spark._jvm
        beside = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_next-{uuid.uuid4().hex}")
        stream = fs.create(beside, False)
        try:
            stream.writeInt(number)
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(location.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fs.makeQualified(beside), fs.makeQualified(location), options)

    def register(self, table: str) -> None:
        """Make the current version readable as ``table`` of the session's catalog."""
        location = f"{self.path}/v{self.version()}"
        if self.spark.catalog.tableExists(table):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(table)
        else:
            self.spark.catalog.createTable(table, location, "parquet")

    def forget(self, keep: int = 1) -> int:
        """Delete all but the last ``keep`` versions; returns how many went. Frames that read those end."""
        location, fs = self._pointer()
        removed = 0
        for number in range(1, self.version() - max(keep, 1) + 1):
            removed += bool(fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{number}"), True))
        return removed

    def read(self) -> DataFrame:
        number = self.version()
        if not number:
            raise SpecError(f"{self.path} holds no version yet")
        return self.spark.read.parquet(f"{self.path}/v{number}")

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        number = self.version() + 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/v{number}")
        self._point_to(number)
        return number

    def merge(self, source: DataFrame, keys: Sequence[str], precombine: str | None = None) -> int:
        if precombine:
            source = latest_source(source, keys, precombine)
        else:
            require_unique(source, keys)
        if not self.version():
            return self.replace(source)
        return self.replace(merge_frames(self.read(), source, keys))


def merge_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Merge into a plain partitioned table, rewriting only the partitions the source touches.

    A row's partition must not change, so the partition columns count as part of the key; there
    NULL is a value like any other, as it has a partition of its own. The outcome is written to the
    scratch folder first: the table is not read while it is replaced.
    """
    target = spark.read.parquet(path).select(*source.columns)
    every = list(dict.fromkeys([*keys, *partition_by]))
    require_unique(source, every, partition_by)
    touched = source.select(*[F.col(c).alias(f"_touched_{c}") for c in partition_by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by]
    affected = target.join(touched, same, "left_semi")
    merged = materialize(merge_frames(affected, source, every, partition_by), "merge")
    write_silver(merged, path, partition_by=partition_by, only_present_partitions=True)


SWAP = "_swap.json"


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    return jvm, jvm(path).getFileSystem(spark._jsc.hadoopConfiguration())


def finish_swap(spark: SparkSession, path: str) -> bool:
    """Carry out a swap of files that was written down and not ended: the old files go, the new ones are
    moved beside the others. Steps already done are skipped, so it may be repeated. Whether there was one."""
    at, fs = _files(spark, path)
    note = at(f"{path}/{SWAP}")
    if not fs.exists(note):
        return False
    stream = fs.open(note)
    try:
        swap = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    for name in swap["old"]:
        fs.delete(at(name), False)
    for staged, name in swap["new"].items():
        if fs.exists(at(staged)):
            fs.rename(at(staged), at(name))
    fs.delete(at(swap["staging"]), True)
    fs.delete(note, False)
    return True


def merge_touched_files(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> int:
    """Merge into a plain parquet folder, rewriting only the files that hold a key of the source; returns how many
    were. Other files keep their names and times.

    The files are found by a semi join of the target's keys with the source's, after the target's rows outside the
    source's range of keys have been left out at the scan by row-group statistics. Their rows are merged and
    written aside; then the swap is written down, old files go and new ones come. Between those two a
    reader may miss rows; a swap cut short is carried out by the next merge or by :func:`finish_swap`. Rows
    with an empty key match nothing and are added. ``source`` must hold a key once. One writer at a time."""
    path = path.rstrip("/")
    finish_swap(spark, path)
    require_unique(source, keys)
    source = materialize(source, "source")
    target = spark.read.parquet(path)
    if set(target.columns) != set(source.columns):
        raise SpecError("merge needs the same columns on both sides")
    source = source.select(*target.columns)
    bounds = source.agg(*[f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    near = target
    for i, k in enumerate(keys):
        if bounds[f"lo{i}"] is None:
            near = near.filter("false")
            break
        kind = target.schema[k].dataType
        near = near.filter(F.col(k).between(F.lit(bounds[f"lo{i}"]).cast(kind), F.lit(bounds[f"hi{i}"]).cast(kind)))
    named = near.select(*keys, F.col("_metadata.file_path").alias("_file"))
    hit = named.join(source.select(*keys), list(keys), "left_semi").select("_file").distinct()
    # As many names as files are rewritten.
    old = sorted(unquote(r["_file"]) for r in hit.collect())
    inside = spark.read.schema(target.schema).parquet(*old) if old else target.limit(0)
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    merge_frames(inside, source, keys).write.parquet(staging)
    at, fs = _files(spark, path)
    parts = [s.getPath().getName() for s in fs.listStatus(at(staging)) if s.getPath().getName().startswith("part-")]
    swap = {"old": old, "new": {f"{staging}/{n}": f"{path}/{n}" for n in parts}, "staging": staging}
    stream = fs.create(at(f"{path}/{SWAP}.part"), True)
    try:
        stream.write(bytearray(json.dumps(swap).encode()))
    finally:
        stream.close()
    fs.rename(at(f"{path}/{SWAP}.part"), at(f"{path}/{SWAP}"))
    finish_swap(spark, path)
    spark.catalog.refreshByPath(path)
    return len(old)


def merge_into_delta(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]) -> None:
    """The same merge on a Delta table, where that format is installed."""
    source.createOrReplaceTempView("_merge_source")
    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    spark.sql(
        f"MERGE INTO {table} t USING _merge_source s ON {condition} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
