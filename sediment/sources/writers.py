"""Batch writers, one function per layer habit."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import InputFormat, SpecError, StorageFormat

# Partition columns a layer gets when its spec names none.
DEFAULT_PARTITIONS = {
    "bronze": ("ingestion_date",),
    "silver": ("country", "update_date"),
    "gold": ("report_date", "country"),
}


# Partition columns that are the same for all rows of a batch.
ONE_PER_BATCH = ("ingestion_date", "update_date", "report_date")


def format_options(fmt: StorageFormat | str, table: str, key: str = "id", precombine: str = "ts") -> dict[str, str]:
    """What a keyed table format wants to know: the table's name, record key and precombine field."""
    if StorageFormat(fmt) is not StorageFormat.HUDI:
        return {}
    return {
        "hoodie.table.name": table,
        "hoodie.datasource.write.recordkey.field": key,
        "hoodie.datasource.write.precombine.field": precombine,
    }


def write(
    df: DataFrame,
    path: str,
    fmt: StorageFormat | InputFormat | str = StorageFormat.PARQUET,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    fmt = str(getattr(fmt, "value", fmt))
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt == StorageFormat.HUDI.value:
        writer = writer.options(**{**format_options(fmt, path.rstrip("/").rsplit("/", 1)[-1]), **options})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


# How Spark's writers name the folder of a value that is null or empty, and the characters they write as %XX.
NO_VALUE, ESCAPED = "__HIVE_DEFAULT_PARTITION__", re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _local_place(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` is on disk if it is below ``file:``, None in any other store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _line_files(top: str, names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of (folders' values, line) in the folders' order: a file of lines for each folder below ``top``, batch by batch."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, ...], bytes]]:
        for batch in batches:
            *values, lines = batch.columns
            new = pa.array([i == 0 for i in range(batch.num_rows)], pa.bool_())
            for column in values if batch.num_rows > 1 else ():
                changed = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
                new = pc.or_(new, pa.concat_arrays([pa.array([True]), changed]))
            starts = pc.indices_nonzero(new).to_pylist()
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                yield tuple(column[start].as_py() for column in values), b"".join(v + b"\n" for v in lines.slice(start, end - start).to_pylist())

    def write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"part-{TaskContext.get().partitionId():05d}.txt"
        for values, found in groupby(runs(batches), itemgetter(0)):
            folders = [f"{name}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', value)}" for name, value in zip(names, values)]
            place = "/".join([top, *folders])
            os.makedirs(place, exist_ok=True)
            held = f"{place}/.{file}-{uuid.uuid4().hex}"
            with open(held, "wb") as out:
                out.writelines(lines for _, lines in found)
            os.replace(held, f"{place}/{file}")
        yield pa.RecordBatch.from_pydict({"done": pa.array([True])})

    return write_files


def write_lines(df: DataFrame, path: str, line: str, partition_by: Sequence[str], together: Sequence[str]) -> None:
    """Text files of the column ``line`` in a fresh folder, one for each folder of ``partition_by``; folders with the same
    ``together``, some of ``partition_by``, are of one task.

    Below ``file:`` the tasks make folders and files themselves: without its native library Hadoop starts a process for each
    that it makes. A file gets its name when it is whole, so a task that runs twice leaves the same files. Any other store
    gets Spark's writer.
    """
    top = _local_place(df.sparkSession, path)
    if top is None:
        df.select(*partition_by, line).repartition(*together).write.partitionBy(*partition_by).text(path)
        return
    if os.path.exists(top):
        raise FileExistsError(path)
    os.makedirs(top)
    values = [F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(NO_VALUE)).alias(c) for c in partition_by]
    rows = df.select(*values, F.coalesce(line, F.lit("")).cast("binary").alias(line))
    dealt = rows.repartition(*together).sortWithinPartitions(*partition_by)
    dealt.mapInArrow(_line_files(top, list(partition_by)), "done boolean").write.format("noop").mode("overwrite").save()


def write_landing(df: DataFrame, path: str, fmt: InputFormat | str) -> None:
    """Feed files: csv with a header, json lines, parquet or orc."""
    fmt = InputFormat(fmt)
    write(df, path, fmt, "append", **({"header": "true"} if fmt is InputFormat.CSV else {}))


def layer_partitions(df: DataFrame, layer: str, wanted: Sequence[str] | None = None) -> list[str]:
    """Partition columns of a layer: those asked for, else the layer's habit where present."""
    names = DEFAULT_PARTITIONS.get(layer, ()) if wanted is None else wanted
    return [name for name in names if name in df.columns]


def with_partition_date(df: DataFrame, name: str, source: Column) -> DataFrame:
    return df.withColumn(name, F.to_date(source))


def cluster_for_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition directory together so that a write makes few files.

    ``rebalance`` lets adaptive execution split a partition that holds too many rows, so
    a hot partition value does not end in one task. A load date has one value per batch, so
    it alone is no reason to shuffle.
    """
    varying = [name for name in partition_by if name not in ONE_PER_BATCH]
    return df.hint("rebalance", *[F.col(name) for name in varying]) if varying else df


def write_bronze(
    df: DataFrame, path: str, fmt: StorageFormat | str = StorageFormat.PARQUET, partition_by: Sequence[str] = ()
) -> None:
    write(cluster_for_partitions(df, partition_by), path, fmt, "append", partition_by)


def write_silver(
    df: DataFrame,
    path: str,
    fmt: StorageFormat | str = StorageFormat.PARQUET,
    partition_by: Sequence[str] = (),
    only_present_partitions: bool = False,
) -> None:
    """Overwrite; with ``only_present_partitions`` just the partitions that ``df`` holds."""
    options = {"partitionOverwriteMode": "dynamic"} if only_present_partitions and partition_by else {}
    write(cluster_for_partitions(df, partition_by), path, fmt, "overwrite", partition_by, **options)


def write_gold(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    fmt: StorageFormat | str = StorageFormat.PARQUET,
    path: str | None = None,
) -> None:
    writer = df.write.format(StorageFormat(fmt).value).mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append_quality_results(results: DataFrame, path: str, run: Mapping[str, Column] | None = None) -> None:
    """One row per evaluation metric with the whole row as JSON; ``run`` adds columns such as
    ``execution_time`` or ``run_id``."""
    results.select(
        "table_name",
        *[value.alias(name) for name, value in (run or {}).items()],
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("results"),
    ).write.mode("append").parquet(path)


QUARANTINE_KINDS = ("malformed", "invalid", "failed")


def quarantine_path(layer_path: str, kind: str) -> str:
    """Folder of one kind of rejected rows: lines that do not parse (``malformed``), rows that break a
    field check (``invalid``), rows that fail a quality rule (``failed``). Each kind has its own schema.
    The folder stands beside the layer, as overwriting a layer empties its own folder."""
    if kind not in QUARANTINE_KINDS:
        raise SpecError(f"unknown quarantine kind {kind!r}")
    return f"{layer_path.rstrip('/')}_quarantine/{kind}"


def append_quarantine(rejected: DataFrame, layer_path: str, kind: str, batch: int | None = None) -> None:
    """Rejected rows with their ``reasons`` array, beside the layer they were kept out of. Those of a
    stream's batch replace what an earlier try of that batch has left."""
    path = quarantine_path(layer_path, kind)
    if batch is None:
        rejected.write.mode("append").parquet(path)
    else:
        rejected.write.mode("overwrite").parquet(f"{path}/batch={batch}")
