"""Batch readers. A schema is expected; inference is something the caller asks for."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.config import InputFormat, Layer, PipelineConfig, SpecError, StorageFormat

CORRUPT = "_corrupt_record"
FILE_FACTS = {
    "file_path": "_metadata.file_path",
    "file_name": "_metadata.file_name",
    "file_size": "_metadata.file_size",
    "file_modification_time": "_metadata.file_modification_time",
}


def as_schema(schema: T.StructType | str | Mapping | None) -> T.StructType | str | None:
    """A StructType, DDL text, a dict in Spark's JSON schema form, or ``{name: type}``."""
    if schema is None or isinstance(schema, (T.StructType, str)):
        return schema
    if "fields" in schema:
        return T.StructType.fromJson(dict(schema))
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def read_source(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: InputFormat | str,
    schema: T.StructType | str | Mapping | None = None,
    pattern: str | None = None,
    with_file_facts: Iterable[str] = (),
    **options: str,
) -> DataFrame:
    """Read landing files. ``pattern`` filters file names, ``with_file_facts`` adds columns
    that only the scan knows (see ``FILE_FACTS``)."""
    try:
        fmt = InputFormat(str(getattr(fmt, "value", fmt)).lower())
    except ValueError:
        raise SpecError(f"unsupported input format {fmt!r}") from None
    reader = spark.read.format(fmt.value)
    if fmt is InputFormat.CSV:
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.options(**options).load(path if isinstance(path, str) else list(path))
    facts = list(with_file_facts)
    return df.select("*", *[F.expr(FILE_FACTS[name]).alias(name) for name in facts]) if facts else df


def read_strict(
    spark: SparkSession,
    path: str,
    fmt: InputFormat | str,
    schema: T.StructType | str | Mapping,
    pattern: str | None = None,
    **options: str,
) -> DataFrame:
    """Typed read that keeps every line: those that do not fit the schema carry their raw
    text in ``_corrupt_record``. Write it once, then split it with :func:`split_corrupt`."""
    typed = as_schema(schema)
    if isinstance(typed, str):
        typed = T.StructType.fromDDL(typed)
    typed = T.StructType([*typed.fields, T.StructField(CORRUPT, T.StringType())])
    return read_source(
        spark, path, fmt, typed, pattern, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, raw text of those that did not). ``df`` must be a written or cached
    table: a text scan that selects only the corrupt column would not parse the others."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("raw_record"), F.array(F.lit("malformed")).alias("reasons")
    )
    return good, bad


def read_layer(
    spark: SparkSession, config: PipelineConfig, layer: Layer | str, schema: T.StructType | None = None
) -> DataFrame:
    return read_stored(spark, config.layer_path(layer), config.storage_format, schema)


def read_stored(
    spark: SparkSession, path: str, fmt: StorageFormat | str = StorageFormat.PARQUET, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read.format(StorageFormat(fmt).value)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_tables(spark: SparkSession, tables: str | Sequence[str]) -> list[DataFrame]:
    names = [tables] if isinstance(tables, str) else list(tables)
    return [spark.read.table(name) for name in names]


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def sql_source(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SQL text over catalog tables and the given named frames."""
    register_views(views or {})
    return spark.sql(text)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
