"""Words, lines and written intermediate tables shared by the corpus operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.session import scratch_path

# White space that parts words (space, tab to carriage return).
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"

# Bytes of data up to which a list of keys is broadcast once it has been measured; beyond it the join shuffles.
# A hashed table takes about three times as much on the driver and on every executor.
KEY_BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text, none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), "")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return the table read back: lost executors
    then cost no recomputation, and later steps read only the columns they name."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing lazy depends on any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores in front until no column of ``df`` has it (case apart)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def _width(c: Column, kind: T.DataType) -> Column:
    """Bytes of a value."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in kind), F.lit(8))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.aggregate(c, F.lit(24).cast("long"), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16), F.lit(8).cast("long"))
    return F.coalesce(F.size(c) * 8 + 24, F.lit(8)) if isinstance(kind, T.ArrayType) else F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a written table's rows in memory, by adding up their values."""
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(8)).cast("long")
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def keys_for_join(keys: DataFrame) -> DataFrame:
    """A written list of keys: hinted for broadcast only when its measured bytes, whatever the width of its
    columns, are within ``KEY_BROADCAST_BYTES``; otherwise a plain table that joins by shuffling."""
    return F.broadcast(keys) if measured_bytes(keys) <= KEY_BROADCAST_BYTES else keys


def map_frames(df: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``mapInPandas`` with the input's whole numbers carried as text: pandas would make them doubles where
    one is NULL, and round large identifiers. ``schema`` names those it returns with their own type."""
    numbers = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType))}
    sent = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in numbers})
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in numbers else f for f in schema])
    back = [F.col(f"`{f.name}`").cast(numbers.get(f.name, f.dataType)).alias(f.name) for f in schema]
    return sent.mapInPandas(run, text).select(*back)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
