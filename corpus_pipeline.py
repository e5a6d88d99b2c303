"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, packing.

Each stage takes what the one before it kept, as written Parquet, and returns documents; the
last returns packed pieces. ``run`` chains them on the documents of a data directory.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import line_dedup, minhash, mixing, packing, quality_rules
from sediment.llm.common import fresh, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Exact repeats from six characters on and near ones from twenty, as in the query of its own.
LINES = line_dedup.LineRules(min_chars=20, exact_chars=6)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the document rules and whose host is not rejected."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat earlier ones; ``n_chars`` is that of the new text."""
    cut = line_dedup.dedup_lines(docs, rules=LINES)
    return cut.withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, at five words and 80 percent."""
    return minhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards flatter source weights, in shuffled order. Columns that bear the names of
    the operator's results are set aside under others meanwhile, and stay as they are."""
    aside = dict(zip([c for c in docs.columns if c.lower() in ("copy", "shuffle_key")], fresh(docs, "_copy", "_shuffle_key")))
    mixed = mixing.mix(docs.withColumnsRenamed(aside))
    return mixed.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 tokens."""
    return packing.pack(docs, VOCABULARY, digest=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Edit joins, byte-pair encoding and bin packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
