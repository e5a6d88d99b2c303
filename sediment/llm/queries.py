"""Registered queries of the corpus operators, most with SQL to check against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import (
    conversation_trie,
    line_dedup,
    minhash,
    mixing,
    oracles,
    packing,
    pieces,
    pii,
    quality_rules,
    secret_scan,
    spelling,
    url_filter,
    vectors,
    warc,
)
from sediment.llm.common import table
from sediment.session import scratch_path

# Segments of six characters still part lines well; below six characters stand list marks, brackets and single words.
LINES = line_dedup.LineRules(min_chars=20, exact_chars=6)
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(table(spark, d, "documents"), carry=["doc_id", "source"])


def op2_minhash(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, d, "documents"), spec=minhash.NearDup(shingle=2))


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents").select("doc_id", "text"), VOCABULARY, digest=True)


def op4_warc(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    pages = table(spark, d, "pages")
    warc.write_warc(pages, path)
    kind = pages.schema["page_id"].dataType
    records = warc.page_records(warc.read_warc(spark, path))
    return records.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"))


def op6_pseudonyms(spark: SparkSession, d: str) -> DataFrame:
    # A published key, for the invented values of the test tables only; real corpora have a secret one.
    key = pii.PiiKey("00112233445566778899aabbccddeeff")
    return pii.pseudonymise(table(spark, d, "documents").select("doc_id", "text"), key)


def op7_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, d, "documents"), rules=LINES)
    return cut.select("doc_id", "text", "n_lines", "n_removed", "n_near")


def op8_vectors(spark: SparkSession, d: str) -> DataFrame:
    return vectors.near_vectors(table(spark, d, "embeddings"))


def op9_secrets(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scan(table(spark, d, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_markov"
    )


def op10_url_rules(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("unwanted")
    )
    judged = url_filter.filter_urls(table(spark, d, "pages").select("page_id", "url"), labels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_conversation_trie(spark: SparkSession, d: str) -> DataFrame:
    own = conversation_trie.conversation_turns(table(spark, d, "conversations"))
    trie = conversation_trie.prefix_trie(conversation_trie.with_borrowed_openings(own))
    nodes = trie.nodes.join(conversation_trie.ends_digest(trie.ends), ["conv_id", "depth"], "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_spelling(spark: SparkSession, d: str) -> DataFrame:
    words = spelling.count_words(table(spark, d, "documents"), slip_every=97)
    return spelling.variant_forms(words)


def op13_pieces(spark: SparkSession, d: str) -> DataFrame:
    encoded = pieces.encode(table(spark, d, "documents").select("doc_id", "text"), PIECES).drop("text")
    both = pieces.decode(encoded, PIECES)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_minhash,
        op3_packing,
        op4_warc,
        op5_mixing,
        op6_pseudonyms,
        op7_line_dedup,
        op8_vectors,
        op9_secrets,
        op10_url_rules,
        op11_conversation_trie,
        op12_spelling,
        op13_pieces,
    )
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.OP1,
    "op2_minhash": oracles.OP2,
    "op4_warc": oracles.OP4,
    "op5_mixing": oracles.OP5,
    "op8_vectors": oracles.OP8,
    "op10_url_rules": oracles.OP10,
    "op11_conversation_trie": oracles.OP11,
    "op12_spelling": oracles.OP12,
}
