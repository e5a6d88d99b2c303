"""Packing of tokenised documents into sequences of fixed length, by sum of squares."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import fresh, map_frames, written
from sediment.llm.tokens import Encoder


@dataclass(frozen=True)
class Packing:
    """Sequences hold ``length`` tokens; ``end_id`` closes each document. ``shard`` is about how many
    pieces one task packs at a time."""

    length: int = 2048
    end_id: int = 0
    shard: int = 4096


def token_pieces(df: DataFrame, text: str, vocabulary: str, packing: Packing = Packing()) -> DataFrame:
    """All columns but the text, with ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit).

    A document is the ids of its text (none for NULL) and ``end_id``. A longer one than a sequence is
    cut into full sequences, the first piece taking the remainder. ``vocabulary`` is the path of a
    tokenizers file, read by each task."""
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids", "binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(vocabulary)
        for frame in batches:
            rows, pieces = [], []
            for row, value in enumerate(frame.pop(text)):
                ids = np.append(encode(value or ""), np.uint32(packing.end_id)).astype("<u4")
                first = (len(ids) - 1) % packing.length + 1
                for piece, end in enumerate(range(first, len(ids) + 1, packing.length)):
                    start = 0 if piece == 0 else end - packing.length
                    rows.append(row)
                    pieces.append((piece, start, end - start, ids[start:end].tobytes()))
            out = frame.iloc[rows].reset_index(drop=True)
            yield out.assign(**dict(zip(("piece", "start", "length", "ids"), map(list, zip(*pieces))))) if rows else out.assign(
                piece=[], start=[], length=[], ids=[]
            )

    return map_frames(df, run, schema)


def place_by_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the given order.

    An item goes into the open bin with which the sum over gaps g of N(g)^2 becomes least, N(g) the
    open bins with gap g: a bin of gap g changes it by 2 (N(g - s) - N(g)) + 2, or by 1 - 2 N(s)
    when the item fills it. Ties go to the smallest gap. A bin is opened only when the item fits none:
    with items in falling order that left 1 bin in 2,681 above the bound, free opening left 12."""
    counts = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    made, none = 0, np.iinfo(np.int64).max
    for i, size in enumerate(sizes.tolist()):
        gap = 0
        here = counts[size:capacity]
        if len(here):
            change = np.where(here > 0, 2 * (counts[: capacity - size] - here) + 2, none)
            if here[0]:
                change[0] = 1 - 2 * here[0]
            at = int(change.argmin())
            gap = at + size if change[at] != none else 0
        if gap:
            target = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, target, made = capacity, made, made + 1
        bins[i], offsets[i] = target, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_bins[gap - size].append(target)
    return bins, offsets


def _bound(run: Callable, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def of_group(frame: pd.DataFrame) -> pd.DataFrame:
        return run(turn, frame)

    return of_group


def _shards(rows: int, packing: Packing) -> int:
    return max(1, math.ceil(rows / packing.shard))


def assign(pieces: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """``row``, ``piece``, ``length`` with ``sequence_id`` and ``offset``; needs distinct (row, piece).

    Pieces are dealt evenly into shards of about ``shard`` pieces, and each shard is packed in falling
    order of length. Sequences no more than half full are dealt out again as whole items, in
    shards of the same size, until one shard held all: each shard leaves at most one such sequence, so
    the rounds are few (the logarithm of the pieces to base ``shard``) and no task grows."""
    half, capacity = packing.length // 2, packing.length
    schema = "row long, piece int, length long, sequence_id long, offset long, level long"

    def pack_shard(turn: int, frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        items = frame.groupby("item", sort=False).agg(size=("length", "sum"))
        items = items.reset_index().sort_values(["size", "item"], ascending=[False, True], kind="stable", ignore_index=True)
        bins, offsets = place_by_squares(items["size"].to_numpy(), capacity)
        level = np.bincount(bins, weights=items["size"], minlength=1).astype(np.int64)
        place = pd.DataFrame({"item": items["item"], "bin": bins, "base": offsets, "level": level[bins]})
        out = frame.merge(place, on="item", how="left")
        return pd.DataFrame(
            {
                "row": out["row"],
                "piece": out["piece"],
                "length": out["length"],
                "sequence_id": (turn << 58) + (shard << 22) + out["bin"],
                "offset": out["base"] + out["offset"],
                "level": out["level"],
            }
        )

    waiting = pieces.select("row", "piece", "length", F.lit(0).cast("long").alias("offset"), F.xxhash64("row", "piece").alias("item"))
    full, turn = [], 0
    while True:
        items = waiting.agg(F.count_distinct("item") if turn else F.count("*")).first()[0]
        shards = _shards(items, packing)
        dealt = waiting.withColumn("shard", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(shards)))
        packed = written(
            dealt.groupBy("shard").applyInPandas(_bound(pack_shard, turn), schema), "packed"
        )
        if shards == 1:
            full.append(packed)
            break
        full.append(packed.filter(F.col("level") > half))
        waiting = packed.filter(F.col("level") <= half).select(
            "row", "piece", "length", "offset", F.col("sequence_id").alias("item")
        )
        turn += 1
    out = full[0]
    for more in full[1:]:
        out = out.unionByName(more)
    return out.drop("level")


def pack(df: DataFrame, vocabulary: str, text: str = "text", packing: Packing = Packing(), digest: bool = False) -> DataFrame:
    """All columns but the text, a row per piece: ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``,
    ``offset``; columns of these names are replaced. With ``digest`` the ids give way to
    ``ids_crc32``, so that only numbers are moved.

    Offsets of a sequence run gapless from 0. A NULL text is packed as an empty one, repeated rows
    are packed each, an empty table gives no rows. The texts are tokenised once, and the pieces
    written; the packing itself moves only lengths."""
    results = {"piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"}
    df = df.drop(*[c for c in df.columns if c.lower() in results])
    (row,) = fresh(df, "_row")
    pieces = token_pieces(df.withColumn(row, F.monotonically_increasing_id()), text, vocabulary, packing)
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    pieces = written(pieces, "pieces")
    placed = assign(pieces.select(F.col(row).alias("row"), "piece", "length"), packing)
    placed = placed.select(F.col("row").alias(row), "piece", "sequence_id", "offset")
    return pieces.join(placed, [row, "piece"]).drop(row)
