"""Prefix trie of conversations: which turns many of them begin with.

Conversations become paths of turn digests, and paths are dealt into shards by splitters, paths taken from
a bounded sample as a range partitioning takes them. A node has members in two shards only if it begins a
splitter's path: these nodes are the skeleton, known everywhere from the broadcast splitters. Each shard
sorts its paths and finishes all other nodes in one pass; of the skeleton it gives partial counts, which a
reduction adds up. A conversation that repeats any number of times spreads over shards by its identifier.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import written

WIDTH = 16  # bytes of a turn's digest


@dataclass(frozen=True)
class TrieSpec:
    """``shard_turns``: turns of one shard; ``sampled``: paths looked at for each splitter."""

    shard_turns: int = 200_000
    sampled: int = 20


def turn_digest(role: Column, text: Column) -> Column:
    """Hex digest that tells turns apart by role and text."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def conversation_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turns``: an array of ``digest`` and ``size`` (UTF-8 bytes of the text) in order of turn.

    NULL turns come first; rows of one turn stand in the order of their digest, repeated rows stay. NULL
    roles and texts are empty; rows without a conversation are left out, other columns ignored. A
    conversation's digests, not its texts, are gathered in one row."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = df.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), turn_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def with_borrowed_openings(conversations: DataFrame, every: int = 5, longest: int = 8) -> DataFrame:
    """Conversations that open as an earlier one does, as branches of one chat would: of conversation c the
    first h turns are those of c - c % ``every`` (none if there is none), h being the checksum of c modulo
    ``longest`` + 1; its own turns after its first h follow."""
    own = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    heads = conversations.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, longest).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    none = F.slice("turns", F.lit(1), F.lit(0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(heads, "base", "left").withColumn("h", h)
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), none), rest).alias("turns"))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


NODE = (
    "key binary, parent_key binary, shard int, conv_id long, depth long, parent_conv_id long, digest binary, size long, n_convs long, "
    "n_children long, n_leaves long, saved long, ends array<long>"
)
_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def _finish_shard(shard: int, rows: pd.DataFrame, lower: bytes | None, upper: bytes | None) -> pd.DataFrame:
    """Nodes of a shard in order of closing. Skeleton nodes have a key, and their counts are partial:
    without what their skeleton children hold. Nodes below them have their key as parent key."""
    rows = rows.sort_values(["path", "conv_id"])
    out: list[list] = []
    stack: list[dict] = []
    waiting: list[list[int]] = []  # rows of ``out`` whose parent is still open, by depth

    def open_node(depth: int, digest: bytes, size: int, key) -> None:
        stack.append({"digest": digest, "size": size, "key": key, "low": None, "n": 0, "children": 0, "leaves": 0, "saved": 0, "ends": []})
        waiting.append([])

    def close_node() -> None:
        node, depth, key = stack.pop(), len(stack), None
        parent = stack[-1] if stack else None
        for row in waiting.pop():
            out[row][5] = node["low"]
        if node["key"] is None:
            node["leaves"] = node["leaves"] or 1
            node["saved"] += (node["n"] - 1) * node["size"]
        else:
            key = node["key"].digest()
        parent_key = parent["key"].digest() if parent and parent["key"] else None
        if parent and parent_key is None:
            waiting[-1].append(len(out))
        out.append(
            [key, parent_key, shard, node["low"], depth, None, node["digest"], node["size"], node["n"], node["children"], node["leaves"], node["saved"], node["ends"]]
        )
        if parent:
            parent["low"] = node["low"] if parent["low"] is None else min(parent["low"], node["low"])
            parent["n"] += node["n"]
            if node["key"] is None:
                parent["children"] += 1
                parent["leaves"] += node["leaves"]
                parent["saved"] += node["saved"]

    split = lower is not None or upper is not None
    before = b""
    open_node(0, None, 0, hashlib.md5(usedforsecurity=False) if split else None)
    for conv_id, path, sizes in zip(rows["conv_id"].tolist(), rows["path"], rows["sizes"], strict=True):
        same = _common(before, path)
        while len(stack) > same + 1:
            close_node()
        if len(path) > same * WIDTH:
            shared = max(_common(path, s) if s is not None else 0 for s in (lower, upper)) if split else 0
            for depth in range(same + 1, len(path) // WIDTH + 1):
                digest, key = path[(depth - 1) * WIDTH : depth * WIDTH], None
                if depth <= shared:
                    key = stack[-1]["key"].copy()
                    key.update(digest)
                open_node(depth, digest, int(sizes[depth - 1]), key)
        end = stack[-1]
        end["n"] += 1
        end["low"] = conv_id if end["low"] is None else min(end["low"], conv_id)
        end["ends"].append(conv_id)
        before = path
    while stack:
        close_node()
    return pd.DataFrame(out, columns=_COLUMNS).astype({"parent_conv_id": "Int64"})


def _sum_skeleton(rows: pd.DataFrame) -> pd.DataFrame:
    """Skeleton nodes with counts over their subtrees, leaves first. The skeleton has at most the
    splitters' paths' nodes, whatever the number of conversations."""
    rows = rows.sort_values("depth", ascending=False)
    keys = list(rows["key"])
    nodes = {k: r for k, r in zip(keys, rows.to_dict("records"), strict=True)}
    for key in keys:
        node = nodes[key]
        if node["n_children"] == 0:
            node["n_leaves"] = 1
        if node["depth"]:
            node["saved"] += (node["n_convs"] - 1) * node["size"]
            parent = nodes[node["parent_key"]]
            node["parent_conv_id"] = parent["conv_id"]
            for name, add in (("n_children", 1), ("n_leaves", node["n_leaves"]), ("saved", node["saved"])):
                parent[name] += add
    return pd.DataFrame(nodes.values(), columns=rows.columns).astype({"parent_conv_id": "Int64"})


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row per node. ``ends``: identifiers of the conversations that end at a node, ascending,
    in rows of bounded length: ``conv_id, depth`` of the node, ``part``, ``ends``. No row for nodes where none ends."""

    nodes: DataFrame
    ends: DataFrame


def _splitters(paths: DataFrame, spec: TrieSpec) -> list[tuple[bytes, int]]:
    """Paths with identifiers that part the conversations into shards of about equal turns. The sample holds
    about ``sampled`` paths for each shard, as a range partitioning's does."""
    turns, count = paths.agg(F.sum(F.octet_length("path") / WIDTH + 1), F.count("*")).first()
    if not count:
        return []
    least = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-int(turns) // spec.shard_turns))
    share = min(1.0, spec.sampled * shards / count)
    drawn = F.pmod(F.xxhash64("conv_id", F.lit("splitters")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = sorted((bytes(r.path), r.conv_id) for r in paths.filter(drawn).select("path", "conv_id").collect())
    total, passed, out = sum(len(p) // WIDTH + 1 for p, _ in sample), 0, []
    for path, conv_id in sample:
        if passed * shards >= (len(out) + 1) * total:
            out.append((path, conv_id))
        passed += len(path) // WIDTH + 1
    return out


def prefix_trie(conversations: DataFrame, spec: TrieSpec = TrieSpec()) -> Trie:
    """The trie of ``conversations`` (``conv_id``, ``turns`` of ``digest`` and ``size``, one row each).

    A node of depth d stands for the first d turns of its members. ``nodes`` has: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (NULL for the root), ``digest`` and ``size`` of the last turn, ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of its subtree, itself included), ``saved`` (over its subtree, members less one
    times size). Conversations without turns end at the root; without conversations there is no node."""
    turns = F.col("turns")
    path = F.unhex(F.array_join(turns["digest"], "")).alias("path")
    paths = written(conversations.select("conv_id", path, turns["size"].alias("sizes")), "paths")
    splitters = _splitters(paths, spec)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(splitters, (bytes(p), c)) for p, c in zip(path, conv_id, strict=True)], dtype="int32")

    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        lower = splitters[shard - 1][0] if shard else None
        upper = splitters[shard][0] if shard < len(splitters) else None
        return _finish_shard(shard, rows, lower, upper)

    raw = written(paths.withColumn("shard", shard_of("path", "conv_id")).groupBy("shard").applyInPandas(finish, NODE), "nodes")
    public = ["conv_id", "depth", "parent_conv_id", "digest", "size", "n_convs", "n_children", "n_leaves", "saved"]
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    partial = raw.filter("key is not null").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.first("digest").alias("digest"), F.first("size").alias("size"), *sums, F.lit(None).cast("long").alias("parent_conv_id"),
    )
    skeleton = written(partial.groupBy(F.lit("skeleton")).applyInPandas(_sum_skeleton, partial.schema), "skeleton")
    own = raw.filter("key is null")
    tops = skeleton.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_low"))
    below = own.filter("parent_key is not null").join(tops, "parent_key").withColumn("parent_conv_id", F.col("parent_low"))
    nodes = own.filter("parent_key is null").select(public).unionByName(below.select(public)).unionByName(skeleton.select(public))
    some = F.size("ends") > 0
    shared = raw.filter("key is not null").filter(some).select("key", F.col("shard").alias("part"), "ends")
    parts = shared.join(skeleton.select("key", "conv_id", "depth"), "key").select("conv_id", "depth", "part", "ends")
    ends = own.filter(some).select("conv_id", "depth", F.lit(0).alias("part"), "ends").unionByName(parts)
    return Trie(nodes, ends)


def ends_digest(ends: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``ends_sha256`` for the nodes of ``Trie.ends``: SHA-256 of all identifiers in order,
    comma-joined. A node's parts go through one running hash, so no list is ever whole in memory."""
    text = F.array_join(F.col("ends").cast("array<string>"), ",")
    rows = ends.select("conv_id", "depth", "part", text.alias("text")).repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for conv_id, depth, text in zip(batch["conv_id"].tolist(), batch["depth"].tolist(), batch["text"], strict=True):
                if node == (conv_id, depth):
                    state.update(b"," + text.encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (conv_id, depth), hashlib.sha256(text.encode())
            yield pd.DataFrame(done, columns=["conv_id", "depth", "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])

    return rows.mapInPandas(run, "conv_id long, depth long, ends_sha256 string")
