"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Sampling by a hash of the row, one Spark group per tree to build it, a broadcast forest of
bounded size (trees x 511 nodes) and vectorised scoring per Arrow batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.operators.selection import flag_highest
from sediment.session import materialize

TREE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double, points int"
EULER = 0.5772156649015329
HASH_GRID = (1 << 63) - 1

# Tasks get this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree over ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * (np.log(big - 1) + EULER) - 2.0 * (big - 1) / big))


def grow_tree(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes as (node, feature, cut, left, right, path); feature -1 marks a leaf, and its
    path is the depth plus the expected rest for the points left in it."""
    nodes: list[tuple] = []
    waiting = [(0, points, 0)]
    created = 1
    while waiting:
        node, inside, depth = waiting.pop()
        low, high = inside.min(axis=0), inside.max(axis=0)
        spread = np.flatnonzero(high > low)
        if depth >= max_depth or len(inside) <= 1 or not len(spread):
            nodes.append((node, -1, 0.0, -1, -1, float(depth + expected_path(len(inside)))))
            continue
        feature = int(rng.choice(spread))
        cut = float(rng.uniform(low[feature], high[feature]))
        below = inside[:, feature] < cut
        left, right = created, created + 1
        created += 2
        nodes.append((node, feature, cut, left, right, 0.0))
        waiting += [(left, inside[below], depth + 1), (right, inside[~below], depth + 1)]
    return nodes


def fit(
    df: DataFrame,
    features: Sequence[str],
    row_id: Sequence[str],
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
) -> tuple[np.ndarray, int]:
    """Build the forest; returns its nodes, whose leaf paths are divided by the mean path of their own
    tree, and the number of rows it was drawn from.

    A first hash keeps a pool of about ``2 * trees * sample_size`` rows of however many there
    are; each tree then draws from the pool by a hash of its own. Neither multiplies the input.
    """
    usable = df.select(
        *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)],
        F.xxhash64(F.lit(seed), *[F.col(c) for c in row_id]).alias("_h"),
    ).dropna()
    total = usable.count()
    if total == 0:
        raise ValueError("no row has all features")
    pool_share = min(1.0, 2.0 * trees * sample_size / total)
    pool = usable.filter(F.col("_h").bitwiseAND(HASH_GRID) <= F.lit(min(HASH_GRID, int(pool_share * HASH_GRID))))
    tree_share = min(1.0, sample_size / (total * pool_share))
    drawn = pool.withColumn(
        "tree",
        F.explode(
            F.filter(
                F.sequence(F.lit(0), F.lit(trees - 1)),
                lambda t: F.xxhash64(F.col("_h"), t).bitwiseAND(HASH_GRID)
                <= F.lit(min(HASH_GRID, int(tree_share * HASH_GRID))),
            )
        ),
    )
    names = [f"f{i}" for i in range(len(features))]
    depth = int(np.ceil(np.log2(max(sample_size, 2))))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(["_h", *names])
        rng = np.random.default_rng([seed, int(key[0])])
        nodes = grow_tree(ordered[names].to_numpy(dtype=float), rng, depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "cut", "left", "right", "path"])
        out.insert(0, "tree", int(key[0]))
        out["points"] = len(ordered)
        return out

    # At most trees x (2 * sample) nodes, whatever the size of the input.
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    grown = drawn.repartition(tasks, "tree").groupBy("tree").applyInPandas(build, TREE_SCHEMA).toPandas()
    # Each tree's paths are measured in its own mean path.
    grown["path"] /= expected_path(np.maximum(grown["points"].to_numpy(), 2))
    nodes = grown.drop(columns="points").sort_values(["tree", "node"])
    return nodes.to_numpy(dtype=float), total


def _scorer(nodes: np.ndarray):
    """A function from a column of values per feature to scores, NaN where one is missing."""
    roots = np.flatnonzero(np.r_[True, nodes[1:, 0] != nodes[:-1, 0]])
    base = np.repeat(roots, np.diff(np.r_[roots, len(nodes)]))
    feature, cut, path = nodes[:, 2].astype(np.intp), nodes[:, 3], nodes[:, 6]
    # A leaf is its own child, so all rows take the same number of steps without a mask.
    leaf = feature < 0
    itself = np.arange(len(nodes))
    children = np.empty(2 * len(nodes), dtype=np.intp)
    children[0::2] = np.where(leaf, itself, nodes[:, 4].astype(np.intp) + base)
    children[1::2] = np.where(leaf, itself, nodes[:, 5].astype(np.intp) + base)
    feature[leaf] = 0
    levels, frontier = 0, roots
    while (inner := frontier[~leaf[frontier]]).size:
        frontier = np.r_[children[2 * inner], children[2 * inner + 1]]
        levels += 1

    def scores(columns: Sequence[np.ndarray]) -> np.ndarray:
        size = len(columns[0])
        x = np.concatenate(columns)
        rows, column_start = np.arange(size), feature * size
        depth_sum = np.zeros(size)
        for root in roots if size else ():
            at = np.full(size, root)
            for _ in range(levels):
                place = column_start.take(at, mode="clip")
                place += rows
                above = x.take(place, mode="clip") >= cut.take(at, mode="clip")
                at *= 2
                at += above
                at = children.take(at, mode="clip")
            depth_sum += path.take(at, mode="clip")
        missing = np.isnan(x).reshape(len(columns), size).any(axis=0)
        return np.where(missing, np.nan, np.power(2.0, -depth_sum / len(roots)))

    return scores


def score(df: DataFrame, features: Sequence[str], forest: np.ndarray) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1]; NULL where a feature is missing."""
    shared = df.sparkSession.sparkContext.broadcast((forest, list(features)))
    schema = T.StructType([*df.schema.fields, T.StructField("anomaly_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, names = shared.value
        scores = _scorer(nodes)
        for batch in batches:
            value = scores([batch.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in names])
            columns = [*batch.columns, pa.array(value, mask=np.isnan(value))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "anomaly_score"])

    return df.mapInArrow(run, schema)


def fit_groups(
    df: DataFrame,
    group_by: Sequence[str],
    features: Sequence[str],
    row_id: Sequence[str],
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
    min_samples: int = 0,
) -> DataFrame:
    """A forest per group: the ``group_by`` columns, ``_rows`` (with all features) and ``_forest``, the nodes as bytes.

    Each group's forest is the one that ``fit`` builds from its rows alone. A group's rows are thinned to a pool
    of about ``2 * trees * sample_size`` before trees draw from it, so a large group moves no more rows than
    others, and each tree is built by a task of its own. Groups of fewer than ``min_samples`` rows have none."""
    groups = [f"_g{i}" for i in range(len(group_by))]
    names = [f"f{i}" for i in range(len(features))]
    usable = df.select(
        *[F.col(f"`{g}`").alias(n) for g, n in zip(group_by, groups, strict=True)],
        *[F.col(f"`{f}`").cast("double").alias(n) for f, n in zip(features, names, strict=True)],
        F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in row_id]).alias("_h"),
    ).dropna(subset=names)
    grid, total, wanted = F.lit(HASH_GRID), F.col("_rows"), float(trees) * sample_size * 2
    bound = lambda share: F.when(share >= 1.0, grid).otherwise((share * F.lit(float(HASH_GRID))).cast("long"))
    pool_share = F.least(F.lit(1.0), F.lit(wanted) / total)
    sizes = usable.groupBy(*groups).agg(F.count("*").alias("_rows")).filter(total >= max(min_samples, 1))
    sizes = materialize(
        sizes.withColumn("_pool", bound(pool_share)).withColumn("_tree", bound(F.least(F.lit(1.0), F.lit(float(sample_size)) / (total * pool_share)))), "groups"
    )
    renamed = sizes.withColumnsRenamed({g: f"{g}_r" for g in groups})
    pool = usable.join(renamed, [F.col(g).eqNullSafe(F.col(f"{g}_r")) for g in groups])
    pool = pool.filter(F.col("_h").bitwiseAND(HASH_GRID) <= F.col("_pool"))
    each = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(F.col("_h"), t).bitwiseAND(HASH_GRID) <= F.col("_tree")
    )
    drawn = pool.select(*groups, "_rows", "_h", *names, F.explode(each).alias("tree"))
    depth = int(np.ceil(np.log2(max(sample_size, 2))))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        ordered, tree = rows.sort_values(["_h", *names]), int(rows["tree"].iloc[0])
        nodes = np.array(grow_tree(ordered[names].to_numpy(dtype=float), np.random.default_rng([seed, tree]), depth))
        nodes[:, 5] /= expected_path(max(len(ordered), 2))
        whole = np.column_stack([np.full(len(nodes), float(tree)), nodes])
        whole = whole[np.argsort(whole[:, 1], kind="stable")]
        return rows[[*groups, "_rows", "tree"]].head(1).assign(nodes=whole.tobytes())

    kinds = ", ".join(f"{g} {sizes.schema[g].dataType.simpleString()}" for g in groups)
    grown = drawn.groupBy(*groups, "tree").applyInPandas(build, f"{kinds}, _rows long, tree int, nodes binary")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("tree", F.hex("nodes").alias("nodes")))), lambda x: x["nodes"])
    forest = grown.groupBy(*groups, "_rows").agg(F.unhex(F.array_join(parts, "")).alias("_forest"))
    return materialize(forest.withColumnsRenamed(dict(zip(groups, group_by, strict=True))), "forests")


# Rows of a group that one task scores.
GROUP_BLOCK_ROWS = 100_000


def score_groups(df: DataFrame, group_by: Sequence[str], features: Sequence[str], row_id: Sequence[str], forests: DataFrame) -> DataFrame:
    """Add ``anomaly_score`` by each row's group's forest; NULL where a feature or the forest is missing.

    ``forests``: the ``group_by`` columns, ``_rows``, ``_forest``, a row per group. Large groups are cut into blocks by a hash
    of ``row_id``, and each block is met by a copy of its group's forest."""
    groups = [f"_g{i}" for i in range(len(group_by))]
    blocks = F.greatest(F.ceil(F.col("_rows") / GROUP_BLOCK_ROWS), F.lit(1)).cast("int")
    known = forests.select(*[F.col(f"`{g}`").alias(n) for g, n in zip(group_by, groups, strict=True)], "_forest", blocks.alias("_blocks"))
    small = known.select(*[F.col(g).alias(f"{g}_r") for g in groups], "_blocks")
    keyed = df.withColumns({n: F.col(f"`{g}`") for g, n in zip(group_by, groups, strict=True)})
    on = [F.col(g).eqNullSafe(F.col(f"{g}_r")) for g in groups]
    keyed = keyed.join(small, on, "left").drop(*[f"{g}_r" for g in groups])
    block = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in row_id]), F.col("_blocks")).cast("int")
    keyed = keyed.withColumn("_block", block).drop("_blocks")
    lone = keyed.filter("_block is null").select(*df.columns).withColumn("anomaly_score", F.lit(None).cast("double"))
    spread = known.select(*groups, F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"), "_forest")
    schema = T.StructType([*df.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
    names, columns = list(features), list(df.columns)

    def run(rows: pa.Table, forest: pa.Table) -> pa.Table:
        kept = rows.select(columns)
        nodes = np.frombuffer(forest.column("_forest")[0].as_py(), float).reshape(-1, 7) if forest.num_rows else None
        if nodes is None or not len(kept):
            return kept.append_column("anomaly_score", pa.nulls(len(kept), pa.float64()))
        value = _scorer(nodes)([kept.column(n).cast(pa.float64()).to_numpy() for n in names])
        return kept.append_column("anomaly_score", pa.array(value, mask=np.isnan(value)))

    met = keyed.filter("_block is not null").groupBy(*groups, "_block").cogroup(spread.groupBy(*groups, "_block")).applyInArrow(run, schema)
    return met.unionByName(lone)


def detect_groups(
    df: DataFrame,
    group_by: Sequence[str],
    features: Sequence[str],
    row_id: Sequence[str],
    flag: str = "is_group_pattern_anomaly",
    contamination: float = 0.1,
    min_samples: int = 0,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
) -> DataFrame:
    """A forest for each group; exactly ``ceil(contamination * n)`` rows of each group are marked, ties by ``row_id``.
    Score and flag are NULL in groups with fewer than ``min_samples`` rows that have all features."""
    forests = fit_groups(df, group_by, features, row_id, trees, sample_size, seed, min_samples)
    scored = materialize(score_groups(df, group_by, features, row_id, forests), "forest")
    marked = flag_highest(scored, "anomaly_score", contamination, row_id, flag, group_by)
    if min_samples:
        known = forests.select(*[F.col(f"`{g}`").alias(f"_r{i}") for i, g in enumerate(group_by)], F.lit(True).alias("_known"))
        same = [F.col(f"`{g}`").eqNullSafe(F.col(f"_r{i}")) for i, g in enumerate(group_by)]
        marked = marked.join(known, same, "left").withColumn(flag, F.when(F.col("_known"), F.col(flag)))
        marked = marked.drop("_known", *[f"_r{i}" for i in range(len(group_by))])
    return marked.withColumn("prediction", F.col(flag).cast("int"))


def detect(
    df: DataFrame,
    features: Sequence[str],
    row_id: Sequence[str],
    flag: str = "is_isolation_forest_anomaly",
    contamination: float = 0.1,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Score every row and mark exactly the ``ceil(contamination * n)`` highest of the ``n`` with a score, ties by
    ``row_id``: ``prediction`` 1 and ``flag`` true. The scored table is written once, as the cut needs
    passes of its own."""
    forest, _ = fit(df, features, row_id, trees, sample_size, seed)
    scored = materialize(score(df, features, forest), "forest")
    marked = flag_highest(scored, "anomaly_score", contamination, row_id, flag)
    return marked.withColumn("prediction", F.col(flag).cast("int")).select(*scored.columns, "prediction", flag)
