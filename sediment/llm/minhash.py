"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact check.

Documents with equal shingle sets are one class, and only classes are compared. A class is
known by the 128-bit hash of its sorted set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.llm.common import discard, fresh, keys_for_join, map_frames, mixed, written
from sediment.llm.components import components, contracted


@dataclass(frozen=True)
class NearDup:
    """``shingle`` words per shingle; documents link from ``percent`` percent similarity on.

    With 50 bands of 7 rows a pair at 80 percent is missed by all bands with probability
    (1 - 0.8^7)^50 = 8e-6. ``checks`` further hashes, compared in batches of ``batch``, drop a
    candidate once the posterior probability of reaching the threshold is below ``miss``. In each of
    ``rounds`` a set is held against one set at most, before what is still apart is compared in blocks."""

    shingle: int = 5
    percent: int = 80
    bands: int = 50
    rows: int = 7
    checks: int = 128
    batch: int = 16
    miss: float = 1e-6
    rounds: int = 3
    seed: int = 20_261


_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted 64-bit hashes of the distinct shingles of a text."""

    def __init__(self, size: int, cached_words: int = 500_000):
        self.size, self.cached_words, self.known = size, cached_words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > self.cached_words:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(ids))
        total = np.full(len(ids) - size + 1, size, np.uint64)
        for i in range(size):
            total = mixed(total * _MIX + ids[i : len(ids) - size + 1 + i])
        return np.unique(total)


def _multipliers(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    return (
        draw.integers(0, 2**32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1),
        draw.integers(0, 2**32, count, dtype=np.uint64).astype(np.uint32),
    )


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    """Least value of each hash function over the set, a block of shingles at a time."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), block):
        part = low[at : at + block]
        for j in range(0, len(a), 64):
            rows = a[j : j + 64, None] * part[None, :]
            rows += b[j : j + 64, None]
            np.minimum(out[j : j + 64], rows.min(axis=1), out=out[j : j + 64])
    return out


def posterior_floor(compared: int, percent: int, miss: float) -> int:
    """Fewest matches of ``compared`` hashes with which the similarity still reaches the threshold
    with probability ``miss`` or more, under a uniform prior.

    The posterior is Beta(m + 1, n - m + 1), and its upper tail at t is that of a binomial:
    P(J >= t) = P(Binomial(n + 1, t) <= m)."""
    t, tail = percent / 100, 0.0
    for m in range(compared + 1):
        tail += math.comb(compared + 1, m) * t**m * (1 - t) ** (compared + 1 - m)
        if tail >= miss:
            return m
    return compared


def sketches(df: DataFrame, text: str, spec: NearDup) -> DataFrame:
    """All columns but the text, with ``n_shingles`` and, for non-empty sets, ``node`` (hash of the
    set), ``keys`` (a hash per band) and ``checks`` (16 bits of each check hash)."""
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept).schema.add("n_shingles", "long").add("node", "binary").add("keys", T.ArrayType(T.LongType()))
    schema = schema.add("checks", "binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(spec.shingle)
        a, b = _multipliers(spec.bands * spec.rows + spec.checks, spec.seed)
        band = np.arange(spec.bands, dtype=np.uint64)
        for frame in batches:
            sizes, nodes, keys, checks = [], [], [], []
            for value in frame.pop(text):
                found = shingler(value)
                sizes.append(len(found))
                if not len(found):
                    nodes.append(None), keys.append(None), checks.append(None)
                    continue
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                sign = signature(found, a, b)
                total = band
                for row in sign[: spec.bands * spec.rows].reshape(spec.bands, spec.rows).T.astype(np.uint64):
                    total = mixed(total * _MIX + row)
                keys.append(total.view(np.int64))
                checks.append(sign[spec.bands * spec.rows :].astype(np.uint16).tobytes())
            yield frame.assign(n_shingles=sizes, node=nodes, keys=keys, checks=checks)

    return map_frames(df, run, schema)


def prune(pairs: DataFrame, marks: DataFrame, spec: NearDup) -> DataFrame:
    """Pairs ``a``, ``b`` whose check hashes leave the threshold within reach, batch after batch."""
    steps = range(spec.batch, spec.checks + 1, spec.batch)
    floors = [(n, posterior_floor(n, spec.percent, spec.miss)) for n in steps]

    @F.pandas_udf("boolean")
    def within_reach(x: pd.Series, y: pd.Series) -> pd.Series:
        left = np.frombuffer(b"".join(x), np.uint16).reshape(len(x), spec.checks)
        right = np.frombuffer(b"".join(y), np.uint16).reshape(len(y), spec.checks)
        alive, equal, at = np.arange(len(x)), np.zeros(len(x), np.int64), 0
        for n, least in floors:
            equal = equal + (left[alive, at:n] == right[alive, at:n]).sum(axis=1)
            keep = equal >= least
            alive, equal, at = alive[keep], equal[keep], n
        out = np.zeros(len(x), bool)
        out[alive] = True
        return pd.Series(out)

    first = marks.select(F.col("node").alias("a"), F.col("checks").alias("_x"))
    second = marks.select(F.col("node").alias("b"), F.col("checks").alias("_y"))
    return pairs.join(first, "a").join(second, "b").filter(within_reach("_x", "_y")).select("a", "b")


def shingle_sets(df: DataFrame, text: str, size: int) -> DataFrame:
    """``node`` and ``shingles`` (sorted 64-bit hashes as bytes) of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(size)
        for frame in batches:
            sets = [shingler(value).tobytes() for value in frame[text]]
            yield pd.DataFrame({"node": [xxhash.xxh3_128_digest(s) for s in sets], "shingles": sets})

    return df.select(text).mapInPandas(run, "node binary, shingles binary")


def reaches(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sets have 100 * intersection >= percent * union."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([reaches(*both, percent) for both in zip(x, y, strict=True)], dtype=bool)

    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y"))
    return pairs.join(first, "a").join(second, "b").filter(linked("_x", "_y")).select("a", "b")


def spanning_links(a: np.ndarray, b: np.ndarray, linked) -> np.ndarray:
    """Positions of the pairs that are ``linked`` and join parts that those before them leave apart."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (above := up.get(x, x)) != x:
            up[x] = x = up.get(above, above)
        return x

    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y and linked(i):
            up[max(x, y)] = min(x, y)
            out.append(i)
    return np.array(out, np.int64)


class _Prints:
    """32-bit prints of the sets of a frame's rows, end to end. Common prints are never fewer than common shingles."""

    def __init__(self, sets: pd.Series):
        self.flat = (np.frombuffer(b"".join(sets), np.uint64) >> np.uint64(32)).astype(np.uint32)
        self.ends = np.cumsum([0, *(len(s) // 8 for s in sets)])

    def of(self, row: int) -> np.ndarray:
        return self.flat[self.ends[row] : self.ends[row + 1]]

    def within(self, x: int, rows: np.ndarray, percent: int) -> np.ndarray:
        """Which of ``rows`` can have 100 * intersection >= percent * union with row ``x``."""
        own = self.of(x)
        other = np.concatenate([self.of(y) for y in rows])
        sizes = self.ends[rows + 1] - self.ends[rows]
        found = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
        common = np.add.reduceat(found, np.cumsum(sizes) - sizes, dtype=np.int64)
        return 100 * common >= percent * (len(own) + sizes - common)


def compare_bucket(rows: slice, frame: dict, floors: list[tuple[int, int]], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of one bucket that are of different roots, within reach after every batch of
    check hashes, and then, where the frame has them, by the prints of their whole sets. Side 0 pairs with 1;
    2 marks rows of a block that pairs with itself. A pair is taken up only in the first bucket it shares."""
    key, keys, checks, root, side = (frame[c][rows] for c in ("key", "keys", "checks", "root", "side"))
    first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    j = np.arange(len(root))
    for start in range(0, len(root), 256):
        i = np.arange(start, min(len(root), start + 256))[:, None]
        open_pairs = (root[i] != root) & np.where(side[i] == 2, i < j, (side[i] == 0) & (side == 1))
        x, y = np.nonzero(open_pairs)
        x += start
        equal, at = np.zeros(len(x), np.int64), 0
        for end, least in floors:
            equal += (checks[x, at:end] == checks[y, at:end]).sum(axis=1)
            keep = equal >= least
            x, y, equal, at = x[keep], y[keep], equal[keep], end
        own = np.empty(len(x), bool)
        for part in range(0, len(x), 50_000):
            a, b = x[part : part + 50_000], y[part : part + 50_000]
            own[part : part + 50_000] = keys[a, (keys[a] == keys[b]).argmax(axis=1)] == key[a]
        x, y = x[own], y[own]
        if "prints" not in frame:
            first.append(x), second.append(y)
            continue
        cuts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else []
        for begin, end in zip(cuts, [*cuts[1:], len(x)]):
            for part in range(begin, end, 1024):
                near = y[part : min(end, part + 1024)]
                near = near[frame["prints"].within(rows.start + x[begin], rows.start + near, percent)]
                first.append(np.full(len(near), x[begin])), second.append(near)
    return np.concatenate(first), np.concatenate(second)


def _floors(spec: NearDup) -> list[tuple[int, int]]:
    steps = range(spec.batch, spec.checks + 1, spec.batch)
    return [(n, posterior_floor(n, spec.percent, spec.miss)) for n in steps]


def _dealt(rows: DataFrame, facts: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """``rows`` (``key``, ``node``, ``root``, ``size`` in bytes; written) with their ``facts``, dealt out in blocks by ``task``. Many small
    buckets share a task.

    Rows of one root need no comparing with each other. So the rows of a bucket's most frequent root and its other rows
    are cut apart, each into blocks of about ``block`` rows and ``block_bytes``: an other row has a copy for each block, a row
    of that root one for each block of other rows, which is one only while these are few. The root's first block
    is compared with a block of other rows where that is compared with itself (``low`` = ``high``)."""
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    tasks = 1 + max(count // 2500, (total or 0) // (8 << 20))
    of_root = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    most = F.max(F.struct("n", "bytes", "root"))
    each = of_root.groupBy("key").agg(most.alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    cut = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / block_bytes), F.lit(1)).cast("int")
    blocks = each.select(
        "key",
        F.col("most.root").alias("top"),
        cut(F.col("most.n"), F.col("most.bytes")).alias("top_blocks"),
        cut(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("blocks"),
    )
    is_top = F.col("root") == F.col("top")
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    own = F.when(is_top, F.col("blocks") - 1 + place(F.col("top_blocks"))).otherwise(place(F.col("blocks")))
    last = F.when(is_top, F.col("blocks") - 1).otherwise(F.col("blocks") + F.col("top_blocks") - 2)
    return (
        rows.join(written(blocks, "blocks"), "key")
        .withColumns({"own": own, "first": is_top & (own == F.col("blocks") - 1)})
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("own", F.when(F.col("first"), F.col("other")).otherwise(F.col("own")))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .withColumn("task", F.pmod(F.xxhash64("key", "low", "high"), F.lit(tasks)))
        .drop("top", "top_blocks", "blocks", "first", "other", "size")
        .join(facts, "node")
    )


def _met_in_blocks(frame: pd.DataFrame, spec: NearDup, **more) -> tuple[pd.DataFrame, dict, np.ndarray, np.ndarray]:
    """The rows of a task in the order of its blocks, their columns, and positions of the pairs that :func:`compare_bucket`
    leaves. ``more``: further columns, made from the ordered rows."""
    frame = frame.sort_values(["key", "low", "high"], kind="stable", ignore_index=True)
    group = frame[["key", "low", "high"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)])
    columns = {
        "key": frame["key"].to_numpy(),
        "keys": np.stack(frame["keys"].to_numpy()),
        "checks": np.frombuffer(b"".join(frame["checks"]), np.uint16).reshape(len(frame), spec.checks),
        "root": pd.factorize(frame["root"])[0],
        "side": np.where(frame["low"] == frame["high"], 2, np.where(frame["own"] == frame["low"], 0, 1)),
        **{name: make(frame) for name, make in more.items()},
    }
    floors, a, b = _floors(spec), [], []
    for start, stop in zip(starts, [*starts[1:], len(frame)]):
        x, y = compare_bucket(slice(start, stop), columns, floors, spec.percent)
        a.append(start + x), b.append(start + y)
    return frame, columns, np.concatenate(a), np.concatenate(b)


def rows_within_reach(rows: DataFrame, marks: DataFrame, spec: NearDup, block: int = 1024) -> DataFrame:
    """Those of ``rows`` (``key``, ``node``, ``root``; written) that have a row of another root in their bucket which the check
    hashes leave within reach, in the first bucket the two share: both rows of every such pair stay, so no link is
    lost, and only rows leave a task, never pairs. ``marks``: ``node``, ``keys``, ``checks``; written."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, _, a, b = _met_in_blocks(frame, spec)
        at = np.zeros(len(frame), bool)
        at[a] = at[b] = True
        return frame.loc[at, ["key", "node", "root"]].drop_duplicates(["key", "node"])

    schema = rows.select("key", "node", "root").schema
    sized = rows.withColumn("size", F.lit(8 * spec.bands + 2 * spec.checks).cast("long"))
    met = _dealt(sized, marks, block, 16 << 20).groupBy("task").applyInPandas(run, schema)
    return met.dropDuplicates(["key", "node"])


def crossing_pairs(
    rows: DataFrame, facts: DataFrame, spec: NearDup, block: int = 1024, block_bytes: int = 16 << 20
) -> DataFrame:
    """Links ``a``, ``b`` between sets of different roots that share a bucket, confirmed on the whole sets: of each
    task, those that join what its other links leave apart.

    ``rows``: ``key``, ``node``, ``root``, ``size`` in bytes; ``facts``: ``node``, ``keys``, ``checks``, ``shingles``; both
    written. A large bucket is cut into blocks (:func:`_dealt`); each pair of blocks that can hold different roots is
    compared in memory, and only links leave the task."""
    percent = spec.percent

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, columns, a, b = _met_in_blocks(frame, spec, prints=lambda ordered: _Prints(ordered["shingles"]))
        node, whole, part = frame["node"].to_numpy(object), frame["shingles"].to_numpy(object), columns["root"]
        at = spanning_links(part[a], part[b], lambda i: reaches(whole[a[i]], whole[b[i]], percent))
        return pd.DataFrame({"a": node[a[at]], "b": node[b[at]]})

    met = _dealt(rows, facts, block, block_bytes).groupBy("task").applyInPandas(run, "a binary, b binary")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _class_roots(df: DataFrame, doc_id: str, text: str, classes: DataFrame, low_ids: DataFrame, spec: NearDup) -> DataFrame:
    """``node``, ``root`` of the classes that link with others: the components that all links would give.

    In each round every class is held against one center, a member of one of its buckets that meets the most
    other rows: first the largest of its buckets' centers, then the next that is still in another component.
    So a group of many near copies gets about one link a member, and a set travels once a round. Then only
    pairs of a bucket that are still apart are compared, all of them, in memory: first by their check hashes, then
    those rows that have a partner by them, by their whole sets."""
    rows = written(classes.select("node", F.explode("keys").alias("key")), "bands")
    shared = written(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    members = written(rows.join(keys_for_join(shared), "key"), "members")
    discard(rows)
    met = written(members.groupBy("node").agg(F.sum("n").alias("met")), "met")
    marks = written(classes.select("node", "keys", "checks").join(keys_for_join(met.select("node")), "node", "left_semi"), "marks")
    ranked = members.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("center"))
    order = F.slice(F.sort_array(F.collect_set("center"), asc=False)["node"], 1, spec.rounds + 1)
    centers = written(members.join(ranked, "key").groupBy("node").agg(order.alias("c")), "centers")

    def sets_of(nodes: DataFrame) -> DataFrame:
        ids = written(low_ids.join(nodes, "node", "left_semi"), "wanted")
        (key,) = fresh(df, "_wanted")
        wanted = keys_for_join(ids.select(F.col("low").alias(key)).distinct())
        chosen = df.join(wanted, F.col(doc_id).eqNullSafe(F.col(key)), "left_semi")
        sets = shingle_sets(chosen, text, spec.shingle).join(ids.select("node"), "node", "left_semi")
        return written(sets.dropDuplicates(["node"]), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        alive = written(pairs, "alive")
        nodes = alive.select(F.col("a").alias("node")).unionByName(alive.select(F.col("b").alias("node"))).distinct()
        sets = sets_of(nodes)
        out = written(verify(alive, sets, spec.percent), "confirmed")
        discard(alive)
        discard(sets)
        return out

    roots = None
    for k in range(spec.rounds):
        others = F.filter("c", lambda c: c != F.col("node"))
        stars = centers.select("node", F.try_element_at(others, F.lit(k + 1)).alias("c")).filter("c is not null")
        if roots is not None:
            own = roots.select("node", F.col("root").alias("own"))
            far = roots.select(F.col("node").alias("c"), F.col("root").alias("far"))
            stars = stars.join(own, "node", "left").join(far, "c", "left")
            stars = stars.filter(F.coalesce("own", "node") != F.coalesce("far", "c"))
        pairs = stars.select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")).distinct()
        links = confirmed(prune(pairs, marks.select("node", "checks"), spec))
        roots = components(links) if roots is None else contracted(roots, links)
    rooted = written(members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "rooted")
    mixed = written(
        rooted.groupBy("key").agg(F.min("root").alias("l"), F.max("root").alias("h")).filter("l < h").select("key"), "mixed"
    )
    mixed_rows = written(rooted.join(mixed, "key"), "mixed_rows")
    # By the check hashes first, a few hundred bytes a row: sets are read and sent only for rows that have a partner by them.
    open_rows = written(rows_within_reach(mixed_rows, marks, spec), "open")
    sets = sets_of(open_rows.select("node").distinct())
    facts = written(marks.join(sets, "node"), "facts")
    for done in (sets, marks, members, centers, rooted, mixed_rows):
        discard(done)
    sizes = facts.select("node", F.octet_length("shingles").alias("size"))
    sized = written(open_rows.join(sizes, "node"), "sized")
    links = written(crossing_pairs(sized, facts, spec), "crossing")
    for done in (open_rows, facts, sized):
        discard(done)
    return contracted(roots, links)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", spec: NearDup = NearDup()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row.

    Words are separated by ASCII white space and lower-cased in A-Z; a text of fewer words than
    ``shingle`` is one shingle of all of them; a text without words, or NULL, has an empty set and
    links with nothing. ``component_id`` is the least identifier reachable by links, the row's own
    included; ``kept`` says whether that is its own. Rows with equal texts are in one component;
    rows that repeat an identifier each get a row. A NULL identifier counts as larger than any other
    and is kept only where a component has no other. An empty table gives no rows."""
    sketched = written(sketches(df.select(doc_id, text), text, spec).withColumnRenamed(doc_id, "doc"), "sketches")
    filled = sketched.filter("node is not null")
    classes = written(
        filled.groupBy("node").agg(F.min("doc").alias("low"), F.first("keys").alias("keys"), F.first("checks").alias("checks")),
        "classes",
    )
    low_ids = classes.select("node", "low")
    roots = _class_roots(df.select(doc_id, text), doc_id, text, classes, low_ids, spec)
    linked = low_ids.join(roots, "node")
    least = written(linked.groupBy("root").agg(F.min("low").alias("component")), "least")
    placed = written(linked.join(least, "root").select("node", "component"), "placed")
    own = written(
        low_ids.join(placed, "node", "left").select("node", F.coalesce("component", "low").alias("component")), "own"
    )
    discard(classes)
    return (
        sketched.drop("keys", "checks")
        .join(own, "node", "left")
        .select(
            F.col("doc").alias(doc_id),
            "n_shingles",
            F.coalesce("component", "doc").alias("component_id"),
            F.coalesce("component", "doc").eqNullSafe(F.col("doc")).alias("kept"),
        )
    )


def drop_near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", spec: NearDup = NearDup()
) -> DataFrame:
    """One row of each group of near duplicates, as it was: the row of the least identifier; every
    row without words stays.

    Rows that repeat an identifier are told apart by the hash of their set, and of rows that repeat
    both one stays. The rows that go are listed by number, and joined out."""
    (row,) = fresh(df, "_row")
    numbered = written(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    judged = near_duplicates(numbered.select(F.col(row).alias("_n"), F.col(doc_id).alias("_d"), F.col(text).alias("_t")), "_n", "_t", spec)
    filled = written(judged.select("_n", "component_id"), "judged")
    ids = numbered.select(F.col(row).alias("_n"), F.col(doc_id).alias("_d"))
    sized = filled.join(ids, "_n")
    sized = written(sized, "grouped")
    first = F.min_by("_n", F.struct(F.col("_d").isNull(), F.col("_d"), F.col("_n"))).alias("first")
    groups = sized.groupBy("component_id").agg(first, F.count("*").alias("n")).filter("n > 1")
    gone = sized.join(written(groups, "keepers"), "component_id").filter("_n <> first").select(F.col("_n").alias(row))
    return numbered.join(keys_for_join(written(gone, "gone")), row, "left_anti").drop(row)
