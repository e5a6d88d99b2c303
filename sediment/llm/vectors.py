"""Near-duplicate embeddings: coarse lists, product-quantised residuals, exact cosine rerank."""

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

from sediment.llm.common import map_frames, written
from sediment.llm.components import components


@dataclass(frozen=True)
class VectorIndex:
    """Vectors link at a cosine of ``threshold`` or more. The index is fitted on the ``sample`` vectors
    of least hash, collected to the driver: ``sample`` bounds that. Lists number about the square root of the
    vectors, at every size: beyond one per ``per_list`` sampled ones they have two levels, a center and one of the
    residual centers that all share. ``recall`` is the share of
    neighbours exactly at the threshold, in random directions, that the probes must reach; the
    number of probes follows from it. ``block`` bounds the rows of either side in one task's group."""

    threshold: float = 0.9
    sample: int = 20_000
    per_list: int = 32
    parts: int = 8
    codes: int = 64
    recall: float = 0.999
    block: int = 2048
    rounds: int = 12
    seed: int = 11


# Scores of rows against centers that are held at once.
SCORES = 4_000_000


def _parts(rows: int, centers: int) -> list[slice]:
    step = max(1, SCORES // max(centers, 1))
    return [slice(at, at + step) for at in range(0, rows, step)]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = 0.5 * (centers**2).sum(1)
    return np.concatenate([(x[part] @ centers.T - half).argmax(1) for part in _parts(len(x), len(centers))] or [np.empty(0, np.int64)])


def _k_means(x: np.ndarray, k: int, rounds: int, draw: np.random.Generator) -> np.ndarray:
    centers = x[draw.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centers)
        count = np.bincount(near, minlength=len(centers))
        for j in range(x.shape[1]):
            total = np.bincount(near, weights=x[:, j], minlength=len(centers))
            centers[:, j] = np.where(count > 0, total / np.maximum(count, 1), centers[:, j])
    return centers


@dataclass(frozen=True)
class Model:
    """Coarse ``centers``, ``books`` of residual codewords per part of the vector, ``probes`` per query."""

    centers: np.ndarray
    books: list[np.ndarray]
    edges: np.ndarray
    probes: int

    def coarse(self, x: np.ndarray) -> np.ndarray:
        return x @ self.centers.T - 0.5 * (self.centers**2).sum(1)

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector, and those it probes."""
        cells, probes = [np.empty(0, np.int64)], [np.empty((0, self.probes), np.int64)]
        for part in _parts(len(x), len(self.centers)):
            score = self.coarse(x[part])
            cells.append(score.argmax(1))
            probes.append(np.argpartition(-score, self.probes - 1, axis=1)[:, : self.probes])
        return np.concatenate(cells), np.concatenate(probes)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each vector is from its decoded form."""
        codes = np.empty((len(residual), len(self.books)), np.uint8)
        error = np.zeros(len(residual))
        for m, book in enumerate(self.books):
            part = residual[:, self.edges[m] : self.edges[m + 1]]
            codes[:, m] = _nearest(part, book)
            error += ((part - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def tables(self, residual: np.ndarray) -> list[np.ndarray]:
        """Squared distances from each query residual to every codeword of every part."""
        out = []
        for m, book in enumerate(self.books):
            part = residual[:, self.edges[m] : self.edges[m + 1]]
            out.append(((part[:, None, :] - book[None]) ** 2).sum(2).astype(np.float32))
        return out


def fit(sample: np.ndarray, rows: int, spec: VectorIndex) -> Model:
    """A model of unit vectors for an index of ``rows`` rows."""
    draw = np.random.default_rng(spec.seed)
    wanted, most = max(1, math.isqrt(max(rows, 1))), max(1, len(sample) // spec.per_list)
    centers = _k_means(sample, min(wanted, most), spec.rounds, draw)
    if wanted > len(centers):
        inner = min(most, -(-wanted // len(centers)))
        finer = _k_means(sample - centers[_nearest(sample, centers)], inner, spec.rounds, draw)
        centers = (centers[:, None, :] + finer[None]).reshape(-1, sample.shape[1])
    near = _nearest(sample, centers)
    residual = sample - centers[near]
    edges = np.linspace(0, sample.shape[1], min(spec.parts, sample.shape[1]) + 1).astype(int)
    books = [_k_means(residual[:, a:b], spec.codes, spec.rounds, draw) for a, b in zip(edges, edges[1:])]
    trial = sample[: 1 + len(sample) // 4]
    apart = draw.normal(size=trial.shape)
    apart -= (apart * trial).sum(1, keepdims=True) * trial
    apart /= np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12)
    other = spec.threshold * trial + math.sqrt(1 - spec.threshold**2) * apart
    model = Model(centers, books, edges, 1)
    ranks = []
    for part in _parts(len(trial), len(centers)):
        score = model.coarse(trial[part])
        ranks.append((score > np.take_along_axis(score, model.coarse(other[part]).argmax(1)[:, None], 1)).sum(1))
    rank = np.concatenate(ranks)
    probes = int(np.quantile(rank, spec.recall, method="higher")) + 1
    return Model(centers, books, edges, min(probes, len(centers)))


def _units(data: pd.Series, dim: int) -> np.ndarray:
    """Unit vectors in doubles of vectors as they were given, four or eight bytes a number."""
    raw = b"".join(data)
    kind = np.float32 if len(raw) == 4 * dim * len(data) else np.float64
    x = np.frombuffer(raw, kind).reshape(len(data), dim).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _read(df: DataFrame, vec_id: str, embedding: str, dim: int) -> DataFrame:
    """``vec``, ``node`` (hash of the unit vector, NULL where it cannot link) and ``unit``, the vector's numbers as
    they are: floats stay four bytes a number wherever the vector travels."""
    given = df.schema[embedding].dataType
    kind = np.float32 if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else np.float64

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            nodes, units = [], []
            for value in frame["x"]:
                x = np.array(value, np.float64) if value is not None and len(value) == dim else np.zeros(1)
                scale = np.abs(x).max() if np.isfinite(x).all() and len(x) else 0.0
                if not scale:
                    nodes.append(None), units.append(None)
                    continue
                x = x / scale
                nodes.append(xxhash.xxh3_128_digest((x / np.linalg.norm(x)).tobytes())), units.append(np.array(value, kind).tobytes())
            yield pd.DataFrame({"vec": frame["vec"], "node": nodes, "unit": units})

    read = df.select(F.col(vec_id).alias("vec"), F.col(embedding).cast("array<double>").alias("x"))
    return map_frames(read, run, read.select("vec").schema.add("node", "binary").add("unit", "binary"))


def _coded(classes: DataFrame, model: Model, dim: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            x = _units(frame["unit"], dim)
            cell, probes = model.lists(x)
            codes, error = model.encode(x - model.centers[cell])
            yield frame.assign(
                cell=cell.astype(np.int32), code=[c.tobytes() for c in codes], error=error, probes=list(probes.astype(np.int32))
            )

    return classes.mapInPandas(
        run, "node binary, n long, unit binary, cell int, code binary, error double, probes array<int>"
    )


def search_block(data: pd.DataFrame, queries: pd.DataFrame, model: Model, dim: int, threshold: float) -> pd.DataFrame:
    """``node``, ``links``, ``root``: per row of either side that links, the rows linked and the least
    position of its component within this block. Pairs count once: the query has the lesser node."""
    x, q = _units(data["unit"], dim), _units(queries["unit"], dim)
    x_node, q_node = data["node"].to_numpy(object), queries["node"].to_numpy(object)
    order = {node: i for i, node in enumerate(sorted({*x_node, *q_node}))}
    x_at, q_at = np.array([order[v] for v in x_node]), np.array([order[v] for v in q_node])
    codes = np.frombuffer(b"".join(data["code"]), np.uint8).reshape(len(data), len(model.books))
    center = model.centers[int(data["cell"].iloc[0])]
    reach = (math.sqrt(max(0.0, 2 - 2 * threshold)) + data["error"].to_numpy() + 1e-5).astype(np.float32) ** 2
    first, second = [], []
    for start in range(0, len(q), 256):
        part = q[start : start + 256]
        distance = np.zeros((len(part), len(x)), np.float32)
        for m, table in enumerate(model.tables(part - center)):
            distance += table[:, codes[:, m]]
        i, j = np.nonzero((distance <= reach[None, :]) & (q_at[start : start + 256, None] < x_at[None, :]))
        for at in range(0, len(i), 200_000):
            a, b = i[at : at + 200_000], j[at : at + 200_000]
            linked = np.einsum("ij,ij->i", part[a], x[b]) >= threshold
            first.append(q_at[start + a[linked]]), second.append(x_at[b[linked]])
    a = np.concatenate(first) if first else np.empty(0, np.int64)
    b = np.concatenate(second) if second else np.empty(0, np.int64)
    size = np.zeros(len(order), np.int64)
    size[x_at], size[q_at] = data["n"].to_numpy(), queries["n"].to_numpy()
    links = np.bincount(a, weights=size[b], minlength=len(order)) + np.bincount(b, weights=size[a], minlength=len(order))
    root = np.arange(len(order))
    while len(a):
        least = np.minimum(root[a], root[b])
        if (least == root[a]).all() and (least == root[b]).all():
            break
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
    nodes = np.array(list(order), object)
    hit = np.nonzero(links)[0]
    return pd.DataFrame({"node": nodes[hit], "links": links[hit].astype(np.int64), "root": nodes[root[hit]]})


def near_vectors(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", spec: VectorIndex = VectorIndex(), dim: int | None = None
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row.

    Every vector is indexed and every vector is a query, compared in blocks. A vector that is NULL,
    zero, of another length than ``dim`` (by default the commonest), or that holds NULL or a value that
    is not finite links with nothing. Equal directions are one class with a count, so copies are
    counted without being compared. Within a probed list nothing is lost: a code is dropped only when
    its table distance less its own coding error exceeds the radius. ``component_id`` is the least
    identifier reachable, NULL counting as largest; rows that repeat an identifier are rows of their
    own; an empty table gives no rows."""
    if dim is None:
        sizes = df.filter(F.size(embedding) > 0).groupBy(F.size(embedding).alias("d")).count()
        row = sizes.orderBy(F.desc("count"), F.desc("d")).first()
        dim = row["d"] if row else 1
    rows = written(_read(df, vec_id, embedding, dim), "vectors")
    classes = written(
        rows.filter("node is not null")
        .groupBy("node")
        .agg(F.min("vec").alias("low"), F.count("*").alias("n"), F.first("unit").alias("unit")),
        "classes",
    )
    total = classes.count()
    out = rows.select(F.col("vec").alias(vec_id), "node")
    if not total:
        return out.select(vec_id, F.lit(0).cast("long").alias("n_links"), F.col(vec_id).alias("component_id"), F.lit(True).alias("kept"))
    chosen = classes.select("unit", F.xxhash64("node").alias("h")).orderBy("h").limit(spec.sample).collect()
    model = fit(_units(pd.Series([bytes(r["unit"]) for r in chosen]), dim), total, spec)
    coded = written(_coded(classes.select("node", "n", "unit"), model, dim), "coded")
    in_cell = dict(coded.groupBy("cell").count().collect())
    to_cell = dict(coded.select(F.explode("probes").alias("cell")).groupBy("cell").count().collect())
    blocks = [
        (c, -(-in_cell.get(c, 0) // spec.block), -(-to_cell.get(c, 0) // spec.block)) for c in range(len(model.centers))
    ]
    # A row per list that anything probes; the two counts are joined on, as there may be many lists.
    cut = written(
        df.sparkSession.createDataFrame([(c, max(1, d), max(1, q)) for c, d, q in blocks if q], "cell int, _data int, _queries int"), "cuts"
    )
    data_blocks, query_blocks = F.col("_data"), F.col("_queries")
    turn = F.xxhash64("node")
    data = coded.select("node", "n", "unit", "cell", "code", "error").join(cut, "cell").withColumns(
        {"data_block": F.pmod(turn, data_blocks).cast("int"), "query_block": F.explode(F.sequence(F.lit(0), query_blocks - 1))}
    )
    queries = (
        coded.select("node", "n", "unit", F.explode("probes").alias("cell"))
        .join(cut, "cell")
        .withColumns({"code": F.lit(None).cast("binary"), "error": F.lit(None).cast("double")})
        .withColumns(
            {"query_block": F.pmod(turn, query_blocks).cast("int"), "data_block": F.explode(F.sequence(F.lit(0), data_blocks - 1))}
        )
    )
    threshold = spec.threshold

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame["code"].notna()
        if own.all() or not own.any():
            return pd.DataFrame({"node": [], "links": [], "root": []})
        return search_block(frame[own], frame[~own], model, dim, threshold)

    found = written(
        data.drop("_data", "_queries")
        .unionByName(queries.drop("_data", "_queries"))
        .groupBy("cell", "data_block", "query_block")
        .applyInPandas(run, "node binary, links long, root binary"),
        "found",
    )
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("node <> root").select("node", "root").distinct(), "node", "root")
    low = classes.select("node", "low", "n")
    linked = written(low.join(roots, "node"), "linked")
    least = written(linked.groupBy("root").agg(F.min("low").alias("component")), "least")
    placed = written(linked.join(least, "root").select("node", "component"), "placed")
    facts = written(
        low.join(counted, "node", "left")
        .join(placed, "node", "left")
        .select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "low").alias("component"),
        ),
        "facts",
    )
    own = F.coalesce("component", vec_id)
    return out.join(facts, "node", "left").select(
        vec_id,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        own.eqNullSafe(F.col(vec_id)).alias("kept"),
    )
