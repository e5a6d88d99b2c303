"""Near-duplicate lines across documents by a segment-partition edit join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import discard, fresh, keys_for_join, map_frames, mixed, written
from sediment.llm.components import components

WORD_BITS = 64


@dataclass(frozen=True)
class LineRules:
    """Lines of at least ``min_chars`` code points link at an edit distance of ``edits`` or less, and lines of at
    least ``exact_chars`` (``min_chars`` when None) are repeats where they are the same. Shorter ones are never touched."""

    edits: int = 2
    min_chars: int = 40
    exact_chars: int | None = None

    @property
    def least(self) -> int:
        return self.min_chars if self.exact_chars is None else self.exact_chars

    def __post_init__(self):
        if not 1 <= self.least <= self.min_chars:
            raise ValueError("lines that link must also count when they are the same")
        if not 0 <= self.edits <= WORD_BITS // 2 - 1 or self.min_chars < 2 * (self.edits + 1):
            raise ValueError("edits must fit the band of a word, and lines must be long enough for their segments")


def within_edits(a: str, b: str, limit: int) -> bool:
    """True when at most ``limit`` insertions, deletions and substitutions turn ``a`` into ``b``.

    Equal ends are cut off first. The rest is a bit-parallel table of vertical differences whose
    word slides along the diagonal, so only the band of 2 * limit + 1 rows is computed."""
    if abs(len(a) - len(b)) > limit:
        return False
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        start += 1
    while end > start and a[len(a) - 1 - (min(len(a), len(b)) - end)] == b[len(b) - 1 - (min(len(a), len(b)) - end)]:
        end -= 1
    tail = min(len(a), len(b)) - end
    a, b = a[start : len(a) - tail], b[start : len(b) - tail]
    if not a or not b:
        return max(len(a), len(b)) <= limit
    if len(a) <= limit and len(b) <= limit:
        return True
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    whole, top = (1 << WORD_BITS) - 1, 1 << (WORD_BITS - 1)
    rising = (whole << (WORD_BITS - limit - 1)) & whole
    falling, distance, along = 0, limit, top >> 1
    for j, c in enumerate(b):
        shift = j + limit + 1 - WORD_BITS
        seen = places.get(c, 0)
        match = (seen >> shift if shift >= 0 else seen << -shift) & whole
        diagonal = ((((match & rising) + rising) & whole) ^ rising) | match | falling
        up = falling | (~(diagonal | rising) & whole)
        down = diagonal & rising
        if j < len(a) - limit:
            distance += not diagonal & top
        else:
            distance += bool(up & along) - bool(down & along)
            along >>= 1
        if distance > 2 * limit + len(b) - len(a) and j < len(a) - limit:
            return False
        rising = down | (~((diagonal >> 1) | up) & whole)
        falling = (diagonal >> 1) & up
    return distance <= limit


def segment_bounds(length: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of a segment; the last segments are one longer."""
    base = length // parts
    longer = length - base * parts
    return base * part + np.maximum(part - (parts - longer), 0), base + (part >= parts - longer)


def probe_shifts(edits: int) -> list[tuple[int, int, int]]:
    """(d, part, shift): where a segment of a line shorter by d can stand in a line, its own place aside.

    ``part`` edits can have shifted the text before, and ``edits - part`` the text after."""
    out = []
    for d in range(edits + 1):
        for part in range(edits + 1):
            left = edits - part
            out += [(d, part, shift) for shift in range(max(-part, d - left), min(part, d + left) + 1) if d or shift]
    return out


SKETCH_GROUPS, SKETCH_BITS = 10, 3


class SegmentHasher:
    """Hashes of substrings of many lines at once, from running sums over their characters."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, edits: int):
        self.edits, self.shifts = edits, probe_shifts(edits)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per line: hashes of its segments, of its probes, and the sketch of its character counts.

        A hash is of the line's length (for a probe: the shorter line's), the segment's number and its characters."""
        codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter(map(len, lines), np.int64, len(lines))
        first = np.cumsum(length) - length
        self._powers(len(codes) + 1)
        value = mixed(codes.astype(np.uint64) + np.uint64(1 << 40))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(value * self.power[: len(codes)], out=sums[1:])
        parts = self.edits + 1

        def hashed(d: int, part: int, shift: int) -> np.ndarray:
            start, size = segment_bounds(length - d, part, parts)
            start = first + start + shift
            body = (sums[start + size] - sums[start]) * self.inverse[start]
            return mixed(body + mixed(((length - d) * parts + part).astype(np.uint64)))

        index = np.stack([hashed(0, part, 0) for part in range(parts)], axis=1)
        probe = np.stack([hashed(*s) for s in self.shifts], axis=1) if self.shifts else np.empty((len(lines), 0), np.uint64)
        group = (value >> np.uint64(40)) % np.uint64(SKETCH_GROUPS)
        at = np.repeat(np.arange(len(lines)) * SKETCH_GROUPS, length) + group.astype(np.int64)
        counts = np.bincount(at, minlength=len(lines) * SKETCH_GROUPS).reshape(-1, SKETCH_GROUPS)
        bits = (counts & ((1 << SKETCH_BITS) - 1)) << (SKETCH_BITS * np.arange(SKETCH_GROUPS))
        return index.view(np.int64), probe.view(np.int64), bits.sum(axis=1).astype(np.int32)


def may_be_near(x: Column, y: Column, edits: int) -> Column:
    """False where two sketches differ by more than ``edits`` edits can make: an edit changes one or two
    counts by one, and counts are compared modulo 8, the shorter way round."""
    whole = 1 << SKETCH_BITS
    total = F.lit(0)
    for k in range(SKETCH_GROUPS):
        part = [F.shiftright(c, SKETCH_BITS * k).bitwiseAND(whole - 1) for c in (x, y)]
        apart = F.abs(part[0] - part[1])
        total = total + F.least(apart, whole - apart)
    return total <= 2 * edits


def _key_of(line: bytes) -> bytes:
    return hashlib.md5(line, usedforsecurity=False).digest()


def _long_lines(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The columns that passes over the lines read, with a hash of the text to tell repeated identifiers apart."""
    return df.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull()
    )


def line_places(df: DataFrame, doc_id: str, text: str, rules: LineRules) -> DataFrame:
    """``doc``, ``mark``, ``line_no``, ``key`` (MD5) of the lines that count, exact repeats included."""
    places = _long_lines(df, doc_id, text)
    schema = places.select("doc", "mark").schema.add("line_no", "integer").add("key", "binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows, numbers, keys = [], [], []
            for row, value in enumerate(frame["text"]):
                for number, line in enumerate(value.split("\n")):
                    if len(line) >= rules.least:
                        rows.append(row), numbers.append(number)
                        keys.append(_key_of(line.encode("utf-8", "surrogatepass")))
            out = frame[["doc", "mark"]].iloc[rows].reset_index(drop=True)
            yield out.assign(line_no=np.array(numbers, np.int32), key=keys)

    return map_frames(places, run, schema)


def line_segments(df: DataFrame, doc_id: str, text: str, rules: LineRules, chars: int = 1_000_000) -> DataFrame:
    """``doc``, ``mark``, ``line_no``, ``key``, ``id`` (xxHash64, as Spark's with its seed of 42), ``sketch``, ``index`` and
    ``probe`` of the lines that link; about ``chars`` characters are hashed at a time."""
    kind = df.schema[doc_id].dataType.simpleString()

    def flush(hasher: SegmentHasher, docs: pa.Array, marks: pa.Array, rows: list, numbers: list, lines: list) -> pa.RecordBatch:
        index, probe, sketch = hasher(lines)
        lists = [
            pa.ListArray.from_arrays(pa.array(np.arange(len(lines) + 1, dtype=np.int32) * h.shape[1]), pa.array(h.ravel()))
            for h in (index, probe)
        ]
        data = [line.encode("utf-8", "surrogatepass") for line in lines]
        ids = np.fromiter((xxhash.xxh64_intdigest(b, 42) for b in data), np.uint64, len(data)).view(np.int64)
        keys = pa.array([_key_of(b) for b in data], pa.binary())
        take = pa.array(rows, pa.int64())
        columns = [docs.take(take), marks.take(take), pa.array(numbers, pa.int32()), keys, pa.array(ids), pa.array(sketch), *lists]
        return pa.RecordBatch.from_arrays(columns, ["doc", "mark", "line_no", "key", "id", "sketch", "index", "probe"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SegmentHasher(rules.edits)
        for batch in batches:
            docs, marks, texts = batch.column(0), batch.column(1), batch.column(2)
            rows, numbers, lines, size = [], [], [], 0
            for row, value in enumerate(texts):
                for number, line in enumerate(value.as_py().split("\n")):
                    if len(line) >= rules.min_chars:
                        rows.append(row), numbers.append(number), lines.append(line)
                        size += len(line)
                        if size >= chars:
                            yield flush(hasher, docs, marks, rows, numbers, lines)
                            rows, numbers, lines, size = [], [], [], 0
            if lines:
                yield flush(hasher, docs, marks, rows, numbers, lines)

    schema = f"doc {kind}, mark long, line_no int, key binary, id long, sketch int, index array<bigint>, probe array<bigint>"
    return _long_lines(df, doc_id, text).mapInArrow(run, schema)


def line_links(df: DataFrame, doc_id: str, text: str, repeated: DataFrame, rules: LineRules) -> DataFrame:
    """``a``, ``b``: keys of different lines within the edit limit.

    Only the first occurrence of a line is indexed and probed. Lines meet where they share a segment and
    their character counts allow the edits; only of those the text is fetched."""
    single = (
        line_segments(df, doc_id, text, rules)
        .join(keys_for_join(repeated.select("key", "owner")), "key", "left")
        .filter(F.col("owner").isNull() | (F.col("owner") == F.struct("doc", "mark", "line_no")))
    )
    single = written(single.select("id", "sketch", "index", "probe"), "segments")
    index = single.select(F.explode("index").alias("segment"), "id", "sketch")
    probe = single.select(F.explode("probe").alias("segment"), "id", "sketch")
    left = index.select("segment", F.col("id").alias("a"), F.col("sketch").alias("x"))
    near_enough = may_be_near(F.col("x"), F.col("sketch"), rules.edits)
    pairs = left.join(index, "segment").filter((F.col("a") < F.col("id")) & near_enough).select("a", F.col("id").alias("b"))
    if rules.edits:
        shifted = left.join(probe, "segment").filter((F.col("a") != F.col("id")) & near_enough)
        pairs = pairs.unionByName(shifted.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")))
    pairs = written(pairs.distinct(), "line_pairs")
    discard(single)
    wanted = written(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "line_ids")
    lines = df.select(F.explode(F.split(text, "\n")).alias("line")).filter(F.length("line") >= rules.min_chars)
    texts = written(
        lines.select(F.xxhash64("line").alias("id"), "line")
        .join(keys_for_join(wanted), "id", "left_semi")
        .groupBy("id", F.unhex(F.md5("line")).alias("key"))
        .agg(F.first("line").alias("line")),
        "line_texts",
    )
    limit = rules.edits

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([within_edits(a, b, limit) for a, b in zip(x, y)], dtype=bool)

    first = texts.select(F.col("id").alias("a"), F.col("key").alias("ka"), F.col("line").alias("_x"))
    second = texts.select(F.col("id").alias("b"), F.col("key").alias("kb"), F.col("line").alias("_y"))
    checked = pairs.join(first, "a").join(second, "b").filter(near("_x", "_y"))
    return written(checked.select(F.col("ka").alias("a"), F.col("kb").alias("b")), "line_links")


def repeated_lines(df: DataFrame, doc_id: str, text: str, rules: LineRules) -> DataFrame:
    """``doc``, ``mark``, ``line_no``, ``near`` of every line that repeats an earlier one of its class.

    The earliest occurrence of a class, by document, then by line, stays. ``near`` is true where the
    line itself is not the same as the one that stays."""
    places = written(line_places(df, doc_id, text, rules), "lines")
    place = F.struct("doc", "mark", "line_no")
    repeated = written(
        places.groupBy("key").agg(F.min(place).alias("owner"), F.count("*").alias("n")).filter("n > 1").select("key", "owner"),
        "repeated",
    )
    links = line_links(df, doc_id, text, repeated, rules)
    roots = components(links)
    linked = (
        places.join(keys_for_join(roots.select(F.col("node").alias("key"))), "key", "left_semi")
        .groupBy("key")
        .agg(F.min(place).alias("first"))
        .join(roots.withColumnRenamed("node", "key"), "key")
    )
    linked = written(linked, "linked")
    least = written(linked.groupBy("root").agg(F.min("first").alias("owner")), "least")
    classes = linked.join(least, "root").select("key", "owner", (F.col("first") != F.col("owner")).alias("near"))
    plain = repeated.join(roots.select(F.col("node").alias("key")), "key", "left_anti")
    decided = written(plain.select("key", "owner", F.lit(False).alias("near")).unionByName(classes), "decided")
    out = places.join(keys_for_join(decided), "key").filter(place != F.col("owner")).select("doc", "mark", "line_no", "near")
    out = written(out, "repeats")
    discard(links)
    discard(places)
    return out


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """All rows and columns with the repeated lines cut from the text, and ``n_lines``, ``n_removed``,
    ``n_near``; columns of these names are replaced.

    A line counts as repeated when an earlier line of any document (or its own) equals it or is
    joined to it by links of ``edits`` edits. Earlier: smaller identifier (NULL first), then line
    number. Rows that repeat both identifier and text keep and lose the same lines. A NULL text
    stays NULL with no lines; a text may become empty, its row stays; an empty table gives no rows."""
    df = df.drop(*[c for c in df.columns if c.lower() in ("n_lines", "n_removed", "n_near")])
    removed = repeated_lines(df, doc_id, text, rules)
    mark, key, cut, gone, lines, near = fresh(df, "_mark", "_key", "_cut", "_gone", "_lines", "_near")
    per_doc = removed.groupBy(F.col("doc").alias(key), F.col("mark").alias(mark)).agg(
        F.sort_array(F.collect_set("line_no")).alias(cut), F.size(F.collect_set(F.when(F.col("near"), F.col("line_no")))).alias(near)
    )
    per_doc = written(per_doc, "cuts")
    per_doc = keys_for_join(per_doc)
    c = F.col(cut)
    flags = F.flatten(
        F.transform(
            c,
            lambda p, i: F.concat(
                F.array_repeat(F.lit(False), p - F.coalesce(F.get(c, i - 1), F.lit(-1)) - 1), F.array(F.lit(True))
            ),
        )
    )
    marked = df.withColumn(mark, F.xxhash64(text)).withColumnRenamed(doc_id, key)
    left, right = marked.alias("l"), per_doc.alias("r")
    joined = left.join(
        right, F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) & (F.col(f"l.{mark}") == F.col(f"r.{mark}")), "left"
    ).select("l.*", cut, near)
    keep = F.filter(F.col(lines), lambda line, i: ~F.coalesce(F.get(F.col(gone), i), F.lit(False)))
    parted = joined.withColumns({lines: F.split(text, "\n"), gone: flags})
    whole = F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.array_join(keep, "\n"))
    return (
        parted.withColumns(
            {
                text: whole,
                "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
                "n_removed": F.coalesce(F.size(cut), F.lit(0)).cast("long"),
                "n_near": F.coalesce(near, F.lit(0)).cast("long"),
            }
        )
        .withColumnRenamed(key, doc_id)
        .select(*df.columns, "n_lines", "n_removed", "n_near")
    )
