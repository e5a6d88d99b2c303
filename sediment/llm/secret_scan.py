"""Secrets in texts: fixed patterns, and random-looking strings by two character Markov models."""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import map_frames

# The base patterns in their order.
ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 24 and more are the matches of [0-9a-f]+ that are long enough, as each of those is a whole run.
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_letters + string.digits + "+/_-="
_PLACE = np.full(128, -1, np.int16)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_START = len(ALPHABET)
LEAST = 20
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{3,}")


@dataclass(frozen=True)
class Training:
    """The models are counted on the ``documents`` distinct texts of least hash, labelled by the base
    patterns: their values are random strings, all other words ordinary, alone and joined to
    identifiers. ``drawn`` strings over usual key alphabets are added to the random ones. A string, or a part
    of it, is reported when its log-likelihood ratio exceeds ``ratio`` and ``per_char`` for each character."""

    documents: int = 4000
    drawn: int = 4000
    ratio: float = 12.0
    per_char: float = 0.35
    seed: int = 5


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found.sort()
    return found


def _codes(value: str) -> np.ndarray:
    return _PLACE[np.frombuffer(value.encode("ascii"), np.uint8)].astype(np.int64)


def _count(counts: np.ndarray, value: str) -> None:
    codes = _codes(value)
    np.add.at(counts, (np.concatenate(([_START], codes[:-1])), codes), 1)


def _drawn(training: Training) -> Iterator[str]:
    draw = np.random.default_rng(training.seed)
    sets = ("0123456789abcdef", string.digits + string.ascii_uppercase, string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-")
    for i in range(training.drawn):
        letters = sets[i % len(sets)]
        yield "".join(letters[k] for k in draw.integers(0, len(letters), int(draw.integers(20, 49))))


def train(df: DataFrame, text: str = "text", training: Training = Training()) -> np.ndarray:
    """Log-likelihood ratios of each character after each other, random against ordinary.

    Only the sample's character pairs reach the driver, summed: a table of at most 2 x 68 x 67."""
    hashed = df.select(F.xxhash64(text).alias("h"), F.col(text).alias("t")).filter(F.col(text).isNotNull())
    last = hashed.select("h").distinct().orderBy("h").limit(training.documents).agg(F.max("h")).first()[0]
    size = len(ALPHABET)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, size + 1, size), np.int64)
        for frame in batches:
            for value in frame["t"]:
                rest, end, waiting = [], 0, []
                for start, kind, stop in base_spans(value):
                    secret = value[start:stop] if kind else ASSIGN.match(value, start).group(2)
                    _count(counts[0], re.sub(r"[^A-Za-z0-9+/_=-]", "", secret) or "0")
                    rest.append(value[end:start])
                    end = max(end, stop)
                rest.append(value[end:])
                for word in _WORD.findall(" ".join(rest)):
                    _count(counts[1], word)
                    waiting.append(word)
                    if len(waiting) == 3:
                        _count(counts[1], "_".join(waiting))
                        _count(counts[1], "".join(w.capitalize() for w in waiting))
                        waiting = []
        model, before, after = np.nonzero(counts)
        yield pd.DataFrame({"model": model, "before": before, "after": after, "n": counts[model, before, after]})

    counts = np.ones((2, size + 1, size))
    if last is not None:
        sample = hashed.filter(F.col("h") <= last).dropDuplicates(["h"]).select("t")
        pairs = sample.mapInPandas(count, "model long, before long, after long, n long")
        for row in pairs.groupBy("model", "before", "after").agg(F.sum("n").alias("n")).collect():
            counts[row["model"], row["before"], row["after"]] += row["n"]
    drawn = np.zeros((size + 1, size), np.int64)
    for value in _drawn(training):
        _count(drawn, value)
    counts[0] += drawn
    chances = np.log(counts / counts.sum(axis=2, keepdims=True))
    return chances[0] - chances[1]


def _scores(value: str, ratios: np.ndarray) -> np.ndarray:
    codes = _codes(value)
    return ratios[np.concatenate(([_START], codes[:-1])), codes]


def _random_parts(scores: np.ndarray, training: Training) -> Iterator[tuple[int, int]]:
    """The whole where it passes; else the part of 20 and more that exceeds ``per_char`` most, and those beside it."""
    waiting = [(0, len(scores))]
    while waiting:
        start, end = waiting.pop()
        if end - start < LEAST:
            continue
        part = scores[start:end]
        if part.sum() > max(training.ratio, training.per_char * len(part)):
            yield start, end
            continue
        sums = np.concatenate(([0.0], np.cumsum(part - training.per_char)))
        first = np.minimum.accumulate(sums[:-LEAST])
        gain = sums[LEAST:] - first
        last = int(gain.argmax()) + LEAST
        begin = int(sums[: last - LEAST + 1].argmin())
        if gain.max() > 0 and part[begin:last].sum() > training.ratio:
            yield start + begin, start + last
            waiting += [(start, start + begin), (start + last, end)]


def markov_spans(text: str, taken: list[tuple[int, int, int]], ratios: np.ndarray, training: Training) -> list[tuple[int, int, int]]:
    """Random-looking runs of 20 and more key characters outside the base spans, or such parts of runs."""
    out, at = [], 0
    merged: list[list[int]] = []
    for start, _, end in taken:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(merged) and merged[at][1] <= start:
            at += 1
        free, k = [], at
        while k < len(merged) and merged[k][0] < end:
            free.append((start, merged[k][0]))
            start, k = merged[k][1], k + 1
        for a, b in (*free, (start, end)):
            if b - a >= LEAST:
                out += [(a + x, 3, a + y) for x, y in _random_parts(_scores(text[a:b], ratios), training)]
    return sorted(out)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(df: DataFrame, text: str = "text", training: Training = Training(), ratios: np.ndarray | None = None) -> DataFrame:
    """All columns but the text, with ``n_assign``, ``n_access``, ``n_hex``, ``n_markov``, ``base_spans`` and
    ``spans``; columns of these names are replaced.

    Spans are written kind:start:end in code points, end exclusive, by start, then kind. A NULL or
    empty text has none. Repeated rows are scanned alike; an empty table gives no rows. ``ratios`` is a
    model from ``train``; without one it is trained on the table itself."""
    names = ["n_assign", "n_access", "n_hex", "n_markov", "base_spans", "spans"]
    df = df.drop(*[c for c in df.columns if c.lower() in names])
    ratios = train(df, text, training) if ratios is None else ratios
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept).schema
    for name in names:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            counts, base, every = [], [], []
            for value in frame.pop(text):
                value = value or ""
                spans = base_spans(value)
                more = markov_spans(value, spans, ratios, training)
                counts.append(np.bincount([k for _, k, _ in spans + more], minlength=4))
                base.append(_joined(spans))
                every.append(_joined(sorted(spans + more)))
            columns = dict(zip(names[:4], np.array(counts, np.int64).reshape(-1, 4).T))
            yield frame.assign(**columns, base_spans=base, spans=every)

    return map_frames(df, run, schema)


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
