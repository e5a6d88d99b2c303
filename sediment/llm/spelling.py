"""Spelling variants: words one edit apart, and the frequent form each belongs to.

Of two words one edit apart, the shorter (or equal) one's first or last half stands unchanged in the
other. Words are dealt out by their halves, so that both meet in one shard; each shard keeps a
full-text index (FM-index) of its words between delimiters, read forwards or backwards, and searches it
for each word: the half exactly, the rest with one error, by ranges of suffix ranks. The work of a search
does not depend on the number of words in the shard. A half that too many words share is dealt out by
halves of what is still open, so shards stay bounded whatever the vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import discard, written

# What a word is, and its lower case.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Spelling:
    """``ratio``: a form has at least so many times the word's count. ``shard_rows``: rows of one index;
    ``group_rows``: rows that may share one half before it is dealt out further."""

    min_length: int = 5
    min_count: int = 3
    ratio: int = 2
    shard_rows: int = 20_000
    group_rows: int = 10_000


def lower_ascii(text: Column) -> Column:
    """Only A-Z lower-cased."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_words(
    docs: DataFrame, spec: Spelling = Spelling(), doc_id: str = "doc_id", text: str = "text", slip_every: int | None = None
) -> DataFrame:
    """``word``, ``n``: words of whole texts with their occurrences over all rows.

    With ``slip_every``, an occurrence loses one letter where the checksum of ``<doc_id>:<word>`` is
    divisible by it, as hasty typing would. NULL texts have no words; a NULL identifier counts as an
    empty one; repeated rows count again."""
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= spec.min_length)
    words = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    word = F.col("run")
    if slip_every:
        words = words.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("h") % slip_every == 0, cut).otherwise(F.col("run"))
    words = words.select(word.alias("word")).filter(F.length("word") >= spec.min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= spec.min_count)


def _key(word: Column) -> Column:
    """Of a word in the role of a word of length ``m`` whose error lies in ``lo`` to ``hi``: what stands outside."""
    tail = F.col("m") - F.col("hi")
    ends = F.substring(word, F.length(word) - tail + 1, tail)
    return F.xxhash64("m", "lo", "hi", F.substring(word, F.lit(1), F.col("lo")), F.when(tail > 0, ends).otherwise(""))


def _split(rows: DataFrame, split: Column) -> DataFrame:
    """The rows, those of ``split`` once for each half of their open part, with their keys."""
    mid = ((F.col("lo") + F.col("hi")) / 2).cast("int")
    part = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    parts = F.when(split, F.array(part(F.col("lo"), mid), part(mid, F.col("hi")))).otherwise(F.array(part(F.col("lo"), F.col("hi"))))
    out = rows.select("word", "n", "m", F.explode(parts).alias("part")).select("word", "n", "m", "part.lo", "part.hi")
    return out.filter("lo < hi").withColumn("key", _key(F.col("word")))


def _windows(words: DataFrame, spec: Spelling) -> DataFrame:
    """Rows ``word, n, m, lo, hi, key``: every word as itself and as the longer of a pair, once for each
    part of the word the error may lie in. Parts whose outside too many words share are halved again."""
    length = F.length("word")
    roles = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).filter("m > 0")
    rows = _split(roles.withColumns({"lo": F.lit(0), "hi": F.col("m")}), F.lit(True))
    while True:
        full = rows.filter("hi - lo > 1").groupBy("key").count().filter(F.col("count") > spec.group_rows)
        full = written(full.select("key", F.lit(True).alias("full")), "full-halves")
        if full.limit(1).count() == 0:
            discard(full)
            return rows
        rows = written(_split(rows.join(full, "key", "left"), F.coalesce("full", F.lit(False)) & (F.col("hi") - F.col("lo") > 1)), "parts")


class TextIndex:
    """FM-index of words between delimiters, the sorted words in a row."""

    def __init__(self, words: list[str]):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64) + 1
        text = np.zeros(len(codes) + len(words) + 1, np.int64)
        text[np.arange(len(codes)) + np.repeat(np.arange(len(words)), lengths) + 1] = codes
        self.alphabet, text = np.unique(text, return_inverse=True)  # 0 is the delimiter
        order = self._suffixes(text)
        self.starts = np.searchsorted(text[order], np.arange(len(self.alphabet))).astype(np.int64)
        before = text[order - 1]
        self.ranks = np.zeros((len(text) + 1, len(self.alphabet)), np.int32)
        self.ranks[np.arange(1, len(text) + 1), before] = 1
        np.cumsum(self.ranks, axis=0, out=self.ranks)
        self.delimiters = len(words) + 1

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffixes in order, by doubling the length they are sorted by."""
        rank, step, size = text, 1, len(text)
        while True:
            behind = np.zeros(size, np.int64)
            behind[:-step] = rank[step:] + 1
            key = rank * (size + 2) + behind
            order = np.argsort(key, kind="stable")
            fresh = np.empty(size, np.int64)
            fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
            if fresh[order[-1]] == size - 1:
                return order
            rank, step = fresh, step * 2

    def codes(self, words: list[str]) -> np.ndarray:
        """A row for each of the words, all of one length."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64) + 1
        return np.searchsorted(self.alphabet, points).reshape(len(words), -1)

    def extend(self, low, high, symbol):
        """Ranges of the suffixes with ``symbol`` put before."""
        return self.starts[symbol] + self.ranks[low, symbol], self.starts[symbol] + self.ranks[high, symbol]

    def branch(self, low, high, barred):
        """All ranges with any character but ``barred`` put before, and of which row each is."""
        lows, highs = self.ranks[low], self.ranks[high]
        found = highs > lows
        found[:, 0] = False
        rows = np.flatnonzero(barred >= 0)
        found[rows, barred[rows]] = False
        row, symbol = np.nonzero(found)
        return row, self.starts[symbol] + lows[row, symbol], self.starts[symbol] + highs[row, symbol]

    def search(self, patterns: np.ndarray, changed: range, added: range, after: bool):
        """Row of pattern and rank of word, for words that differ by one replaced character at a place of
        ``changed`` or one more before a place of ``added``. A run of equal characters that is one longer
        counts once: not where the character equals the one before the place, or at it if not ``after``."""
        count, size = patterns.shape
        row, low, high = np.arange(count), np.zeros(count, np.int64), np.full(count, self.delimiters, np.int64)
        late = [np.zeros(0, np.int64)] * 3  # with their error behind them
        none = np.full(count, -1)
        for i in range(size + 1):
            new = []
            if i in added:
                same = (patterns[:, i - 1] if i else none) if after else (patterns[:, i] if i < size else none)
                of, a, b = self.branch(low, high, same[row])
                late = [np.concatenate(x) for x in zip(late, (row[of], a, b), strict=True)]
            if i == size:
                break
            if i in changed:
                of, a, b = self.branch(low, high, patterns[row, i])
                new = [row[of], a, b]
            a, b = self.extend(late[1], late[2], patterns[late[0], i])
            late = [x[b > a] for x in (late[0], a, b)]
            if new:
                late = [np.concatenate(x) for x in zip(late, new, strict=True)]
            a, b = self.extend(low, high, patterns[row, i])
            row, low, high = (x[b > a] for x in (row, a, b))
        a, b = self.extend(late[1], late[2], np.zeros(len(late[0]), np.int64))
        return late[0][b > a], a[b > a] - 1


FOUND = "word string, n long, n_near long, form string, form_n long"


def _search_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of a shard's words: how many, and the most frequent, for each word."""
    backwards = bool(rows["backwards"].iloc[0])
    turned = (lambda w: w) if backwards else (lambda w: w[::-1])
    counts = dict(zip(rows["word"], rows["n"], strict=True))
    words = sorted(counts)
    number = {w: i for i, w in enumerate(words)}
    n = np.fromiter((counts[w] for w in words), np.int64, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    stored = sorted((turned(w), i) for w, i in number.items())
    index, place = TextIndex([w for w, _ in stored]), np.array([i for _, i in stored])
    sources, targets = [], []
    own = rows[rows["word"].str.len() == rows["m"]].drop_duplicates(["word", "m", "lo", "hi"])
    for (m, lo, hi), group in own.groupby(["m", "lo", "hi"]):
        asked = list(group["word"])
        patterns = index.codes([turned(w)[::-1] for w in asked])
        if backwards:
            row, rank = index.search(patterns, range(m - hi, m - lo), range(m - hi + 1, m - lo + 1), False)
        else:
            row, rank = index.search(patterns, range(lo, hi), range(lo, hi + 1), True)
        source, target = np.array([number[w] for w in asked])[row], place[rank]
        longer = size[target] > size[source]
        sources += [source, target[longer]]
        targets += [target, source[longer]]
    source, target = np.concatenate(sources or [place[:0]]), np.concatenate(targets or [place[:0]])
    order = np.lexsort((target, -n[target], source))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.diff(source, prepend=-1))
    names = np.array(words, object)
    return pd.DataFrame(
        {
            "word": names[source[first]],
            "n": n[source[first]],
            "n_near": np.diff(np.append(first, len(source))),
            "form": names[target[first]],
            "form_n": n[target[first]],
        }
    )


def near_words(words: DataFrame, spec: Spelling = Spelling()) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``best``, ``best_n``: how many of the words differ from it by one character
    inserted, deleted or replaced, and the most frequent of them (ties: first in code-point order).

    ``words``: one row per word with its ``n``. Each pair is found in one part of one shard only."""
    rows = _windows(words, spec).withColumn("backwards", F.col("hi") < F.col("m"))
    least = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-4 * words.count() // spec.shard_rows))
    shard = (F.pmod(F.col("key"), F.lit(shards)) * 2 + F.col("backwards").cast("int")).alias("shard")
    found = rows.select("word", "n", "m", "lo", "hi", "backwards", shard).groupBy("shard").applyInPandas(_search_shard, FOUND)
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("long").alias("form_n"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("low"), "form"))).alias("best")
    each = found.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return each.select("word", "n", "n_near", F.col("best.form").alias("best"), (-F.col("best.low")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for rows of ``word``, ``form``: the end of following forms. Paths halve each round."""
    at = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = at.join(on, "root", "left")
        ahead = written(
            step.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots"
        )
        discard(at)
        at = ahead
        if at.filter("moved").limit(1).count() == 0:
            return at.select("word", "root")


def variant_forms(words: DataFrame, spec: Spelling = Spelling()) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every row of ``words`` (``word``, ``n``).

    ``form`` is the near word of largest ``n``, where that is ``ratio`` times the word's or more, else NULL;
    ``root`` is what following forms ends at, the word itself without one. Words are told apart by code
    points and may hold any character; NULL and empty words are left out, other columns ignored, repeated
    words are one with the sum of their counts (NULL counts as 0). No words give no rows."""
    words = words.filter(F.length("word") > 0).groupBy("word").agg(F.sum(F.coalesce("n", F.lit(0))).cast("long").alias("n"))
    words = written(words, "words")
    near = near_words(words, spec)
    chosen = F.col("best_n") >= spec.ratio * F.col("n")
    forms = written(
        near.select("word", F.when(chosen, F.col("best")).alias("form"), "n", "n_near", F.when(chosen, F.col("best_n")).alias("form_n")), "forms"
    )
    ends = roots(forms.filter("form is not null"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
