"""The whole pipeline against a plain Python version of it, stage by stage."""

import collections
import hashlib
import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sediment.llm.common import written
from sediment.llm.line_dedup import within_edits
from tests.llm.test_documents import measures

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def good(docs):
    def fails(text):
        n_words, chars, symbols, dup, repeat = measures(text)
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
        return [n_words < 50, 100 * repeat > 50 * n_words, 100 * symbols > 10 * chars, 100 * dup > 30 * lines]

    found = {d["doc_id"]: fails(d["text"]) for d in docs}
    hosts = collections.defaultdict(list)
    for d in docs:
        hosts[d["source"]].append(found[d["doc_id"]])
    total, rejected = len(docs), set()
    within, squares = len(hosts) - 1, sum(len(fs) ** 2 for fs in hosts.values())
    for rule in range(4):
        mean = sum(f[rule] for fs in hosts.values() for f in fs) / total
        spread = sum(len(fs) * (sum(f[rule] for f in fs) / len(fs) - mean) ** 2 for fs in hosts.values())
        room = total - squares / total - within
        between = (spread / (mean * (1 - mean)) - within) / room if 0 < mean < 1 and room > 0 else 0.0
        most = max(0.5, 20 * mean / (1 - mean + 20 * mean))
        for host, fs in hosts.items():
            strength = max(1 / between - 1, 2) if between > 1e-9 else None
            bad = sum(f[rule] for f in fs)
            rate = mean if strength is None else (bad + mean * strength) / (len(fs) + strength)
            if rate > most:
                rejected.add(host)
    return [d for d in docs if not any(found[d["doc_id"]][:2]) and d["source"] not in rejected]


def without_repeated_lines(docs):
    docs = sorted(docs, key=lambda d: d["doc_id"])
    lines = [x for d in docs for x in d["text"].split("\n") if len(x) >= 6]
    by_length = collections.defaultdict(list)
    for x in dict.fromkeys(lines):
        if len(x) >= 20:
            by_length[len(x)].append(x)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, some in by_length.items():
        for i, x in enumerate(some):
            for y in some[i + 1 :] + by_length.get(n + 1, []) + by_length.get(n + 2, []):
                if within_edits(x, y, 2):
                    root[find(y)] = find(x)
    seen, out = set(), []
    for d in docs:
        kept = []
        for x in d["text"].split("\n"):
            if len(x) >= 6:
                if find(x) in seen:
                    continue
                seen.add(find(x))
            kept.append(x)
        text = "\n".join(kept)
        out.append({**d, "text": text, "n_chars": len(text) if text != d["text"] else d["n_chars"]})
    return out


def one_of_each_group(docs):
    def shingles(text):
        w = re.sub("[A-Z]+", lambda m: m.group().lower(), text).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d["doc_id"]: shingles(d["text"]) for d in docs}
    ids = sorted(sets)
    root = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root[i], root[j]
                for k in ids:
                    if root[k] == max(x, y):
                        root[k] = min(x, y)
    return [d for d in docs if root[d["doc_id"]] == d["doc_id"]]


def mixed(docs):
    totals = collections.Counter()
    for d in docs:
        totals[d["source"]] += d["n_chars"] or 0
    powers = {s: t**0.7 for s, t in totals.items()}
    out = []
    for d in docs:
        mean = powers[d["source"]] / sum(powers.values()) * sum(totals.values()) / totals[d["source"]]
        assert mean < 32
        u = int(hashlib.md5(f"2026:count:{d['doc_id']}:1".encode()).hexdigest()[:13], 16) / 2**52
        count, chance = 0, math.exp(-mean)
        below = chance
        while below <= u:
            count += 1
            chance *= mean / count
            below += chance
        out += [d] * count
    return out


def test_stages_and_run_equal_the_plain_version(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plain = [r.asDict() for r in docs.collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]
    key = lambda d: tuple(str(d[c]) for c in docs.columns)
    frame = docs
    for (name, stage), step in zip(corpus_pipeline.STAGES, (good, without_repeated_lines, one_of_each_group, mixed)):
        frame = written(stage(spark, frame, DATA), f"test-{name}")
        plain = step(plain)
        assert frame.columns == docs.columns
        assert sorted(map(key, (r.asDict() for r in frame.collect()))) == sorted(map(key, plain)), name
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, DATA).toPandas()
    again = corpus_pipeline.run(spark, DATA).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(packed[columns].itertuples(index=False)) == sorted(again[columns].itertuples(index=False))
    assert collections.Counter(packed[packed["piece"] == 0]["doc_id"]) == collections.Counter(d["doc_id"] for d in plain)
    for _, rows in packed.sort_values("offset").groupby("sequence_id"):
        ends = rows["length"].cumsum()
        assert (rows["offset"] == ends - rows["length"]).all() and ends.max() <= 2048
    assert packed["sequence_id"].nunique() <= -(-packed["length"].sum() // 2048) + 1
    assert np.isfinite(packed["ids_crc32"]).all()


def test_stages_on_an_empty_table(spark):
    frame = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        frame = written(stage(spark, frame, DATA), f"empty-{name}")
        assert frame.count() == 0


def test_stages_on_odd_rows(spark):
    """NULLs in any column, repeated rows and identifiers, empty and very long texts, columns with the names of results."""
    text = " ".join(f"w{i}" for i in range(200))
    long = " ".join(f"x{i}" for i in range(150_000)) + "\n" + "a line that stands here twice\n" * 2
    rows = [(1, None, None, None, None), (None, "", "en", None, 0), (2, "word " * 60, "en", "a", None), (2, "word " * 60, "en", "a", None)]
    rows += [(i, text, "en", None, 5) for i in (3, 4, None, None)] + [(5, text + " more", None, "b", 7), (6, long, "en", "b", None), (7, "few words", "en", "b", 9)]
    names = "n_words kept node copy shuffle_key piece sequence_id component_id line_no key _row _mark".split()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.withColumns({n: F.lit(f"own {n}") for n in names})
    columns = frame.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = written(stage(spark, frame, DATA), f"odd-{name}")
        assert frame.columns == columns
        rows = frame.collect()
        assert all(r[n] == f"own {n}" for r in rows for n in names)
        counts.append(sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in rows))
    good, cut, apart, dealt = counts
    # Four copies (two without an identifier), the longer one of them, and the long text; words in repeats and few words fail.
    assert good == sorted([(0, len(text)), (0, len(text)), (3, len(text)), (4, len(text)), (5, len(text) + 5), (6, len(long))])
    # The repeated line goes once; of the four copies, one line each, the first by identifier (NULL first) keeps it.
    assert [n for d, n in cut if d == 6] == [len(long) - len("a line that stands here twice\n")]
    assert sorted(n for d, n in cut if d in (0, 3, 4)) == [0, 0, len(text), len(text)] and (5, len(text) + 5) in cut
    # Copies and the longer text are near duplicates: the least identifier of the texts left stays (NULL is the largest); empty texts stay.
    assert {d for d, n in apart if n} == {5, 6} and len(apart) == 4
    assert {d for d, _ in dealt} <= {d for d, _ in apart}
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, DATA).toPandas()
    assert set(packed["doc_id"].fillna(0).astype(int)) == {d for d, _ in dealt} and packed["length"].max() <= 2048


