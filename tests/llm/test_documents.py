"""Quality rules, near duplicates, lines, mixing and packing on small tables with every odd case."""

import collections
import random
import re

import numpy as np
import public_tokenizers
import pytest

from sediment.llm import common, line_dedup, minhash, mixing, packing, quality_rules, queries, url_filter
from sediment.llm.common import written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, size=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(size)}" for _ in range(n)]


def text(n, seed):
    return " ".join(words(n, seed, 10**6))


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs everywhere, empty and very long texts, ties, repeated rows and identifiers."""
    base = words(120, 1, 10**6)
    near = base[:60] + ["changed"] + base[61:]
    rows = [
        (1, " ".join(base), "en", "a", 9),
        (2, " ".join(near), "en", "a", 9),
        (2, " ".join(near), "en", "a", 9),
        (3, " ".join(base), None, None, None),
        (4, None, "en", "a", 0),
        (5, "", "en", "b", 0),
        (6, " \t\n\x0b\x0c\r ", "en", "b", 7),
        (None, " ".join(base), "en", "b", 3),
        (None, text(80, 9), "en", "b", 3),
        (7, text(60000, 2), "de", "b", 400000),
        (8, "one", "de", "b", 3),
        (9, "one", "de", "c", 3),
        (10, "a b c " * 90, "de", "c", 3),
        (11, " ".join(base[:100]) + "\n" + "x" * 50 + "\n\n" + "x" * 50, "fr", "c", 12),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clashing(odd):
    """Columns that bear the names of results and of helpers."""
    names = "n_words kept base_failed node keys key _key _words copy shuffle_key piece length sequence_id offset n_lines component_id row _row mark".split()
    from pyspark.sql import functions as F

    return odd.withColumns({n: F.lit(f"own {n}") for n in names})


def measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_measures(odd):
    got = quality_rules.with_measures(odd).select("text", *quality_rules.MEASURES).collect()
    assert len(got) == 14
    for row in got:
        assert tuple(row)[1:] == measures(row["text"])


def test_judge_clashing_and_empty(clashing, odd):
    plain = sorted(map(str, quality_rules.judge(odd, carry=["doc_id"]).collect()))
    assert plain == sorted(map(str, quality_rules.judge(clashing, carry=["doc_id"]).collect()))
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.count() == sum("kept=True" in r for r in plain)
    assert quality_rules.keep_good(odd.limit(0)).count() == 0


def test_bad_host_takes_its_documents_along(spark):
    good = [(i, text(70, i), "en", "good", 1) for i in range(60)]
    bad = [(100 + i, "few words", "en", "bad", 1) for i in range(60)] + [(200, text(70, 200), "en", "bad", 1)]
    kept = quality_rules.judge(spark.createDataFrame(good + bad, SCHEMA)).filter("kept").collect()
    assert {r["doc_id"] for r in kept} == set(range(60))


def test_one_document_does_not_condemn_its_host(spark):
    """200 hosts of one document, half of them full of symbols; then the same with one host of sixty such documents."""
    noisy = lambda i: text(70, i) + " " + "#" * 300
    single = [(i, noisy(i) if i % 2 else text(70, i), "en", f"h{i}", 1) for i in range(200)]
    assert all(r["kept"] for r in quality_rules.judge(spark.createDataFrame(single, SCHEMA)).collect())
    rare = [(i, noisy(i) if i % 50 == 0 else text(70, i), "en", f"h{i}", 1) for i in range(200)]
    many = [(1000 + i, noisy(1000 + i), "en", "bad", 1) for i in range(40)] + [(2000 + i, text(70, 2000 + i), "en", f"big{i % 9}", 1) for i in range(900)]
    out = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rare + many, SCHEMA)).collect()}
    assert {d for d, kept in out.items() if not kept} == {1000 + i for i in range(40)}


def similarity(a, b, k):
    def shingles(t):
        w = re.sub("[A-Z]+", lambda m: m.group().lower(), t or "").split()
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    a, b = shingles(a), shingles(b)
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def grouped(items, linked):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_against_all_pairs(spark, odd, shingle):
    rows = [tuple(r)[:2] for r in odd.collect() if r["doc_id"] is not None and r["doc_id"] != 7]
    draw = random.Random(4)
    for group in range(12):
        base = words(draw.randrange(20, 200), 100 + group, 10**5)
        for copy in range(6):
            own = list(base)
            for _ in range(draw.randrange(0, max(1, len(base) // 12))):
                own[draw.randrange(len(own))] = f"e{draw.random()}"
            rows.append((1000 + 10 * group + copy, " ".join(own).upper() if copy % 2 else " ".join(own)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), spec=minhash.NearDup(shingle=shingle))
    got = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in found.collect())
    roots = grouped([t for _, t in rows], lambda a, b: similarity(a, b, shingle))
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    assert got == collections.Counter((i, least[r], i == least[r]) for (i, _), r in zip(rows, roots))


def test_sets_travel_only_for_rows_with_a_partner_within_reach(spark, monkeypatch):
    # With one hash a band, texts that share a third of their words meet in many buckets and are far from linked.
    draw, rows = random.Random(8), []
    common = words(40, 1, 10**5)
    for i in range(60):
        rows.append((i, " ".join(common + [f"w{i}x{j}" for j in range(60)])))
    for i in range(6):
        own = words(100, 50 + i, 10**5)
        for copy in range(5):
            rows.append((100 + 10 * i + copy, " ".join(own[: 84 + 4 * copy] + [f"c{i}y{copy}z{j}" for j in range(16 - 4 * copy)])))
    draw.shuffle(rows)
    spec, sent, compared = minhash.NearDup(shingle=1, rows=1), [], minhash.crossing_pairs

    def counted(rows, facts, *more):
        sent.append({r["node"] for r in facts.select("node").collect()})
        return compared(rows, facts, *more)

    monkeypatch.setattr(minhash, "crossing_pairs", counted)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), spec=spec).collect()
    roots = grouped([t for _, t in rows], lambda a, b: similarity(a, b, 1))
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(i, least[r]) for (i, _), r in zip(rows, roots)}
    assert len(sent) == 1 and len(sent[0]) <= 30


def test_blocks_of_a_large_bucket_grow_with_its_rows(spark):
    # A bucket of mostly one root and one of many roots: every pair of different roots meets once.
    def dealt(rows):
        df = common.written(spark.createDataFrame(rows, "key long, node string, root string, size long"), "rows")
        facts = common.written(df.select("node").distinct(), "facts")
        return minhash._dealt(df, facts, 20, 1 << 20).collect()

    def bucket(key, of_top, others):
        return [(key, f"{key}-{i}", "top", 8) for i in range(of_top)] + [(key, f"{key}+{i}", f"r{i // 2}", 8) for i in range(others)]

    for rows in (bucket(1, 190, 12), bucket(1, 30, 90), bucket(1, 1, 1) + bucket(2, 5, 3)):
        units, met = collections.defaultdict(list), collections.Counter()
        for r in dealt(rows):
            units[r["key"], r["low"], r["high"]].append(r)
        for (_, low, high), unit in units.items():
            for i, a in enumerate(unit):
                for b in unit[i + 1 :]:
                    if a["root"] != b["root"] and (low == high or (a["own"] == low) != (b["own"] == low)):
                        met[frozenset((a["node"], b["node"]))] += 1
        pairs = [frozenset((a[1], b[1])) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[0] == b[0] and a[2] != b[2]]
        assert met == collections.Counter(pairs)
    few, many = len(dealt(bucket(1, 400, 12))), len(dealt(bucket(1, 1600, 12)))
    assert many <= 4 * few and many <= 3 * 1612


def test_near_duplicates_odd_cases(odd, clashing, spark):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == 14
    of = collections.defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(r)
    assert [r["component_id"] for i in (1, 2, 3) for r in of[i]] == [1, 1, 1, 1]
    assert all(of[i][0]["n_shingles"] == 0 and of[i][0]["kept"] for i in (4, 5, 6))
    assert sorted(r["component_id"] is None for r in of[None]) == [False, True]
    left = minhash.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert collections.Counter(ids) == collections.Counter([1, 4, 5, 6, None, 7, 8, 10])
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_results_do_not_turn_on_broadcast_bounds(spark, odd, monkeypatch):
    pairs = lambda df, *c: sorted(str(tuple(r)) for r in df.select(*c).collect())
    lines = line_dedup.LineRules(min_chars=20, exact_chars=6)
    urls = spark.createDataFrame([(i, f"http://a.net/{'bad' if i % 3 else 'good'}/{i}") for i in range(90)], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 3 > 0) for i in range(60)], "page_id long, unwanted boolean")

    def run():
        return (
            pairs(minhash.near_duplicates(odd), "doc_id", "n_shingles", "component_id", "kept"),
            pairs(minhash.drop_near_duplicates(odd), *odd.columns),
            pairs(line_dedup.dedup_lines(odd, rules=lines), "doc_id", "text", "n_removed", "n_near"),
            pairs(url_filter.filter_urls(urls, labels), "page_id", "verdict", "mined"),
        )

    within = run()
    monkeypatch.setattr(common, "KEY_BROADCAST_BYTES", 0)
    assert run() == within


def test_measured_bytes_follow_the_width(spark):
    narrow = written(spark.range(100).select("id"), "narrow")
    wide = written(spark.range(100).selectExpr("id", "named_struct('t', repeat('x', 1000)) as s", "array('ab') as a", "array(1) as n"), "wide")
    assert 1_000 < common.measured_bytes(narrow) < 3_000 and 100_000 < common.measured_bytes(wide) < 120_000
    assert common.measured_bytes(wide.filter("false")) == 0


def test_posterior_floor_rises():
    floors = [minhash.posterior_floor(n, 80, 1e-6) for n in (16, 32, 64, 128)]
    assert floors == sorted(floors) and 0 < floors[0] < 0.8 * 16 and floors[-1] < 0.8 * 128


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(line, edits, draw):
    line = list(line)
    for _ in range(edits):
        at, kind = draw.randrange(len(line)), draw.randrange(3)
        if kind == 0:
            line.insert(at, draw.choice("abcé"))
        elif kind == 1:
            line.pop(at)
        else:
            line[at] = draw.choice("abcé")
    return "".join(line)


def test_banded_distance():
    draw = random.Random(3)
    for _ in range(4000):
        a = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 60)))
        b = edited(a, draw.randrange(min(len(a), 6)), draw)
        limit = draw.randrange(6)
        assert line_dedup.within_edits(a, b, limit) == (distance(a, b) <= limit)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_lines_against_all_pairs(spark, edits):
    draw = random.Random(edits)
    stock = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randrange(40, 70))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = [edited(draw.choice(stock), draw.randrange(5), draw) for _ in range(draw.randrange(5))] + ["short", ""]
        draw.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = dict(line_dedup.dedup_lines(df, rules=line_dedup.LineRules(edits)).select("doc_id", "text").collect())
    places = [(i, n, x) for i, t in docs for n, x in enumerate(t.split("\n")) if len(x) >= 40]
    roots = grouped([x for _, _, x in places], lambda a, b: abs(len(a) - len(b)) <= edits and distance(a, b) <= edits)
    gone = {places[k][:2] for k, r in enumerate(roots) if k != r}
    assert got == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in docs}


@pytest.mark.parametrize("edits", [0, 2])
def test_short_lines_against_all_pairs(spark, edits):
    """Lines of 2 to 39 characters, most of them repeated: the same from six characters on, near from 20 on."""
    draw = random.Random(10 + edits)
    stock = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randrange(2, 40))) for _ in range(40)]
    docs = []
    for i in range(80):
        lines = [edited(x := draw.choice(stock), draw.randrange(4) if len(x) > 5 else 0, draw) for _ in range(draw.randrange(6))]
        docs.append((i, "\n".join(lines + ["short", "", "boilerplate", "All rights reserved."])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rules = line_dedup.LineRules(edits, min_chars=20, exact_chars=6)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df, rules=rules).collect()}
    places = [(i, n, x) for i, t in docs for n, x in enumerate(t.split("\n")) if len(x) >= 6]
    near = lambda a, b: a == b or min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits
    roots = grouped([x for _, _, x in places], near)
    gone = {places[k][:2] for k, r in enumerate(roots) if k != r}
    assert {len(x) for i, n, x in places if (i, n) in gone} >= {11, 20} and any(20 > len(x) for i, n, x in places if (i, n) in gone)
    for i, t in docs:
        assert got[i]["text"] == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        assert got[i]["n_removed"] == sum(d == i for d, _ in gone)


def test_registered_query_cuts_short_repeats(spark, tmp_path):
    rows = [(1, "Released under the MIT License.\nWas ntonti.\nLes."), (2, "Released under the MIT License!\nWas ntonti.\nLes.\nnew")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: (r["text"], r["n_removed"], r["n_near"]) for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {1: (rows[0][1], 0, 0), 2: ("Les.\nnew", 2, 1)}


def test_lines_odd_cases(odd, clashing):
    cut = line_dedup.dedup_lines(clashing)
    assert cut.columns == [c for c in clashing.columns if c != "n_lines"] + ["n_lines", "n_removed", "n_near"]
    rows = cut.collect()
    assert len(rows) == 14
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by_id[4]["text"] is None and by_id[4]["n_lines"] == 0 and by_id[5]["text"] == ""
    assert by_id[11]["text"].endswith("\n" + "x" * 50 + "\n") and by_id[11]["n_removed"] == 1
    assert [r["text"] for r in rows if r["doc_id"] in (1, 3)] == ["", ""]
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_mixing_means_and_odd_cases(spark, odd, clashing):
    rows = [(i, "t", "en", "big" if i % 4 else "small", 10) for i in range(8000)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), mixture=mixing.Mixture({"small": 0.5, "big": 0.5}))
    count = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(count["big"] - 4000) < 300 and abs(count["small"] - 4000) < 300
    per_row = collections.Counter(r["doc_id"] for r in mixed.filter("source = 'small'").collect())
    twos = [per_row.get(i, 0) for i in range(0, 8000, 4)]
    assert abs(np.mean(twos) - 2) < 0.15 and abs(np.var(twos) - 2) < 0.3
    keys = [r["shuffle_key"] for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    out = mixing.mix(clashing)
    assert out.columns == [c for c in clashing.columns if c not in ("copy", "shuffle_key")] + ["copy", "shuffle_key"]
    plain = mixing.mix(odd)
    # Rows without an identifier draw by all their columns, the others by their identifier.
    shown = lambda df: sorted(str((r["doc_id"], r["text"], r["copy"], r["shuffle_key"])) for r in df.collect() if r["doc_id"] is not None)
    assert shown(out) == shown(plain) and out.count() > 0
    extra = [c for c in clashing.columns if c not in odd.columns and c not in ("copy", "shuffle_key")]
    assert all(r[c] == f"own {c}" for r in out.collect() for c in extra)
    assert mixing.mix(odd.limit(0)).count() == 0


def test_mixing_large_rates(spark):
    rows = [(i, "t", "en", "rare", 1) for i in range(20)] + [(100, "t", "en", "bulk", 10**6)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), mixture=mixing.Mixture({"rare": 0.02}, volume=1.0))
    n = mixed.filter("source = 'rare'").count()
    assert abs(n - 20000) < 5 * 20000**0.5


def test_packing_is_whole_gapless_and_tight(spark, odd, clashing):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    out = packing.pack(clashing, VOCABULARY).toPandas()
    docs = [r["text"] for r in odd.collect()]
    expected = collections.Counter()
    for t in docs:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for start, end in zip(cuts, cuts[1:]):
            expected[start, tuple(ids[start:end])] += 1
    assert expected == collections.Counter(
        (start, tuple(np.frombuffer(ids, "<u4").tolist())) for start, ids in zip(out["start"], out["ids"])
    )
    for _, rows in out.sort_values("offset").groupby("sequence_id"):
        ends = rows["length"].cumsum()
        assert (rows["offset"] == ends - rows["length"]).all() and ends.max() <= 2048
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 2048) + 1
    assert packing.pack(odd.limit(0), VOCABULARY).count() == 0


def test_packing_in_rounds(spark):
    draw = random.Random(8)
    sizes = [(i, 0, draw.randrange(1, 2049)) for i in range(3000)]
    pieces = spark.createDataFrame(sizes, "row long, piece int, length long")
    out = packing.assign(pieces, packing.Packing(shard=100)).toPandas()
    assert sorted(zip(out["row"], out["length"])) == sorted((r, n) for r, _, n in sizes)
    for _, rows in out.sort_values("offset").groupby("sequence_id"):
        ends = rows["length"].cumsum()
        assert (rows["offset"] == ends - rows["length"]).all() and ends.max() <= 2048
    assert out["sequence_id"].nunique() <= 1.06 * out["length"].sum() / 2048


def test_squares_choose_the_least_sum():
    sizes, capacity = np.array([7, 6, 6, 5, 4, 3, 3, 2, 1, 1]), 10
    bins, offsets = packing.place_by_squares(sizes, capacity)
    levels = []
    for size, b, offset in zip(sizes, bins, offsets):
        fits = [i for i, level in enumerate(levels) if level + size <= capacity]
        total = lambda ls: sum(n * n for g, n in collections.Counter(capacity - x for x in ls).items() if g)
        if fits:
            costs = {i: total(levels[:i] + [levels[i] + size] + levels[i + 1 :]) for i in fits}
            assert b in fits and costs[b] == min(costs.values()) and offset == levels[b]
            levels[b] += size
        else:
            assert b == len(levels) and offset == 0
            levels.append(size)


def test_encoder_equals_the_library():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    from sediment.llm.tokens import Encoder

    encode, plain = Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    piece = st.sampled_from(["the ", "Über", "'s", "  ", "\n\n", "<|endoftext|>", "12", "ñ", "“", "…", "漢", "🙂", "͸", "\x00"])

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(max_size=40), st.lists(piece, max_size=30).map("".join)))
    def same(t):
        assert encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids

    same()
    assert encode(" " * 5000 + "a").tolist() == plain.encode(" " * 5000 + "a", add_special_tokens=False).ids


def test_large_identifiers_beside_nulls_stay_whole(spark):
    from sediment.llm import pii, secret_scan, vectors

    big = 2**60 + 1
    df = spark.createDataFrame([(big, text(60, 1)), (None, text(60, 2)), (big + 2, text(60, 3))], "doc_id long, text string")
    ids = lambda out, name="doc_id": {r[name] for r in out.collect()}
    whole = {big, None, big + 2}
    assert ids(minhash.near_duplicates(df)) == ids(line_dedup.dedup_lines(df)) == whole
    assert ids(packing.pack(df, VOCABULARY)) == ids(pii.pseudonymise(df, pii.PiiKey("00" * 16))) == ids(secret_scan.scan(df)) == whole
    vecs = spark.createDataFrame([(big, [1.0, 0.0]), (None, [0.0, 1.0]), (big + 2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert ids(vectors.near_vectors(vecs), "vec_id") == whole
