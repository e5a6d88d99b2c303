"""Conversation trie, spelling variants and pieces against plain versions of them."""

import hashlib
import random
import re
import zlib
from array import array

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sediment.llm import conversation_trie as trie
from sediment.llm import pieces, queries, spelling

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# -- conversation trie


def md5(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain_paths(rows, borrow):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0, md5(role, text)), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    if not borrow:
        return own
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(abs(c) % 5 * (1 if c > 0 else -1)), [])[:h] + ts[h:]
    return out


def plain_trie(paths):
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    deep = sorted(nodes, key=len, reverse=True)
    leaves, saved = {}, {}
    for p in deep:
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        own = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in kids.get(p, []))
    rows = set()
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(p))
        up = min(nodes[p[:-1]]) if p else None
        rows.add((min(members), len(p), up, len(members), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def spark_trie(conversations, spec):
    made = trie.prefix_trie(conversations, spec)
    got = made.nodes.join(trie.ends_digest(made.ends), ["conv_id", "depth"], "left")
    got = got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def odd_conversations(seed, n):
    draw = random.Random(seed)
    rows = [(7, 1, "user", "x" * 200_000), (7, 2, None, None), (7, 2, None, None), (8, None, "user", "é"), (8, 1, "", ""), (None, 1, "user", "no one's")]
    for c in range(n):
        for t in range(draw.randrange(0, 9)):
            rows.append((c - 20, draw.choice([t, t, 3, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "ab", "", None])))
    rows += [(10_000 + c, t, "user", f"same {t}") for c in range(n // 3) for t in range(4)]  # copies
    rows += [(5_000, t, "user", f"turn {t}") for t in range(n)]  # a third of all rows
    return rows


@pytest.mark.parametrize("borrow", [False, True])
@pytest.mark.parametrize("spec", [trie.TrieSpec(), trie.TrieSpec(shard_turns=10, sampled=1000), trie.TrieSpec(shard_turns=40, sampled=3)])
def test_trie_equals_the_plain_one(spark, spec, borrow):
    rows = odd_conversations(4, 150)
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumns({n: F.lit("own") for n in ("t", "digest", "turns", "head", "base", "key")})
    turns = trie.conversation_turns(df)
    turns = trie.with_borrowed_openings(turns) if borrow else turns
    assert spark_trie(turns, spec) == plain_trie(plain_paths(rows, borrow))


def test_trie_without_conversations_has_no_node(spark):
    turns = trie.with_borrowed_openings(trie.conversation_turns(spark.createDataFrame([(None, 1, "a", "b")], CONVERSATIONS)))
    assert spark_trie(turns, trie.TrieSpec()) == set()


def test_one_conversation_without_turns_left_is_the_root(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 9 > 1 and c % 5)
    turns = trie.with_borrowed_openings(trie.conversation_turns(spark.createDataFrame([(c, 1, "a", "b")], CONVERSATIONS)))
    assert spark_trie(turns, trie.TrieSpec()) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


def test_no_shard_holds_most_copies_of_a_conversation(spark):
    rows = [(c, t, "user", f"{t}") for c in range(3000) for t in range(3)]
    made = trie.prefix_trie(trie.conversation_turns(spark.createDataFrame(rows, CONVERSATIONS)), trie.TrieSpec(shard_turns=500))
    parts = made.ends.filter("depth = 3").select(F.size("ends").alias("n")).collect()
    assert len(parts) > 10 and max(r.n for r in parts) < 3000 / 5 and sum(r.n for r in parts) == 3000


# -- spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_forms(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        found = [v for v in counts if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form, None, n, len(found), counts.get(form)]
    for w, row in out.items():
        row[1] = w
        while out[row[1]][0] is not None:
            row[1] = out[row[1]][0]
    return {(w, *row) for w, row in out.items()}


def some_words(seed):
    draw = random.Random(seed)
    made = {"".join(draw.choice("abé") for _ in range(draw.randrange(1, 7))) for _ in range(500)}
    made |= {"x" * 700, "x" * 699, "x" * 350 + "y" + "x" * 349, "\0", "\0a", "😀a", "😀", "ab" * 40, "ab" * 39 + "b"}
    return {w: draw.randrange(1, 40) for w in made}


@pytest.mark.parametrize("spec", [spelling.Spelling(), spelling.Spelling(shard_rows=40, group_rows=25), spelling.Spelling(shard_rows=40, group_rows=3)])
def test_forms_equal_all_pairs(spark, spec):
    counts = some_words(5)
    rows = [(w, n, "own", 1) for w, n in counts.items()] + [("", 5, "own", 1), (None, 5, "own", 1)]
    df = spark.createDataFrame(rows, "word string, n long, form string, key int")
    assert {tuple(r) for r in spelling.variant_forms(df, spec).collect()} == plain_forms(counts)


def test_a_half_that_all_words_share(spark):
    """A third of all words and more with one first half: dealt out further, no link lost."""
    draw = random.Random(6)
    counts = {"prefix" + "".join(draw.choice("abcd") for _ in range(6)): draw.randrange(1, 50) for _ in range(900)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    spec = spelling.Spelling(shard_rows=100, group_rows=30)
    rows = spelling._windows(df, spec)
    assert rows.groupBy("key").count().agg(F.max("count")).first()[0] <= 30
    assert {tuple(r) for r in spelling.variant_forms(df, spec).collect()} == plain_forms(counts)


def test_repeated_words_add_up_and_none_give_none(spark):
    df = spark.createDataFrame([("abcde", 2), ("abcde", None), ("abcdf", 9)], "word string, n long")
    assert {tuple(r) for r in spelling.variant_forms(df).collect()} == plain_forms({"abcde": 2, "abcdf": 9})
    assert spelling.variant_forms(df.filter("n > 100")).collect() == []


def test_counted_words_of_whole_texts(spark):
    draw = random.Random(8)
    texts = [None, "", "ABC def", "Änder ÄNDER änder" * 40, "word1word_WORDS" * 30, "z" * 100_000]
    texts += [" ".join(draw.choice(["Streets", "houses", "ÉTUDE", "one", "river", "Zürich×3"]) for _ in range(300)) for _ in range(20)]
    rows = [(None if k % 7 == 3 else k, t, "own") for k, t in enumerate(texts)] * 2
    counts = {}
    for k, t, _ in rows:
        for run in spelling_runs(t or ""):
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
            counts[word] = counts.get(word, 0) + 1
    want = {(w, n) for w, n in counts.items() if len(w) >= 5 and n >= 3}
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert {tuple(r) for r in spelling.count_words(df, slip_every=97).collect()} == want


def spelling_runs(text):
    return [m.translate(str.maketrans(spelling.UPPER, spelling.LOWER)) for m in re.findall("[A-Za-zÀ-ÿ]+", text)]


# -- pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_prefix_table_equals_the_library(library):
    encoder, draw = pieces.PieceEncoder(MODEL), random.Random(9)
    alphabet = " ▁\n\tabcdefgh.,<>0é́äöÀ×ｆ😀中文字かなкир​\x00　"
    names = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    texts = ["", " ", "  ", "<s>", "<0x41>", "▁", "a▁", " " * 5000 + "end", "abcdefghij" * 20_000, "中" * 3000, "͸" * 10]
    for _ in range(4000):
        texts.append("".join(draw.choice(alphabet) for _ in range(draw.randrange(40))))
        texts.append("".join(draw.choice(" ab▁") for _ in range(draw.randrange(60))))
        texts.append("".join(draw.choice(names) for _ in range(draw.randrange(8))))
    assert [t for t in texts if library.encode(t) != list(encoder(t))] == []
    for t in texts[:200]:  # without any parting of the text
        whole = [i for p in encoder.pieces(library.normalize(t)) for i in encoder._of_piece(p)]
        assert whole == library.encode(t)


def test_decoder_equals_the_library(library):
    read, draw = pieces.piece_decoder(MODEL), random.Random(10)
    for _ in range(20_000):
        ids = [draw.choice([draw.randrange(32_000), draw.randrange(260), 28705, 259]) for _ in range(draw.randrange(8))]
        assert read(ids) == library.decode(ids)


def test_few_known_parts_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_PARTS", 3)
    monkeypatch.setattr(pieces, "KNOWN_LENGTH", 4)
    text = "the cat and the dog and the very long dachshund " * 20
    assert list(pieces.PieceEncoder(MODEL)(text)) == library.encode(text)


def test_encode_and_decode_frames_of_odd_rows(spark, library, monkeypatch):
    texts = [None, "", " ", "Grüße  aus\nWien", "Grüße  aus\nWien", "word " * 50_000, "😀\x00ｆ"]
    rows = [(k if k != 2 else None, t, "own", [7]) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Decoded string, IDS array<int>")
    out = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    assert sorted(out[0].asDict()) == ["decoded", "doc_id", "ids", "text"]
    assert [r.ids for r in out] == [library.encode(t or "") for t in texts]
    assert [r.decoded for r in out] == [library.decode(library.encode(t or "")) for t in texts] == [t or "" for t in texts]
    assert pieces.encode(df.filter("false"), MODEL).collect() == []


def test_batches_of_results_stay_small(spark, library):
    df = spark.createDataFrame([(k, "one two three " * (k % 5)) for k in range(50)], "doc_id long, text string").coalesce(1)
    limit, pieces.BATCH_IDS = pieces.BATCH_IDS, 20
    try:
        out = pieces.encode(df, MODEL).collect()
    finally:
        pieces.BATCH_IDS = limit
    assert [(r.doc_id, r.ids) for r in out] == [(k, library.encode("one two three " * (k % 5))) for k in range(50)]


def test_query_of_pieces_on_documents(spark, library):
    d = "/root/testdata/sf0.001"
    want = set()
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        joined, back = ",".join(map(str, ids)), library.decode(ids)
        want.add((r.doc_id, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert {tuple(r) for r in queries.op13_pieces(spark, d).collect()} == want


def test_piece_encoder_remembers_four_bytes_an_id_and_pairs_by_numbers():
    """A pair fits exactly when merging its text gives it back, characters that no piece has included."""
    encoder, draw = pieces.PieceEncoder(MODEL), random.Random(4)
    for text in ("some words, of 12 kinds", "øl og brød", "龘 and 🙂x"):
        ids = encoder(text)
        assert list(ids) == encoder.library.encode(text)
    word = encoder.library.normalize("kinds")
    assert encoder.known[word] == array("i", encoder.library.encode("kinds")).tobytes()
    names = sorted(i for i, name in encoder.names.items() if len(name) < 5)
    for _ in range(3000):
        before, piece = draw.choice([*draw.sample(names, 1), -1 - ord("龘")]), draw.choice(names)
        first = encoder.names.get(before, "龘")
        assert encoder.fits(before, piece) == (encoder.merge(first + encoder.names[piece]) == [first, encoder.names[piece]])
