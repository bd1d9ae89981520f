"""Ranked search, turn repair and token files against brute force."""

import hashlib
import io
import itertools
import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labeltext.llm import conversations, lexical, tokenfile

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranked(docs, items, k):
    """Rows of ``search`` from lists of ``(id, text)``, one document after another."""
    bags = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, n_terms = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item, text in items:
        scores = {}
        found = []
        for t in set(terms(text)):
            df = sum(t in b for _, b in bags)
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            for at, (i, b) in enumerate(bags):
                tf = b.count(t)
                m = 10 + 90 * len(b) * n_docs // n_terms
                scores[at] = scores.get(at, 0) + w * (10**9 * tf // (1000 * tf + 8 * m))
        found = sorted((-s, bags[at][0]) for at, s in scores.items() if s > 0 and bags[at][0] is not None)
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ITEMS = [(0, "the quick Brown fox"), (1, None), (2, ""), (3, "...!"), (4, "a b c d d d"), (4, "secret"), (None, "x dog"),
         (5, "Ünïcode ünïcode 𝄞"), (6, "nowhere to be found")]


def test_search_on_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(*x, "en", i, 0.5, i) for i, x in enumerate(ITEMS)],
                                  "item_id bigint, text string, lang string, doc_id bigint, score double, rank int")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for k in (1, 3, 10):
        assert rows(lexical.search(odd_docs, items, k)) == ranked(docs, ITEMS, k)


def test_search_in_blocks_and_buckets(spark, some_docs, monkeypatch):
    df, texts = some_docs
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = ranked(sorted(texts.items()), [(r["item_id"], r["text"]) for r in items.collect()], 10)
    assert rows(lexical.search(df, items)) == want
    monkeypatch.setattr(lexical, "BUCKET", 7)
    monkeypatch.setattr(lexical, "SEEDS", 20)
    assert rows(lexical.search(df, items, block_terms=100)) == want


def test_search_with_many_ties(spark):
    docs = [(i, "same words here") for i in range(3000)] + [(i, f"other {i}") for i in range(3000, 3100)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    items = spark.createDataFrame([(1, "same"), (2, "other 3050")], "item_id bigint, text string")
    assert rows(lexical.search(df, items, 5)) == ranked(docs, [(1, "same"), (2, "other 3050")], 5)


def test_search_on_empty_tables(spark, no_docs, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for got in (lexical.search(no_docs, items), lexical.search(odd_docs, items.limit(0))):
        assert rows(got) == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_buckets_are_pruned():
    """Short vectors and vectors without the heavy terms never reach the exact score."""
    bounds, places = np.arange(5), np.array([0, 0, 1, 1])
    impacts = np.array([900, 800, 700, 5])
    weights = np.array([100.0, 1.0])
    bucket = lexical.Bucket(np.sqrt(weights[places]) * impacts, np.arange(4), bounds, places, impacts, 2)
    query = np.array([0, 1])
    assert bucket.candidates(query, weights, 10**6).tolist() == []  # Cauchy-Schwarz
    assert bucket.candidates(query, weights, 85_000).tolist() == [0]  # coordinate bounds
    assert bucket.candidates(query, weights, 1).tolist() == [0, 1, 2, 3]
    assert bucket.scores(np.array([0, 3]), np.array([100, 1])).tolist() == [90_000, 5]


def test_buckets_of_several_files():
    """A long vector behind a short one, as where a task reads several files, is not skipped."""
    bounds, places, impacts = np.arange(3), np.array([0, 0]), np.array([5, 900])
    weights = np.array([100.0])
    bucket = lexical.Bucket(np.sqrt(weights[places]) * impacts, np.arange(2), bounds, places, impacts, 1)
    assert bucket.candidates(np.array([0]), weights, 80_000).tolist() == [1]


def test_search_over_files_in_one_task(spark):
    """Lengths rise from file to file within a task; thresholds of earlier files must not hide later ones."""
    docs = [(i, "w " * (1 + i % 40) + f"own{i % 7} " + "pad " * (i % 13)) for i in range(600)]
    items = [(1, "w own3"), (2, "own1 own2 pad")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = rows(lexical.search(df, spark.createDataFrame(items, "item_id bigint, text string"), 3))
    assert got == ranked(docs, items, 3)


# conversations

LETTERS = "suax"


def all_repairs(codes, most=2):
    """Every edit list with ``most`` insertions at most between two rows, as ``(cost, audit)`` of the right ones."""
    right = re.compile(r"(s?(ua)+)?").fullmatch
    spots = [[(0, "", "")] + [(5 * n, "I" * n, "".join(r)) for n in range(1, most + 1) for r in itertools.product("ua", repeat=n)]]
    steps = list(spots)
    for c in codes:
        kind, fault = LETTERS[c & 3], c >> 2
        choices = [(2, "D", "")]
        if fault in (0, 3):
            more = 5 if fault == 3 else 0
            choices += [(more, "K", kind), (1 + more, "R", "u"), (1 + more, "R", "a")]
        steps += [choices, *spots]
    for path in itertools.product(*steps):
        if right("".join(p[2] for p in path)):
            yield sum(p[0] for p in path), "".join(p[1] for p in path)


@given(st.lists(st.integers(0, 15), max_size=4))
@settings(max_examples=60, deadline=None)
def test_cheapest_is_least_of_all(codes):
    assert conversations.cheapest(bytes(codes)) == min(all_repairs(codes, 2 if len(codes) < 3 else 1))


def test_long_conversations_take_linear_work():
    rng = np.random.default_rng(5)
    codes = bytes(rng.integers(0, 16, 30_000).tolist())
    cost, audit = conversations.cheapest(codes)
    assert len(audit) - audit.count("I") == len(codes) and cost == conversations.suffix_bounds(codes)[0][0]


def repaired(group):
    """Result of ``repair`` (no damage) for the rows ``(turn, role, text)`` of a conversation."""
    group = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in group]
    group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    codes, seen, counts = [], set(), {1: 0, 2: 0, 3: 0, 0: 0}
    for _, role, text in group:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 1 if not body else 2 if (role, text) in seen else 0 if body[-1] in ".!?" else 3
        seen.add((role, text))
        counts[fault] += 1
        codes.append("sua".find(role[:1]) % 4 + 4 * fault if role else 3 + 4 * fault)
    turns = [t for t, _, _ in group if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
    cost, audit = conversations.cheapest(bytes(codes))
    out, lines, last = [], iter(group), ""
    for letter in audit:
        _, role, text = ("", "", "") if letter == "I" else next(lines)
        if letter in "IR":
            role = "assistant" if last == "u" else "user"
        if letter != "D":
            last = role[:1]
            out.append(f"{role}:{text}")
    return (gaps, counts[1], counts[2], counts[3], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()), out


ODD = {
    1: [(0, "system", "Be kind."), (1, "user", "Hi!"), (2, "assistant", "Hello.")],
    2: [(None, None, None), (None, "user", "a."), (3, "user", "a."), (3, "user", "a."), (9, "", "x"), (10, "assistant", "end. \n")],
    3: [(5, "user", ""), (5, "user", " \t"), (6, "tool", "ran")],
    4: [(i, "user" if i % 2 else "assistant", f"row {i % 7}" + "." * (i % 3)) for i in range(200)],
    None: [(1, "user", "same."), (1, "user", "same."), (2, "assistant", "ok?")],
}


def test_repair_on_odd_rows(spark):
    flat = [(c, t, r, x, "en", 1, "mine") for c, g in ODD.items() for t, r, x in g]
    df = spark.createDataFrame(flat, "conv_id bigint, turn bigint, role string, text string, row string, code int, audit string")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(df.repartition(3)).collect()}
    assert got == {c: repaired(g)[0] for c, g in ODD.items()}
    back = conversations.repair(df, keep_rows=True).collect()
    for c, g in ODD.items():
        mine = sorted((r["place"], f"{r['role']}:{r['text']}") for r in back if r["conv_id"] == c)
        assert [x for _, x in mine] == repaired(g)[1]


def test_damage_and_empty_conversations(spark):
    dropped = [(c, 0) for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame([(c, t, "user", "x.") for c, t in dropped], "conv_id bigint, turn bigint, role string, text string")
    got = conversations.repair(df, damage=True).collect()
    assert {tuple(r) for r in got} == {(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, _ in dropped}
    assert conversations.repair(df.limit(0), damage=True).collect() == []


# token files

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(TOKENIZER)
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def contents(path):
    import glob

    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*"))]


@given(st.lists(st.text(alphabet=st.sampled_from("aB '.\n\t\x1c\x85 é𝄞7<|endoftext|>s") | st.characters(codec="utf-8"), max_size=40), max_size=6))
@settings(max_examples=80, deadline=None)
def test_stretches_encode_as_whole_texts(library, texts):
    with open(TOKENIZER, encoding="utf-8") as f:
        coder = tokenfile.encoder(f.read())
    assert coder.by_stretch
    assert coder.encode(pa.array(texts, pa.string())) == [packed(library(t)) for t in texts]


def test_other_tokenizers_get_whole_texts(some_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        coder = tokenfile.Encoder(f.read())
    texts = list(some_docs[1].values())[:20]
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert not coder.by_stretch and coder.encode(pa.array(texts)) == [packed(e.ids) for e in want]


def expected(docs, library):
    out, start = [], 0
    for i, ids in docs:
        out.append((i, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    return sorted(out, key=repr)


def test_files_round_trip(spark, some_docs, library, tmp_path, monkeypatch):
    df, texts = some_docs
    coded = [(i, [*library(texts[i]), 0]) for i in sorted(texts)]
    monkeypatch.setattr(tokenfile, "FRAME_IDS", 1000)  # long documents span frames
    path = str(tmp_path / "files")
    tokenfile.write_token_files(df, path, TOKENIZER, file_bytes=30_000)
    assert len([c for c in contents(path) if c]) > 8
    assert rows(tokenfile.read_token_files(spark, path, keep_ids=False)) == expected(coded, library)
    chosen = {r["doc_id"]: r["ids"] for r in tokenfile.read_token_files(spark, path, only=[3, 77, 10**6]).collect()}
    assert chosen == {i: ids for i, ids in coded if i in (3, 77)}


def test_files_are_plain_zstandard(spark, some_docs, library, tmp_path):
    import zstandard

    df, texts = some_docs
    path = str(tmp_path / "files")
    tokenfile.write_token_files(df, path, TOKENIZER)
    ids = b"".join(packed([*library(texts[i]), 0]) for i in sorted(texts))
    plain = b""
    for data in contents(path):
        if not data:
            continue
        file = tokenfile.FileReader(data)
        assert file.opened == 1  # the index
        file.document(0)
        assert file.opened == 2
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        plain += whole[: 4 * int(file.n_tokens.sum())]
        n, flags, end = struct.unpack("<IBI", data[-9:])
        assert (flags, end) == (0x80, 0x8F92EAB1) and n == len(file.packed) == len(file.ids) + 1
    assert plain == ids


def test_damage_is_seen(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text number {i} " * 50) for i in range(5)], "doc_id bigint, text string").coalesce(1)
    path = str(tmp_path / "files")
    tokenfile.write_token_files(df, path, TOKENIZER)
    data = next(c for c in contents(path) if c)
    file = tokenfile.FileReader(data)
    sums = len(data) - 9 - 12 * len(file.packed) + 8  # checksum of the first frame
    for broken in (data[:sums] + bytes([data[sums] ^ 1]) + data[sums + 1 :], data[:-1], data[: len(data) // 2], b""):
        with pytest.raises(Exception, match="checksum|seek table"):
            tokenfile.FileReader(broken).document(0)
    assert tokenfile.FileReader(data).document(0)


def test_files_on_odd_rows(spark, odd_docs, no_docs, library, tmp_path):
    path = str(tmp_path / "odd")
    tokenfile.write_token_files(odd_docs, path, TOKENIZER)
    got = tokenfile.read_token_files(spark, path).collect()
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == sorted(((i, [*library(t), 0]) for i, t in docs), key=repr)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in docs), key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(len(got))]
    path = str(tmp_path / "none")
    tokenfile.write_token_files(no_docs, path, TOKENIZER)
    assert tokenfile.read_token_files(spark, path).collect() == []
