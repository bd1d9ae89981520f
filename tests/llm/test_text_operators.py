"""Operators on single texts: encoding, fingerprints, secrets."""

import base64
import hashlib
import re
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from labeltext.llm import bpe, fingerprints, queries, secrets

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def tiktoken_codec():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(odd_docs, some_docs, tiktoken_codec):
    for df in (odd_docs, some_docs[0]):
        rows = bpe.encode_texts(df, RANKS, public_tokenizers.PATTERN).collect()
        texts = [r["text"] or "" for r in df.collect()]
        want = [tiktoken_codec.encode_ordinary(t) for t in texts]
        assert sorted(r["ids"] for r in rows) == sorted(want)
        digests = sorted(sha(struct.pack(f"<{len(w)}I", *w)) for w in want)
        assert sorted(r["ids_sha256"] for r in rows) == digests
        assert sorted(r["decoded_sha256"] for r in rows) == sorted(sha(t.encode()) for t in texts)


def test_bpe_white_space(tiktoken_codec):
    pieces = bpe.read_ranks(RANKS)
    codec = bpe.Codec(pieces, bpe.serialise_model(pieces), public_tokenizers.PATTERN)
    texts = [" a", "a ", "a  b", "a \n b", "\na b.", "x' s it's  we'll", "a  b", "a \x1c b", "1 2  3", "ñ. é!", " ", "a  b"]
    for text, ids in zip(texts, codec.encode(texts)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == tiktoken_codec.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_bpe_empty_table(no_docs):
    assert bpe.encode_texts(no_docs, RANKS, public_tokenizers.PATTERN).collect() == []


def brute_spans(text):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secrets_equal_regular_expressions(odd_docs, some_docs):
    for df in (odd_docs, some_docs[0]):
        found = secrets.scan_documents(df, rules=secrets.BASE_RULES).collect()
        got = sorted([tuple(x) for x in r["findings"]] for r in found)
        assert [sorted(x) for x in got] == [sorted(x) for x in sorted(brute_spans(r["text"] or "") for r in df.collect())]


def test_secret_counts_and_digest(spark):
    rows = queries.op4_secret_ledger(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        spans = brute_spans(texts[r["doc_id"]])
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == sha(base.encode())
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)]


def test_failed_match_consumes_its_text(spark):
    df = spark.createDataFrame([(1, "token=token: abcdefgh")], "doc_id bigint, text string")
    assert secrets.scan_documents(df).first()["findings"] == []


def test_ledger_is_incremental(spark, odd_docs):
    held = secrets.address(odd_docs.select("text"))
    ledger = secrets.scan(held).cache()
    assert secrets.scan(held, ledger).count() == 0
    newer = (*secrets.RULES[:-1], secrets.Rule("key_block", secrets.RULES[-1].pattern, 0, 1, "2"))
    assert {r["rule"] for r in secrets.scan(held, ledger, newer).collect()} == {"key_block@2"}
    more = secrets.address(odd_docs.sparkSession.createDataFrame([("password=hunter22",)], "text string"))
    assert secrets.scan(held.unionByName(more, True), ledger).select("blob").distinct().count() == 1
    again = secrets.scan_documents(odd_docs, ledger=ledger).collect()
    fresh = secrets.scan_documents(odd_docs).collect()
    order = lambda rows: sorted((str(r["doc_id"]), r["_blob"], sorted(map(tuple, r["findings"]))) for r in rows)
    assert order(again) == order(fresh)


def test_history_versions(spark):
    df = spark.createDataFrame([(1, "new", ["old", None])], "path bigint, text string, history array<string>")
    assert secrets.address(df, history_col="history").select("_blob").distinct().count() == 3


def test_redaction(spark, odd_docs):
    df = spark.createDataFrame([(1, "a password=hunter22 b"), (2, None), (3, "fine")], "id int, text string")
    out = {r["id"]: r["text"] for r in secrets.redact_documents(df).collect()}
    assert out == {1: "a [secret] b", 2: None, 3: "fine"}
    assert secrets.redact_documents(odd_docs).count() == odd_docs.count()


def test_fingerprints_of_next_and_edited(odd_docs, some_docs):
    df, texts = some_docs
    rows = {r["doc_id"]: r for r in fingerprints.compare_with_next(df).collect()}
    ids = sorted(texts, reverse=True)
    follow = dict(zip(ids, ids[1:] + ids[:1]))
    for i, r in rows.items():
        n = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - n] + texts[follow[i]][:n]
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == sha(edited.encode())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if texts[i] == texts[follow[i]]:
            assert r["near_next"] == 1 and r["fingerprint"] == rows[follow[i]]["fingerprint"]
    assert fingerprints.compare_with_next(odd_docs).count() == odd_docs.count()


def brute_prints(spark, texts, k=5, window=9):
    """``{text: [(hash, place)]}``: the least of each window, rightmost among equals; hashes alone are Spark's."""
    words = {t: t.encode().split() for t in texts}
    grams = {t: [w[i : i + k] for i in range(max(len(w) - k + 1, min(len(w), 1)))] for t, w in words.items()}
    distinct = sorted({b"\0".join(g).decode() for gs in grams.values() for g in gs})
    hashed = spark.createDataFrame([(g,) for g in distinct], "g string").select(
        "g", F.xxhash64(F.split("g", "\0")).alias("h")).collect()
    high = {r["g"]: (r["h"] & ((1 << 63) - 1)) >> fingerprints.POSITION_BITS for r in hashed}
    out = {}
    for t, gs in grams.items():
        values = [(high[b"\0".join(g).decode()], -i) for i, g in enumerate(gs)]
        chosen = {min(values[i : i + window]) for i in range(max(1, len(values) - window + 1))} if values else set()
        out[t] = sorted(((h, -i) for h, i in chosen), key=lambda x: x[1])
    return out


def test_fingerprints_equal_brute_force(spark, some_docs):
    texts = dict(sorted(some_docs[1].items())[:150])
    texts |= {-1: "", -2: "one", -3: "a b c d e", -4: "z " * 60, -5: "z " * 60, -6: " ".join(f"w{i % 7}" for i in range(100))}
    rows = fingerprints.compare_with_next(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    ids = sorted(texts, reverse=True)
    follow = dict(zip(ids, ids[1:] + ids[:1]))
    edited = {}
    for i, t in texts.items():
        n = len(t) // 2
        edited[i] = t[: len(t) - n] + texts[follow[i]][:n]
    prints = brute_prints(spark, {*texts.values(), *edited.values()})
    shown = lambda t: " ".join(f"{h:X}@{i}" for h, i in prints[t])

    def likeness(a, b):
        a, b = ({h for h, _ in prints[t]} for t in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(texts[i]), shown(edited[i]))
        assert r["near_edited"] == pytest.approx(likeness(texts[i], edited[i]))
        assert r["near_next"] == pytest.approx(likeness(texts[i], texts[follow[i]]))


def test_places_do_not_change_the_order(some_docs, monkeypatch):
    df, _ = some_docs
    want = fingerprints.compare_with_next(df).orderBy("doc_id").collect()
    monkeypatch.setattr(fingerprints, "ROWS_PER_PLACE", 7)
    assert fingerprints.compare_with_next(df).orderBy("doc_id").collect() == want


def test_winnowing_keeps_its_guarantee(spark):
    """Texts that share k + window - 1 words share a fingerprint; positions point at it."""
    shared = " ".join(f"w{i}" for i in range(13))
    rows = [(1, "a b c " + shared + " d e"), (2, "z " * 40 + shared), (3, "q"), (4, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r["id"]: r for r in df.select("id", fingerprints.winnow(F.col("text")).alias("p")).select(
        "id", fingerprints.hashes(F.col("p")).alias("h"), fingerprints.positions(F.col("p")).alias("at")).collect()}
    assert set(got[1]["h"]) & set(got[2]["h"])
    assert len(got[3]["h"]) == 1 and got[4]["h"] == []
    assert got[1]["at"] == sorted(got[1]["at"]) and max(got[1]["at"]) < 18
    # of a run of equal grams the rightmost of each window: every window's last one
    assert got[2]["at"][0] == 8


def test_fingerprints_of_no_rows(no_docs):
    assert fingerprints.compare_with_next(no_docs).collect() == []
    assert secrets.scan_documents(no_docs).collect() == []
