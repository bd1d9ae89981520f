"""Operators over a whole corpus against brute force: scores, repeats, near copies, mixing."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from labeltext.llm import mixing, neardup, queries, substrings, suffixtree

SF = "/root/testdata/sf0.001"
LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def made_up(spark, texts, first=0):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts, first)], "doc_id bigint, text string")


# language-model scores

def check_scores(rows, texts, held_out):
    tokens = {i: (t or "").encode().translate(LOW).split() + [None] for i, t in texts.items()}
    counts = collections.Counter(x for i, w in tokens.items() if not held_out(i) for x in w)
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        w = tokens[r["doc_id"]]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and math.isfinite(r["score"])


def test_suffix_tree_scores(spark, some_docs):
    rows = queries.op1_suffix_tree(spark, SF).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    check_scores(rows, some_docs[1], held)
    some = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some)


def test_suffix_tree_sums_to_one(spark):
    """The probabilities of all texts of up to three known words stay within one."""
    docs = made_up(spark, ["a b c a b d", "a b c", "b c a b"] * 40)
    learnt = suffixtree.learn(docs)
    assert any(len(kept.keys) for kept, _ in learnt[1].levels)
    words = ["a", "b", "c", "d"]

    frame = made_up(spark, [" ".join(c) for c in (["a"], ["a", "b"], ["c"], [])])
    assert suffixtree.score(frame, *learnt).count() == 4
    texts = [" ".join(x) for n in range(4) for x in itertools.product(words, repeat=n)]
    scored = suffixtree.score(made_up(spark, texts), *learnt).collect()
    assert 0.2 < sum(10 ** r["score"] for r in scored) <= 1 + 1e-9


def brute_tree(texts):
    """Tree and smoothed counts over tuples of words: ``(counts, base, kept)``; ``kept[context]``: rest, listed."""
    rows = [(t or "").encode().translate(LOW).split() + [None] for t in texts]
    counts = collections.Counter(x for w in rows for x in w)
    norm = sum(counts.values()) + len(counts) + 1
    least = max(2.0, suffixtree.P_MIN * sum(counts.values()))
    base = lambda x: (counts[x] + 1) / norm
    known, kept = {(x,): n for x, n in counts.items() if n >= least and x is not None}, {}
    for size in range(1, suffixtree.MOST_WORDS + 1):
        after = collections.defaultdict(collections.Counter)
        for w in rows:
            for i in range(size, len(w)):
                if tuple(w[i - size : i]) in known and counts[w[i]] >= least:
                    after[tuple(w[i - size : i])][w[i]] += 1
        longer, new = {}, {}
        for context, tokens in after.items():
            tokens = {x: n for x, n in tokens.items() if n >= least}
            longer |= {(*context, x): n for x, n in tokens.items() if x is not None}
            n_all = known[context]
            before = {x: brute_probability(kept, base, context[1:], x) for x in tokens}
            gain = sum(n * math.log(n / n_all / before[x]) for x, n in tokens.items())
            other = n_all - sum(tokens.values())
            if other > 0:
                gain += other * math.log(other / n_all / max(1 - sum(before.values()), 1e-12))
            width = len(tokens)
            if width and gain >= suffixtree.LEAST_GAIN * n_all and gain >= width + 3 * math.sqrt(2 * width) + 10:
                listed = {x: (n - suffixtree.DISCOUNT) / n_all for x, n in tokens.items()}
                new[context] = 1 - sum(listed.values()), listed
        known = longer
        kept |= new
    return counts, base, kept


def brute_probability(kept, base, before, token):
    p = base(token)
    for size in range(1, min(len(before), suffixtree.MOST_WORDS) + 1):
        rest, listed = kept.get(tuple(before[-size:]), (1.0, {}))
        p = p * rest + listed.get(token, 0.0)
    return p


def test_suffix_tree_equals_brute_force(spark):
    """Scores of learnt and of other texts, with contexts of every length in use."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    passages = [" ".join(draw.choices(words, k=9)) for _ in range(6)]
    texts = [" ".join([*draw.choices(words, k=4), draw.choice(passages), *draw.choices(words, k=3)]) for _ in range(600)]
    texts += [None, "", "W1 once only", "never"]
    counts, base, kept = brute_tree(texts)
    assert {len(c) for c in kept} == set(range(1, suffixtree.MOST_WORDS + 1))
    asked = [*texts[:80], *texts[-4:], *passages, "w1 w2 unheard w3 " * 3]
    learnt = suffixtree.learn(made_up(spark, texts))
    assert sum(len(c.keys) for c, _ in learnt[1].levels) == len(kept)
    got = {r["doc_id"]: r["score"] for r in suffixtree.score(made_up(spark, asked), *learnt).collect()}
    for i, text in enumerate(asked):
        w = (text or "").encode().translate(LOW).split() + [None]
        want = sum(math.log10(brute_probability(kept, base, w[:j], x)) for j, x in enumerate(w))
        assert got[i] == pytest.approx(want, rel=1e-9)


def test_suffix_tree_odd_rows(odd_docs, no_docs):
    learnt = suffixtree.learn(odd_docs)
    rows = suffixtree.score(odd_docs, *learnt).collect()
    assert len(rows) == odd_docs.count() and all(r["n_tokens"] == r["n_known"] for r in rows)
    assert suffixtree.score(no_docs, *suffixtree.learn(no_docs)).collect() == []
    assert len(suffixtree.score(odd_docs, *suffixtree.learn(no_docs)).collect()) == len(rows)


# repeated passages

def brute_repeats(rows):
    first, out = {}, collections.defaultdict(list)
    docs = sorted(((i, (t or "").encode().split()) for i, t in rows if i is not None), key=lambda x: x[0])
    for i, w in docs:
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    for i, w in docs:
        gone = set()
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < i:
                gone.update(range(j, j + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i].append((len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return {i: sorted(x) for i, x in out.items()}


def check_repeats(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = collections.defaultdict(list)
    for r in substrings.remove_repeats(df).collect():
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            got[r["doc_id"]].append((r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]))
    assert {i: sorted(x) for i, x in got.items()} == brute_repeats(rows)


def test_repeats_of_the_tables_and_odd_rows(spark, odd_docs, no_docs, some_docs):
    check_repeats(some_docs[0])
    check_repeats(odd_docs)
    assert substrings.remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_repeats_at_the_limit(spark, alphabet):
    """Passages of 49 to 120 words in other surroundings, long runs and periods among them."""
    import random

    r = random.Random(alphabet)
    word = lambda: f"w{r.randrange(alphabet)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 90, 120)]
    passages += [["a"] * 60, ["a", "b"] * 40, ["a", "b", "c"] * 30]
    texts = []
    for _ in range(40):
        text = []
        for _ in range(r.randrange(1, 4)):
            text += [word() for _ in range(r.randrange(0, 30))] + r.choice(passages)
        texts.append(" ".join(text + [word() for _ in range(r.randrange(0, 60))]))
    check_repeats(made_up(spark, texts, 5))


# near copies

def brute_components(rows, k, share=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOW).split()
        sets.setdefault(i, []).append(frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            for a in sets[i]:
                for b in sets[j]:
                    if a and b and 100 * len(a & b) >= share * len(a | b):
                        x, y = find(i), find(j)
                        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: sorted(map(len, s)) for i, s in sets.items()}


def check_components(df, k, **settings):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want, sizes = brute_components([r for r in rows if r[0] is not None], k)
    got = neardup.near_duplicates(df, k=k, **settings).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["n_shingles"] in sizes[r["doc_id"]]
            # rows without words belong to their own id even if the id's other rows are linked
            assert r["component_id"] == (want[r["doc_id"]] if r["n_shingles"] else r["doc_id"])
            assert r["kept"] == (r["component_id"] == r["doc_id"])


def near_copies(spark):
    """Copies of some texts with a few words changed, chains of them, and other texts."""
    import random

    r = random.Random(3)
    texts = []
    for _ in range(6):
        base = [f"w{r.randrange(500)}" for _ in range(r.randrange(30, 200))]
        for _ in range(30):
            base = list(base)
            for _ in range(r.randrange(0, 3)):
                base[r.randrange(len(base))] = f"w{r.randrange(500)}"
            texts.append(" ".join(base))
    return made_up(spark, texts + [" ".join(f"v{r.randrange(300)}" for _ in range(50)) for _ in range(40)])


def test_near_copies(spark, odd_docs, no_docs, some_docs):
    check_components(some_docs[0], 4)
    check_components(odd_docs, 5)
    check_components(near_copies(spark), 5)
    assert neardup.near_duplicates(no_docs).collect() == []


def test_near_copies_in_small_blocks(spark):
    check_components(near_copies(spark), 5, block_shingles=2_000)


def test_dropping_near_copies(spark, odd_docs):
    df = near_copies(spark)
    kept = {r["doc_id"] for r in neardup.near_duplicates(df).where("kept").collect()}
    assert {r["doc_id"] for r in neardup.drop_near_duplicates(df).collect()} == kept
    assert neardup.drop_near_duplicates(odd_docs).columns == odd_docs.columns
    assert neardup.drop_near_duplicates(odd_docs).where("doc_id is null").count() == 1


def test_components(spark):
    """A long path, a star and a pair, against the smallest id of each."""
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7_000, 200)]
    got = {r["id"]: r["component"] for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 7_000: 200}
    assert got == want


# mixing

def check_mix(rows, parts, rest, block):
    """Every row once, blocks within their windows, and shares within a block of the target."""
    of = lambda s: s if s in parts else None
    blocks = collections.defaultdict(set)
    for r in rows:
        assert r["_release"] <= r["_slot"] < r["_due"] and 0 <= r["_offset"] < block
        blocks[r["_slot"]].add((of(r["source"]), r["_block"]))
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())
    sizes = collections.Counter(of(r["source"]) for r in rows)
    weights = {**parts, None: rest}
    left = {s: -(-n // block) for s, n in sizes.items()}
    order = [next(iter(blocks[s])) for s in range(len(blocks))]
    for s in left:
        assert [b for source, b in order if source == s] == list(range(left[s]))
    frame = {s: min(weights[s], n) for s, n in left.items()}
    done, at, total = collections.Counter(), 0, sum(frame.values())
    for source, _ in order:
        done[source] += 1
        at += 1
        assert all(abs(done[s] - at * frame[s] / total) < 1 for s in frame)
        if at == total:
            left = {s: n - done[s] for s, n in left.items()}
            frame = {s: min(weights[s], n) for s, n in left.items() if n}
            done, at, total = collections.Counter(), 0, sum(frame.values())


@pytest.mark.parametrize("parts", [{"src0": 8, "src1": 2, "src2": 1}, {"src5": 7, "src6": 5, "none": 3}])
def test_mix_keeps_shares(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    rows = mixing.interleave(docs, parts, rest_parts=3, block_rows=4).collect()
    assert len({r["doc_id"] for r in rows}) == docs.count() == len(rows)
    check_mix(rows, parts, 3, 4)


def brute_mix(rows, parts, rest, block):
    """``(slot, offset)`` of every ``(id, source)``: frames in turn, in each the earliest deadline first."""
    queues = collections.defaultdict(list)
    for i, source in rows:
        digest = hashlib.md5(str(i).encode()).hexdigest()
        queues[source if source in parts else ""].append((int(digest[:8], 16) % mixing.GROUPS, digest, i))
    blocks = {}
    for source, queue in queues.items():
        ids = [i for *_, i in sorted(queue)]
        blocks[source] = [ids[i : i + block] for i in range(0, len(ids), block)]
    weights, place, base = {**parts, "": rest}, {}, 0
    while any(blocks.values()):
        size = {s: min(weights[s], len(b)) for s, b in blocks.items() if b}
        total, done = sum(size.values()), collections.Counter()
        for slot in range(total):
            ready = [(-(-(done[s] + 1) * total // n), s) for s, n in size.items() if done[s] < n and done[s] * total // n <= slot]
            source = min(ready)[1]
            done[source] += 1
            for offset, i in enumerate(blocks[source].pop(0)):
                place[i] = base + slot, offset
        base += total
    return place


def test_mix_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    rows = [tuple(r) for r in docs.collect()] + [(10**7 + i, "src0") for i in range(300)]  # one source holds most
    got = mixing.interleave(spark.createDataFrame(rows, docs.schema), queries.SOURCE_PARTS, block_rows=3).collect()
    assert {r["doc_id"]: (r["_slot"], r["_offset"]) for r in got} == brute_mix(rows, queries.SOURCE_PARTS, 1, 3)


def test_mix_odd_rows(odd_docs, no_docs):
    rows = mixing.interleave(odd_docs, {"src0": 2}, block_rows=2)
    assert rows.columns[: len(odd_docs.columns)] == odd_docs.columns
    check_mix(rows.collect(), {"src0": 2}, 1, 2)
    assert rows.count() == odd_docs.count()
    assert mixing.interleave(no_docs, {"src0": 2}).collect() == []
    with pytest.raises(ValueError):
        mixing.interleave(odd_docs, {"src0": 0})


def test_mix_query_is_whole(spark):
    rows = queries.op10_pfair_mix(spark, SF)
    assert rows.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert rows.where((F.col("slot") < F.col("release")) | (F.col("slot") >= F.col("due"))).count() == 0
