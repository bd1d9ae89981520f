"""URL verdicts, nearest neighbours, toxicity and the pipeline."""

import collections
import math
import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from labeltext.llm import ann, queries, toxicity, urls

SF = "/root/testdata/sf0.001"


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    best = None
    for _, rule in urls.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and len(rule) > len(best or ""):
            best = rule
    return host, path, best


def test_url_rules(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://A.ORG/x?y#z", "http://a.org", "http://x://y.org/", "//b.com/fr/",
           "ftp://example.org/es/a", "http://notexample.org/es/", "http://example.org/en/12", "http://q.com/de/?a", "x://É.org/ü"]
    rows = [(i, u, "<p>some words here</p>") for i, u in enumerate(odd)] + [(3, odd[4], None), (None, odd[5], "")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("host", F.lit("mine"))
    out = urls.judge(df).collect()
    verdicts = {rule: v for v, rule in urls.RULES}
    assert sorted((r["host"], r["path"], r["rule"] or "") for r in out) == sorted(
        (h, p, b or "") for h, p, b in (brute_url(u) for _, u, _ in rows))
    assert all(r["verdict"] == verdicts[r["rule"]] for r in out if r["rule"])
    assert all(r["verdict"] in ("allow", "block") for r in out)
    assert urls.judge(df.where("false")).collect() == []


def test_names_are_split_into_words(spark):
    counts = spark.createDataFrame([("casino", 50), ("win", 80), ("news", 90), ("in", 500), ("a", 700)], "word string, n bigint")
    names = spark.createDataFrame([("casinowin",), ("newsqq",), ("win",)], "name string")
    got = {r["name"]: r["words"] for r in urls.segment(names, counts, 2000.0).collect()}
    assert got == {"casinowin": ["casino", "win"], "newsqq": ["news", "qq"], "win": ["win"]}


def test_url_model_learns(spark):
    rows = [(i, f"http://s{'casino' if i % 2 else 'news'}.com/{'de' if i % 2 else 'fr'}/{i}", "news casino s") for i in range(40)]
    rows += [(100, "http://casinonews.net/de/1", ""), (101, "http://newsnews.net/fr/1", "")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(df).collect()}
    assert got[100] == "block" and got[101] == "allow"


def brute_split(name, counts, total):
    """The likeliest split by trying every last word, without a bound on its length."""
    best = {0: (0.0, [])}
    for end in range(1, len(name) + 1):
        ways = []
        for start in range(end):
            word = name[start:end]
            cost = math.log(counts[word] / total) if word in counts else -math.log(total) - len(word) * math.log(10)
            ways.append((best[start][0] + cost, -start, [*best[start][1], word]))
        best[end] = max(ways, key=lambda w: w[:2])[::2]
    return best[len(name)][1]


def brute_judge(rows):
    """Verdicts and scores of ``(id, url, html)`` by counting in dictionaries."""
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    counts = collections.Counter(
        w for _, _, h in rows for w in re.split("[^a-z]+", low(re.sub("<[^<>]*>", " ", h or ""))) if 0 < len(w) <= 63)
    total = sum(counts.values()) or 1
    verdicts = {rule: v for v, rule in urls.RULES}
    tokens, learnt = {}, {"allow": collections.Counter(), "block": collections.Counter()}
    kinds = collections.Counter()
    for i, url, _ in rows:
        host, path, rule = brute_url(url)
        words = [w for n in re.split("[^a-z]+", host) if n for w in brute_split(n, counts, total)]
        parts = regex.split(r"[^\p{L}0]+", re.sub("[0-9]+", "0", low(path)))
        tokens[i] = rule, words + ["/" + x for x in parts if x]
        if rule:
            kinds[verdicts[rule]] += 1
            learnt[verdicts[rule]].update(tokens[i][1])
    size = len(set(learnt["allow"]) | set(learnt["block"]))
    a_all, b_all = (sum(learnt[v].values()) + size + 1 for v in ("allow", "block"))
    both = kinds["allow"] and kinds["block"]
    prior = math.log(kinds["block"] / kinds["allow"]) if both else 0.0
    out = {}
    for i, (rule, words) in tokens.items():
        score = None if rule else prior + sum(math.log(
            (learnt["block"][w] + 1) / b_all / ((learnt["allow"][w] + 1) / a_all)) for w in words)
        out[i] = verdicts[rule] if rule else "block" if both and score > 0 else "allow", score
    return out


@pytest.mark.parametrize("made_up", [False, True])
def test_url_verdicts_equal_brute_force(spark, made_up):
    if made_up:
        long = "antidisestablishmentarianism"
        rows = [(i, f"http://{long if i % 3 else 'cat'}{'dog' * (i % 4)}.com/{'de' if i % 2 else 'fr'}/{i}", f"{long} cat dog") for i in range(30)]
        rows += [(100, f"https://{long}cat.net/a", ""), (101, "x://" + "catdog" * 20 + ".net", None), (102, None, "cat")]
        df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    else:
        df = spark.read.parquet(f"{SF}/pages.parquet")
        rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    want = brute_judge(rows)
    got = {r["page_id"]: (r["verdict"], r["score"]) for r in urls.judge(df).collect()}
    assert got.keys() == want.keys()
    for i, (verdict, score) in want.items():
        assert got[i][1] is None if score is None else got[i][1] == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert got[i][0] == verdict or abs(score) < 1e-9


def brute_nearest(rows, asked, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    fine = [(i, v) for i, v in fine if np.isfinite(v).all() and v.any()]
    out = {}
    for i, q in fine:
        if asked(i):
            near = sorted((-float((q * v).sum()), j) for j, v in fine if j != i and len(v) == len(q))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_exact_search_of_the_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found(queries.op8_vp_trees(spark, SF)) == brute_nearest(rows, lambda i: i % 20 == 0, 20)


def test_search_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), 1.0, -2.0 * (i % 3)]) for i in range(60)] + [
        (60, None), (61, [0.0] * 3), (62, [nan, 1.0, 1.0]), (63, [inf, 0.0, 0.0]), (64, [None, 1.0, 1.0]), (65, []),
        (80, [5.0, 5.0, 5.0]), (None, [9.0, 9.0, 9.0]), (100, [1.0, 2.0]), (120, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit(1))
    got = found(ann.nearest(df, df.where("vec_id % 20 = 0"), 7, shard_rows=16))
    assert got == brute_nearest(rows, lambda i: i % 20 == 0, 7)
    assert ann.nearest(df.where("false"), df, 3).collect() == []
    assert ann.nearest(df, df.where("false"), 3).collect() == []


def test_no_row_holds_a_tree(spark):
    """What goes to a worker, or through a join, is one vector a row, however many vectors there are."""
    r = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(r.normal(size=(300, 4)).tolist())] + [(7, [9.0] * 4), (7, [9.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    asked = df.where("vec_id % 10 = 3")
    out = ann.nearest(df, asked, 5, shard_rows=20)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "binary" not in out._jdf.queryExecution().toString()
    assert found(out) == brute_nearest(rows, lambda i: i % 10 == 3, 5)


def test_relaxed_pruning(spark):
    """A larger factor looks at less and still finds at least nine in ten."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(40, 12))
    x = centres[r.integers(0, 40, 4000)] + 0.2 * r.normal(size=(4000, 12))
    tree = ann.build(np.arange(4000), x, leaf=64)
    ids = np.arange(0, 4000, 20)
    exact = ann.search(tree, ids, x[ids], 10)
    relaxed = ann.search(tree, ids, x[ids], 10, factor=1.3)
    pairs = lambda s: set(zip(s[0].tolist(), s[1].tolist()))
    assert len(pairs(exact) & pairs(relaxed)) >= 0.9 * len(pairs(exact))
    brute = (x[ids] @ x.T)
    brute[np.arange(len(ids)), ids] = -np.inf
    assert pairs(exact) == {(q, int(v)) for q in range(len(ids)) for v in np.argsort(-brute[q])[:10]}


def test_toxicity_on_labels_never_seen(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op9_pu_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(y and p for y, p in held)
    assert right >= 0.9 * sum(y for y, _ in held) and right >= 0.95 * sum(p for _, p in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 0, 1), (3, 1, 1), (9, 1, 0), (77, 0, 1), (None, 0, 1), (4, 0, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.trained(odd_docs, labels)
    rows = toxicity.score(odd_docs, model, keep=tuple(odd_docs.columns), score_col="_t")
    assert rows.count() == odd_docs.count() and rows.columns == [*odd_docs.columns, "_t"]
    assert toxicity.score(no_docs, toxicity.trained(no_docs, labels.where("false"))).collect() == []


def test_non_negative_risk():
    """Positives are a third of the unlabelled; the fit ranks them first and does not run off."""
    r = np.random.default_rng(1)
    n_p, n_u = 300, 3000
    hidden = r.random(n_u) < 0.3
    x = np.r_[r.normal(2, 1, n_p), r.normal(0, 1, n_u) + 2 * hidden]
    toxic = np.arange(n_p + n_u) < n_p
    row = np.arange(len(x))
    w, b = toxicity.fit(row, np.zeros(len(x), int), x, toxic, 1, 0.3)
    p = 1 / (1 + np.exp(-(x[n_p:] * w[0] + b)))
    assert ((p > 0.5) == hidden).mean() > 0.8


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.materialize(stage(spark, docs, SF), "stage")
        out.append((name, docs, result))
        docs = result
    return out


def test_pipeline_stages(stages):
    names = [n for n, _, _ in stages]
    assert names == ["toxicity", "near duplicates", "secrets", "mixing", "encoding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.schema == before.schema
    rows = lambda df: sorted(map(tuple, df.collect()))
    toxic, copies, redacted, mixed, encoded = stages
    assert set(rows(toxic[2])) <= set(rows(toxic[1])) and set(rows(copies[2])) <= set(rows(copies[1]))
    from test_corpus_operators import brute_components

    want, _ = brute_components([(r["doc_id"], r["text"]) for r in copies[1].collect()], 5)
    texts = {r["doc_id"]: (r["text"] or "").split() for r in copies[1].collect()}
    assert {r["doc_id"] for r in copies[2].collect()} == {i for i in want if want[i] == i or not texts[i]}
    after = {r["doc_id"]: r for r in redacted[2].collect()}
    for r in redacted[1].collect():
        assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"] or "")
    assert rows(mixed[1]) == rows(mixed[2])
    assert sorted(r["doc_id"] for r in encoded[1].collect()) == sorted(r["doc_id"] for r in encoded[2].collect())


def test_pipeline_run(spark, stages):
    want = {(r["doc_id"], r["ids_sha256"]) for r in stages[-1][2].collect()}
    assert {(r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_pipeline_takes_odd_documents(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "odd")
    assert docs.count() > 0
