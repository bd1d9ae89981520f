import math
from collections import Counter

import pytest

from labeltext.operators import evaluate, features, filters, stats, topk
from labeltext.operators.dedup import dedup_first
from labeltext.operators.topk import build_vocab

ROWS = [
    (1, "INTJ", "cat dog dog bird"), (2, "INTJ", "cat cat fish"), (3, "ESFP", "dog fish fish fish"),
    (4, "ESFP", "tree"), (5, "INTJ", "cat the and"), (6, "ENTP", ""),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(ROWS, "doc_id long, type string, posts string")


def test_class_distribution(corpus):
    got = [tuple(r) for r in stats.class_distribution(corpus).collect()]
    assert got == [("INTJ", 3, 50.0), ("ESFP", 2, pytest.approx(100 / 3)), ("ENTP", 1, pytest.approx(50 / 3))]


def test_axis_marginals_keep_zero(corpus):
    only_intj = corpus.filter("type = 'INTJ'")
    got = {(r.axis, r.letter): (r.n, r.pct) for r in stats.axis_marginals(only_intj).collect()}
    assert len(got) == 8
    assert got["E/I", "I"] == (3, 100.0) and got["E/I", "E"] == (0, 0.0)


def test_top_words_ties_by_term(corpus):
    rows = stats.top_words(corpus, k=2).collect()
    got = {(r.type, r.rank): (r.term, r.n) for r in rows}
    assert got == {
        ("INTJ", 1): ("cat", 4), ("INTJ", 2): ("dog", 2),
        ("ESFP", 1): ("fish", 3), ("ESFP", 2): ("dog", 1),
    }


def test_class_tfidf_by_hand(corpus):
    rows = stats.class_tfidf(corpus, k=5).collect()
    counts = {"INTJ": Counter(cat=4, dog=2, bird=1, fish=1), "ESFP": Counter(fish=3, dog=1, tree=1)}
    df = Counter(t for c in counts.values() for t in c)
    for label, c in counts.items():
        w = {t: n * (math.log(4 / (1 + df[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        got = {r.term: r.score for r in rows if r.type == label}
        assert got == {t: pytest.approx(x / norm, abs=1e-8) for t, x in w.items()}


def test_vocabulary_cap_is_global(corpus):
    rows = stats.class_tfidf(corpus, k=5, max_features=2).collect()
    assert {r.term for r in rows} == {"cat", "fish"}
    vocab = build_vocab(stats.explode_terms(corpus, "posts"), 3)
    assert [tuple(r) for r in vocab.collect()] == [("cat", 4), ("fish", 4), ("dog", 3)]
    assert build_vocab(stats.explode_terms(corpus, "posts"), None).count() == 7


def brute_force_mi(docs, term):
    pairs = [(text.split().count(term), y) for text, y in docs]
    n, total = len(pairs), 0.0
    for (x, y), k in Counter(pairs).items():
        nx = sum(p[0] == x for p in pairs)
        ny = sum(p[1] == y for p in pairs)
        total += k / n * math.log(k * n / (nx * ny))
    return max(total, 0.0)


def test_mutual_information_by_brute_force(corpus):
    labelled = filters.axis_label(corpus, "type")
    got = {r.term: r.mi for r in stats.mutual_information(labelled, k=None).collect()}
    docs = [(text, 1 if label[0] == "I" else 0) for _, label, text in ROWS]
    assert set(got) == {"cat", "dog", "bird", "fish", "tree"}
    assert got == {t: pytest.approx(brute_force_mi(docs, t), abs=1e-8) for t in got}


def test_mutual_information_skips_rows_without_label(corpus):
    labelled = filters.axis_label(corpus, "type", 2, "N", "S")
    rows = stats.mutual_information(labelled.withColumnRenamed("y", "z"), "z", k=1).collect()
    assert len(rows) == 1


def test_concat_by_group(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "g int, o int, t string")
    assert {r.g: r.text for r in stats.concat_by_group(df, "g", "t", "o").collect()} == {1: "a b", 2: "c"}


def test_concat_of_a_hot_group_goes_by_parts(spark):
    df = spark.range(1000).selectExpr("0 as g", "id as o", "cast(id as string) as t").repartition(8)
    want = [" ".join(map(str, range(i, i + 100))) for i in range(0, 1000, 100)]
    parts = stats.concat_parts(df, "g", "t", "o", rows_per_part=100).orderBy("part").collect()
    assert [r.text for r in parts] == want
    whole = stats.concat_by_group(df, "g", "t", "o", rows_per_part=100).first()
    assert whole.text == " ".join(want)


def test_class_weights_sum_to_the_rows(corpus):
    rows = stats.class_weights(corpus).collect()
    assert sum(r.n * r.weight for r in rows) == pytest.approx(len(ROWS))
    assert {r.type: r.weight for r in rows}["INTJ"] == pytest.approx(6 / (3 * 3))


def test_top_k_per_group_cuts_before_the_shuffle(corpus):
    df = topk.top_k_per_group(corpus, "type", [corpus.doc_id], 1)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("WindowGroupLimit") == 2 and p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_hot_term_plan_broadcasts_only_the_bounded_side(corpus):
    p = features.tfidf_table(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10000" in p and "CartesianProduct" not in p
    # the union of common and rare cells is already placed by text
    assert "Exchange" not in p[: p.index("Union")]


@pytest.mark.parametrize("hot", [0, 1, 2, 100])
def test_tfidf_does_not_depend_on_the_hot_split(corpus, hot):
    want = {(r.doc_id, r.term): r.weight for r in features.tfidf_table(corpus).collect()}
    got = {(r.doc_id, r.term): r.weight for r in features.tfidf_table(corpus, hot_terms=hot).collect()}
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}
    for doc in {d for d, _ in got}:
        assert sum(w * w for (d, _), w in got.items() if d == doc) == pytest.approx(1.0)


def test_document_terms(corpus):
    got = {(r.doc_id, r.term): r.n for r in features.document_terms(corpus, ["doc_id"], "posts").collect()}
    want = {(i, t): n for i, _, text in ROWS for t, n in Counter(text.split()).items()}
    assert got == want


# --- evaluation ---------------------------------------------------------------

CASES = {
    "plain": [(0, 0), (0, 1), (1, 1), (2, 2), (2, 0)],
    "never predicted": [(0, 0), (1, 0), (1, 0)],
    "never true": [(0, 0), (0, 2)],
    "one class": [(1, 1), (1, 1)],
}


@pytest.mark.parametrize("name", CASES)
def test_report_by_hand(spark, name):
    pairs = CASES[name]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    classes = sorted({c for p in pairs for c in p})
    rows = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert set(rows) == {str(c) for c in classes} | {"accuracy", "macro avg", "weighted avg"}
    f1s, supports = [], []
    for c in classes:
        tp = sum(t == p == c for t, p in pairs)
        predicted = sum(p == c for _, p in pairs)
        true = sum(t == c for t, _ in pairs)
        r = rows[str(c)]
        assert r.precision == pytest.approx(tp / predicted if predicted else 0)
        assert r.recall == pytest.approx(tp / true if true else 0)
        f1s.append(2 * tp / (predicted + true))
        supports.append(true)
        assert r.f1 == pytest.approx(f1s[-1]) and r.support == true
    accuracy = sum(t == p for t, p in pairs) / len(pairs)
    assert rows["accuracy"].f1 == pytest.approx(accuracy)
    assert evaluate.accuracy(df).first()[0] == pytest.approx(accuracy)
    both = evaluate.f1_scores(df).first()
    assert both.macro_f1 == pytest.approx(sum(f1s) / len(f1s))
    assert both.weighted_f1 == pytest.approx(sum(f * s for f, s in zip(f1s, supports)) / len(pairs))
    matrix = {(r.label, r.prediction): r.n for r in evaluate.confusion_matrix(df).collect()}
    assert matrix == {(a, b): pairs.count((a, b)) for a in classes for b in classes}


def test_log_loss(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [1.0, 0.0])], "label int, probability array<double>")
    want = (-math.log(0.5 + 1e-10) - math.log(1e-10)) / 2
    assert evaluate.log_loss(df).first()[0] == pytest.approx(want)


def test_missing_values_in_evaluation(spark):
    """A missing prediction is a miss, a missing label no row, a label off the array a certain loss."""
    from labeltext.constants import LOG_LOSS_EPSILON

    df = spark.createDataFrame([(0, 0), (1, None), (1, 1), (None, 1)], "label int, prediction int")
    assert evaluate.accuracy(df).first()[0] == pytest.approx(2 / 3)
    report = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["f1"] == pytest.approx(2 / 3) and report["1"]["recall"] == 0.5
    cells = {(r.label, r.prediction): r.n for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1, (1, None): 1}
    p = spark.createDataFrame([(0, [0.5, 0.5]), (5, [0.5, 0.5]), (None, [1.0])], "label int, probability array<double>")
    want = (-math.log(0.5 + LOG_LOSS_EPSILON) - math.log(LOG_LOSS_EPSILON)) / 2
    assert evaluate.log_loss(p).first()[0] == pytest.approx(want)


def test_rows_without_a_class(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "type string")
    assert [tuple(r) for r in stats.class_distribution(df).collect()] == [("a", 1, 50.0), ("b", 1, 50.0)]
    assert {r.type: r.weight for r in stats.class_weights(df).collect()} == {"a": 1.0, "b": 1.0}


def test_dedup_is_hash_based(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, None, "c"), (4, "", "d"), (5, None, "e")], "id long, k string, v string")
    first = dedup_first(df, "k", "id")
    assert sorted(r.id for r in first.collect()) == [1, 3, 4] and first.columns == ["id", "k", "v"]
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
