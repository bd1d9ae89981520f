import math

import pytest
from pyspark.sql import functions as F

from labeltext.functions import arrays as ar
from labeltext.operators import features, scoring, sequences


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(2, "b a a"), (1, "c b, a"), (3, ""), (4, "c zz Don't"), (5, None)]
    return spark.createDataFrame(rows, "doc_id long, posts string")


def test_vocab_ties_by_first_appearance(corpus):
    vocab = {r.word: r.idx for r in sequences.fit_sequence_vocab(corpus).collect()}
    assert vocab == {"a": 2, "c": 3, "b": 4, "zz": 5, "don't": 6}
    small = {r.word for r in sequences.fit_sequence_vocab(corpus, num_words=4).collect()}
    assert small == {"a", "c"}


def test_vocab_aggregate_is_hash_based(corpus):
    p = sequences.fit_sequence_vocab(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in p


def encoded(df, col="seq"):
    return {r.doc_id: list(r[col]) for r in df.collect() if r[col] is not None}


def test_encode_in_row_equals_join(corpus):
    filled = corpus.fillna("", ["posts"])
    vocab = sequences.fit_sequence_vocab(filled, num_words=5)
    want = {1: [3, 4, 2], 2: [4, 2, 2], 3: [], 4: [3, 1, 1], 5: []}
    assert encoded(sequences.encode_sequences(filled, vocab, num_words=5)) == want
    plan = sequences.encode_sequences(filled, vocab, num_words=5)._jdf.queryExecution()
    outer = plan.executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in outer and "Join" not in outer
    assert encoded(sequences.encode_sequences(filled, vocab, num_words=5, method="join")) == want


def test_both_methods_on_repeated_ids_and_nulls(spark):
    rows = [(1, "a b a"), (1, "c"), (2, None), (3, ""), (None, "b"), (1, "a b a")]
    df = spark.createDataFrame(rows, "doc_id long, posts string")
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "word string, idx int")
    got = [
        sorted(sequences.encode_sequences(df, vocab, method=m).collect(), key=str) for m in ("row", "join")
    ]
    assert got[0] == got[1]
    assert sorted(str(r.seq) for r in got[0]) == sorted(map(str, [[2, 3, 2], [1], None, [], [3], [2, 3, 2]]))
    with pytest.raises(ValueError):
        sequences.encode_sequences(df, vocab, method="other")


@pytest.mark.parametrize("maxlen", [1, 2, 3, 5])
def test_pad(corpus, maxlen):
    filled = corpus.fillna("", ["posts"])
    vocab = sequences.fit_sequence_vocab(filled)
    full = encoded(sequences.encode_sequences(filled, vocab))
    want = {i: (s[-maxlen:] + [0] * maxlen)[:maxlen] for i, s in full.items()}
    cut_first = sequences.encode_sequences(filled, vocab, maxlen=maxlen, pad=True)
    cut_last = sequences.pad_sequences(sequences.encode_sequences(filled, vocab), maxlen=maxlen)
    assert encoded(cut_first) == encoded(cut_last) == want


def test_summary(corpus):
    row = sequences.encoding_summary(corpus, maxlen=50).first()
    assert row.train_rows + row.val_rows == 5
    assert row.vocab_size == 6 and row.max_length == 50


def test_split_is_stable(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    first = {r.doc_id for r in features.split_train_val(df).filter("is_val").collect()}
    again = features.split_train_val(df.repartition(7, F.rand(1))).filter("is_val").collect()
    assert first == {r.doc_id for r in again}
    assert 0.19 < len(first) / 20_000 < 0.21
    assert features.split_train_val(df, seed=1).filter("is_val").count() != 0
    assert features.split_threshold(1.0) == "ffffffff"


def test_labels_alphabetical_and_back(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "type string")
    coded = features.encode_labels(df)
    assert sorted((r.type, r.label) for r in coded.collect()) == [("a", 0), ("a", 0), ("b", 1), ("c", 2)]
    back = features.decode_labels(coded, ["a", "b", "c"], "label", "again")
    assert all(r.type == r.again for r in back.collect())


def test_softmax_and_ranked(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0, 0.0],), ([1000.0, 1001.0, 0.0, 5.0],)], "a array<double>")
    for r in df.select("a", ar.softmax(F.col("a")).alias("p")).collect():
        m = max(r.a)
        e = [math.exp(x - m) for x in r.a]
        assert list(r.p) == [pytest.approx(x / sum(e)) for x in e]
    top = df.select(ar.ranked(F.col("a"), 3).alias("t"), ar.arg_max(F.col("a")).alias("i")).first()
    assert [e.idx for e in top.t] == [1, 2, 0] and top.i == 1


def test_alternatives_threshold(spark):
    rows = [
        (1, [0.69, 0.21, 0.10]), (2, [0.70, 0.2, 0.1]), (3, [0.71, 0.2, 0.09]),
        (4, [0.1, 0.1, 0.4, 0.4]),
    ]
    df = spark.createDataFrame(rows, "id int, probability array<double>")
    scored = scoring.score_probabilities(df, ["INTJ", "INTP", "zz", "ENTJ"])
    best = {r.id: (r.predicted_type, r.description.split(" ")[0]) for r in scored.collect()}
    assert best[1] == ("INTJ", "Architect") and best[4] == ("zz", "No")
    alt = scoring.alternatives(scored, ["id"], ["INTJ", "INTP", "zz", "ENTJ"]).orderBy("id", "rank")
    got = [(r.id, r.rank, r.alternative, round(r.confidence, 6)) for r in alt.collect()]
    assert got == [(1, 2, "INTP", 21.0), (1, 3, "zz", 10.0), (4, 2, "ENTJ", 40.0), (4, 3, "INTJ", 10.0)]
    assert "Exchange" not in scoring.alternatives(scored, ["id"], ["a"])._jdf.queryExecution().executedPlan().toString()
