import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from labeltext import sources
from labeltext.functions import text as tx
from labeltext.operators import classify as cl
from labeltext.operators import evaluate, features, scoring, sequences
from labeltext.plans import run_experiment
from labeltext.streaming import read_text_stream, score_stream
from labeltext.timing import Timings
from registry.inputs import by_language

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return by_language(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def data(docs):
    return cl.prepare_features(docs, max_features=300)


@pytest.fixture(scope="module")
def lr(data):
    return cl.train_lr(data, "tuned", max_iter=20)


def majority(corpus):
    rows = corpus.validation.groupBy("label").count().collect()
    return max(r["count"] for r in rows) / sum(r["count"] for r in rows)


def test_vectors_equal_the_long_table(docs):
    unlimited = cl.prepare_features(docs, max_features=None)
    cells = features.vector_cells(unlimited.data, "features", ["doc_id"])
    vocab = unlimited.stages[1].vocabulary
    got = {(r.doc_id, vocab[r.idx]): r.value for r in cells.collect()}
    cleaned = docs.withColumn("posts", tx.clean_text(docs.posts, "model"))
    want = {(r.doc_id, r.term): r.weight for r in features.tfidf_table(cleaned).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in got) < 1e-9


def test_fit_on_train_sees_only_training_rows(docs):
    parts = features.split_train_val(docs)
    train = cl.prepare_features(docs, max_features=None, fit_on="train").stages[1].vocabulary
    assert len(train) < len(cl.prepare_features(docs, max_features=None).stages[1].vocabulary)
    assert parts.filter("is_val").count() > 0


def test_class_weights_reach_the_rows(data):
    train = data.train.agg({"weight": "sum"}).first()[0]
    assert train == pytest.approx(data.train.count())


def test_lr_beats_the_majority_and_is_stable(data, lr):
    reached = evaluate.accuracy(lr.transform(data.validation)).first()[0]
    assert reached > majority(data)
    again = cl.train_lr(data, "tuned", max_iter=20)
    assert np.allclose(lr.coefficientMatrix.toArray(), again.coefficientMatrix.toArray())


def test_presets():
    assert cl.LR_PRESETS["base"]["maxIter"] == 1000 and cl.LR_PRESETS["tuned"]["maxIter"] == 300
    assert cl.RF_PRESETS["tuned"] == {"numTrees": 100, "maxDepth": 15, "minInstancesPerNode": 2}


@pytest.mark.parametrize(
    "model,options",
    [("rf", {"num_trees": 20}), ("rf_svd", {"svd_k": 8, "num_trees": 20}),
     ("mlp", {"svd_k": 8, "max_iters": (5, 30)})],
)
def test_other_models_beat_the_majority(docs, model, options):
    corpus, _, predictions = run_experiment(docs, model, max_features=200, **options)
    assert evaluate.accuracy(predictions).first()[0] > majority(corpus)


def test_hashed_terms_lose_nothing(docs):
    """All terms share the columns: every text has as much weight as it has distinct columns."""
    data = cl.prepare_features(docs, hashed=64)
    assert data.data.count() == docs.count()
    assert data.data.first()["features"].size == 64
    corpus, _, predictions = run_experiment(docs, "lr", hashed=512, max_iter=30)
    assert evaluate.accuracy(predictions).first()[0] > majority(corpus)


def test_rows_without_a_label_are_left_out(spark, docs):
    more = docs.unionByName(docs.limit(1).selectExpr("doc_id + 1000000 AS doc_id", "cast(null AS string) AS type", "posts"))
    assert cl.prepare_features(more, max_features=50).data.count() == docs.count()


def test_corpus_feeds_the_model_jobs(spark):
    from labeltext.plans import prepare_corpus
    from registry.inputs import LEAK_WORDS, posts

    corpus = prepare_corpus(posts(spark, SF_DIR), mention_vocab=LEAK_WORDS, lo=1, keep_id=True)
    _, _, predictions = run_experiment(corpus, "lr", id_col="row_id", max_features=100, max_iter=5)
    assert predictions.count() > 0


def test_unknown_model(docs):
    with pytest.raises(ValueError):
        run_experiment(docs, "other", max_features=10)


@pytest.mark.parametrize("route", ["gram", "randomised"])
def test_svd_equals_numpy(data, route):
    close = 1e-6 if route == "gram" else 1e-3
    rows = data.train.select(vector_to_array("features").alias("v")).collect()
    dense = np.array([r.v for r in rows])
    sigma = np.linalg.svd(dense, compute_uv=False)[:5]
    model = features.TruncatedSvd(5, passes=8, solver=route).fit(data.train)
    assert np.allclose(model.singular_values, sigma, rtol=close)
    assert np.allclose(model.components.T @ model.components, np.eye(5), atol=1e-9)
    projected = np.array([
        r.v for r in model.transform(data.train).select(vector_to_array("svd").alias("v")).collect()
    ])
    # signs are free, inner products are not
    best = dense @ model.components
    assert np.allclose(projected @ projected.T, best @ best.T, atol=1e-8)
    assert np.allclose(np.linalg.norm(projected, axis=0), sigma, rtol=close)


def test_too_large_vocabulary_is_refused(docs, monkeypatch):
    monkeypatch.setattr(features, "MAX_VOCABULARY_TERMS", 10)
    with pytest.raises(ValueError, match="max_features"):
        features.fit_idf(docs, "posts", None)


def test_saved_model_scores_the_same_in_batch_and_stream(spark, docs, data, lr, tmp_path):
    model = cl.scoring_pipeline(data, lr)
    sources.save_model(model, str(tmp_path / "m"), data.classes)
    loaded = sources.load_model(str(tmp_path / "m"))
    classes = sources.load_classes(spark, str(tmp_path / "m"))
    assert classes == data.classes

    talk = spark.read.parquet(f"{SF_DIR}/conversations.parquet").withColumnRenamed("text", "posts")
    talk = talk.select("conv_id", "turn", "posts").unionByName(
        spark.createDataFrame([(-1, 0, " \n "), (-2, 0, None)], "conv_id long, turn long, posts string")
    )
    talk.repartition(5).write.parquet(str(tmp_path / "in"))

    def rows(df):
        return sorted(
            (r.conv_id, r.turn, r.predicted_type, round(r.confidence, 9), r.description)
            for r in df.collect()
        )

    batch = rows(scoring.score_texts(model, talk, classes))
    assert len(batch) == talk.count() - 2  # empty input is refused
    assert rows(scoring.score_texts(loaded, talk, classes)) == batch
    stream = read_text_stream(spark, str(tmp_path / "in"), talk.schema, files_per_batch=2)
    q = score_stream(loaded, stream, classes, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == batch


def test_encoders_round_trip(spark, docs, tmp_path):
    vocab = sequences.fit_sequence_vocab(docs, num_words=50)
    sources.save_encoders(vocab, ["a", "b"], str(tmp_path / "e"))
    back, classes = sources.load_encoders(spark, str(tmp_path / "e"))
    assert classes == ["a", "b"] and sorted(back.collect()) == sorted(vocab.collect())


def test_report_round_trip(spark, data, lr, tmp_path):
    report = evaluate.classification_report(lr.transform(data.validation))
    sources.write_report(report, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == report.count()


def test_timings():
    t = Timings()
    with t.timed("a"):
        math.sqrt(2)
    with t.timed("a"):
        pass
    assert list(t) == ["a"] and t["a"] >= 0
