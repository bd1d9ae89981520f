"""Vectors over the whole vocabulary, put together from tables."""

from pyspark.sql import functions as F

from labeltext.operators import features


def test_ids_are_dense_and_alphabetical(spark):
    words = sorted({f"w{i * 7919 % 5000}" for i in range(5000)} | {"ä", "Z", ""})
    terms = spark.createDataFrame([(w, 1) for w in reversed(words)] + [(None, 1)], "term string, df long").repartition(7)
    got = sorted((r.idx, r.term) for r in features.term_ids(terms).collect())
    assert got == list(enumerate(sorted(words, key=lambda w: w.encode())))


def test_vectors_equal_the_long_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.col("text").alias("posts"))
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "one one two")], docs.schema))
    vectors, ids = features.tfidf_vectors(docs)
    names = {r.idx: r.term for r in ids.collect()}
    want = {(r.doc_id, r.term): r.weight for r in features.tfidf_table(docs).collect()}
    got = {(r.doc_id, names[i]): w for r in vectors.collect() for i, w in zip(r.indices, r.values)}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-12
    ml = features.as_ml_vectors(vectors, len(names)).where("doc_id = -3").first().features
    assert ml.size == len(names) and len(ml.indices) >= 2 and abs(ml.norm(2) - 1) < 1e-12


def test_no_cells_no_vectors(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, posts string")
    vectors, ids = features.tfidf_vectors(docs)
    plain = {r.doc_id for r in features.tfidf_table(docs).collect()}
    assert {r.doc_id for r in vectors.collect()} == plain


def test_hot_and_rare_terms_meet(spark):
    cells = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "zz", 5.0), (2, "b", 3.0)], "doc_id long, term string, weight double")
    ids = features.term_ids(spark.createDataFrame([("b", 2), ("a", 1)], "term string, df long"))
    got = {r.doc_id: (r.indices, r.values) for r in features.sparse_vectors(cells, ids, hot_terms=1).collect()}
    assert got == {1: ([0, 1], [1.0, 2.0]), 2: ([1], [3.0])}


def test_vectors_move_cells_once(spark):
    """Texts and rare cells are placed by id once; weights and vectors are made in that place."""
    from registry.inputs import corpus

    df = corpus(spark, "/root/testdata/sf0.001")
    vectors, _ = features.tfidf_vectors(df)
    plan = vectors._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Window" in plan
    above = plan[: plan.index("Window")]
    assert "Exchange" not in above  # no shuffle between weights and vectors
    assert plan.count("Scan parquet") <= 12 and "cells-" not in plan  # no written table of cells
