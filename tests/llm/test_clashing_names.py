"""Extra columns that have the names operators use for their own."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from labeltext.llm import mixing, neardup, secrets, toxicity
from labeltext.llm.queries import SOURCE_PARTS

NAMES = (
    "base total slot due release first_frame last_frame source_ _source _group _digest _at _j _frame _block _slot _offset "
    "blob _blob _findings findings rule spans row own _text key _key _dropped block n share before _before _toxicity _scored "
    "score position _file _n _start _place doc.id"
).split()


@pytest.fixture(scope="module")
def named_docs(odd_docs):
    bare = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    return bare.select("*", *(F.concat(F.lit(n + " of "), F.col("doc_id").cast("string")).alias(n) for n in NAMES))


def kept(df, names=None):
    return sorted((tuple(r) for r in df.select(*(F.col(f"`{c}`") for c in names or df.columns)).collect()), key=repr)


def test_interleave_keeps_every_column(named_docs):
    got = mixing.interleave(named_docs, SOURCE_PARTS)
    assert got.columns == [*named_docs.columns, *mixing.result_names(named_docs.columns).values()]
    assert kept(got, named_docs.columns) == kept(named_docs)


def test_redaction_keeps_every_column(named_docs):
    got = secrets.redact_documents(named_docs)
    others = [c for c in named_docs.columns if c != "text"]
    assert got.columns == named_docs.columns and kept(got, others) == kept(named_docs, others)
    texts = [r["text"] for r in got.select("text").collect() if r["text"]]
    assert any("[secret]" in t for t in texts) and not any("abcdef0123" in t for t in texts)


def test_copies_go_and_columns_stay(named_docs):
    got = neardup.drop_near_duplicates(named_docs)
    assert got.columns == named_docs.columns
    assert {r[0] for r in kept(got)} == {None, 0, 1, 2, 3, 4, 5, 6, 8, 9, 11, 12}
    assert set(kept(got)) <= set(kept(named_docs))


def test_pipeline_keeps_every_column(spark, named_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = named_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        docs = corpus_pipeline.materialize(out, "stage")
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(r["position"] for r in last) == list(range(len(last))) and len(last) == docs.count()


def test_pipeline_of_an_empty_table(spark, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "stage")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect() == []


def test_a_model_without_features_condemns_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i} other{i}") for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0, int(i < 25)) for i in range(30)], "doc_id bigint, quality int, toxic int")
    model = toxicity.trained(docs, labels)
    scores = [r["score"] for r in toxicity.score(docs, model).collect()]
    assert len(scores) == 40 and max(scores) < toxicity.THRESHOLD
