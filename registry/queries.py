"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.functions import arrays as ar
from labeltext.functions import text as tx
from labeltext.operators import classify as cl
from labeltext.operators import decompose, dedup, evaluate, features, filters, scoring, sequences, stats
from labeltext.operators.topk import build_vocab as build_vocab_of
from labeltext.plans import evaluate_experiment, run_experiment, funnel as funnel_of, prepare_corpus as prepare, write_accounted
from labeltext.session import materialize, scratch_path
from labeltext.operators.neural import fit_sequences
from labeltext.sources import ArtifactStore, read_corpus, read_posts, write_corpus, write_report
from labeltext.streaming import read_text_stream, score_stream_by_version, scored_batches
from registry.inputs import (
    CLASS_NAMES,
    LEAK_WORDS,
    by_language,
    corpus,
    posts,
    predictions,
    table,
    texts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks --------------------------------------------------------

@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    raw = texts(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id", "source AS author_flair_text", "text AS body"
    )
    write_corpus(raw, path)
    return read_posts(spark, path, id_from="doc_id")


#: What a task reads of a file in the queries on splits; small, so that records cross many borders.
CSV_SPLIT = 512 << 10


@query
def csv_split_roundtrip(spark, sf_dir):
    """Posts with quotes and line breaks, their files read by many tasks each."""
    path = scratch_path(spark, "csv")
    raw = texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.col("source").alias("author_flair_text"),
        F.concat(F.lit('"'), F.replace(F.col("text"), F.lit(" "), F.lit("\n")), F.lit('",\n')).alias("body"))
    write_corpus(raw, path)
    return read_posts(spark, path, id_from="doc_id", split=True, split_bytes=CSV_SPLIT)


@query
def corpus_split_rows(spark, sf_dir):
    """The cleaned corpus as read back from split files: rows, different row numbers and texts per class."""
    path = scratch_path(spark, "csv")
    write_corpus(prepare(posts(spark, sf_dir), mention_vocab=LEAK_WORDS, ordered=False), path)
    read = read_corpus(spark, path, split=True, split_bytes=CSV_SPLIT)
    return read.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("numbers"),
        F.sum(F.char_length("posts")).alias("chars"), F.min(F.md5("posts")).alias("least"))


@query
def encoders_roundtrip(spark, sf_dir):
    """The second of two saved sequence vocabularies, as read back."""
    store = ArtifactStore(spark, scratch_path(spark, "store"))
    for n in (100, 1000):
        store.save({"vocabulary": sequences.fit_sequence_vocab(corpus(spark, sf_dir), num_words=n)})
    return store.table("vocabulary")


@query
def report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = classification_report(spark, sf_dir)
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


def _saved_models(spark, sf_dir):
    """Two versions of a saved language model, the newer one better; its corpus."""
    data = cl.prepare_features(by_language(spark, sf_dir), max_features=500)
    store = ArtifactStore(spark, scratch_path(spark, "store"))
    names = spark.createDataFrame(list(enumerate(data.classes)), "label int, type string")
    for steps in (1, 30):
        model = cl.scoring_pipeline(data, cl.train_lr(data, "tuned", max_iter=steps))
        store.save({"classes": names}, {"model": model})
    return data, model, store


@query
def model_roundtrip(spark, sf_dir):
    """Whether the newest saved model scores every conversation turn as it did before it was saved."""
    data, model, store = _saved_models(spark, sf_dir)
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("posts"))
    version, loaded = store.model("model")
    scored = [scoring.score_texts(m, talk, data.classes) for m in (model, loaded)]
    a, b = (s.select("conv_id", "turn", F.col("predicted_type").alias(f"t{i}"), F.col("confidence").alias(f"c{i}"))
            for i, s in enumerate(scored))
    same = (F.col("t0") == F.col("t1")) & (F.abs(F.col("c0") - F.col("c1")) < 1e-9)
    return a.join(b, ["conv_id", "turn"], "full").select("conv_id", "turn", F.lit(version).cast("bigint").alias("version"), F.coalesce(same, F.lit(False)).alias("same"))


@query
def score_stream(spark, sf_dir):
    """Turns scored as a stream of batches with the newest model, against the same scored at once."""
    data, model, store = _saved_models(spark, sf_dir)
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("posts"))
    source, out, checkpoint = (scratch_path(spark, n) for n in ("stream", "scored", "stream-checkpoint"))
    talk.repartition(4, "conv_id").write.parquet(source)
    stream = read_text_stream(spark, source, talk.schema, files_per_batch=2)
    score_stream_by_version(store, stream, out, checkpoint).awaitTermination()
    streamed = scored_batches(spark, out).select("conv_id", "turn", "version", F.col("predicted_type").alias("streamed"))
    at_once = scoring.score_texts(model, talk, data.classes).select("conv_id", "turn", "predicted_type")
    both = at_once.join(streamed, ["conv_id", "turn"], "full")
    return both.select("conv_id", "turn", "version", F.coalesce(F.col("streamed") == F.col("predicted_type"), F.lit(False)).alias("same"))


# --- labels and row filters ---------------------------------------------------

@query
def extract_label(spark, sf_dir):
    return filters.extract_label(posts(spark, sf_dir), "author_flair_text").select(
        "row_id", "author_flair_text", "type"
    )


@query
def extract_label_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    vocab = ("URGENT", "HIGH", "MEDIUM", "LOW")
    labelled = filters.extract_label(orders, "o_orderpriority", vocab, "priority")
    return labelled.select("o_orderkey", "priority")


@query
def drop_unlabelled(spark, sf_dir):
    labelled = filters.extract_label(posts(spark, sf_dir), "author_flair_text")
    return filters.drop_unlabelled(labelled).select("row_id", "type")


@query
def drop_mentions(spark, sf_dir):
    return filters.drop_mentions(posts(spark, sf_dir), "body", LEAK_WORDS).select("row_id", "body")


@query
def drop_blank(spark, sf_dir):
    # Text without its letters: some rows are left with white space only.
    bare = texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.regexp_replace("text", r"[\p{L}\p{N}.,|]", "").alias("rest")
    )
    return filters.drop_blank(bare, "rest")


@query
def word_count(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id")
    return docs.select("doc_id", tx.word_count(F.col("text")).alias("words"))


@query
def filter_word_range(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id")
    return filters.filter_word_range(docs, "text").select("doc_id", "n_chars")


@query
def axis_label(spark, sf_dir):
    # Two of the classes are read as the axis letters; the rest has none.
    docs = table(spark, sf_dir, "documents").select("doc_id", F.upper("lang").alias("code"))
    return filters.axis_label(docs, "code", 1, "D", "E")


@query
def select_corpus(spark, sf_dir):
    return filters.select_corpus(corpus(spark, sf_dir))


@query
def prepare_corpus(spark, sf_dir):
    return prepare(posts(spark, sf_dir), mention_vocab=LEAK_WORDS)


@query
def prepare_corpus_pages(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id").select(
        F.col("page_id").alias("row_id"),
        F.concat(F.lit("istp "), F.col("url")).alias("author_flair_text"),
        F.col("html").alias("body"),
    )
    return prepare(pages, "basic", mention_vocab=LEAK_WORDS)


@query
def funnel(spark, sf_dir):
    return funnel_of(posts(spark, sf_dir), mention_vocab=LEAK_WORDS)


@query
def accounted_corpus(spark, sf_dir):
    """Rows per step as counted by the job that writes the corpus, and whether its wall time was taken."""
    accounts = write_accounted(posts(spark, sf_dir), scratch_path(spark, "corpus"), mention_vocab=LEAK_WORDS)
    return accounts.select("step_no", "step", "rows_before", "rows_after", "removed", (F.col("seconds") > 0).alias("timed"))


# --- duplicates and vocabulary ------------------------------------------------

@query
def dedup_raw(spark, sf_dir):
    return dedup.dedup_first(posts(spark, sf_dir), "body", "row_id")


@query
def dedup_clean(spark, sf_dir):
    cleaned = corpus(spark, sf_dir).select(
        "doc_id", "type", tx.clean_text(F.col("posts"), "model").alias("posts")
    )
    return dedup.sort_by_text(dedup.dedup_first(cleaned, "posts", "doc_id"))


@query
def build_vocab(spark, sf_dir):
    return build_vocab_of(stats.explode_terms(corpus(spark, sf_dir), "posts"), 1000)


# --- text ---------------------------------------------------------------------

@query
def clean_basic(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id")
    return pages.select("page_id", tx.clean_text(F.col("html"), "basic").alias("cleaned"))


@query
def clean_parallel(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id")
    return docs.select("doc_id", tx.clean_text(F.col("text"), "parallel").alias("cleaned"))


@query
def clean_model(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id")
    return docs.select("doc_id", tx.clean_text(F.col("text"), "model").alias("cleaned"))


@query
def clean_model_pages(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id")
    text = F.concat_ws(" ", "url", "html")
    return pages.select("page_id", tx.clean_text(text, "model").alias("cleaned"))


@query
def remove_stop_words(spark, sf_dir):
    words = F.split(F.lower("text"), " ")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(tx.remove_stop_words(words), " ").alias("kept")
    )


@query
def unescape_html(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id")
    return pages.select("page_id", tx.unescape_html(F.col("html")).alias("decoded"))


@query
def tokenize_words(spark, sf_dir):
    tokens = tx.tokenize_words(F.col("text"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(tokens, " ").alias("tokens")
    )


@query
def tokenize_keras(spark, sf_dir):
    tokens = tx.tokenize_keras(F.concat_ws("'", "url", "html"))
    return texts(spark, sf_dir, "pages", "page_id").select(
        "page_id", F.size(tokens).alias("n"), F.array_join(tokens, " ").alias("tokens")
    )


# --- statistics ---------------------------------------------------------------

@query
def token_counts(spark, sf_dir):
    return stats.term_counts(corpus(spark, sf_dir), "type", "posts")


@query
def class_distribution(spark, sf_dir):
    d = stats.class_distribution(corpus(spark, sf_dir))
    return d.withColumn("pct", F.round("pct", 6))


@query
def class_distribution_events(spark, sf_dir):
    d = stats.class_distribution(table(spark, sf_dir, "events"), "event_type")
    return d.withColumn("pct", F.round("pct", 6))


@query
def axis_marginals(spark, sf_dir):
    d = stats.axis_marginals(corpus(spark, sf_dir))
    return d.withColumn("pct", F.round("pct", 6))


@query
def distinct_labels(spark, sf_dir):
    return stats.distinct_labels(corpus(spark, sf_dir))


@query
def top_words(spark, sf_dir):
    return stats.top_words(corpus(spark, sf_dir))


@query
def class_tfidf(spark, sf_dir):
    return stats.class_tfidf(corpus(spark, sf_dir))


@query
def mutual_information(spark, sf_dir):
    labelled = filters.axis_label(corpus(spark, sf_dir), "type")
    return stats.mutual_information(labelled)


@query
def concat_by_group(spark, sf_dir):
    return stats.concat_by_group(table(spark, sf_dir, "conversations"), "conv_id", "text", "turn")


@query
def class_weights(spark, sf_dir):
    w = stats.class_weights(corpus(spark, sf_dir))
    return w.withColumn("weight", F.round("weight", 9))


# --- features -----------------------------------------------------------------

@query
def tfidf_table(spark, sf_dir):
    t = features.tfidf_table(corpus(spark, sf_dir))
    return t.withColumn("weight", F.round("weight", 6))


@query
def tfidf_vectors(spark, sf_dir):
    """The cells of sparse vectors over every term of the corpus."""
    vectors, _ = features.tfidf_vectors(corpus(spark, sf_dir))
    cells = F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("weight"))
    return vectors.select("doc_id", F.inline(cells)).withColumn("weight", F.round("weight", 6))


@query
def count_vectors(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    vocab = features.vocabulary_list(build_vocab_of(stats.explode_terms(docs, "posts"), 1000))
    vectors = features.count_vectors(docs, vocab)
    cells = features.vector_cells(vectors, "counts", ["doc_id"])
    return cells.select("doc_id", "idx", F.col("value").cast("long").alias("n"))


@query
def encode_labels(spark, sf_dir):
    return features.encode_labels(corpus(spark, sf_dir)).select("doc_id", "type", "label")


@query
def split_train_val(spark, sf_dir):
    return features.split_train_val(corpus(spark, sf_dir)).select("doc_id", "is_val")


@query
def svd_features(spark, sf_dir):
    """Squared lengths of the vectors of ``embeddings`` after a projection on all their singular vectors.

    Nothing is lost at full rank, so they are the lengths of the vectors.
    """
    vectors = table(spark, sf_dir, "embeddings")
    cells = vectors.select("vec_id", F.posexplode("embedding").alias("place", "weight"))
    cells = cells.where("weight <> 0").select("vec_id", F.col("place").cast("string").alias("term"), F.col("weight").cast("double"))
    width = cells.select("term").distinct().count()
    reduced = decompose.fit_svd(cells, width, "vec_id", passes=1).project(cells, "vec_id")
    squares = F.aggregate("svd", F.lit(0.0), lambda a, x: a + x * x)
    return reduced.select("vec_id", F.round(squares, 5).alias("squared_length"))


# --- sequences ----------------------------------------------------------------

@query
def sequence_vocab(spark, sf_dir):
    return sequences.fit_sequence_vocab(corpus(spark, sf_dir), num_words=1000)


@query
def encode_sequences(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    vocab = sequences.fit_sequence_vocab(docs, num_words=1000)
    coded = sequences.encode_sequences(docs, vocab, num_words=1000)
    return coded.select("doc_id", F.array_join(F.col("seq").cast("array<string>"), " ").alias("seq"))


@query
def pad_sequences(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    vocab = sequences.fit_sequence_vocab(docs)
    coded = sequences.encode_sequences(docs, vocab, maxlen=500, pad=True)
    return coded.select("doc_id", F.array_join(F.col("seq").cast("array<string>"), " ").alias("seq"))


@query
def encoding_summary(spark, sf_dir):
    return sequences.encoding_summary(corpus(spark, sf_dir))


# --- evaluation ---------------------------------------------------------------

@query
def accuracy(spark, sf_dir):
    a = evaluate.accuracy(predictions(spark, sf_dir))
    return a.select(F.round("accuracy", 9).alias("accuracy"))


@query
def classification_report(spark, sf_dir):
    r = evaluate.classification_report(predictions(spark, sf_dir))
    return r.select(
        "class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query
def f1_scores(spark, sf_dir):
    f = evaluate.f1_scores(predictions(spark, sf_dir))
    return f.select(*[F.round(c, 9).alias(c) for c in f.columns])


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(predictions(spark, sf_dir))


@query
def log_loss(spark, sf_dir):
    scored = table(spark, sf_dir, "embeddings").select(
        "label", ar.softmax(F.col("embedding")).alias("probability")
    )
    return evaluate.log_loss(scored).select(F.round("log_loss", 9).alias("log_loss"))


# --- scoring ------------------------------------------------------------------

@query
def softmax(spark, sf_dir):
    p = ar.softmax(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(p).alias("idx", "p")
    ).withColumn("p", F.round("p", 9))


def _scored_embeddings(spark, sf_dir):
    sharpened = F.transform(F.col("embedding"), lambda x: x.cast("double") * 20.0)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", ar.softmax(sharpened).alias("probability")
    )


@query
def score_probabilities(spark, sf_dir):
    names = {c: f"class {c}" for c in CLASS_NAMES[:32]}
    s = scoring.score_probabilities(_scored_embeddings(spark, sf_dir), CLASS_NAMES, descriptions=names)
    return s.select("vec_id", "predicted_type", F.round("confidence", 6).alias("confidence"),
                    "description")


@query
def alternatives(spark, sf_dir):
    names = {c: f"class {c}" for c in CLASS_NAMES[:32]}
    a = scoring.alternatives(
        _scored_embeddings(spark, sf_dir), ["vec_id"], CLASS_NAMES, descriptions=names
    )
    return a.withColumn("confidence", F.round("confidence", 6))


@query
def score_texts(spark, sf_dir):
    """Whether every scored text got a known class, its description and a confidence in range, and the class of long ones."""
    data = cl.prepare_terms(by_language(spark, sf_dir))
    model = cl.train_lr(data, "tuned")
    talk = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("posts")
    )
    names = {"en": "English", "de": "German", "fr": "French", "es": "Spanish"}
    scored = scoring.score_texts_by_terms(model, data, talk, ["conv_id", "turn"], descriptions=names)
    known = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col("predicted_type")]
    fits = F.col("confidence").between(100.0 / len(data.classes) - 1e-6, 100.0) & (F.col("description") == known)
    # letters that only one of the four languages has tell which class is right
    told = F.when(F.col("posts").rlike("[äßü]"), "de").when(F.col("posts").rlike("[ñíó]"), "es").when(
        F.col("posts").rlike("[èçêà]"), "fr")
    told = F.when(F.char_length("posts") >= 500, told)
    return scored.select(
        "conv_id", "turn", F.coalesce(fits, F.lit(False)).alias("ok"),
        F.when(told.isNotNull(), F.col("predicted_type")).alias("language"))


@query
def drop_empty_input(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return filters.drop_empty_input(talk, "text")


@query
def decode_labels(spark, sf_dir):
    coded = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return features.decode_labels(coded, CLASS_NAMES, "label", "name").select("vec_id", "name")


@query
def corpus_to_weights(spark, sf_dir):
    """Raw posts to corpus, split by the kept id, class weights of the training rows."""
    kept = prepare(posts(spark, sf_dir), mention_vocab=LEAK_WORDS, ordered=False, keep_id=True)
    train = features.split_train_val(kept, "row_id").filter(~F.col("is_val"))
    return stats.class_weights(train).withColumn("weight", F.round("weight", 9))


# --- model jobs ---------------------------------------------------------------

def _beats_majority(report: DataFrame, least: float = 0.0) -> DataFrame:
    """``(class, support, beats_majority, accurate)`` of a classification report; accurate: ``least`` or more."""
    report = materialize(report, "report")
    reached = report.filter(F.col("class") == "accuracy").agg(F.max("f1")).scalar()
    classes = report.filter(~F.col("class").isin("accuracy", "macro avg", "weighted avg"))
    majority = classes.agg(F.max("support") / F.sum("support")).scalar()
    return classes.select(
        "class", "support", (reached > majority).alias("beats_majority"), (reached >= least).alias("accurate"))


@query
def lr_eval(spark, sf_dir):
    """Classes with their support, whether accuracy reaches 0.95 and the gradient went under its limit."""
    data, model, predictions = run_experiment(by_language(spark, sf_dir), "lr")
    named = features.decode_labels(predictions, data.classes, "label", "truth")
    report = _beats_majority(evaluate.classification_report(
        features.decode_labels(named, data.classes, "prediction", "guess"), "truth", "guess"), least=0.95)
    small = model.history[-1][2] <= 1e-4
    return report.withColumn("gradient_small", F.lit(small))


@query
def sequence_eval(spark, sf_dir):
    """A classifier on padded sequences: its validation report, and whether its loss fell and the best epoch was kept."""
    docs = features.encode_labels(by_language(spark, sf_dir))
    vocab = materialize(sequences.fit_sequence_vocab(docs, num_words=2000), "vocabulary")
    coded = sequences.encode_sequences(docs, vocab, num_words=2000, maxlen=200, pad=True)
    rows = features.split_train_val(coded).select("doc_id", "seq", "label", "is_val", "type")
    rows = materialize(rows, "sequences")
    model = fit_sequences(rows, rows.select("label").distinct().count(), 2000, epochs=5, batches=4, rate=0.02)
    predicted = model.predict(rows.filter("is_val"))
    names = [r[0] for r in rows.select("type").distinct().orderBy("type").collect()]  # class-sized
    named = features.decode_labels(predicted, names, "prediction", "guess")
    report = _beats_majority(evaluate.classification_report(named, "type", "guess"), least=0.9)
    losses, kept = [h[1] for h in model.history], min(model.history, key=lambda h: h[3])[0]
    return report.withColumn("loss_falls", F.lit(losses[-1] < losses[0])).withColumn("best_kept", F.lit(kept == model.best_epoch))


@query
def rf_eval(spark, sf_dir):
    return _beats_majority(
        evaluate_experiment(by_language(spark, sf_dir), "rf"), least=0.9)


@query
def rf_svd_eval(spark, sf_dir):
    return _beats_majority(
        evaluate_experiment(by_language(spark, sf_dir), "rf_svd"), least=0.9)


@query
def mlp_eval(spark, sf_dir):
    return _beats_majority(
        evaluate_experiment(by_language(spark, sf_dir), "mlp"), least=0.9)
