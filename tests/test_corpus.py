import random

import pytest
from pyspark.sql import functions as F

from labeltext.functions import text as tx
from labeltext.operators import dedup, filters
from labeltext.plans import funnel, prepare_corpus
from labeltext.sources import read_corpus, read_posts, write_corpus

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()


def long_text(extra=""):
    return " ".join(WORDS) + extra


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (7, "x intj", long_text()), (3, "entp here", long_text()),          # same body, first wins
        (5, "ISFP", long_text("!!!")),                                      # same cleaned text, later
        (9, "enfj", long_text(" one")), (8, None, long_text(" two")),
        (10, "esfj", "I am an INTP " + long_text()), (11, "esfj", " \n"), (12, "esfj", None),
        (13, "istp", "too short"), (14, "istp", " ".join(["w"] * 1001)),
        (15, "istp", long_text(" three")), (16, "estj", long_text(" THREE 3")),
    ]
    # A third of all rows are copies of one text.
    rows += [(100 + i, "infp", long_text(" hot")) for i in range(len(rows) // 2)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "row_id long, author_flair_text string, body string")


def stepwise(posts):
    """The same chain one operator at a time, with the count after each."""
    counts = [posts.count()]
    df = filters.drop_unlabelled(filters.extract_label(posts, "author_flair_text"))
    counts.append(df.count())
    df = filters.drop_mentions(df, "body")
    counts.append(df.count())
    df = filters.drop_blank(df.withColumn("body", tx.as_text(F.col("body"))), "body")
    counts.append(df.count())
    df = dedup.dedup_first(df, "body", "row_id")
    counts.append(df.count())
    df = df.withColumn("posts", tx.clean_text(F.col("body")))
    df = filters.filter_word_range(df, "posts")
    counts.append(df.count())
    df = dedup.dedup_first(df.select("row_id", "type", "posts"), "posts", "row_id")
    counts.append(df.count())
    return filters.select_corpus(dedup.sort_by_text(df)), counts


def test_prepare_corpus(posts):
    got = [tuple(r) for r in prepare_corpus(posts).collect()]
    assert got == [
        ("ENTP", long_text()), ("INFP", long_text(" hot")), ("ENFJ", long_text(" one")),
        ("ISTP", long_text(" three")),
    ]


def test_one_pass_equals_the_steps(posts):
    want, counts = stepwise(posts)
    assert sorted(prepare_corpus(posts, ordered=False).collect()) == sorted(want.collect())
    rows = funnel(posts).orderBy("step_no").collect()
    assert [rows[0].rows_before] + [r.rows_after for r in rows] == counts
    assert all(r.removed == r.rows_before - r.rows_after for r in rows)


def test_funnel_of_nothing(posts):
    rows = funnel(posts.filter("false")).collect()
    assert [(r.rows_before, r.rows_after) for r in rows] == [(0, 0)] * 6


def test_column_names_are_parameters(posts):
    assert prepare_corpus(posts, label="label", text="POST").columns == ["label", "POST"]


def test_dedup_first_does_not_depend_on_partitioning(posts):
    want = sorted(dedup.dedup_first(posts, "body", "row_id").collect(), key=lambda r: r.row_id)
    for n in (1, 3, 8):
        got = dedup.dedup_first(posts.repartition(n), "body", "row_id").collect()
        assert sorted(got, key=lambda r: r.row_id) == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_one_text_shuffle_and_no_python(posts):
    p = plan(prepare_corpus(posts, ordered=False))
    assert p.count("Exchange") == 1
    assert "SortAggregate" not in p and "Python" not in p and "HashAggregate" in p
    # the cleaning chain is evaluated once
    assert p.count(r"\1{2,}") == 1
    assert plan(prepare_corpus(posts)).count("Exchange") == 2


def test_unescape_is_the_only_python(posts):
    assert "ArrowEvalPython" in plan(prepare_corpus(posts, "basic"))
    assert "ArrowEvalPython" not in plan(prepare_corpus(posts, "model"))


def test_csv_round_trip(spark, tmp_path):
    rows = [
        (0, "a", 'he said "hi", twice'), (1, None, "line\nbreak\r\nend "), (2, "NA", ""),
        (3, "null", "back\\slash \\n"), (4, "x", " lead"), (5, "y", "é"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, author_flair_text string, body string")
    write_corpus(df, str(tmp_path / "csv"))
    back = read_posts(spark, str(tmp_path / "csv"), id_from="doc_id").orderBy("row_id").collect()
    got = [tuple(r) for r in back]
    # an empty field reads as missing, "NA" stays text
    assert got == [(i, f, b or None) for i, f, b in rows]


def test_read_keeps_file_order(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text('other,author_flair_text,body\n' + "".join(f'z,t{i},"b\n{i}"\n' for i in range(50)))
    rows = read_posts(spark, str(path), partitions=4).orderBy("row_id").collect()
    assert [r.author_flair_text for r in rows] == [f"t{i}" for i in range(50)]
    assert rows[3].body == "b\n3"


def test_corpus_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "INTJ", "a b"), (2, "ESFP", "c\nd")], "doc_id long, type string, posts string")
    for fmt in ("csv", "parquet", "orc", "json"):
        write_corpus(df, str(tmp_path / fmt), fmt)
        back = read_corpus(spark, str(tmp_path / fmt), fmt, id_from="doc_id")
        assert sorted(back.collect()) == sorted(df.collect())


def test_first_in_file_over_unequal_files(spark, tmp_path):
    """The small file comes first by name, though Spark reads the large one first."""
    from labeltext.sources import read_posts

    folder = tmp_path / "posts"
    folder.mkdir()
    (folder / "a.csv").write_text('author_flair_text,body\nINTJ,same body\n')
    rows = ["ENFP,same body"] + [f"ENFP,other body {i}" for i in range(5000)]
    (folder / "b.csv").write_text("author_flair_text,body\n" + "\n".join(rows) + "\n")
    posts = read_posts(spark, str(folder))
    first = posts.filter("body = 'same body'").orderBy("row_id").collect()
    assert [r.author_flair_text for r in first] == ["INTJ", "ENFP"]
    assert posts.select("row_id").distinct().count() == 5002
    posts.drop("row_id").repartitionByRange(3, "body").write.parquet(str(tmp_path / "p"))
    again = read_posts(spark, str(tmp_path / "p"), "parquet")
    assert again.select("row_id").distinct().count() == 5002
