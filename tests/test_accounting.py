"""Observed counts equal the funnel's; the corpus written is that of the plain job."""

import pytest

from labeltext.plans import funnel, prepare_corpus, write_accounted
from registry.inputs import LEAK_WORDS, posts as table_posts


def counts(df):
    return [tuple(r)[:5] for r in df.select("step_no", "step", "rows_before", "rows_after", "removed").orderBy("step_no").collect()]


@pytest.mark.parametrize("ordered", [True, False])
def test_equals_funnel(spark, tmp_path, ordered):
    raw = table_posts(spark, "/root/testdata/sf0.001")
    raw = raw.unionByName(raw)  # every raw text twice
    path = str(tmp_path / "corpus")
    accounts = write_accounted(raw, path, mention_vocab=LEAK_WORDS, ordered=ordered)
    assert counts(accounts) == counts(funnel(raw, mention_vocab=LEAK_WORDS))
    assert min(r.seconds for r in accounts.collect()) > 0
    want = [tuple(r) for r in prepare_corpus(raw, mention_vocab=LEAK_WORDS, ordered=False).collect()]
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(want)


def test_odd_rows_and_clashing_names(spark, tmp_path):
    long = "quick brown foxes jump over lazy dogs while seven clever wizards mix potions near old rivers today "
    rows = [(1, "ISTP", None, "x"), (None, "ISTP", long, "x"), (3, None, long, None), (4, "entj", long, "y"),
            (5, "entj", "", "y"), (6, "infp", long + " intj", "z"), (7, "enfp", long.upper(), "z")]
    raw = spark.createDataFrame(rows, "row_id bigint, author_flair_text string, body string, _text string")
    for name, df in (("full", raw), ("none", raw.limit(0)), ("false", raw.filter("false")),
                     ("blank", raw.where("row_id = 5")), ("unlabelled", raw.where("row_id = 3").repartition(3))):
        accounts = write_accounted(df, str(tmp_path / name))
        assert counts(accounts) == counts(funnel(df)), name
