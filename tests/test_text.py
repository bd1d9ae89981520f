import pytest
from pyspark.sql import functions as F

from labeltext.functions import text as tx
from labeltext.operators import filters


def column(spark, values, expr):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


PARALLEL = {
    "Soooo coool!!! it's 123 a_b café naïve x²y": "col b caf na ve x y",
    "line one\nline two\ttab": "line one line two tab",
    "a\\nb literal": "anb literal",
    "&amp;lt; x": "amplt x",
    "foo\xa0bar\u2003baz": "foo bar baz",
    "éxact ١٢٣ words": "exact words",
    "你好 hi 世界peace": "hi peace",
    "zzzz \x1c\x1f q\x85r": "z q r",
    "The AND of": "",
    "": "",
    "nooo--- oook": "ok",
    "aabbb 1112": "aab",
    None: "nan",
}
BASIC = {
    "&amp;lt; x": "lt x",
    "a\\nb literal": "b literal",
    "&lt;p&gt; &eacute;tude &amp tail": "p tude tail",
    "one\ntwo": "one two",
    "no entities": "entities",
    "x && y &copy;": "x y",
    None: "nan",
}
MODEL = {
    "See http://x.y/z NOW <b>bold</b> Café 12": "see now bold caf",
    "www.a.b/c d": "d",
    "a <multi\nline> b": "a multi line b",
    "tail<x": "tailx",
    "foo\xa0bar": "foo bar",
    "the and of": "the and of",
    "!!!": "",
    "pre https://q?x=1\u2003post": "pre post",
    None: "nan",
}


@pytest.mark.parametrize(
    "variant,cases", [("parallel", PARALLEL), ("basic", BASIC), ("model", MODEL)]
)
def test_clean_text(spark, variant, cases):
    got = column(spark, list(cases), lambda c: tx.clean_text(c, variant))
    assert dict(zip(cases, got)) == cases


def test_clean_tokens_are_the_words_of_clean_text(spark):
    texts = [*PARALLEL, *BASIC, *MODEL]
    for variant in tx.VARIANTS:
        joined = column(spark, texts, lambda c: F.array_join(tx.clean_tokens(c, variant), " "))
        assert joined == column(spark, texts, lambda c: tx.clean_text(c, variant))


def test_stop_words_are_a_parameter(spark):
    assert column(spark, ["the cat sat"], lambda c: tx.clean_text(c, stop_words=["cat"])) == ["the sat"]
    assert column(spark, ["the cat sat"], lambda c: tx.clean_text(c, stop_words=[])) == ["the cat sat"]


def test_unknown_variant(spark):
    with pytest.raises(ValueError):
        tx.clean_tokens(F.lit("x"), "other")


def test_long_runs_do_not_overflow_the_stack(spark):
    df = spark.range(1).select(
        F.concat(F.repeat(F.lit("z"), 500_000), F.repeat(F.lit("<a"), 200_000), F.repeat(F.lit("!."), 200_000)).alias("t")
    )
    for variant in tx.VARIANTS:
        assert df.select(tx.clean_text(F.col("t"), variant)).first()[0] is not None


def test_extract_label(spark):
    cases = {
        "intj 5w4": "INTJ", "ENTP/INTJ": "ENTP", "INTJ_x": None, "xENTPx": None,
        "éINTJ": None, "INTJé isfp": "ISFP", "": None, None: None, "(esfj)": "ESFJ",
    }
    df = spark.createDataFrame([(k,) for k in cases], "flair string")
    got = {r["flair"]: r["type"] for r in filters.extract_label(df, "flair").collect()}
    assert got == cases
    kept = filters.drop_unlabelled(filters.extract_label(df, "flair")).count()
    assert kept == sum(v is not None for v in cases.values())


def test_filters(spark):
    df = spark.createDataFrame(
        [(0, None), (1, ""), (2, "\n\n"), (3, "\t"), (4, "I am an intp."), (5, "fine intpx"),
         (6, "\xa0\x1c"), (7, "\u2003 x  y\xa0")],
        "i int, t string",
    )
    assert {r.i for r in filters.drop_blank(df, "t").collect()} == {0, 4, 5, 7}
    assert {r.i for r in filters.drop_mentions(df, "t").collect()} == {0, 1, 2, 3, 5, 6, 7}
    assert [(r.i, r.t) for r in filters.drop_empty_input(df, "t").orderBy("i").collect()] == [
        (4, "I am an intp."), (5, "fine intpx"), (7, "x  y")]


def test_word_range_ends_are_included(spark):
    sizes = [0, 9, 10, 1000, 1001]
    df = spark.createDataFrame([(n, " ".join(["w"] * n)) for n in sizes], "n int, t string")
    assert sorted(r.n for r in filters.filter_word_range(df, "t").collect()) == [10, 1000]
    assert [r[0] for r in df.orderBy("n").select(tx.word_count(F.col("t"))).collect()] == sizes


def test_tokenizers(spark):
    text = "Don't stop_me NOW: x (été) a\xa0b, 42!"
    assert column(spark, [text], tx.tokenize_words)[0] == ["don", "stop_me", "now", "été", "42"]
    assert column(spark, [text], tx.tokenize_keras)[0] == [
        "don't", "stop", "me", "now", "x", "été", "a\xa0b", "42"]


def test_axis_label(spark):
    df = spark.createDataFrame([("INTJ",), ("ESFP",), ("XXXX",)], "type string")
    assert [r.y for r in filters.axis_label(df, "type").collect()] == [1, 0, None]
