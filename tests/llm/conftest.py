import pytest

#: Nulls, empty and long texts, ties, repeated rows, odd ids; extra columns with clashing names.
TEXTS = [
    None, "", "   \n", "One", "a b c d", "x " * 400, "Ünïcode ☃ 𝄞 text here", "a b c d", "secret=abcdef0123",
    "the quick brown fox jumps over the lazy dog " * 30, "the quick brown fox jumps over the lazy dog " * 30,
    "p" * 30_000, "AKIA" + "A" * 16 + " token: 'abcd' passwd = zzzzzz " + "0123456789abcdef" * 3,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", "src0" if i % 2 else None, 1, f"{i}", 0.5) for i, t in enumerate(TEXTS)]
    rows += [(3, "One", None, None, None, "again", None), (None, "a b c d", None, None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, score double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, score double"
    return spark.createDataFrame([], schema)


@pytest.fixture(scope="session")
def some_docs(spark):
    """Documents of the given tables, as Python rows too."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}
