"""HTML references in the JVM against the standard library."""

import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from labeltext.functions import text as tx

NUMBERS = [0, 1, 8, 9, 10, 11, 12, 13, 14, 31, 32, 38, 65, 126, 127, *range(128, 161), 0x2603, 0xD7FF, 0xD800, 0xDFFF, 0xE000,
           0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**7, 10**12, 2**64, 10**40]


def check(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    got = {r.i: r.u for r in df.select("i", tx.unescape_html(F.col("t")).alias("u")).collect()}
    wrong = [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if got[i] != (None if t is None else html.unescape(t))]
    assert not wrong, wrong[:5]


def test_all_names(spark):
    check(spark, [f"a&{n}b &{n}" for n in html5] + [f"&{n.rstrip(';')}x;" for n in html5] + [f"&{n.rstrip(';')}" for n in html5])


def test_numbers(spark):
    check(spark, [f"x&#{n}{e}y" for n in NUMBERS for e in (";", "", " ")] + [f"&#{x}{n:x};&#X00{n:X}z" for n in NUMBERS for x in "xX"])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_text(spark, seed):
    r = random.Random(seed)
    parts = ["&", "&&", ";", "#", "&#", "&#x", "&amp;", "&amp;lt;", "amp", "lt", "&notit;", "&notin;", "&copyx", "1f600", "65", " ", "\n", "é", "𝄞",
             "<b>", "&nosuch;", "&" + "a" * 40, "\\", "$1", "&ampamp;"]
    check(spark, ["".join(r.choice(parts) for _ in range(r.randrange(0, 14))) for _ in range(1500)] + ["", None, "&", "&;", "a&b"])


def test_no_python_in_the_plan(spark):
    df = spark.range(3).select(F.concat(F.col("id").cast("string"), F.lit("&amp;")).alias("t")).select(tx.clean_text(F.col("t"), "basic"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("EvalPython", "MapInPandas", "MapInArrow", "PythonUDF"))
