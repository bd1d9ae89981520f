"""URL filters: rules first, then a naive Bayes verdict over segmented host and path words.

Host names run words together. Unigram counts of the pages' own words give every
name its likeliest split (Viterbi); the words of host and path are scored by a
multinomial naive Bayes model that learns from the URLs the rules decide.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.session import materialize

#: Longest word looked up in a name. Names in host names have 63 characters at most, so no
#: longer word can be in one; a longer name, which no resolver takes, is split as a whole too.
WORD_LENGTH = 63

#: Verdict, then host and path of each rule.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule whose host (or a domain above) and beginning of the path fit, or null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``(word, n)``: lower-case ASCII words of the visible text, up to WORD_LENGTH letters."""
    text = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), "<[^<>]*>", " ")
    words = F.split(lower(text), "[^a-z]+")
    rows = pages.select(F.explode(words).alias("word"))
    return rows.where(F.length("word").between(1, WORD_LENGTH)).groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, logs: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The likeliest split of ``name``: known words by ``logs[start, length]``.

    Other stretches cost ``unknown``, and ten times less likely with every letter.
    """
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        top = None
        for start in range(max(0, end - WORD_LENGTH), end):
            size = end - start
            cost = logs.get((start, size))
            cost = best[start] + (unknown - size * math.log(10) if cost is None else cost)
            if top is None or cost > top[0]:
                top = cost, start
        best.append(top[0])
        back.append(top[1])
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def segment(names: DataFrame, counts: DataFrame, total: float) -> DataFrame:
    """``(name, words)`` for distinct ``name`` of letters.

    All stretches of a name are looked up by a join, so the word list is neither
    broadcast nor bounded; a name has WORD_LENGTH of them for each of its letters at most.
    """
    places = F.sequence(F.lit(1), F.length("name"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(WORD_LENGTH), F.length("name") - F.col("start") + 1))
    spans = names.select("name", F.explode(places).alias("start")).select("name", "start", F.explode(sizes).alias("size"))
    spans = spans.select("name", "start", "size", F.expr("substring(name, start, size)").alias("word"))
    known = spans.join(counts, "word").select("name", F.struct(
        (F.col("start") - 1).alias("start"), "size", F.log(F.col("n") / F.lit(total)).alias("log")).alias("span"))
    known = known.groupBy("name").agg(F.collect_list("span").alias("spans"))
    unknown = -math.log(total)

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([
            split_name(n, {(int(s["start"]), int(s["size"])): s["log"] for s in (() if ss is None else ss)}, unknown)
            for n, ss in zip(name, spans)
        ])

    return names.join(known, "name", "left").select("name", split("name", "spans").alias("words"))


def _names(host: Column) -> Column:
    """The letter runs of a host."""
    return F.filter(F.split(host, "[^a-z]+"), lambda x: x != "")


def path_words(path: Column) -> Column:
    """Words of a path, lower case, marked as such; every run of digits is one word."""
    parts = F.split(F.regexp_replace(lower(path), "[0-9]+", "0"), r"[^\p{L}0]+")
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit("/"), x))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` for every row of ``pages``.

    ``score`` is the log odds of blocking by the model, null where a rule decides.
    URLs without ``://`` and null ones have an empty host and path and are judged
    by the model's prior. Rows with equal URLs are scored once and all returned.
    Without a URL of each kind to learn from, the model allows. Null and empty pages
    have no words; an empty table gives no rows; odds of exactly zero allow, and of
    equally likely splits the one whose last word is longest is taken, then the one
    whose word before it is, and so on. Columns other than the three named are not read.

    Word counts and model are tables joined by word; hot words and hosts are left
    to skew joins, and counts are combined before any shuffle.
    """
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    counts = materialize(word_counts(pages, html_col), "words")
    total = float(counts.agg(F.sum("n")).first()[0] or 1)

    urls = rows.groupBy("host", "path", "rule").agg(F.count("*").alias("_n"))
    hosts = urls.groupBy("host").agg(F.lit(1).alias("_one")).select("host", _names(F.col("host")).alias("names"))
    names = hosts.select(F.explode("names").alias("name")).distinct()
    split = segment(names, counts, total)
    held = hosts.select("host", F.posexplode("names").alias("at", "name")).join(split, "name")
    host_words = held.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("w"))
    host_words = host_words.select("host", F.flatten("w.words").alias("words"))

    none = F.array().cast("array<string>")
    urls = urls.join(host_words, "host", "left").withColumn(
        "tokens", F.concat(F.coalesce("words", none), path_words(F.col("path"))))
    urls = materialize(urls.select("host", "path", "rule", "_n", "tokens"), "urls")
    verdicts = F.create_map(*(x for v, r in rules for x in (F.lit(r), F.lit(v))))
    blocked = verdicts[F.col("rule")] == "block"
    tokens = urls.where(F.col("rule").isNotNull()).select(
        blocked.alias("blocked"), "_n", F.explode("tokens").alias("token"))
    model = tokens.groupBy("token").agg(
        F.sum(F.when(F.col("blocked"), F.col("_n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("blocked"), 0).otherwise(F.col("_n"))).alias("a"))
    size = model.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    n = urls.where(F.col("rule").isNotNull()).agg(
        F.sum(F.when(blocked, F.col("_n")).otherwise(0)), F.sum(F.when(blocked, 0).otherwise(F.col("_n")))).first()
    b_all, a_all, v = float(size[0] or 0), float(size[1] or 0), float(size[2] or 0)
    n_b, n_a = float(n[0] or 0), float(n[1] or 0)
    prior = math.log(n_b / n_a) if n_b and n_a else 0.0
    unseen = math.log((a_all + v + 1) / (b_all + v + 1))
    odds = model.select("token", (F.log((F.col("b") + 1) / (F.col("a") + 1)) + unseen).alias("odds"))

    open_urls = urls.where(F.col("rule").isNull()).select("host", "path", F.explode("tokens").alias("token"))
    scored = open_urls.join(odds, "token", "left").groupBy("host", "path").agg(
        (F.sum(F.coalesce("odds", F.lit(unseen))) + prior).alias("score"))
    out = rows.join(scored, ["host", "path"], "left")
    score = F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(prior)))
    by_model = F.when((score > 0) & F.lit(bool(n_b and n_a)), "block").otherwise("allow")
    return out.select(
        id_col, "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), verdicts[F.col("rule")]).otherwise(by_model).alias("verdict"),
        score.alias("score"),
    )
