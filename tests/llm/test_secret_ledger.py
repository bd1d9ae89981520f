"""Histories, rule versions and runs against a kept ledger."""

import re
from dataclasses import replace

from pyspark.sql import functions as F

from labeltext.llm import secrets

SECRET = "password = abcdef123 and AKIA" + "B" * 20


def spans(text, rule):
    return sorted((m.start(), m.end()) for m in re.finditer(rule.pattern, text or "", re.A)
                  if len(m.group(rule.group)) >= rule.least)


def brute(text):
    return sorted((a, i, b) for i, r in enumerate(secrets.RULES) for a, b in spans(text, r))


def found(df, *keys):
    return sorted((*(r[k] for k in keys), [tuple(x) for x in sorted(r.findings)]) for r in df.collect())


def test_every_version_is_scanned_and_joined_back(spark):
    rows = [(1, "clean now", ["token: zzzzzz9", SECRET, None]), (2, SECRET, []), (3, None, None), (4, "clean now", ["x"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, older array<string>")
    got = found(secrets.scan_documents(docs, history_col="older"), "doc_id", "_version")
    want = [(i, v, brute(t)) for i, text, old in rows for v, t in enumerate([text, *(old or [])])]
    assert got == want and sum(len(w[2]) for w in want) == 5


def test_second_run_scans_nothing(spark, some_docs, tmp_path):
    docs, texts = some_docs
    path = str(tmp_path / "ledger")
    first, added = secrets.scan_with_ledger(docs, path)
    blobs = len(set(texts.values()))
    assert added.count() == blobs * len(secrets.RULES)
    again, more = secrets.scan_with_ledger(docs, path)
    assert more.count() == 0
    assert found(first, "doc_id") == found(again, "doc_id") == [(i, brute(t)) for i, t in sorted(texts.items())]


def test_new_text_and_new_rule_version_alone_are_scanned(spark, tmp_path):
    path = str(tmp_path / "ledger")
    old = spark.createDataFrame([(1, SECRET), (2, "plain"), (3, "plain")], "doc_id long, text string")
    secrets.scan_with_ledger(old, path)[1].count()
    new = old.union(spark.createDataFrame([(4, SECRET + " more"), (5, SECRET)], old.schema))
    _, added = secrets.scan_with_ledger(new, path)
    assert added.select("blob").distinct().count() == 1 and added.count() == len(secrets.RULES)
    longer = (replace(secrets.RULES[0], least=30, version="2"), *secrets.RULES[1:])
    result, added = secrets.scan_with_ledger(new, path, rules=longer)
    assert {r.rule for r in added.collect()} == {"assign@2"} and added.count() == 3
    assert all(x.place != 0 for r in result.collect() for x in r.findings)  # the old version's spans are out


def test_pairs_added_twice_count_once(spark):
    docs = spark.createDataFrame([(1, SECRET)], "doc_id long, text string")
    rows = secrets.update_ledger(docs)
    twice = secrets.scan_documents(docs, ledger=rows.union(rows))
    assert found(twice, "doc_id") == [(1, brute(SECRET))]


def test_odd_rows_and_no_rows(spark, odd_docs, no_docs, tmp_path):
    want = found(secrets.scan_documents(odd_docs.where("doc_id is not null")), "doc_id")
    got, _ = secrets.scan_with_ledger(odd_docs.withColumn("_history", F.lit(1)), str(tmp_path / "odd"))
    assert got.count() == odd_docs.count()
    assert found(got.where("doc_id is not null"), "doc_id") == want
    empty, added = secrets.scan_with_ledger(no_docs, str(tmp_path / "none"))
    assert empty.count() == 0 and added.count() == 0


def test_no_python_and_no_text_shuffle_when_all_is_seen(spark, some_docs):
    docs, _ = some_docs
    ledger = secrets.update_ledger(docs)
    plan = secrets.scan(secrets.address(docs.select("text")), ledger)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
