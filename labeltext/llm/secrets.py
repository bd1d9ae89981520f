"""Secret scans over a ledger of blobs, in DataFrame operations only.

Every version of a text is a blob, addressed by the digest of its content. A
blob is scanned once per rule version, however many paths hold it, and not at
all if the ledger already has it. Findings are joined back to every path.

A ledger is a table ``(blob, rule, spans)`` with a row per pair that was scanned,
spans or none. ``update_ledger`` gives the rows that a run adds, ``scan_with_ledger``
keeps them in a folder from run to run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.llm.names import quoted
from labeltext.session import materialize


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: str = "1"


#: The base rules, in the order of their kinds.
BASE_RULES = (
    Rule(
        "assign",
        "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)

#: Further rules: signed web tokens, host tokens with a prefix, key blocks.
MORE_RULES = (
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40),
    Rule("prefixed", "(ghp|gho|ghs|glpat|xoxb|xoxp|sk_live)[_-][A-Za-z0-9_-]+", 0, 24),
    Rule("key_block", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)

RULES = BASE_RULES + MORE_RULES

LEDGER_SCHEMA = "blob string, rule string, spans array<struct<start:bigint,end:bigint>>"


def _fast(rule: Rule) -> str:
    """A pattern that every text with a kept match fits; cheaper than the rule's own."""
    if rule.kind == "hex":
        return "[0-9a-f]{%d}" % rule.least
    return rule.pattern


def find_spans(text: Column, rule: Rule) -> Column:
    """Array of ``(start, end)`` in code points of the rule's matches in ``text``.

    Splitting at the pattern gives what lies between the matches; running lengths
    of both give the places. A pattern of one character class and a least length
    is searched for with that length, since shorter runs cannot contain a match.
    """
    pattern = _fast(rule)[: -len("{%d}" % rule.least)] + "{%d,}" % rule.least if rule.kind == "hex" else rule.pattern
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part"))
    steps = F.slice(steps, 1, F.greatest(F.size(whole), F.lit(0)))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["whole"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        kept = F.char_length(x["part"]) >= rule.least
        return F.struct(end.alias("at"), F.when(kept, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    found = F.aggregate(steps, zero, step, lambda state: state["spans"])
    return F.when(text.rlike(_fast(rule)), found).otherwise(empty)


def rule_key(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def address(docs: DataFrame, text_col: str = "text", history_col: str | None = None) -> DataFrame:
    """``docs`` with ``_blob``; with ``history_col`` (array of older texts) a row per version.

    Versions are numbered in ``_version``: 0 the text itself, then the older ones in
    the order of the array. A null text is the empty text, a null array holds none.
    """
    if history_col:
        versions = F.concat(F.array(F.col(text_col)), F.coalesce(F.col(history_col), F.array().cast("array<string>")))
        others = [quoted(c) for c in docs.columns if c not in (text_col, history_col)]
        docs = docs.select(*others, F.posexplode(versions).alias("_version", text_col))
    return docs.withColumn("_blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, _seen)`` of the blobs that ``ledger`` lacks for some rule; digests alone are shuffled.

    Written, so that what follows knows its size: where few blobs or none are new,
    no text is shuffled to find that out.
    """
    keys = [rule_key(r) for r in rules]
    seen = ledger.where(F.col("rule").isin(keys)).groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
    digests = blobs.select(F.col("_blob").alias("blob")).distinct()
    lacking = digests.join(seen, "blob", "left").where(F.coalesce(F.size("_seen"), F.lit(0)) < len(set(keys)))
    return materialize(lacking, "unseen")


def scan(blobs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows ``(blob, rule, spans)`` of the pairs that ``ledger`` lacks.

    ``blobs`` has ``_blob`` and ``text`` and may repeat; copies are merged on the
    map side, so a blob that is a third of all rows costs a row per task. Without
    a match ``spans`` is empty: the pair counts as seen.
    """
    fresh = [F.lit(True)] * len(rules)
    if ledger is None:
        one = blobs.groupBy("_blob").agg(F.first("text").alias("_text"))
    else:
        new = unseen(blobs, ledger, rules)
        rows = blobs.join(new, blobs["_blob"] == new["blob"])
        one = rows.groupBy("_blob").agg(F.first("text").alias("_text"), F.first("_seen").alias("_seen"))
        fresh = [~F.coalesce(F.array_contains("_seen", rule_key(r)), F.lit(False)) for r in rules]
    text = F.coalesce(F.col("_text"), F.lit(""))
    each = F.array(*(
        F.struct(F.lit(rule_key(r)).alias("rule"), F.when(f, find_spans(text, r)).alias("spans"))
        for r, f in zip(rules, fresh)
    ))
    rows = one.select(F.col("_blob").alias("blob"), F.inline(each))
    return rows.where(F.col("spans").isNotNull())


def joined(findings: Column, names: tuple[str, ...]) -> Column:
    """``kind:start:end``, by start and then by place in ``names``, joined by commas."""
    kept = F.array_sort(F.filter(findings, lambda x: x["place"] < len(names)))
    kind = lambda x: F.element_at(F.array(*map(F.lit, names)), x["place"] + 1)
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", kind(x), x["start"], x["end"])), ",")


def findings_by_blob(held: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, findings)`` of the blobs of ``held`` that have any, with those of ``ledger``."""
    rows = scan(held, ledger, rules)
    if ledger is not None:
        # two runs at a time may have added the same pair
        rows = rows.unionByName(ledger.select("blob", "rule", "spans").where("size(spans) > 0").dropDuplicates(["blob", "rule"]))
    place = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(rule_key(r)), F.lit(i))))
    rows = rows.where((F.size("spans") > 0) & F.col("rule").isin([rule_key(r) for r in rules]))
    spans = F.transform("spans", lambda x: F.struct(
        x["start"].alias("start"), place[F.col("rule")].alias("place"), x["end"].alias("end")))
    by_blob = rows.groupBy("blob").agg(F.flatten(F.collect_list(spans)).alias("findings"))  # an entry a rule
    # written, so that a join reads plain rows on both sides and a hot blob can be split
    return materialize(by_blob, "findings")


def update_ledger(docs: DataFrame, text_col: str = "text", ledger: DataFrame | None = None,
                  rules: tuple[Rule, ...] = RULES, history_col: str | None = None) -> DataFrame:
    """The rows ``(blob, rule, spans)`` that a scan of all versions in ``docs`` adds to ``ledger``, written.

    Every pair of a blob and a rule version that ``ledger`` lacks has a row, with no
    spans where nothing was found, so the next run scans it no more. Null texts are
    the empty text; repeated texts add one blob; an empty table adds nothing.
    """
    columns = [F.col(text_col).alias("text"), *([F.col(history_col).alias("_history")] if history_col else [])]
    held = address(docs.select(*columns), "text", "_history" if history_col else None)
    return materialize(scan(held, ledger, rules), "ledger")


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
                   history_col: str | None = None) -> DataFrame:
    """Every row of ``docs`` (id only) with ``_blob`` and ``findings``.

    ``findings``: array of ``(start, place, end)``, place being that of the rule in
    ``rules``, for all rules, those found in earlier runs included. Null or empty
    texts have none. With ``history_col``, an array of older texts, every version
    has a row with its number in ``_version`` (0: the text itself). Other columns are
    not read; repeated rows are all returned.
    """
    columns = [quoted(id_col), F.col(text_col).alias("text"), *([F.col(history_col).alias("_history")] if history_col else [])]
    held = address(docs.select(*columns), "text", "_history" if history_col else None)
    by_blob = findings_by_blob(held, ledger, rules)
    empty = F.array().cast("array<struct<start:bigint,place:int,end:bigint>>")
    version = ["_version"] if history_col else []
    paths = held.select(quoted(id_col), *version, "_blob")
    return paths.join(by_blob, paths["_blob"] == by_blob["blob"], "left").select(
        quoted(id_col), *version, "_blob", F.coalesce("findings", empty).alias("findings")
    )


def scan_with_ledger(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     rules: tuple[Rule, ...] = RULES, history_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`scan_documents` against the ledger kept at ``path``, and the rows that this run added to it.

    The first run makes the folder, later ones append to it. A run that fails has
    added either all its rows or none and can be repeated.
    """
    spark = docs.sparkSession
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(path)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    added = update_ledger(docs, text_col, ledger, rules, history_col)
    added.write.mode("append").parquet(path)
    whole = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return scan_documents(docs, id_col, text_col, whole, rules, history_col), added


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """``text`` with every found span, or union of spans that overlap, as ``mark``."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        fresh = x["start"] >= s["at"]
        gap = F.substring(text, (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int"))
        out = F.when(fresh, F.concat(s["out"], gap, F.lit(mark))).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

    def finish(s: Column) -> Column:
        return F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text)))

    return F.when(F.size(findings) > 0, F.aggregate(F.array_sort(findings), state, step, finish)).otherwise(text)


def redact_documents(docs: DataFrame, text_col: str = "text", ledger: DataFrame | None = None,
                     rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found secret replaced; all rows and columns stay, nulls too.

    Findings come from the ledger scan. Texts that no rule can match, which a look
    at each row tells, are not shuffled; the others get the findings of their blob.
    """
    by_blob = findings_by_blob(address(docs.select(F.col(text_col).alias("text"))), ledger, rules)
    suspect = F.lit(False)
    for rule in rules:
        suspect = suspect | F.col(text_col).rlike(_fast(rule))
    suspect = F.coalesce(suspect, F.lit(False))
    text = quoted(text_col)
    hits = docs.where(suspect).select(
        F.struct(*map(quoted, docs.columns)).alias("row"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("own"))
    hits = hits.join(by_blob.select("blob", "findings"), F.col("own") == F.col("blob"), "left")
    cell = lambda c: F.col("row").getField(c)
    cleaned = redact(cell(text_col), F.col("findings"))
    hits = hits.select(*((cleaned if c == text_col else cell(c)).alias(c) for c in docs.columns))
    return docs.where(~suspect).unionByName(hits)
