"""CSV files with line breaks in fields, one file read by many tasks.

A task that starts in the middle of a file cannot tell whether it starts inside a
quoted field. One pass counts the quotes of every split; their running parity over
the splits of a file tells it. In a second pass each task puts the lines of its
split together to records. What a split has of a record that goes on beyond it is
joined with the rest by the place of the split where that record begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labeltext.session import materialize

#: Bits of a row's number within its file.
ROW_BITS = 40

#: What a piece of a record is: all of it, its begin, or a later part.
WHOLE, BEGIN, LATER = 0, 1, 2


def _parity_after(lines: pa.Array) -> np.ndarray:
    """For each line whether an odd number of quotes was seen up to its end, from none."""
    return np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) % 2 == 1


def _runs(file: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows of one split each; a task may hold several splits, one after another."""
    edge = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    return list(zip(np.append(0, edge), np.append(edge, len(file)))) if len(file) else []


def _blank(lines: pa.Array) -> np.ndarray:
    """Lines of nothing, or of a carriage return."""
    return np.array(pc.is_in(lines, pa.array([b"", b"\r"], lines.type)))


def _count_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and split: quotes, and records that end there if it starts outside or inside a field."""
    for batch in batches:
        file, block, lines = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        rows = []
        for a, b in _runs(file, block):
            part = lines.slice(a, b - a)
            odd, blank = _parity_after(part), _blank(part)
            rows.append((file[a], block[a], int(odd[-1]), int((~odd & ~blank).sum()), int((odd & ~blank).sum())))
        columns = [pa.array(np.array(c, np.int64)) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "odd", "ends_even", "ends_odd"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces ``(file, block, kind, nth, record)``; ``nth`` counts the records that begin in a split.

    What is held between batches is the record at hand.
    """
    at, odd, nth, later, held = None, False, 0, False, []

    def piece(kind: int, number: int, lines: list[bytes]) -> pa.RecordBatch:
        row = [np.int64(at[0]), np.int64(at[1]), np.int64(kind), np.int64(number)]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v]) for v in row), pa.array([b"\n".join(lines)], pa.binary())],
            ["file", "block", "kind", "nth", "record"])

    for batch in batches:
        file, block, inside = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
        for a, b in _runs(file, block):
            if at != (file[a], block[a]):
                if at is not None and held:
                    yield piece(LATER if later else BEGIN, nth, held)
                at, odd, nth, held = (file[a], block[a]), bool(inside[a]), 0, []
                later = odd  # what comes first belongs to a record of an earlier split
            lines = batch.column(2).slice(a, b - a)
            open_after = _parity_after(lines) ^ odd
            odd = bool(open_after[-1])
            ends = np.flatnonzero(~open_after)
            if not len(ends):
                held += lines.to_pylist()
                continue
            first = held + lines.slice(0, ends[0] + 1).to_pylist()
            if later:
                yield piece(LATER, 0, first)
                later = False
            elif first not in ([b""], [b"\r"]):
                yield piece(WHOLE, nth, first)
                nth += 1
            held = lines.slice(ends[-1] + 1).to_pylist()
            if len(ends) > 1:
                edges = pa.array((ends + 1 - (ends[0] + 1)).astype(np.int32))
                own = lines.slice(ends[0] + 1, ends[-1] - ends[0]).cast(pa.binary())
                whole = pc.binary_join(pa.ListArray.from_arrays(edges, own), pa.scalar(b"\n"))
                whole = whole.filter(pa.array(~_blank(whole)))
                n = len(whole)
                same = [pa.array(np.full(n, v, np.int64)) for v in (*at, WHOLE)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(np.arange(nth, nth + n)), whole], ["file", "block", "kind", "nth", "record"])
                nth += n
    if at is not None and held:
        yield piece(LATER if later else BEGIN, nth, held)


def split_table(lines: DataFrame) -> DataFrame:
    """A row per split: ``inside`` (starts in a field), ``first`` (records before it), ``origin``.

    ``origin`` is the split where the record begins that reaches into this one. The
    table has as many rows as the driver has planned splits.
    """
    counted = lines.select("file", "block", "line").mapInArrow(
        _count_quotes, "file bigint, block bigint, odd bigint, ends_even bigint, ends_odd bigint")
    # batches of a split come in order, but sums need their parities: number them in the task
    counted = counted.withColumn("seq", F.monotonically_increasing_id())
    before = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, -1)
    steps = counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    ends = F.when(F.col("inside"), F.col("ends_odd")).otherwise(F.col("ends_even"))
    per = steps.groupBy("file", "block").agg(
        F.min_by("inside", "seq").alias("inside"), F.sum(ends).alias("ends"),
        F.max_by((F.col("odd") == 1) != F.col("inside"), "seq").alias("open"))
    # a record that ends here may begin earlier, one that begins here may end later
    begins = F.col("ends") - F.col("inside").cast("int") + F.col("open").cast("int")
    opens = F.col("open") & (~F.col("inside") | (F.col("ends") > 0))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(
        "file", "block", "inside", F.coalesce(F.sum(begins).over(before), F.lit(0)).alias("first"),
        F.last(F.when(opens, F.col("block")), ignorenulls=True).over(before).alias("origin"))


def read_split_csv(
    spark: SparkSession, path: str, options: dict[str, str], split_bytes: int | None = None,
) -> tuple[DataFrame, str]:
    """All columns of the CSV files at ``path`` as text, and the name of the row number's column.

    Rows are numbered by file name and then by their place in the file, as if one
    task had read it. ``split_bytes`` sets how much of a file a task reads (by
    default what the session says for files). Quotes must come in pairs, as in
    every file that quotes fields that hold one; a quote within an unquoted field,
    which pairs with nothing, makes the fields after it part of a long record.
    Empty lines between records are no rows. The first record of each file is its
    header; files have the same columns.
    """
    names = spark.read.options(**options).csv(path).columns
    if split_bytes:
        spark = spark.newSession()  # the setting is that of the reading session
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    source = spark.read.option("lineSep", "\n").text(path)
    lines = source.select(
        F.xxhash64(F.input_file_name()).alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))
    splits = materialize(split_table(lines), "splits")
    # a row per split, of which the driver holds a plan anyway (some 30 bytes against 128 MB)
    placed = lines.join(F.broadcast(splits.select("file", "block", "inside")), ["file", "block"])
    pieces = placed.select("file", "block", "line", "inside").mapInArrow(
        _records, "file bigint, block bigint, kind bigint, nth bigint, record binary")
    pieces = pieces.join(F.broadcast(splits.select("file", "block", "first", "origin")), ["file", "block"])
    pieces = pieces.withColumn("place", F.col("first") + F.col("nth"))
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "place", "record")
    # at most two pieces a split: its records that go on, or come from an earlier one
    home = F.when(F.col("kind") == BEGIN, F.col("block")).otherwise(F.col("origin"))
    parts = pieces.where(F.col("kind") != WHOLE).groupBy("file", home.alias("home")).agg(
        F.min_by("place", "block").alias("place"),
        F.array_sort(F.collect_list(F.struct("block", F.col("record").cast("string").alias("text")))).alias("parts"))
    joined = parts.select("file", "place", F.array_join("parts.text", "\n").cast("binary").alias("record"))
    files = spark.createDataFrame([(f, i) for i, f in enumerate(sorted(source.inputFiles()))], "name string, rank long")
    ranks = F.broadcast(files.select(F.xxhash64("name").alias("file"), "rank"))
    records = whole.unionByName(joined).join(ranks, "file").where("place > 0")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    line = F.regexp_replace(F.col("record").cast("string"), "\r\\z", "")
    fields = F.from_csv(line, schema, {k: v for k, v in options.items() if k != "header"})
    number = "_row_number"
    while number in names:
        number = "_" + number
    row = (F.shiftleft("rank", ROW_BITS) + F.col("place") - 1).alias(number)
    parsed = records.select(row, F.explode(F.array(fields)).alias("fields"))
    return parsed.select(number, *(F.col("fields").getField(n).alias(n) for n in names)), number
