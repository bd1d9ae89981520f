"""Corpus tables: CSV and parquet readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.sources.splitcsv import ROW_BITS, read_split_csv

POSTS_COLUMNS = ("author_flair_text", "body")
CORPUS_COLUMNS = ("type", "posts")

#: Quoted fields may hold line breaks, a quote inside a field is doubled.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def _in_read_order(df: DataFrame, fmt: str):
    """A row number that follows file names, then the order within each file.

    Spark hands out splits by size, so its own numbers depend on the cluster. A
    CSV file with line breaks in fields is read by one task, whose numbers rise
    along the file; parquet tells each row's place. Other formats are numbered by
    block and then as they are read.
    """
    files = sorted(df.inputFiles())
    ranks = df.sparkSession.createDataFrame(
        [(f, i) for i, f in enumerate(files)], "_file string, _rank long"
    )
    within = (1 << 33) - 1  # the part of Spark's number that counts rows within a task
    if fmt == "parquet":
        place = F.col("_metadata.row_index")
    elif fmt == "csv":
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(within))
    else:
        place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(within))
    placed = df.select("*", F.input_file_name().alias("_file"), place.alias("_place"))
    # one row per input file, a list the driver holds anyway
    return placed.join(F.broadcast(ranks), "_file", "left"), (
        F.shiftleft(F.coalesce("_rank", F.lit(0).cast("long")), ROW_BITS) + F.col("_place")
    )


def _read(
    spark: SparkSession, path: str, columns, id_col: str, fmt: str, partitions: int | None,
    id_from: str | None, split: bool, split_bytes: int | None,
) -> DataFrame:
    reader = spark.read
    number = None
    if fmt == "csv" and split:
        df, number = read_split_csv(spark, path, CSV_OPTIONS, split_bytes)
    elif fmt == "csv":
        # Columns are found by the header's names and read as text; only the
        # header line is looked at beforehand, nothing is inferred from data.
        df = reader.options(**CSV_OPTIONS).csv(path)
    else:
        df = reader.format(fmt).load(path)
    if id_from:
        row_id = F.col(id_from).cast("long")
    elif number:
        row_id = F.col(number)
    else:
        df, row_id = _in_read_order(df, fmt)
    df = df.select(row_id.alias(id_col), *[F.col(c).cast("string").alias(c) for c in columns])
    return df.repartition(partitions) if partitions else df


def read_posts(
    spark: SparkSession, path: str, fmt: str = "csv", partitions: int | None = None,
    id_from: str | None = None, split: bool = False, split_bytes: int | None = None,
) -> DataFrame:
    """Raw posts ``(row_id, author_flair_text, body)``.

    ``id_from`` names an id column of the input, which is what "first" goes by
    later. Without one, ids follow file names and then the order within each file,
    however the files are split over tasks. A CSV file with line breaks in fields is read by one task;
    with ``split`` by many, in two passes (see :func:`read_split_csv`), with the
    same rows and numbers. ``partitions`` spreads the rows of a few large files.
    """
    return _read(spark, path, POSTS_COLUMNS, "row_id", fmt, partitions, id_from, split, split_bytes)


def read_corpus(
    spark: SparkSession, path: str, fmt: str = "csv", partitions: int | None = None,
    id_from: str | None = None, split: bool = False, split_bytes: int | None = None,
) -> DataFrame:
    """Training corpus ``(doc_id, type, posts)``; options as :func:`read_posts`."""
    return _read(spark, path, CORPUS_COLUMNS, "doc_id", fmt, partitions, id_from, split, split_bytes)


def write_corpus(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write a corpus as a folder of part files, one per task."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        # Line breaks at either end of a text belong to it.
        writer.options(
            header="true", quote='"', escape='"', emptyValue="",
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        ).csv(path)
    else:
        writer.format(fmt).save(path)


def write_report(report: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Write an evaluation report (a class-sized table) as one file."""
    report.coalesce(1).write.mode(mode).format(fmt).save(path)
