"""One CSV file over many tasks equals the read by one task, row numbers included."""

import csv
import random

import pytest

from labeltext.sources import read_corpus, read_posts
from labeltext.sources.splitcsv import read_split_csv
from labeltext.sources.tables import CSV_OPTIONS


def written(path, rows, header=("author_flair_text", "body"), end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows([header, *rows])


def odd_rows(n, seed):
    rng = random.Random(seed)
    pieces = ["plain", 'a "quoted" word', "line\nbreak", "\n\n", ",", "", "Ünï ☃ 𝄞", '"', '""\n"', "x" * 300, "tail\n"]
    return [("istp", "".join(rng.choices(pieces, k=rng.randrange(6)))) if rng.random() < 0.9 else ("", "") for _ in range(n)]


def both(spark, path, split_bytes, reader=read_posts):
    one = [tuple(r) for r in reader(spark, path).collect()]
    many = [tuple(r) for r in reader(spark, path, split=True, split_bytes=split_bytes).collect()]
    return sorted(one, key=lambda r: r[0]), sorted(many, key=lambda r: r[0])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_read_by_one_task(spark, tmp_path, end):
    written(tmp_path / "in" / "b.csv", odd_rows(400, 1), end=end)
    written(tmp_path / "in" / "a.csv", odd_rows(300, 2), end=end)
    one, many = both(spark, str(tmp_path / "in"), 997)
    assert len(one) == 700 and many == one


def test_records_longer_than_splits(spark, tmp_path):
    rows = [("istp", "one\n" * 5000), ("entj", "short"), ("infp", 'q "" \n' * 4000), ("", "end")]
    written(tmp_path / "long.csv", rows)
    one, many = both(spark, str(tmp_path / "long.csv"), 1000)
    assert [r[2] for r in many] == [r[1] for r in rows]
    assert many == one


def test_many_tasks_take_part(spark, tmp_path):
    written(tmp_path / "in.csv", odd_rows(500, 3))
    df, _ = read_split_csv(spark, str(tmp_path / "in.csv"), CSV_OPTIONS, 2000)
    assert df.rdd.getNumPartitions() > 8


def test_empty_lines_empty_files_other_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('x,type,_row_number,posts\n\n1,istp,,"a\n\nb"\n\n\n2,,7,\n')
    (tmp_path / "in" / "b.csv").write_text("x,type,_row_number,posts\n")
    one, many = both(spark, str(tmp_path / "in"), 10, read_corpus)
    assert many == one and [r[1:] for r in many] == [("istp", "a\n\nb"), (None, None)]


def test_small_file_with_the_session_s_splits(spark, tmp_path):
    written(tmp_path / "in.csv", odd_rows(50, 4))
    one, many = both(spark, str(tmp_path / "in.csv"), None)
    assert many == one
