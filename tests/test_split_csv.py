"""A large CSV with line breaks in quotes, read by many tasks."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import types as T

from marketlake.sources import readers
from marketlake.sources.split_csv import open_ranges, read_csv_split


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "2000")
    spark.conf.set(names[1], "0")
    yield
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)


def _write(path, rows, end="\n", header=("id", "text", "note")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)


def _rows(n, seed):
    rng = random.Random(seed)
    words = ["plain", 'a "quote"', "two\nlines", "é, and\n\nmore", '"', ",", "\n", "x" * 40]
    return [[str(i), " ".join(rng.choices(words, k=rng.randint(1, 12))), rng.choice(["", "n", 'end "\n'])] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_give_the_rows_of_the_single_task_reader(spark, tmp_path, small_ranges, end):
    for i in range(3):
        _write(tmp_path / f"{i}.csv", _rows(300, i), end)
    path = str(tmp_path)
    assert open_ranges(spark, path).count() > 5
    got = read_csv_split(spark, path)
    assert got.rdd.getNumPartitions() > 20
    expected = readers.read_csv(spark, path)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f'line {i} "q"' for i in range(2000))
    rows = [["1", "a", ""], ["2", long, "b"], ["3", "c\nd", ""], ["4", long, long]]
    _write(tmp_path / "a.csv", rows)
    got = {r["id"]: (r["text"], r["note"]) for r in read_csv_split(spark, str(tmp_path)).collect()}
    assert got == {r[0]: (r[1], r[2] or None) for r in rows}


def test_small_files_share_a_task_and_schemas_cast(spark, tmp_path):
    for i in range(40):
        _write(tmp_path / f"{i}.csv", [[str(i), "a\nb", "1.5"]])
    _write(tmp_path / "none.csv", [])
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("note", T.DoubleType())])
    got = read_csv_split(spark, str(tmp_path), schema)
    assert sorted((r["id"], r["text"], r["note"]) for r in got.collect()) == [(i, "a\nb", 1.5) for i in range(40)]


def test_other_headers_and_open_quotes(spark, tmp_path):
    _write(tmp_path / "a.csv", [["1", "a", "b"]])
    _write(tmp_path / "b.csv", [["1", "a", "b"]], header=("id", "note", "text"))
    with pytest.raises(Exception, match="another header"):
        read_csv_split(spark, str(tmp_path), readers.text_schema("id", "text", "note")).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text('id,text\n1,"never\nclosed\n')
    assert read_csv_split(spark, str(tmp_path / "c")).count() == 1
