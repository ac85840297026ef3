"""CSV by byte ranges against the reader that takes a file whole."""

from __future__ import annotations

import csv
import random

import pytest

from tradewind.sources.csv_tables import read_raw_csv

CELLS = ["plain", "", "two\nlines", '"', 'a "quoted" word', ",", "\n\n", "é\r\nü", " padded ", "x" * 300, "line\n" * 40, '"\n"']


def written(folder, name, rows, header=("a", "b", "c"), ends="\n"):
    with open(folder / name, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=ends)
        writer.writerow(header)
        writer.writerows(rows)


def whole(spark, path):
    df = spark.read.csv(str(path), header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST")
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few lines."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("seed, ends", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_ranges_give_the_same_rows(spark, small_ranges, tmp_path, seed, ends):
    rng = random.Random(seed)
    for name in ("one.csv", "two.csv"):
        rows = [[f"{name}{n}", *(rng.choice(CELLS) for _ in range(2))] for n in range(120)]
        written(tmp_path, name, rows, ends=ends)
    read = read_raw_csv(spark, str(tmp_path))
    got = sorted(map(tuple, read.collect()), key=str)
    assert got == whole(spark, tmp_path) and len(got) == 240
    assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 5


def test_records_longer_than_ranges_and_a_broken_header(spark, small_ranges, tmp_path):
    rows = [["1", "long\n" * 900, "x"], ["2", "y", ""], ["3", "\n" * 2000, "z"]]
    written(tmp_path, "long.csv", rows, header=("a", "b\nb", "c" * 900))
    got = sorted(map(tuple, read_raw_csv(spark, str(tmp_path)).collect()), key=str)
    assert got == whole(spark, tmp_path) and len(got) == 3


def test_other_headers_and_other_widths_stop(spark, tmp_path):
    written(tmp_path, "one.csv", [["1", "2", "3"]])
    written(tmp_path, "two.csv", [["1", "2", "3"]], header=("a", "c", "b"))
    with pytest.raises(Exception, match="header does not conform"):
        read_raw_csv(spark, str(tmp_path)).collect()
    wide = tmp_path / "wide"
    wide.mkdir()
    written(wide, "one.csv", [["1", "2", "3"], ["1", "2", "3", "4"]])
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        read_raw_csv(spark, str(wide)).collect()


def test_a_file_with_only_a_header(spark, tmp_path):
    written(tmp_path, "one.csv", [])
    assert read_raw_csv(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("cell, split", [("plain, \"quoted\"", True), ("two\nlines", False), ("a\rb", False)])
def test_files_of_one_line_records_go_to_sparks_reader(spark, small_ranges, tmp_path, cell, split):
    written(tmp_path, "one.csv", [[str(n), " ", "é"] for n in range(200)] + [["x", cell, ""], []])
    read = read_raw_csv(spark, str(tmp_path))
    assert ("MapInArrow" not in read._jdf.queryExecution().optimizedPlan().toString()) is split
    got = sorted(map(tuple, read.collect()), key=str)
    assert got == whole(spark, tmp_path) and len(got) == 201


def test_lines_of_blanks_stay_records(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a\nx\n  \n\ny\n")
    assert sorted(r["a"] for r in read_raw_csv(spark, str(tmp_path)).collect()) == ["  ", "x", "y"]
