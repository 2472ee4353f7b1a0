"""CSV read split by split against the whole file in one task and Python's parser."""

from __future__ import annotations

import csv
import gzip
import random

import pytest
from pyspark.errors import PySparkException

from basketlens.sources import csv_splits, readers
from basketlens.sources.layers import FolderLayer
from basketlens.session import scratch_path

CELLS = ["", "x", "é日本", 'say ""hi""', "a\nb", "one\r\ntwo\n\nthree", ",", '""', "long " * 12, "12.5", " padded ", '"",\n""', "\n" * 9]


@pytest.fixture()
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "97")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, old):
        spark.conf.set(name, value)


def write(path, rows, end="\n"):
    quoted = lambda c: f'"{c}"' if any(x in c for x in '",\n\r') or c.startswith(" ") else c
    path.write_bytes(("id,Some Text,last" + end + "".join(",".join(quoted(c) for c in row) + end for row in rows)).encode())


def plain(path):
    with open(path, newline="", encoding="utf-8") as f:
        rows = [r for r in csv.reader(f) if r]
    return sorted([tuple((c or None) for c in r) for r in rows[1:]], key=str)


def read(spark, path, **more):
    return sorted(map(tuple, readers.read_csv_table(spark, str(path), **more).collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(4))
def test_splits_equal_the_whole_file(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    cells = CELLS if seed else [c for c in CELLS if "\n" not in c]
    rows = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(150)]
    write(tmp_path / "t.csv", rows, end)
    source = spark.read.text(str(tmp_path / "t.csv"))
    assert source.rdd.getNumPartitions() > 20
    assert read(spark, tmp_path / "t.csv") == plain(tmp_path / "t.csv")


def test_a_record_longer_than_many_splits(spark, tmp_path, small_splits):
    rows = [["1", "a\n" * 600, "x"], ["2", "b", 'c""\n' * 100], ["3", "", "end"]]
    write(tmp_path / "t.csv", rows)
    assert read(spark, tmp_path / "t.csv") == plain(tmp_path / "t.csv")


def test_lines_dealt_out_where_the_splits_are_many(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(csv_splits, "BROADCAST_SPLITS", 3)
    rows = [[str(i), "a\nb" if i % 3 else "c", "d"] for i in range(200)]
    write(tmp_path / "t.csv", rows)
    assert read(spark, tmp_path / "t.csv") == plain(tmp_path / "t.csv")


def test_folder_of_parts_each_with_its_header(spark, tmp_path, small_splits):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for part in range(3):
        write(folder / f"part-{part}.csv", [[f"{part}-{i}", "a\nb", "c"] for i in range(20)])
    (folder / "part-9.csv.gz").write_bytes(gzip.compress(b'id,Some Text,last\n9-0,"x\ny",z\n'))
    got = read(spark, folder)
    assert len(got) == 61 and ("9-0", "x\ny", "z") in got


def test_quotes_inside_fields_are_text(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text('id,Some Text,last\n1,5" pipe,x\n2,"a\nb"tail,y\n3,z"",""\n' + "4,p,q\n" * 40)
    got = read(spark, tmp_path / "t.csv")
    assert ("1", '5" pipe', "x") in got and len(got) == 43


def test_no_last_line_end_and_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Some Text,last\n\n1,"x\ny",z')
    assert read(spark, tmp_path / "a.csv") == [("1", "x\ny", "z")]
    (tmp_path / "b.csv").write_text("id,Some Text,last\n")
    assert read(spark, tmp_path / "b.csv") == []


def test_short_rows_end_in_nulls_and_long_ones_fail(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text('id,Some Text,last\n1,"a\nb"\n')
    assert read(spark, tmp_path / "t.csv") == [("1", "a\nb", None)]
    (tmp_path / "u.csv").write_text('id,Some Text,last\n1,"a\nb",c,d\n')
    with pytest.raises(PySparkException, match="too many fields"):
        read(spark, tmp_path / "u.csv")


def test_the_loader_can_be_told_that_there_are_no_line_breaks(spark, tmp_path):
    (tmp_path / "notes.csv").write_text("a,b\n1,2\n")
    layer = FolderLayer(spark, scratch_path(spark, "layer"))
    assert readers.load_csv_folder(spark, str(tmp_path), layer, line_breaks=False).first()["loaded_rows"] == 1
