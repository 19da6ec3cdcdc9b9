"""CSV files read in many ranges, and types found in the cells."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from kohorta.sources import csv_records, tables as io

SPLIT = "spark.sql.files.maxPartitionBytes"
SCHEMA = "k int, v string, w string"


def cell(rng):
    part = ["plain", "a,b", 'say "x"', "two\nlines", "with\r\nboth", '"', "\n", "", " edge ", "é日🙂", None, '",\n"', "x" * 30]
    return rng.choice(part)


def written(path, data, end="\n"):
    """A file by the rules of RFC 4180, with nothing for a missing cell."""
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write(f"k,v,w{end}")
        for k, *cells in data:
            quoted = ["" if c is None else '"' + c.replace('"', '""') + '"' if c == "" or set(c) & set('",\r\n') else c for c in cells]
            file.write(f"{k},{','.join(quoted)}{end}")
    return data


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}

    def limit(size):
        spark.conf.set(SPLIT, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield limit
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [10_000_000, 2000, 97, 11])
def test_one_file_in_many_ranges(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    data = written(f"{tmp_path}/a.csv", [(i, cell(rng), cell(rng)) for i in range(150 if size < 100 else 800)], end)
    small_splits(size)
    out = io.read_csv(spark, f"{tmp_path}/a.csv", SCHEMA)
    if size < 10_000:
        assert csv_records._lines(spark, f"{tmp_path}/a.csv").rdd.getNumPartitions() > 4
    assert rows(out, "k", "v", "w") == rows(spark.createDataFrame(data, SCHEMA), "k", "v", "w")


def test_a_cell_over_many_ranges(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, with ''quotes''" for i in range(400))
    data = written(f"{tmp_path}/a.csv", [(1, "a", "b"), (2, long, "c"), (3, long + '"', None), (4, "\n" * 300, "d")])
    small_splits(64)
    out = io.read_csv(spark, f"{tmp_path}/a.csv", SCHEMA)
    assert rows(out, "k", "v", "w") == rows(spark.createDataFrame(data, SCHEMA), "k", "v", "w")


def test_many_files_and_other_readers(spark, tmp_path, small_splits):
    rng = random.Random(5)
    data = []
    (tmp_path / "d").mkdir()
    for f in range(5):
        data += written(f"{tmp_path}/d/{f}.csv", [(1000 * f + i, cell(rng), cell(rng)) for i in range(60)])
    small_splits(300)
    out = io.read_csv(spark, f"{tmp_path}/d", SCHEMA)
    options = io.CSV | {"nullValue": io.NOTHING, "multiLine": True, "emptyValue": "", "enforceSchema": False}
    same = spark.read.schema(SCHEMA).options(**options).csv(f"{tmp_path}/d")
    assert rows(out, "k", "v", "w") == rows(same, "k", "v", "w") == rows(spark.createDataFrame(data, SCHEMA), "k", "v", "w")
    with open(f"{tmp_path}/d/0.csv", newline="", encoding="utf-8") as file:
        assert len(list(csv.reader(file))) == 61


def test_headers_must_agree(spark, tmp_path):
    written(f"{tmp_path}/a.csv", [(1, "a", "b")])
    with pytest.raises(ValueError):
        io.read_csv(spark, f"{tmp_path}/a.csv", "k int, other string, w string")
    (tmp_path / "b.csv").write_text("k,v\n1,a\n")
    with pytest.raises(ValueError):
        io.read_csv(spark, f"{tmp_path}/*.csv")


def test_types_of_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '﻿long,double,text,flag,none,"big, one",mixed,quoted\n1,1.5,a,TRUE,,123456789012345678901,1,"1"\n-2,2,,false,,2,x,"2"\n,.5e3,1,,,3,2,\n'
    )
    out = io.read_csv(spark, f"{tmp_path}/a.csv")
    assert dict(out.dtypes) == {
        "long": "bigint", "double": "double", "text": "string", "flag": "boolean", "none": "string",
        "big, one": "double", "mixed": "string", "quoted": "bigint",
    }
    assert [r["double"] for r in out.collect()] == [1.5, 2.0, 500.0]
    assert out.filter(F.col("flag")).count() == 1


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n")
    assert io.read_csv(spark, f"{tmp_path}/a.csv").dtypes == [("k", "string"), ("v", "string")]
    assert io.read_csv(spark, f"{tmp_path}/a.csv", "k int, v string").count() == 0
    (tmp_path / "b.csv").write_text("")
    assert io.read_csv(spark, f"{tmp_path}/b.csv", "k int").count() == 0
