"""UTF-16 reports read in byte ranges give the rows of the one-task reader."""

import random

import pytest

from civicmart.sources import read_utf16_tsv, read_utf16_tsv_ranges


def put(path, rows, codec, end="\r\n", mark=True):
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in '"\t\n\r') else v
    text = end.join("\t".join(map(quoted, r)) for r in rows)
    with open(path, "wb") as f:
        f.write((("﻿" if mark else "") + text).encode(codec))


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("codec", ["utf-16-le", "utf-16-be"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_the_one_task_reader(spark, scratch, small_ranges, codec, end):
    rng = random.Random(len(codec + end))
    # letters and pairs of letters whose bytes hold those of a line feed or a quote, at odd places
    bits = ["a", "é", "日", "😀", "ਂĀ", "∀Ā", "Āਂ", "Ȁ", "∀", '"', "\n", "\t", " ", "xyz" * 9]
    rows = [["id", "a note", 'q"x']]
    for i in range(600):
        rows.append([str(i), *("".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(2))])
    rows[300][1] = "long\n" * 900  # a field over many ranges
    put(f"{scratch}/a.tsv", rows, codec, end)
    ddl = 'id int, `a note` string, `q"x` string'
    got, want = read_utf16_tsv_ranges(spark, f"{scratch}/a.tsv", ddl), read_utf16_tsv(spark, f"{scratch}/a.tsv", ddl)
    assert got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 600
    assert got.rdd.getNumPartitions() > 5
    assert sorted(map(repr, read_utf16_tsv_ranges(spark, f"{scratch}/a.tsv").collect())) == sorted(map(repr, read_utf16_tsv(spark, f"{scratch}/a.tsv").collect()))


def test_several_files_and_blank_lines(spark, scratch):
    for i, codec in enumerate(("utf-16-le", "utf-16-be", "utf-16-be")):
        put(f"{scratch}/{i}.tsv", [["x", "y"], [str(i), "v"], [""], ["9", ""]], codec, mark=i < 2)
    open(f"{scratch}/empty.tsv", "wb").close()
    got = read_utf16_tsv_ranges(spark, scratch, "x int, y string")
    assert sorted((r.x, r.y or "") for r in got.collect()) == [(0, "v"), (1, "v"), (2, "v"), (9, ""), (9, ""), (9, "")]


def test_bad_input_fails(spark, scratch):
    put(f"{scratch}/a.tsv", [["x", "y"], ["1", "v"]], "utf-16-le")
    with pytest.raises(ValueError):
        read_utf16_tsv_ranges(spark, f"{scratch}/a.tsv", "y string, x int")
    for bad in (["z", "v"], ["1"], ["1", "2", "3"]):
        put(f"{scratch}/b.tsv", [["x", "y"], bad], "utf-16-le")
        with pytest.raises(Exception):
            read_utf16_tsv_ranges(spark, f"{scratch}/b.tsv", "x int, y string").collect()
    with open(f"{scratch}/a.tsv", "ab") as f:
        f.write(b"\n\x00\x00")  # half a character at the end
    with pytest.raises(Exception):
        read_utf16_tsv_ranges(spark, f"{scratch}/a.tsv", "x int, y string").collect()
    put(f"{scratch}/c.tsv", [["x", "y"]], "utf-16-le")
    assert read_utf16_tsv_ranges(spark, f"{scratch}/c.tsv", "x int, y string").count() == 0


def test_header_of_two_lines(spark, scratch):
    put(f"{scratch}/a.tsv", [["x\ny", "z"], ["1", "2"]], "utf-16-le")
    got = read_utf16_tsv_ranges(spark, f"{scratch}/a.tsv")
    assert got.columns == ["x\ny", "z"] and [tuple(r) for r in got.collect()] == [("1", "2")]
