"""CSV cut at any byte range against Spark's own reader of whole files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuro.sources import csv_ranges, files

SCHEMA = T.StructType([T.StructField(n, k) for n, k in (("video_id", T.StringType()), ("text", T.StringType()), ("likes", T.LongType()))])


@pytest.fixture()
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def field(r, line_break):
    kind = r.random()
    if kind < 0.2:
        return ""
    if kind < 0.5:
        return f"plain {r.randrange(100)}"
    pieces = ["a", "b ", ",", '""', line_break, line_break * 2, "é", "x" * r.randrange(1, 80), '""""', "NA"]
    return '"' + "".join(r.choice(pieces) for _ in range(r.randrange(0, 12))) + '"'


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def whole_files(spark, path):
    return spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


@pytest.mark.parametrize("seed,line_break", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_equal_to_the_reader_of_whole_files(spark, small_ranges, tmp_path, seed, line_break):
    r = random.Random(seed)
    for name in ("one", "two"):
        lines = [f"v{i},{field(r, line_break)},{i}" for i in range(120)]
        # A field longer than several ranges.
        lines.insert(60, 'long,"' + (f"line of it, and{line_break}" * 60) + '",7')
        text = line_break.join(["﻿video_id,text,likes", *lines]) + (line_break if name == "one" else "")
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    lines = csv_ranges._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 40
    assert lines.select("file", "start").distinct().count() > 40
    got = csv_ranges.read_csv(spark, str(tmp_path), SCHEMA)
    # That reader makes \n of a file's own line break inside quotes; here it stays.
    one_break = got.withColumn("text", F.replace("text", F.lit("\r\n"), F.lit("\n")))
    assert rows(one_break) == rows(whole_files(spark, str(tmp_path)))
    assert got.where(F.col("text").contains("\r\n")).isEmpty() == (line_break == "\n")


def test_records_inside_and_between_ranges():
    def cut(lines, inside):
        state = csv_ranges._Range(inside)
        out = [x for x in map(state.add, lines) if x]
        return out + ([state.rest()] if state.rest() else [])

    assert cut(['a,"b', 'c",d', "e,f"], False) == [("whole", 'a,"b\nc",d'), ("whole", "e,f")]
    assert cut(["of it", 'end",x', 'y,"z'], True) == [("end", 'of it\nend",x'), ("begin", 'y,"z')]
    assert cut(["all", 'of "" it'], True) == [("middle", 'all\nof "" it')]
    assert cut([], True) == []


def test_missing_cells_empty_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('video_id,text,likes\n\nv,NA,1\n"v""2","",2\n')
    (tmp_path / "b.csv").write_text("video_id,text,likes\n")
    (tmp_path / "c.csv").write_text("")
    got = rows(files.read_comments_csv(spark, str(tmp_path), SCHEMA))
    assert got == sorted([("v", None, 1), ('v"2', None, 2)], key=str)
