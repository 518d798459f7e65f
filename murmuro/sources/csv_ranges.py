"""CSV with quoted line breaks, read by many tasks per file.

A file is read as lines, in the byte ranges that Spark cuts it into. One pass counts the quotes of each range; whether
a range begins inside quotes follows from the parity of all ranges before it, a running sum over one row per range.
Knowing that, every range cuts its own lines into records; what reaches over its ends are fragments, at most two per
range, which are put together in order. Quotes inside a field must be doubled and the field quoted, as writers do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuro.runtime import written

# A record inside its range; the end of one that began before it; the beginning of one that goes on after it; a
# range inside one record.
WHOLE, END, BEGIN, MIDDLE = "whole", "end", "begin", "middle"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # Only \n ends a line here: other breaks inside quotes stay as they are.
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


class _Range:
    """Cuts the lines of one range into records and fragments."""

    def __init__(self, inside: bool) -> None:
        # Lines that belong together, and whether the range has not yet seen the end of what began before it.
        self.held: list[str] = []
        self.inside = self.before = inside

    def add(self, line: str) -> tuple[str, str] | None:
        self.held.append(line)
        self.inside ^= line.count('"') % 2 == 1
        if self.inside:
            return None
        text, kind = "\n".join(self.held), END if self.before else WHOLE
        self.held, self.before = [], False
        return kind, text

    def rest(self) -> tuple[str, str] | None:
        if not self.held:
            return None
        return MIDDLE if self.before else BEGIN, "\n".join(self.held)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, no, record): one row per record of the file or files, quotes and all.

    `start` is the range a record begins in, `no` its place there. A line break at the end of a record is left out.
    """
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = written(lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd")), "ranges")
    # One row per range.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # Its bound: the number of ranges.
    begun = lines.join(F.broadcast(inside), ["file", "start"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, no = None, None, 0
        for batch in batches:
            out: list[tuple] = []
            for file, start, inside, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "inside", "value")), strict=True):
                if (file, start) != at:
                    if state and (left := state.rest()):
                        out.append((*at, no, *left))
                    at, state, no = (file, start), _Range(inside), 0
                if done := state.add(line):
                    out.append((file, start, no, *done))
                    no += 1
            yield _batch(out)
        if state and (left := state.rest()):
            yield _batch([(*at, no, *left)])

    schema = "file string, start bigint, no bigint, kind string, record string"
    pieces = written(begun.select("file", "start", "inside", "value").mapInArrow(cut, schema), "records")
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "start", "no", "record")
    # At most two rows per range.
    parts = pieces.where(F.col("kind") != WHOLE)
    so_far = Window.partitionBy("file").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.max(F.when(F.col("kind") == BEGIN, F.struct("start", "no"))).over(so_far)
    ordered = F.sort_array(F.collect_list(F.struct("start", "no", "record")))
    joined = (
        parts.withColumn("opened", opened)
        .groupBy("file", "opened")
        .agg(F.array_join(F.transform(ordered, lambda x: x["record"]), "\n").alias("record"))
    )
    records = whole.unionByName(joined.select("file", "opened.start", "opened.no", "record"))
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "start", "no", "kind", "record"])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The fields of every record by position; the first record of a file is its header. Empty lines are left out."""
    records = read_records(spark, path).where(F.col("record") != "")
    if header:
        records = records.where("NOT (start = 0 AND no = 0)")
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return records.select(F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("x")).select("x.*")
