"""Quoted CSV whose cells may hold line breaks, read by many tasks from one file.

A file is split at its lines. The quotes of each split are counted, and the parity of all
quotes before a split tells whether it starts inside a cell. With that, each task puts the
lines of its split together to records; what a split leaves open at its ends is joined
across splits by the order of the file. Only those ends are shuffled.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a piece of text is: a whole record, the rest of one from earlier splits, or the start of an open one.
RECORD, REST, START = 0, 1, 2
PIECES = "path string, split long, kind int, first boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split")
    )


def _quotes() -> F.Column:
    return (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long")


def _odd_splits(lines: DataFrame) -> DataFrame:
    """Splits that start inside a quoted cell; at most one row per split of a file."""
    splits = lines.groupBy("path", "split").agg(F.sum(_quotes()).alias("n"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return counted.where(F.col("before") % 2 == 1).select("path", "split", F.lit(True).alias("odd"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split, and the texts at its ends that belong to records of several splits."""
    at, inside, held, started, first = None, False, [], False, False
    names = ["path", "split", "kind", "first", "text"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def open_end() -> list[tuple]:
        return [(*at, START if started else REST, first, "\n".join(held))] if held else []

    for batch in batches:
        rows = []
        quotes = pc.count_substring(batch.column(0), '"').to_pylist()
        for value, path, split, odd, n in zip(*(c.to_pylist() for c in batch.columns), quotes):
            if (path, split) != at:
                rows += open_end()
                at, inside, held, started, first = (path, split), bool(odd), [], not odd, split == 0
            held.append(value)
            inside ^= n % 2 == 1
            if not inside:
                rows.append((*at, RECORD if started else REST, first, "\n".join(held)))
                held, started, first = [], True, False
        if rows:
            yield batch_of(rows)
    if at and (rows := open_end()):
        yield batch_of(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records as text: (path, split, first, text), from any number of files and splits.

    A record is closed where the quotes so far are even. Cells are separated by commas,
    quotes in cells are doubled; a lone quote in an unquoted cell breaks that rule and
    shows as malformed records (``malformed_report``).
    """
    lines = _lines(spark, path)
    marked = lines.join(F.broadcast(_odd_splits(lines)), ["path", "split"], "left").select("value", "path", "split", "odd")
    pieces = marked.mapInArrow(_pieces, PIECES)
    # The ends of splits: a start opens a record, the rests after it belong to it.
    order = Window.partitionBy("path").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = pieces.where(F.col("kind") != RECORD).withColumn("record", F.sum((F.col("kind") == START).cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("split", "kind", "text")))
    joined = ends.groupBy("path", "record").agg(
        F.min("split").alias("split"), F.max("first").alias("first"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")
    )
    columns = ["path", "split", "first", "text"]
    return pieces.where(F.col("kind") == RECORD).select(columns).unionByName(joined.select(columns))


CORRUPT = "_malformed"


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Text cells of all records under the header's names, and ``_malformed``: the record, if its cells do not fit the header.

    Every file starts with the same header (an error otherwise), which is dropped; empty
    lines are no records.
    """
    how = {"quote": '"', "escape": '"'}
    names = spark.read.csv(path, header=True, enforceSchema=False, **how).columns
    top = spark.read.csv(path, header=False, **how).head()
    header = [None if top is None else top[i] for i in range(len(names))]
    schema = ", ".join([f"c{i} string" for i in range(len(names))] + [f"{CORRUPT} string"])
    options = {**how, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    records = read_records(spark, path).select("first", F.rtrim(F.col("text"), F.lit("\r")).alias("text")).where(F.trim("text") != "")
    cells = records.select("first", F.from_csv("text", schema, options).alias("r"))
    same = F.lit(True)
    for i, name in enumerate(header):
        same = same & F.col(f"r.c{i}").eqNullSafe(F.lit(name))
    data = F.when(~F.col("first"), True).when(same, False).otherwise(F.raise_error(F.lit(f"Files differ in their headers: {path}")))
    out = [F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)]
    return cells.where(data).select(*out, F.col(f"r.{CORRUPT}").alias(CORRUPT))


def malformed_report(spark: SparkSession, path: str) -> DataFrame:
    """One row: records, and those whose cells do not fit the header."""
    return read_csv_records(spark, path).agg(F.count(F.lit(1)).alias("n_records"), F.count(CORRUPT).alias("n_malformed"))


# Workers then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
