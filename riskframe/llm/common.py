"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.tables import shared_folder, stage

__all__ = ["new_folder", "shared_folder", "small_batches", "stage", "table", "text_of", "unused"]

#: Rows and bytes of text in an Arrow batch handed to Python.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as keep them apart from the table's columns."""
    taken = {c.lower() for c in df.columns}
    mark = "_"
    while any(mark + n.lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, so that long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
