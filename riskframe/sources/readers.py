"""Scan a policy file and coerce its cells."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import schema as catalog
from riskframe.sources.records import CORRUPT, read_csv_records

log = logging.getLogger(__name__)

# Cell texts that a CSV reader of the pandas family takes as missing.
MISSING_MARKERS = [
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


#: Decimal notation; Java's own forms of numbers (12D, 5f, 0x1p3) are no numbers in a file.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
#: Texts that start like an ISO date are read as such, others by the first of DATE_FORMATS that fits.
ISO_DATE = r"^\s*[0-9]{4}-[0-9]{1,2}(-|\s*$)"
DATE_FORMATS = ["M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy"]


def read_policies(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """Lazy scan. CSV cells stay text, with the missing markers read as NULL.

    Quoted cells may hold separators, doubled quotes and, with ``multi_line``, line breaks;
    one large file is split among tasks either way (see ``records``). Lines or records
    with too few cells have NULLs, further cells are dropped; ``malformed_report`` counts them.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    if multi_line:
        raw = read_csv_records(spark, path).drop(CORRUPT)
    else:
        raw = spark.read.csv(path, header=True, enforceSchema=False, quote='"', escape='"')
    return raw.select(
        [F.when(~F.col(f"`{c}`").isin(MISSING_MARKERS), F.col(f"`{c}`")).alias(c)
         for c in raw.columns]
    )


def numeric_or_null(column: Column, text: bool = True) -> Column:
    """Double value of a cell; what is no finite number becomes NULL. ``text``: the cell is a string."""
    number = column.try_cast(T.DoubleType())
    finite = ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return F.when((column.rlike(NUMBER) & finite) if text else finite, number)


def date_or_null(column: Column, formats: list[str] | None = None) -> Column:
    """Timestamp of a cell; what is no date becomes NULL. The first format that fits wins.

    Without ``formats``: ISO dates and DATE_FORMATS (month before day). A time without a
    date is none, so no result depends on the clock.
    """
    text = column.cast("string")
    if formats:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
    others = F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)) for f in DATE_FORMATS])
    return F.when(text.rlike(ISO_DATE), F.try_to_timestamp(text)).otherwise(others)


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace the columns that exist by their numeric form."""
    return df.withColumns({c: numeric_or_null(F.col(c), _is_text(df, c)) for c in cols if c in df.columns})


def coerce_date(df: DataFrame, col: str, formats: list[str] | None = None) -> DataFrame:
    """Replace the column, if it exists, by its timestamp form."""
    if col not in df.columns or catalog.kind_of(df.schema[col].dataType) == "datetime":
        return df
    return df.withColumn(col, date_or_null(F.col(col), formats))


def coercion_report(df: DataFrame, dates: list[str] = (), numbers: list[str] = ()) -> DataFrame:
    """Per column: rows, cells missing before coercion, and cells NULL after it. One job."""
    columns = {c: date_or_null(F.col(c)) for c in dates if c in df.columns}
    columns |= {c: numeric_or_null(F.col(c), _is_text(df, c)) for c in numbers if c in df.columns}
    if not columns:
        raise ValueError("None of the columns exists")
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for i, (c, coerced) in enumerate(columns.items()):
        counts += [
            F.count_if(F.col(c).isNull()).alias(f"before_{i}"),
            F.count_if(coerced.isNull()).alias(f"after_{i}"),
        ]
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            F.col(f"before_{i}").alias("n_missing"),
            F.col(f"after_{i}").alias("n_invalid"),
        )
        for i, c in enumerate(columns)
    ]))
    return df.agg(*counts).select(rows.alias("r")).select("r.*")


def load_policies(
    spark: SparkSession,
    path: str,
    required: list[str] | None = None,
    validate: bool = True,
    fmt: str = "csv",
    date_formats: list[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Scan, check and coerce a policy table.

    FileNotFoundError if the path does not exist; ValueError if the table is empty or
    lacks a required column. Columns the catalog declares as dates or numbers are
    coerced; cells that do not parse become NULL (see ``coercion_report``).
    """
    try:
        df = read_policies(spark, path, fmt, multi_line)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Data file not found: {path}") from error
        raise
    if not df.columns or df.isEmpty():
        raise ValueError("Loaded table is empty")
    if validate:
        ok, missing, absent = catalog.check_columns(df, required)
        if not ok:
            raise ValueError(f"Missing required columns: {missing}")
        if absent:
            log.info("Optional columns absent: %s", absent)
    df = coerce_numeric(df, catalog.NUMERIC_COLUMNS)
    for c in catalog.DATE_COLUMNS:
        df = coerce_date(df, c, date_formats)
    return df


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first n rows in a stated order (by default that of all columns)."""
    return df.orderBy(*(order_by or df.columns)).limit(n)
