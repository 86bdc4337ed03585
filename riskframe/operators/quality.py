"""Quality checks and table profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import schema as catalog
from riskframe.functions.columns import CLAIMS, POLICY, PREMIUM, ratio


def _rows(*structs: Column) -> Column:
    return F.explode(F.array(*structs)).alias("r")


def quality_report(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row per check: (check_name, severity, n, passed, detail). One scan.

    An empty table gives the single row ``empty``.
    """
    _, missing, absent = catalog.check_columns(df, required)
    _, mismatches = catalog.check_types(df)
    counts = [F.count(F.lit(1)).alias("total")]
    checks = [("rows", "info", F.col("total")), ("columns", "info", F.lit(len(df.columns)))]
    detail = {
        "missing_required": ", ".join(missing),
        "missing_expected": ", ".join(absent),
        "type_mismatch": ", ".join(f"{c}: {m}" for c, m in sorted(mismatches.items())),
    }
    checks += [
        ("missing_required", "error", F.lit(len(missing))),
        ("missing_expected", "warning", F.lit(len(absent))),
        ("type_mismatch", "warning", F.lit(len(mismatches))),
    ]
    for name, column in (("negative_premiums", PREMIUM), ("negative_claims", CLAIMS)):
        if column in df.columns:
            counts.append(F.count_if(F.col(column) < 0).alias(name))
            checks.append((name, "warning", F.col(name)))
    if POLICY in df.columns:
        present = F.count_distinct(POLICY).alias("ids")
        unknown = F.max(F.col(POLICY).isNull().cast("int")).alias("null_id")
        counts += [present, unknown]
        duplicates = F.col("total") - F.col("ids") - F.col("null_id")
        checks.append(("duplicate_ids", "warning", duplicates))
    structs = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            n.cast("bigint").alias("n"),
            (F.lit(severity == "info") | (n == 0)).alias("passed"),
            F.lit(detail.get(name, "")).alias("detail"),
        )
        for name, severity, n in checks
    ]
    empty = F.struct(
        F.lit("empty").alias("check_name"),
        F.lit("error").alias("severity"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(False).alias("passed"),
        F.lit("Table is empty").alias("detail"),
    )
    rows = F.when(F.col("total") == 0, F.array(empty)).otherwise(F.array(*structs))
    return df.agg(*counts).select(F.explode(rows).alias("r")).select("r.*")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, type family, table shape. One count."""
    structs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.lit(catalog.kind_of(f.dataType)).alias("kind"),
            F.col("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(_rows(*structs)).select("r.*")


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, most affected first. One scan for all columns."""
    fields = df.schema.fields
    counts = [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"m{i}") for i, f in enumerate(fields)]
    structs = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f"m{i}").alias("missing_count"),
            (ratio(F.col(f"m{i}"), F.col("total")) * 100).alias("missing_percentage"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
        )
        for i, f in enumerate(fields)
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("total"), *counts)
        .select(_rows(*structs))
        .select("r.*")
        .where(F.col("missing_count") > 0)
        .orderBy(F.col("missing_percentage").desc(), "column_name")
    )
