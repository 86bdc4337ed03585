"""Sources, quality and table comparison."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.checks.common import over_policies, policies, rounded
from riskframe.operators import quality
from riskframe.schema import COLUMN_GROUPS, select_by_kind
from riskframe.sources import (
    coerce_date, coerce_numeric, coercion_report, load_policies, malformed_report, preview, read_snapshot, shared_folder,
    snapshot_table, table_diff, table_fingerprint, write_result,
)

RAW_NUMBER = (
    "CASE WHEN Gender IS NULL THEN 'NaN' WHEN Gender <> 'Not specified' THEN PostalCode WHEN PolicyID % 5 = 0 THEN '12D'"
    " WHEN PolicyID % 5 = 1 THEN '5f' WHEN PolicyID % 5 = 2 THEN '0x1p3' WHEN PolicyID % 5 = 3 THEN 'inf' ELSE 'unknown' END"
)
RAW_DATE = (
    "CASE WHEN Gender IS NULL THEN '2015-13-01' WHEN Gender = 'Not specified' THEN 'n/a'"
    " ELSE CAST(TransactionMonth AS STRING) END"
)
MISSING = ["Gender", "VehicleType", "CustomValueEstimate", "TotalPremium", "TotalClaims"]
CENTS = "CAST(floor(TotalPremium * 100 + 0.5e0) AS BIGINT)"
PRINTED = ["PolicyID", "Province", "Gender", "PostalCode", "TransactionMonth", "Cents"]
CLEANED = ["UnderwrittenCoverID", "PolicyID", "Gender", "TotalPremium"]


def raw_cells(spark, sf):
    return policies(spark, sf).select(
        "UnderwrittenCoverID", F.expr(RAW_NUMBER).alias("number"), F.expr(RAW_DATE).alias("date")
    )


def diff(spark, sf, keys=None):
    old = policies(spark, sf).select(CLEANED)
    new = old.withColumn("Gender", F.coalesce("Gender", F.lit("Unknown"))).where(
        F.col("TotalPremium").isNull() | (F.col("TotalPremium") >= 0)
    )
    return rounded(table_diff(old, new, keys), TotalPremium=4)


#: Cells of a written file: quotes, separators and line breaks inside, dates and numbers as text.
WRITTEN = {
    "PolicyID": "CAST(PolicyID AS STRING)", "UnderwrittenCoverID": "CAST(UnderwrittenCoverID AS STRING)",
    "TransactionMonth": "CASE WHEN PolicyID % 11 = 0 THEN 'soon' ELSE CAST(TransactionMonth AS STRING) END",
    "VehicleType": "CASE WHEN PolicyID % 3 = 0 THEN Make || chr(10) || chr(34) || VehicleType || chr(34) || ', or ' || chr(10) || Gender ELSE VehicleType END",
    "TotalPremium": "CASE WHEN PolicyID % 13 = 0 THEN 'n/a' ELSE CAST(PolicyID AS STRING) END",
    "TotalClaims": "CASE WHEN TotalClaims > 0 THEN '1.5e3' ELSE '0' END",
}


def _folder(spark, name):
    return f"{shared_folder(spark)}/riskframe/{name}-{uuid.uuid4().hex}"


def _csv(spark, sf):
    """The view's rows as CSV, one part per task."""
    path = _folder(spark, "csv")
    cells = policies(spark, sf).select(*[F.expr(e).alias(c) for c, e in WRITTEN.items()])
    cells.write.option("escape", '"').csv(path, header=True)
    return path


def loaded(spark, sf):
    """Written, loaded, checked and coerced."""
    return load_policies(spark, _csv(spark, sf)).select(
        "PolicyID", "UnderwrittenCoverID", F.col("TransactionMonth").cast("date").alias("TransactionMonth"), "VehicleType",
        "TotalPremium", "TotalClaims")


def snapshots(spark, sf):
    """Two versions of a table, each checked against its manifest, and what both hold."""
    root = _folder(spark, "snapshots")
    old = policies(spark, sf).select(CLEANED)
    snapshot_table(old, root, "1")
    snapshot_table(old.where("TotalPremium >= 0"), root, "2")
    for version in ("1", "2"):
        read_snapshot(spark, root, version, check=True)
    return rounded(read_snapshot(spark, root).withColumn("version", F.col("version").cast("int")), TotalPremium=4)


def written(spark, sf):
    """A result written by province and read back."""
    path = _folder(spark, "result")
    write_result(policies(spark, sf).select("UnderwrittenCoverID", "Province", "Gender"), path, partition_by=["Province"])
    return spark.read.parquet(path).select("UnderwrittenCoverID", "Province", "Gender")


def catalog_columns(spark, sf):
    """Type family, catalog group and number of values of each column."""
    df = policies(spark, sf)
    group = {c: g for g, names in COLUMN_GROUPS.items() for c in names}
    kinds = {c: k for k in ("numeric", "categorical", "datetime") for c in select_by_kind(df, k)}
    return df.agg(*[F.count(c).alias(c) for c in kinds]).select(
        F.stack(F.lit(len(kinds)), *[x for c, k in kinds.items() for x in (F.lit(c), F.lit(k), F.lit(group.get(c, "")), F.col(c))])
        .alias("column_name", "kind", "column_group", "n_values"))


QUERIES = {
    "load_policies": loaded,
    "malformed_report": lambda s, sf: malformed_report(s, _csv(s, sf)),
    "snapshots": snapshots,
    "write_result": written,
    "catalog_columns": catalog_columns,
    "quality_report": lambda s, sf: quality.quality_report(policies(s, sf)),
    "missing_report": lambda s, sf: rounded(quality.missing_report(policies(s, sf))),
    "column_profile": lambda s, sf: quality.column_profile(policies(s, sf)),
    "coerce_numeric": lambda s, sf: coerce_numeric(raw_cells(s, sf), ["number"]).drop("date"),
    "coerce_date": lambda s, sf: coerce_date(raw_cells(s, sf), "date")
    .select("UnderwrittenCoverID", F.col("date").cast("date").alias("date")),
    "coercion_report": lambda s, sf: coercion_report(raw_cells(s, sf), ["date"], ["number"]),
    "preview": lambda s, sf: rounded(preview(
        policies(s, sf).select("UnderwrittenCoverID", "Province", "TotalClaims"),
        5, ["UnderwrittenCoverID", "Province", "TotalClaims"])),
    "table_fingerprint_md5": lambda s, sf: table_fingerprint(
        policies(s, sf).withColumn("Cents", F.expr(CENTS)), PRINTED, "md5"),
    "table_diff": lambda s, sf: diff(s, sf),
    "table_diff_keys": lambda s, sf: diff(s, sf, ["UnderwrittenCoverID"]),
}

VIEW_COLUMNS = 17
ABSENT_COLUMNS = 52 - VIEW_COLUMNS  # catalog columns that the view does not have

_DIFF = """, old AS (SELECT UnderwrittenCoverID, PolicyID, Gender, TotalPremium FROM policies),
new AS (SELECT UnderwrittenCoverID, PolicyID, coalesce(Gender, 'Unknown') AS Gender, TotalPremium FROM old
        WHERE TotalPremium IS NULL OR TotalPremium >= 0),
delta AS (SELECT UnderwrittenCoverID, PolicyID, Gender, TotalPremium, CAST(sum(d) AS BIGINT) AS d
          FROM (SELECT *, -1 AS d FROM old UNION ALL SELECT *, 1 FROM new) GROUP BY ALL HAVING sum(d) <> 0),
diff AS (SELECT UnderwrittenCoverID, PolicyID, Gender, round(TotalPremium, 4) AS TotalPremium,
                CASE WHEN d > 0 THEN 'added' ELSE 'removed' END AS change, abs(d) AS copies FROM delta)
"""

# Columns of the view, in order, with type and type family.
_TYPES = [
    ("UnderwrittenCoverID", "bigint"), ("PolicyID", "bigint"), ("TransactionMonth", "date"), ("Province", "string"),
    ("MainCrestaZone", "string"), ("PostalCode", "string"), ("Gender", "string"), ("CoverType", "string"),
    ("CoverCategory", "string"), ("VehicleType", "string"), ("Make", "string"), ("RegistrationYear", "int"),
    ("SumInsured", "double"), ("CustomValueEstimate", "double"), ("CalculatedPremiumPerTerm", "double"),
    ("TotalPremium", "double"), ("TotalClaims", "double"),
]
# Names of the catalog that the view lacks, in catalog order.
_ABSENT = ", ".join(c for names in COLUMN_GROUPS.values() for c in names if c not in dict(_TYPES))
_KINDS = {"string": "categorical", "date": "datetime"}

_GROUPS = {c: g for g, names in COLUMN_GROUPS.items() for c in names}

SQL = {
    "load_policies": over_policies(f""", c AS (SELECT {", ".join(f"{e} AS {c}" for c, e in WRITTEN.items())} FROM policies)
  SELECT PolicyID, UnderwrittenCoverID, try_cast(TransactionMonth AS DATE) AS TransactionMonth, VehicleType,
  try_cast(TotalPremium AS DOUBLE) AS TotalPremium, CAST(TotalClaims AS DOUBLE) AS TotalClaims FROM c"""),
    "malformed_report": over_policies(" SELECT count(*) AS n_records, CAST(0 AS BIGINT) AS n_malformed FROM policies"),
    "snapshots": over_policies(", s AS (SELECT UnderwrittenCoverID, PolicyID, Gender, round(TotalPremium, 4) AS TotalPremium FROM policies)"
                               " SELECT *, 1 AS version FROM s UNION ALL SELECT *, 2 FROM s WHERE TotalPremium >= 0"),
    "write_result": over_policies(" SELECT UnderwrittenCoverID, Province, Gender FROM policies"),
    "catalog_columns": over_policies(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{_KINDS.get(t, 'numeric')}' AS kind, '{_GROUPS.get(c, '')}' AS column_group,"
        f" count({c}) AS n_values FROM policies" for c, t in _TYPES)),
    "column_profile": over_policies(" UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS dtype, '{_KINDS.get(t, 'numeric')}' AS kind,"
        f" (SELECT count(*) FROM policies) AS n_rows, {len(_TYPES)} AS n_columns" for i, (c, t) in enumerate(_TYPES))),
    "quality_report": over_policies(f""", c AS (SELECT count(*) AS total,
  count(*) FILTER (TotalPremium < 0) AS negative_premiums, count(*) FILTER (TotalClaims < 0) AS negative_claims,
  count(PolicyID) - count(DISTINCT PolicyID) + greatest(count(*) - count(PolicyID) - 1, 0) AS duplicate_ids FROM policies),
  r AS (SELECT 'rows' AS check_name, 'info' AS severity, total AS n FROM c
  UNION ALL SELECT 'columns', 'info', {VIEW_COLUMNS} UNION ALL SELECT 'missing_required', 'error', 0
  UNION ALL SELECT 'missing_expected', 'warning', {ABSENT_COLUMNS} UNION ALL SELECT 'type_mismatch', 'warning', 0
  UNION ALL SELECT 'negative_premiums', 'warning', negative_premiums FROM c
  UNION ALL SELECT 'negative_claims', 'warning', negative_claims FROM c
  UNION ALL SELECT 'duplicate_ids', 'warning', duplicate_ids FROM c)
  SELECT check_name, severity, CAST(n AS BIGINT) AS n, severity = 'info' OR n = 0 AS passed,
         CASE WHEN check_name = 'missing_expected' THEN '{_ABSENT}' ELSE '' END AS detail FROM r"""),
    "missing_report": over_policies(", m AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, count(*) AS total,"
        f" '{'string' if c in ('Gender', 'VehicleType') else 'double'}' AS dtype FROM policies"
        for c in MISSING
    ) + ") SELECT column_name, missing_count, round(missing_count / total * 100, 6) AS missing_percentage, dtype"
        " FROM m WHERE missing_count > 0"),
    "coerce_numeric": over_policies(
        f", c AS (SELECT UnderwrittenCoverID, try_cast({RAW_NUMBER} AS DOUBLE) AS x FROM policies)"
        " SELECT UnderwrittenCoverID, CASE WHEN isfinite(x) THEN x END AS number FROM c"),
    "coerce_date": over_policies(
        f"SELECT UnderwrittenCoverID, try_cast({RAW_DATE} AS DATE) AS date FROM policies"),
    "coercion_report": over_policies("""
  SELECT 'date' AS column_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing,
         count(*) FILTER (Gender IS NULL OR Gender = 'Not specified') AS n_invalid FROM policies
  UNION ALL SELECT 'number', count(*), 0, count(*) FILTER (Gender IS NULL OR Gender = 'Not specified') FROM policies"""),
    "preview": over_policies("""SELECT UnderwrittenCoverID, Province, round(TotalClaims, 6) AS TotalClaims FROM policies
  ORDER BY UnderwrittenCoverID, Province, TotalClaims NULLS FIRST LIMIT 5"""),
    "table_fingerprint_md5": over_policies(f", t AS (SELECT *, {CENTS} AS Cents FROM policies) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values,"
        f" CAST(sum(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 15) AS BIGINT)) AS VARCHAR) AS content_hash"
        " FROM t" for c in PRINTED)),
    "table_diff": over_policies(_DIFF + "SELECT * FROM diff"),
    "table_diff_keys": over_policies(_DIFF + """, sides AS (SELECT UnderwrittenCoverID FROM diff
  GROUP BY 1 HAVING count(DISTINCT change) = 2)
  SELECT d.* REPLACE (CASE WHEN s.UnderwrittenCoverID IS NULL THEN change WHEN change = 'added' THEN 'changed_to'
    ELSE 'changed_from' END AS change) FROM diff d LEFT JOIN sides s USING (UnderwrittenCoverID)"""),
}
