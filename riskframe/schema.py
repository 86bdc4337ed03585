"""Column catalog of the policy table and checks that need only the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the policy table, by group.
COLUMN_GROUPS = {
    "policy": ["UnderwrittenCoverID", "PolicyID", "TransactionMonth"],
    "client": [
        "IsVATRegistered", "Citizenship", "LegalType", "Title", "Language",
        "Bank", "AccountType", "MaritalStatus", "Gender",
    ],
    "location": ["Country", "Province", "PostalCode", "MainCrestaZone", "SubCrestaZone"],
    "vehicle": [
        "ItemType", "Mmcode", "VehicleType", "RegistrationYear", "Make", "Model",
        "Cylinders", "Cubiccapacity", "Kilowatts", "Bodytype", "NumberOfDoors",
        "VehicleIntroDate", "CustomValueEstimate", "AlarmImmobiliser",
        "TrackingDevice", "CapitalOutstanding", "NewVehicle", "WrittenOff",
        "Rebuilt", "Converted", "CrossBorder", "NumberOfVehiclesInFleet",
    ],
    "plan": [
        "SumInsured", "TermFrequency", "CalculatedPremiumPerTerm", "ExcessSelected",
        "CoverCategory", "CoverType", "CoverGroup", "Section", "Product",
        "StatutoryClass", "StatutoryRiskType",
    ],
    "financial": ["TotalPremium", "TotalClaims"],
}

REQUIRED = ["PolicyID", "TotalPremium", "TotalClaims"]

# Type family expected of the key columns.
EXPECTED_TYPES = {
    "PolicyID": "string",
    "TotalPremium": "numeric",
    "TotalClaims": "numeric",
    "TransactionMonth": "datetime",
    "Province": "string",
    "PostalCode": "string",
    "Gender": "string",
    "VehicleType": "string",
    "Make": "string",
}

# Identifiers may be stored as numbers; both forms pass the type check.
ID_COLUMNS = {"PolicyID", "PostalCode"}

DATE_COLUMNS = ["TransactionMonth"]
NUMERIC_COLUMNS = [
    "RegistrationYear", "Cylinders", "Cubiccapacity", "Kilowatts", "NumberOfDoors",
    "CustomValueEstimate", "CapitalOutstanding", "NumberOfVehiclesInFleet",
    "SumInsured", "CalculatedPremiumPerTerm", "TotalPremium", "TotalClaims",
]


def catalog_type(column: str) -> T.DataType:
    if column in DATE_COLUMNS:
        return T.TimestampType()
    if column in NUMERIC_COLUMNS:
        return T.DoubleType()
    return T.StringType()


def catalog_schema(group: str | None = None) -> T.StructType:
    """Declared schema of one column group, or of the whole policy table."""
    groups = [group] if group else list(COLUMN_GROUPS)
    return T.StructType(
        [T.StructField(c, catalog_type(c), True) for g in groups for c in COLUMN_GROUPS[g]]
    )


def kind_of(data_type: T.DataType) -> str:
    """Type family: numeric (booleans excluded), categorical, datetime or other."""
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "categorical"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "other"


def select_by_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of the columns of one type family, in table order."""
    return [f.name for f in df.schema.fields if kind_of(f.dataType) == kind]


def check_columns(
    df: DataFrame,
    required: list[str] | None = None,
    expected: dict[str, list[str]] | None = None,
) -> tuple[bool, list[str], list[str]]:
    """(all required present, missing required, missing expected). Reads no data."""
    present = set(df.columns)
    needed = REQUIRED if required is None else required
    groups = COLUMN_GROUPS if expected is None else expected
    missing = [c for c in needed if c not in present]
    absent = [c for names in groups.values() for c in names if c not in present]
    return not missing, missing, absent


def check_types(
    df: DataFrame, expected: dict[str, str] | None = None
) -> tuple[bool, dict[str, str]]:
    """(all fit, mismatches) by type family; absent columns are skipped."""
    wanted = EXPECTED_TYPES if expected is None else expected
    family = {"numeric": "numeric", "string": "categorical", "datetime": "datetime"}
    mismatches = {}
    for column, want in wanted.items():
        if column not in df.columns:
            continue
        data_type = df.schema[column].dataType
        kind = kind_of(data_type)
        if kind == family[want] or (column in ID_COLUMNS and kind == "numeric"):
            continue
        mismatches[column] = f"Expected {want}, got {data_type.simpleString()}"
    return not mismatches, mismatches


def require_columns(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
