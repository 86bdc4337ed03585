"""Demo policy tables, for use where no file is at hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Categories and value ranges of the demo tables.
PROVINCES = ["Gauteng", "Western Cape", "KwaZulu-Natal", "Eastern Cape"]
GENDERS = ["Male", "Female"]
VEHICLE_TYPES = ["Sedan", "SUV", "Hatchback", "Coupe"]
MAKES = ["Toyota", "Ford", "BMW", "Mercedes", "VW"]
POSTAL_CODES = ["1000", "2000", "3000", "4000", "5000", "6000"]
FIRST_DAY = "2014-02-01"
MEAN_CLAIM = 10000.0
CLAIM_RATE = 0.3
DEMO_ROWS = {"eda": 1000, "tests": 5000, "models": 10000}


def synthetic_policies(
    spark: SparkSession, n: int | None = None, seed: int = 42, kind: str = "models"
) -> DataFrame:
    """n demo rows of the given kind (``eda``, ``tests`` or ``models``).

    Every value is a hash of (id, column, seed), so the table is the same whatever the
    number of partitions, and a lost task recomputes the same rows.
    """

    def unit(tag: str) -> Column:
        top = F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit(tag), F.lit(seed)), 11)
        return top.cast("double") / F.lit(float(2**53))

    def uniform(tag: str, low: float, high: float) -> Column:
        return F.lit(low) + unit(tag) * F.lit(high - low)

    def choice(tag: str, values: list[str]) -> Column:
        at = F.floor(unit(tag) * F.lit(len(values))).cast("int") + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), at)

    exponential = -F.lit(MEAN_CLAIM) * F.log1p(-unit("claim_size"))
    claims = F.when(unit("claim") < CLAIM_RATE, exponential).otherwise(F.lit(0.0))
    month = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("id").cast("int")).cast("timestamp")
    postal = F.floor(uniform("postal", 1000, 9999)).cast("string")

    common = {
        "PolicyID": F.col("id"),
        "Province": choice("province", PROVINCES),
        "Gender": choice("gender", GENDERS),
        "TotalPremium": uniform("premium", 5000, 50000),
    }
    vehicle = {
        "TransactionMonth": month,
        "VehicleType": choice("vehicle", VEHICLE_TYPES),
        "CustomValueEstimate": uniform("value", 50000, 500000),
    }
    if kind == "eda":
        columns = common | vehicle | {
            "PostalCode": postal,
            "Make": choice("make", MAKES[:4]),
            "TotalClaims": uniform("claim_size", 0, 60000),
        }
    elif kind == "tests":
        columns = common | {"PostalCode": choice("postal", POSTAL_CODES[:5]), "TotalClaims": claims}
    elif kind == "models":
        columns = common | vehicle | {
            "PostalCode": choice("postal", POSTAL_CODES),
            "Make": choice("make", MAKES),
            "RegistrationYear": F.floor(uniform("year", 2000, 2020)).cast("int"),
            "SumInsured": uniform("insured", 50000, 500000),
            "CalculatedPremiumPerTerm": uniform("term", 4000, 45000),
            "TotalClaims": claims,
        }
    else:
        raise ValueError(f"Unknown kind of demo table: {kind}")
    rows = DEMO_ROWS[kind] if n is None else n
    return spark.range(rows).select([c.alias(name) for name, c in columns.items()])
