"""Column expressions: the per-row business definitions and features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREMIUM = "TotalPremium"
CLAIMS = "TotalClaims"
POLICY = "PolicyID"

# Labels and upper edges of the value bands.
BAND_LABELS = ["Low", "Medium", "High", "VeryHigh"]
VALUE_EDGES = [0.0, 50000.0, 150000.0, 300000.0]
OLDEST_VEHICLE = 50


def as_col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; NULL where the denominator is 0 or anything is missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def margin(premium: str | Column = PREMIUM, claims: str | Column = CLAIMS) -> Column:
    return as_col(premium) - as_col(claims)


def has_claim(claims: str | Column = CLAIMS) -> Column:
    """1 if the claim amount is positive, else 0 (also where it is missing)."""
    return F.when(as_col(claims) > 0, 1).otherwise(0)


def vehicle_age(as_of_year: int, year: str | Column = "RegistrationYear") -> Column:
    """Years since registration, held within 0 and 50; NULL where the year is missing."""
    age = F.lit(as_of_year) - as_col(year).try_cast("double")
    return F.when(
        age.isNotNull() & ~F.isnan(age),
        F.greatest(F.lit(0.0), F.least(F.lit(float(OLDEST_VEHICLE)), age)),
    )


def premium_to_sum_insured(
    premium: str | Column = PREMIUM, insured: str | Column = "SumInsured"
) -> Column:
    return ratio(as_col(premium), as_col(insured) + 1)


def row_loss_ratio(claims: str | Column = CLAIMS, premium: str | Column = PREMIUM) -> Column:
    """Claims over premium plus one, per row (not the ratio of the sums)."""
    return ratio(as_col(claims), as_col(premium) + 1)


def value_band(value: str | Column = "CustomValueEstimate") -> Column:
    """Label of the right-closed value band; NULL at or below the lowest edge."""
    v = as_col(value)
    band = F.when(v <= VALUE_EDGES[0], F.lit(None))
    for label, edge in zip(BAND_LABELS, VALUE_EDGES[1:]):
        band = band.when(v <= edge, label)
    return band.when(v.isNotNull(), BAND_LABELS[-1])


def band_ordinal(band: str | Column, labels: list[str] = BAND_LABELS) -> Column:
    """1-based position of a band label; NULL for a missing band."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), as_col(band)).cast("int")
    return F.when(position > 0, position)


def month_of(date: str | Column) -> Column:
    return F.date_trunc("month", as_col(date)).cast("date")


# Reading of a model feature by a part of its name; the first match wins.
FEATURE_REASONS = [
    (["VehicleAge", "RegistrationYear"],
     "Older vehicles may require higher premiums due to increased risk"),
    (["Province"], "Geographic location significantly impacts premium pricing"),
    (["VehicleType", "Make"], "Vehicle characteristics are key drivers of insurance costs"),
    (["SumInsured", "CustomValueEstimate"],
     "Vehicle value directly influences premium calculations"),
    (["Gender"], "Gender may be a factor (ensure regulatory compliance)"),
    (["PostalCode"], "Location granularity affects risk assessment"),
]


def feature_reason(feature: str | Column = "feature") -> Column:
    """Business reading of a feature name; NULL where no rule applies."""
    name = as_col(feature)
    rules = [(name.contains(part), text) for parts, text in FEATURE_REASONS for part in parts]
    reason = F.when(*rules[0])
    for condition, text in rules[1:]:
        reason = reason.when(condition, text)
    return reason
