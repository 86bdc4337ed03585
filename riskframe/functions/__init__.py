"""Column expressions and p-value kernels."""

from riskframe.functions.columns import (
    band_ordinal,
    feature_reason,
    has_claim,
    margin,
    month_of,
    premium_to_sum_insured,
    ratio,
    row_loss_ratio,
    value_band,
    vehicle_age,
)

__all__ = [
    "band_ordinal", "feature_reason", "has_claim", "margin", "month_of",
    "premium_to_sum_insured", "ratio", "row_loss_ratio", "value_band", "vehicle_age",
]
