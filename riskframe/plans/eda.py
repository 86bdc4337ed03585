"""The exploratory report: quality, missing values, portfolio and segment KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.operators import metrics, profile, quality

KEY_COLUMNS = ["TotalPremium", "TotalClaims", "CustomValueEstimate", "SumInsured", "CalculatedPremiumPerTerm"]


def eda_report(df: DataFrame) -> dict[str, DataFrame]:
    """Lazy result tables by name; parts whose columns are absent are left out."""
    have = set(df.columns)
    report = {
        "profile": quality.column_profile(df),
        "missing": quality.missing_report(df),
        "quality": quality.quality_report(df),
    }
    if {"TotalPremium", "TotalClaims"} <= have:
        report["portfolio"] = metrics.portfolio_kpis(df)
        for key in ("Province", "VehicleType", "Gender"):
            if key in have:
                report[f"segment_{key}"] = metrics.segment_kpis(df, [key])
        if "TransactionMonth" in have:
            report["monthly"] = metrics.monthly_kpis(df)
        if {"Make", "VehicleType"} <= have:
            report["vehicle_risk"] = metrics.vehicle_risk(df)
            report["make_extremes"] = metrics.make_extremes(df)
        if "PostalCode" in have:
            report["postal"] = metrics.postal_scatter(df)
    numbers = [c for c in KEY_COLUMNS if c in have]
    if len(numbers) > 1:
        report["correlation"] = profile.correlation_matrix(df, numbers)
    if numbers:
        report["stats"] = profile.descriptive_stats(df, numbers)
    return report
