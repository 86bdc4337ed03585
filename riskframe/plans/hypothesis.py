"""The hypothesis report: all risk tests, their summary and what follows from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.group_tests import gender_risk, group_reports
from riskframe.operators.outcome import REJECT

# Hypothesis and kind of test per report.
HYPOTHESES = {
    "province_risk": (
        "H₀: No risk differences across provinces",
        "Chi-squared (frequency) + Kruskal-Wallis (severity)",
    ),
    "postal_risk": (
        "H₀: No risk differences between zip codes",
        "Chi-squared (frequency) + Kruskal-Wallis (severity)",
    ),
    "postal_margin": ("H₀: No margin difference between zip codes", "Kruskal-Wallis"),
    "gender_risk": (
        "H₀: No risk difference between Women and Men",
        "Chi-squared (frequency) + T-test/Mann-Whitney (severity)",
    ),
}

# Report, rejected, area, finding, recommendation, priority.
RECOMMENDATIONS = [
    ("province_risk", True, "Province-Based Pricing",
     "Significant risk differences across provinces detected",
     "Implement province-specific premium adjustments. Analyze loss ratios by province and adjust premiums accordingly.",
     "High"),
    ("province_risk", False, "Province-Based Pricing",
     "No significant risk differences across provinces",
     "Continue monitoring. No immediate premium adjustments needed based on province alone.",
     "Low"),
    ("postal_risk", True, "Zipcode-Based Pricing",
     "Significant risk differences between zipcodes detected",
     "Consider granular location-based pricing. Identify high-risk zipcodes for premium increases and low-risk zipcodes for competitive pricing.",
     "High"),
    ("postal_margin", True, "Zipcode Profitability",
     "Significant margin differences between zipcodes",
     "Target high-margin zipcodes for marketing expansion. Review low-margin zipcodes for premium optimization.",
     "Medium"),
    ("gender_risk", True, "Gender-Based Pricing",
     "Significant risk differences between genders detected",
     "Review gender-based risk profiles. Ensure compliance with local regulations before implementing gender-based pricing adjustments.",
     "Medium (with regulatory review)"),
    ("gender_risk", False, "Gender-Based Pricing",
     "No significant risk differences between genders",
     "Risk profiles are similar across genders. No gender-based premium adjustments needed.",
     "Low"),
]


def risk_reports(df: DataFrame, alpha: float = 0.05, min_n: int = 30, k: int | None = None) -> DataFrame:
    """One row per sub-test of every report whose column exists."""
    reports = group_reports(df, alpha, min_n, k)
    if "Gender" in df.columns:
        reports.append(gender_risk(df, alpha))
    if not reports:
        raise ValueError("None of the columns Province, PostalCode, Gender exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def test_summary(df: DataFrame, alpha: float = 0.05, min_n: int = 30, k: int | None = None) -> DataFrame:
    """One row per hypothesis: p-values of its sub-tests and the overall conclusion.

    The table is read several times: hand in a stored or persisted one.
    """
    rows = risk_reports(df, alpha, min_n, k)
    titles = F.create_map(*[F.lit(x) for r, (t, _) in HYPOTHESES.items() for x in (r, t)])
    kinds = F.create_map(*[F.lit(x) for r, (_, k_) in HYPOTHESES.items() for x in (r, k_)])
    return rows.groupBy("report").agg(
        F.max(F.when(F.col("component") == "frequency", F.col("p_value"))).alias("p_frequency"),
        F.max(F.when(F.col("component") != "frequency", F.col("p_value"))).alias("p_severity"),
        F.max("overall_conclusion").alias("conclusion"),
    ).select(
        "report",
        titles[F.col("report")].alias("hypothesis"),
        kinds[F.col("report")].alias("test_type"),
        "p_frequency",
        "p_severity",
        "conclusion",
    )


# A statistical term, not a software test.
test_summary.__test__ = False


def recommendations(summary: DataFrame) -> DataFrame:
    """Business recommendations that follow from a summary."""
    rules = summary.sparkSession.createDataFrame(
        RECOMMENDATIONS, "report string, rejected boolean, area string, finding string, recommendation string, priority string"
    )
    rejected = F.col("conclusion") == REJECT
    found = summary.select("report", rejected.alias("rejected"))
    return found.join(F.broadcast(rules), ["report", "rejected"]).select(
        "area", "finding", "recommendation", "priority"
    )
