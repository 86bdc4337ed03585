"""Portfolio, segment, time and vehicle aggregates."""

from __future__ import annotations

from riskframe.checks.common import (
    CLAIMS, FREQUENCY, LOSS, MONEY, PREMIUM, SEVERITY, over_policies, policies, rounded,
)
from riskframe.functions import margin
from riskframe.operators import metrics as m


def _money(df):
    return rounded(df, **MONEY)


def _trend(how):
    return lambda s, sf: rounded(
        m.temporal_trend(policies(s, sf), "TransactionMonth", "TotalClaims", how), value=4)


QUERIES = {
    "portfolio_kpis": lambda s, sf: _money(m.portfolio_kpis(policies(s, sf))),
    "loss_ratio": lambda s, sf: rounded(policies(s, sf).agg(m.loss_ratio().alias("LossRatio"))),
    "claim_frequency": lambda s, sf: rounded(policies(s, sf).agg(m.claim_frequency().alias("ClaimFrequency"))),
    "claim_severity": lambda s, sf: _money(policies(s, sf).agg(m.claim_severity().alias("ClaimSeverity"))),
    "margin": lambda s, sf: rounded(
        policies(s, sf).select("UnderwrittenCoverID", margin().alias("Margin")), Margin=4),
    "with_claims": lambda s, sf: _money(
        m.with_claims(policies(s, sf)).select("UnderwrittenCoverID", "TotalClaims")),
    "segment_kpis_province": lambda s, sf: _money(m.segment_kpis(policies(s, sf), ["Province"])),
    "segment_kpis_vehicle": lambda s, sf: _money(m.segment_kpis(policies(s, sf), ["VehicleType"])),
    "segment_kpis_gender": lambda s, sf: _money(m.segment_kpis(policies(s, sf), ["Gender"])),
    "distinct_and_top": lambda s, sf: m.distinct_and_top(policies(s, sf), "Make"),
    "distinct_and_top_province": lambda s, sf: m.distinct_and_top(policies(s, sf), "Province"),
    "category_counts": lambda s, sf: m.category_counts(policies(s, sf), "Make", 20),
    "temporal_sum": _trend("sum"),
    "temporal_mean": _trend("mean"),
    "temporal_count": _trend("count"),
    "loss_ratio_by": lambda s, sf: _money(m.loss_ratio_by(policies(s, sf), "MainCrestaZone", 15)),
    "risk_return": lambda s, sf: _money(m.risk_return(policies(s, sf))),
    "monthly_kpis": lambda s, sf: _money(m.monthly_kpis(policies(s, sf))),
    "vehicle_risk": lambda s, sf: _money(m.vehicle_risk(policies(s, sf))),
    "make_extremes": lambda s, sf: _money(m.make_extremes(policies(s, sf))),
    "postal_scatter": lambda s, sf: _money(m.postal_scatter(policies(s, sf))),
    "postal_corr": lambda s, sf: rounded(m.postal_corr(policies(s, sf))),
    "postal_margin": lambda s, sf: _money(m.postal_margin(policies(s, sf))),
    "min_sample_filter": lambda s, sf: _money(m.min_sample_filter(
        policies(s, sf).select("UnderwrittenCoverID", "PostalCode", "TotalClaims"), "PostalCode", 50)),
    "top_groups": lambda s, sf: _money(m.top_groups(
        policies(s, sf).select("UnderwrittenCoverID", "PostalCode", "TotalClaims"), "PostalCode", 20, 30)),
    "sample_n": lambda s, sf: m.sample_n(
        policies(s, sf).select("UnderwrittenCoverID"), 500, ["UnderwrittenCoverID"]),
}


def _segment(key):
    return over_policies(
        f"SELECT {key}, {PREMIUM} AS TotalPremium, {CLAIMS} AS TotalClaims, count(PolicyID) AS PolicyCount,"
        f" {LOSS} AS LossRatio, {FREQUENCY} AS ClaimFrequency, {SEVERITY} AS ClaimSeverity"
        f" FROM policies WHERE {key} IS NOT NULL GROUP BY {key}")


def _top(col):
    return over_policies(
        f", c AS (SELECT {col} AS v, count(*) AS n FROM policies WHERE {col} IS NOT NULL GROUP BY 1)"
        f" SELECT '{col}' AS column_name, (SELECT count(*) FROM c) AS distinct_values, v AS top_value,"
        " n AS top_count FROM c ORDER BY n DESC, v LIMIT 1")


def _time(value):
    return over_policies(
        f"SELECT TransactionMonth, {value} AS value FROM policies WHERE TransactionMonth IS NOT NULL GROUP BY 1")


_SIZES = ", z AS (SELECT PostalCode, count(*) AS n FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1)"

SQL = {
    "portfolio_kpis": over_policies(
        f'SELECT count(*) AS "Rows", {PREMIUM} AS TotalPremium, {CLAIMS} AS TotalClaims,'
        " round(coalesce(sum(TotalPremium), 0) - coalesce(sum(TotalClaims), 0), 4) AS TotalMargin,"
        f" {LOSS} AS LossRatio, {FREQUENCY} AS ClaimFrequency, {SEVERITY} AS ClaimSeverity FROM policies"),
    "loss_ratio": over_policies(f"SELECT {LOSS} AS LossRatio FROM policies"),
    "claim_frequency": over_policies(f"SELECT {FREQUENCY} AS ClaimFrequency FROM policies"),
    "claim_severity": over_policies(f"SELECT {SEVERITY} AS ClaimSeverity FROM policies"),
    "margin": over_policies("SELECT UnderwrittenCoverID, round(TotalPremium - TotalClaims, 4) AS Margin FROM policies"),
    "with_claims": over_policies(
        "SELECT UnderwrittenCoverID, round(TotalClaims, 4) AS TotalClaims FROM policies WHERE TotalClaims > 0"),
    "segment_kpis_province": _segment("Province"),
    "segment_kpis_vehicle": _segment("VehicleType"),
    "segment_kpis_gender": _segment("Gender"),
    "distinct_and_top": _top("Make"),
    "distinct_and_top_province": _top("Province"),
    "category_counts": over_policies(
        "SELECT Make AS value, count(*) AS n FROM policies WHERE Make IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 20"),
    "temporal_sum": _time(CLAIMS),
    "temporal_mean": _time("round(avg(TotalClaims), 4)"),
    "temporal_count": _time("count(TotalClaims)"),
    "loss_ratio_by": over_policies(
        f"SELECT MainCrestaZone, {CLAIMS} AS TotalClaims, {PREMIUM} AS TotalPremium, {LOSS} AS LossRatio FROM policies"
        " WHERE MainCrestaZone IS NOT NULL GROUP BY 1"
        " ORDER BY sum(TotalClaims) / nullif(sum(TotalPremium), 0) DESC NULLS LAST, MainCrestaZone LIMIT 15"),
    "risk_return": over_policies(
        f"SELECT Province, {PREMIUM} AS TotalPremium, {CLAIMS} AS TotalClaims, count(PolicyID) AS PolicyCount,"
        f" {LOSS} AS LossRatio, round(coalesce(sum(TotalPremium), 0) / nullif(count(PolicyID), 0), 4) AS AvgPremium"
        " FROM policies WHERE Province IS NOT NULL GROUP BY 1"),
    "monthly_kpis": over_policies(
        f"SELECT CAST(date_trunc('month', TransactionMonth) AS DATE) AS Month, {PREMIUM} AS TotalPremium,"
        f" {CLAIMS} AS TotalClaims, count(PolicyID) AS PolicyCount, {LOSS} AS LossRatio,"
        f" {FREQUENCY} AS ClaimFrequency, {SEVERITY} AS ClaimSeverity"
        " FROM policies WHERE TransactionMonth IS NOT NULL GROUP BY 1"),
    "vehicle_risk": over_policies(
        f"SELECT Make, VehicleType, {PREMIUM} AS TotalPremium, {CLAIMS} AS TotalClaims, count(PolicyID) AS PolicyCount,"
        f" {LOSS} AS LossRatio FROM policies WHERE Make IS NOT NULL AND VehicleType IS NOT NULL GROUP BY 1, 2"
        " HAVING count(PolicyID) >= 50"
        " ORDER BY sum(TotalClaims) / nullif(sum(TotalPremium), 0) DESC NULLS LAST, Make, VehicleType LIMIT 20"),
    "make_extremes": over_policies(f""", g AS (SELECT Make, coalesce(sum(TotalClaims), 0) AS total,
  round(avg(TotalClaims), 4) AS AvgClaims, count(TotalClaims) AS PolicyCount FROM policies
  WHERE Make IS NOT NULL GROUP BY 1 HAVING count(TotalClaims) >= 10)
  SELECT Make, round(total, 4) AS TotalClaims_Sum, AvgClaims, PolicyCount, side FROM (
  (SELECT *, 'top' AS side FROM g ORDER BY total DESC, Make LIMIT 10) UNION ALL
  (SELECT *, 'bottom' FROM g ORDER BY total, Make LIMIT 10))"""),
    "postal_scatter": over_policies(
        f"SELECT PostalCode, {PREMIUM} AS TotalPremium, {CLAIMS} AS TotalClaims, count(PolicyID) AS PolicyCount"
        " FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1"),
    "postal_corr": over_policies(
        ", g AS (SELECT PostalCode, coalesce(sum(TotalPremium), 0) AS p, coalesce(sum(TotalClaims), 0) AS c"
        " FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1)"
        " SELECT round(corr(p, c), 6) AS correlation, count(*) AS n_groups FROM g"),
    "postal_margin": over_policies(
        "SELECT PostalCode, round((coalesce(sum(TotalPremium), 0) - coalesce(sum(TotalClaims), 0)) / count(*), 4) AS AvgMargin,"
        " count(*) AS PolicyCount FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1 HAVING count(*) >= 30"
        " ORDER BY PolicyCount DESC, PostalCode LIMIT 10"),
    "min_sample_filter": over_policies(_SIZES + (
        " SELECT UnderwrittenCoverID, PostalCode, round(TotalClaims, 4) AS TotalClaims FROM policies"
        " WHERE PostalCode IN (SELECT PostalCode FROM z WHERE n >= 50)")),
    "top_groups": over_policies(_SIZES + (
        " SELECT UnderwrittenCoverID, PostalCode, round(TotalClaims, 4) AS TotalClaims FROM policies"
        " WHERE PostalCode IN (SELECT PostalCode FROM z WHERE n >= 30 ORDER BY n DESC, PostalCode LIMIT 20)")),
    "sample_n": over_policies(
        "SELECT UnderwrittenCoverID FROM policies ORDER BY md5(concat(CAST(UnderwrittenCoverID AS VARCHAR), '|42')) LIMIT 500"),
}
