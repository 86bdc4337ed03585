"""Engineered features, encodings, imputation and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.checks.common import AS_OF_YEAR, over_policies, policies, rounded, staged
from riskframe.functions import band_ordinal, feature_reason, has_claim, month_of, value_band, vehicle_age
from riskframe.operators import features as f

ID = "UnderwrittenCoverID"
INPUTS = ["RegistrationYear", "TotalClaims", "TotalPremium", "SumInsured", "CustomValueEstimate"]
ENGINEERED = [
    "VehicleAge", "HasClaim", "PremiumToSumInsuredRatio", "LossRatio", "VehicleValueCategory",
    "VehicleValueOrdinal", "PremiumCategory", "PremiumOrdinal",
]
FILLED = ["CustomValueEstimate", "TotalPremium", "Gender", "VehicleType"]
SUPPORT = ["Province", "VehicleType", "Make", "Gender", "PostalCode", "CoverType"]


def _band(col):
    return lambda s, sf: f.quantile_band(staged(s, sf, ID, col), col, "Band").select(ID, "Band", "BandOrdinal")


def _frame(s, sf):
    table, cats, nums = f.feature_frame(
        f.engineer_features(staged(s, sf, ID, "PolicyID", "Province", "Gender", *INPUTS), AS_OF_YEAR), "HasClaim")
    return rounded(table, TotalPremium=4, SumInsured=4, CustomValueEstimate=4)


QUERIES = {
    "vehicle_age": lambda s, sf: policies(s, sf).select(ID, vehicle_age(2020).alias("VehicleAge")),
    "has_claim": lambda s, sf: policies(s, sf).select(ID, has_claim().alias("HasClaim")),
    "month_of": lambda s, sf: policies(s, sf).select(ID, month_of("TransactionMonth").alias("Month")),
    "value_band": lambda s, sf: policies(s, sf).select(
        ID, value_band().alias("Band"), band_ordinal(value_band()).alias("BandOrdinal")),
    "quantile_band": _band("TotalPremium"),
    "quantile_band_ties": _band("TotalClaims"),
    "engineer_features": lambda s, sf: rounded(
        f.engineer_features(staged(s, sf, ID, *INPUTS), AS_OF_YEAR).select(ID, *ENGINEERED)),
    "feature_frame": _frame,
    "one_hot": lambda s, sf: f.one_hot(staged(s, sf, ID, "Province", "Gender"), ["Province", "Gender"]),
    "label_encode": lambda s, sf: f.label_encode(
        staged(s, sf, ID, "Gender", "VehicleType", "PostalCode"), ["Gender", "VehicleType", "PostalCode"]),
    "impute": lambda s, sf: rounded(
        f.impute(staged(s, sf, ID, *FILLED))),
    "impute_mean_constant": lambda s, sf: rounded(
        f.impute(staged(s, sf, ID, *FILLED), "mean", "constant"), CustomValueEstimate=4, TotalPremium=4),
    "impute_most_frequent": lambda s, sf: rounded(
        f.impute(staged(s, sf, ID, "RegistrationYear", "CustomValueEstimate"), "most_frequent")),
    "label_encode_rare": lambda s, sf: f.label_encode(
        staged(s, sf, ID, "Gender", "VehicleType", "PostalCode"), ["Gender", "VehicleType", "PostalCode"], hot=40),
    "hash_split": lambda s, sf: f.hash_split(policies(s, sf).select(ID), [ID]),
    "stratified_split": lambda s, sf: f.stratified_split(
        staged(s, sf, ID, "TotalClaims").select(ID, has_claim().alias("HasClaim")), "HasClaim", [ID]),
    "feature_reason": lambda s, sf: f.category_support(policies(s, sf), SUPPORT)
    .select("feature", "n", feature_reason().alias("reason")),
}

_EDGES = "[quantile_cont({c}, 0), quantile_cont({c}, 0.25), quantile_cont({c}, 0.5), quantile_cont({c}, 0.75), quantile_cont({c}, 1)]"
_LABEL = "CASE {o} WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' WHEN 4 THEN 'VeryHigh' END"
_VALUE_BAND = (
    "CASE WHEN CustomValueEstimate <= 0 THEN NULL WHEN CustomValueEstimate <= 50000 THEN 1"
    " WHEN CustomValueEstimate <= 150000 THEN 2 WHEN CustomValueEstimate <= 300000 THEN 3"
    " WHEN CustomValueEstimate IS NOT NULL THEN 4 END"
)


def _bands(c):
    """Members e (distinct edges) and o (ordinal per row) of a WITH clause."""
    return f""", e AS (SELECT list_sort(list_distinct({_EDGES.format(c=c)})) AS edges FROM policies),
  o AS (SELECT policies.*, CASE WHEN {c} IS NULL THEN NULL ELSE greatest(1, len(list_filter(
        edges[1:greatest(len(edges) - 1, 1)], lambda x: x < {c}))) END AS band FROM policies, e)"""


def _band_sql(c):
    return over_policies(
        _bands(c) + f" SELECT {ID}, {_LABEL.format(o='band')} AS Band, CAST(band AS INTEGER) AS BandOrdinal FROM o")


_AGE = f"CAST(greatest(0, least(50, {AS_OF_YEAR} - RegistrationYear)) AS DOUBLE)"
_RATIO = "round(TotalPremium / nullif(SumInsured + 1, 0), 6)"
_CATEGORIES = {
    "Province": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "Gender": ["Male", "Not specified", None],
}


def _indicator(c, v):
    test = f"{c} IS NULL" if v is None else f"{c} = '{v}'"
    name = f"{c}_{'nan' if v is None else v}"
    return f"CASE WHEN {test} THEN 1e0 ELSE 0e0 END AS \"{name}\""


def _code(c):
    return (f"(SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM"
            f" (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM policies)) d WHERE d.v = coalesce(p.{c}, 'nan')) AS {c}")


def _mode(c):
    return f"(SELECT {c} FROM policies WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


_HASH = f"md5(concat(CAST({ID} AS VARCHAR), '|42'))"

SQL = {
    "vehicle_age": over_policies(
        f"SELECT {ID}, CAST(greatest(0, least(50, 2020 - RegistrationYear)) AS DOUBLE) AS VehicleAge FROM policies"),
    "has_claim": over_policies(f"SELECT {ID}, CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END AS HasClaim FROM policies"),
    "month_of": over_policies(f"SELECT {ID}, CAST(date_trunc('month', TransactionMonth) AS DATE) AS Month FROM policies"),
    "value_band": over_policies(
        f", o AS (SELECT {ID}, {_VALUE_BAND} AS band FROM policies)"
        f" SELECT {ID}, {_LABEL.format(o='band')} AS Band, CAST(band AS INTEGER) AS BandOrdinal FROM o"),
    "quantile_band": _band_sql("TotalPremium"),
    "quantile_band_ties": _band_sql("TotalClaims"),
    "engineer_features": over_policies(_bands("TotalPremium") + f""" SELECT {ID}, {_AGE} AS VehicleAge,
  CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END AS HasClaim, {_RATIO} AS PremiumToSumInsuredRatio,
  round(TotalClaims / nullif(TotalPremium + 1, 0), 6) AS LossRatio,
  {_LABEL.format(o='(' + _VALUE_BAND + ')')} AS VehicleValueCategory, {_VALUE_BAND} AS VehicleValueOrdinal,
  {_LABEL.format(o='band')} AS PremiumCategory, CAST(band AS INTEGER) AS PremiumOrdinal FROM o"""),
    "feature_frame": over_policies(_bands("TotalPremium") + f""" SELECT Province, Gender,
  {_LABEL.format(o='(' + _VALUE_BAND + ')')} AS VehicleValueCategory, {_LABEL.format(o='band')} AS PremiumCategory,
  RegistrationYear, round(TotalPremium, 4) AS TotalPremium, round(SumInsured, 4) AS SumInsured,
  round(CustomValueEstimate, 4) AS CustomValueEstimate, {_AGE} AS VehicleAge, {_RATIO} AS PremiumToSumInsuredRatio,
  CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END AS HasClaim FROM o"""),
    "one_hot": over_policies(
        f"SELECT {ID}, " + ", ".join(_indicator(c, v) for c, vs in _CATEGORIES.items() for v in vs) + " FROM policies"),
    "label_encode": over_policies(
        f"SELECT {ID}, " + ", ".join(_code(c) for c in ("Gender", "VehicleType", "PostalCode")) + " FROM policies p"),
    "impute": over_policies(f""", q AS (SELECT quantile_cont(CustomValueEstimate, 0.5) AS v,
  quantile_cont(TotalPremium, 0.5) AS t FROM policies)
  SELECT {ID}, round(coalesce(CustomValueEstimate, v), 6) AS CustomValueEstimate, round(coalesce(TotalPremium, t), 6)
  AS TotalPremium, coalesce(Gender, {_mode('Gender')}) AS Gender, coalesce(VehicleType, {_mode('VehicleType')})
  AS VehicleType FROM policies, q"""),
    "impute_mean_constant": over_policies(f""", q AS (SELECT avg(CustomValueEstimate) AS v, avg(TotalPremium) AS t FROM policies)
  SELECT {ID}, round(coalesce(CustomValueEstimate, v), 4) AS CustomValueEstimate, round(coalesce(TotalPremium, t), 4)
  AS TotalPremium, coalesce(Gender, 'missing_value') AS Gender, coalesce(VehicleType, 'missing_value') AS VehicleType FROM policies, q"""),
    "impute_most_frequent": over_policies(f"""
  SELECT {ID}, CAST(RegistrationYear AS DOUBLE) AS RegistrationYear, round(coalesce(CustomValueEstimate, {_mode('CustomValueEstimate')}), 6) AS CustomValueEstimate
  FROM policies"""),
    "label_encode_rare": over_policies(
        f"SELECT {ID}, " + ", ".join(_code(c) for c in ("Gender", "VehicleType", "PostalCode")) + " FROM policies p"),
    "hash_split": over_policies(
        f"SELECT {ID}, CAST(concat('0x', substr({_HASH}, 1, 8)) AS BIGINT) / 4294967296.0 < 0.2 AS is_test FROM policies"),
    "stratified_split": over_policies(f""", h AS (SELECT {ID}, CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END AS HasClaim,
  {_HASH} AS h FROM policies),
  r AS (SELECT *, rank() OVER (PARTITION BY HasClaim ORDER BY h) AS r, count(*) OVER (PARTITION BY HasClaim) AS n FROM h)
  SELECT {ID}, HasClaim, r <= floor(n * 0.2e0 + 0.5e0) AS is_test FROM r"""),
    "feature_reason": over_policies(", s AS (" + " UNION ALL ".join(
        f"SELECT concat('{c}_', coalesce({c}, 'nan')) AS feature, count(*) AS n FROM policies GROUP BY 1" for c in SUPPORT)
        + """) SELECT feature, n, CASE
  WHEN feature LIKE '%VehicleAge%' OR feature LIKE '%RegistrationYear%' THEN 'Older vehicles may require higher premiums due to increased risk'
  WHEN feature LIKE '%Province%' THEN 'Geographic location significantly impacts premium pricing'
  WHEN feature LIKE '%VehicleType%' OR feature LIKE '%Make%' THEN 'Vehicle characteristics are key drivers of insurance costs'
  WHEN feature LIKE '%SumInsured%' OR feature LIKE '%CustomValueEstimate%' THEN 'Vehicle value directly influences premium calculations'
  WHEN feature LIKE '%Gender%' THEN 'Gender may be a factor (ensure regulatory compliance)'
  WHEN feature LIKE '%PostalCode%' THEN 'Location granularity affects risk assessment' END AS reason FROM s"""),
}
