"""Distribution profile."""

from __future__ import annotations

from riskframe.checks.common import over_policies, policies, rounded, staged
from riskframe.operators import metrics, profile

STATS = ["TotalPremium", "TotalClaims", "CustomValueEstimate", "SumInsured", "CalculatedPremiumPerTerm"]
STATS_DIGITS = dict.fromkeys(["mean", "std"], 4)


def _claims_histogram(log_scale):
    def query(s, sf):
        claims = metrics.with_claims(staged(s, sf, "TotalClaims"))
        return rounded(profile.histogram(claims, "TotalClaims", 50, log_scale))
    return query


def _box(*by):
    return lambda s, sf: rounded(
        profile.box_stats(staged(s, sf, "CustomValueEstimate", *by), "CustomValueEstimate", *by))


def _bounds(col):
    return lambda s, sf: rounded(
        profile.iqr_bounds(staged(s, sf, col), col))


QUERIES = {
    "descriptive_stats": lambda s, sf: rounded(
        profile.descriptive_stats(staged(s, sf, *STATS), STATS), **STATS_DIGITS),
    "iqr_bounds": _bounds("CustomValueEstimate"),
    "iqr_bounds_zero": _bounds("TotalClaims"),
    "iqr_outliers": lambda s, sf: rounded(profile.iqr_outliers(
        staged(s, sf, "UnderwrittenCoverID", "TotalPremium"), "TotalPremium", 0.5), TotalPremium=4),
    "histogram": _claims_histogram(False),
    "histogram_log": _claims_histogram(True),
    "histogram_premium": lambda s, sf: rounded(
        profile.histogram(staged(s, sf, "TotalPremium"), "TotalPremium", 50, True)),
    "log1p_if_positive": lambda s, sf: rounded(
        profile.log1p_if_positive(staged(s, sf, "SumInsured"), "SumInsured")),
    "box_stats": _box(),
    "box_stats_by": _box("Province"),
    "correlation_matrix": lambda s, sf: rounded(
        profile.correlation_matrix(policies(s, sf), STATS)),
}


def _moments(c):
    return f"""SELECT '{c}' AS measure, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max, round(skewness({c}), 6) AS skewness,
  round(kurtosis({c}), 6) AS kurtosis, round(stddev_samp({c}) / avg({c}), 6) AS coefficient_of_variation FROM policies"""


def _iqr(c):
    return over_policies(f""", q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM policies),
  b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, q3 = q1 AS flat FROM q)
  SELECT count(*) FILTER (NOT flat AND ({c} < lo OR {c} > hi)) AS outlier_count,
  round(count(*) FILTER (NOT flat AND ({c} < lo OR {c} > hi)) / count(*) * 100, 6) AS outlier_percentage,
  round(max(lo), 6) AS lower_bound, round(max(hi), 6) AS upper_bound FROM policies, b""")


def _histogram(values):
    return over_policies(f""", v AS ({values}), s AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50e0 AS w FROM v),
  e AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * w AS low, CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * w END AS high
        FROM s, range(0, 50) t(i)),
  g AS (SELECT x, least(CAST(floor((x - lo) / w) AS INTEGER), 49) AS b, lo, w FROM v, s),
  c AS (SELECT CASE WHEN x < lo + b * w THEN b - 1 WHEN b < 49 AND x >= lo + (b + 1) * w THEN b + 1 ELSE b END AS bin,
        count(*) AS n FROM g GROUP BY 1)
  SELECT e.bin, round(low, 6) AS low, round(high, 6) AS high, coalesce(n, 0) AS n FROM e LEFT JOIN c ON e.bin = c.bin""")


def _boxes(by):
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    match = f"USING ({by})" if by else "ON true"
    return over_policies(f""", r AS (SELECT {key}CustomValueEstimate AS v FROM policies WHERE CustomValueEstimate IS NOT NULL
  {'AND ' + by + ' IS NOT NULL' if by else ''}),
  q AS (SELECT {key}count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3 FROM r {group})
  SELECT {key}n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(least(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), q1), 6) AS whisker_low,
  round(greatest(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_fliers
  FROM r JOIN q {match} GROUP BY ALL""".replace("GROUP BY ALL", f"GROUP BY {key}n, q.q1, q.median, q.q3"))


SQL = {
    "descriptive_stats": over_policies(" UNION ALL ".join(_moments(c) for c in STATS)),
    "iqr_bounds": _iqr("CustomValueEstimate"),
    "iqr_bounds_zero": _iqr("TotalClaims"),
    "iqr_outliers": over_policies(""", q AS (SELECT quantile_cont(TotalPremium, 0.25) AS q1,
  quantile_cont(TotalPremium, 0.75) AS q3 FROM policies)
  SELECT UnderwrittenCoverID, round(TotalPremium, 4) AS TotalPremium FROM policies, q
  WHERE TotalPremium < q1 - 0.5 * (q3 - q1) OR TotalPremium > q3 + 0.5 * (q3 - q1)"""),
    "histogram": _histogram("SELECT TotalClaims AS x FROM policies WHERE TotalClaims > 0"),
    "histogram_log": _histogram("SELECT ln(1 + TotalClaims) AS x FROM policies WHERE TotalClaims > 0"),
    "histogram_premium": _histogram("SELECT TotalPremium AS x FROM policies WHERE TotalPremium IS NOT NULL"),
    "log1p_if_positive": over_policies("SELECT round(ln(1 + SumInsured), 6) AS value FROM policies"),
    "box_stats": _boxes(""),
    "box_stats_by": _boxes("Province"),
    "correlation_matrix": over_policies(" UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r,"
        f" count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM policies"
        for x in STATS for y in STATS)),
}
