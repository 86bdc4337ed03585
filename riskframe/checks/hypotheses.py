"""Ranks, statistical tests, risk reports and recommendations."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskframe.checks.common import chi2_tail, over_policies, policies, result, rounded, staged, t_tail
from riskframe.functions import kernels
from riskframe.operators import ab_tests, group_tests, normality, ordering
from riskframe.operators.metrics import with_claims
from riskframe.plans import hypothesis

ID = "UnderwrittenCoverID"
SEGMENTS = ["Province", "PostalCode", "Gender", "TotalPremium", "TotalClaims"]
BAND = "CAST(floor(TotalClaims / 1000) AS DOUBLE)"


def _claims(s, sf, *keys, banded=False):
    claims = with_claims(staged(s, sf, *keys, "TotalClaims"))
    return claims.withColumn("TotalClaims", F.expr(BAND)) if banded else claims


def _mann_whitney(banded):
    return lambda s, sf: rounded(ab_tests.mann_whitney(
        _claims(s, sf, "Gender", banded=banded), "TotalClaims", "Gender", "Female", "Male"))


def _kruskal(banded):
    return lambda s, sf: rounded(group_tests.kruskal_k(
        _claims(s, sf, "Province", banded=banded), "TotalClaims", "Province"))


def _severity(normal=False, **how):
    """Severity of the genders; ``normal`` puts normal deviates of hashed ids in place of the claims."""
    def run(s, sf):
        rows = staged(s, sf, ID, "Gender", "TotalClaims")
        if normal:
            a, b = ((F.conv(F.substring(F.md5(F.col(ID).cast("string")), i, 8), 16, 10).cast("double") + 0.5) / 2.0**32 for i in (1, 9))
            score = F.sqrt(-2 * F.ln(a)) * F.cos(2 * math.pi * b)
            rows = rows.withColumn("TotalClaims", F.when(F.col("TotalClaims") > 0, 50_000 + 8_000 * score))
        return rounded(ab_tests.severity_ab(rows, "Gender", "Female", "Male", **how),
                       group_a_severity=4, group_b_severity=4, severity_difference=4)

    return run


QUERIES = {
    "average_rank": lambda s, sf: rounded(ordering.average_rank(_claims(s, sf), "TotalClaims")),
    "average_rank_ties": lambda s, sf: rounded(
        ordering.average_rank(_claims(s, sf, banded=True), "TotalClaims")),
    "ab_groups": lambda s, sf: rounded(ab_tests.ab_groups(
        policies(s, sf).select("UnderwrittenCoverID", "Gender", "TotalClaims"), "Gender", "Female", "Male"), TotalClaims=4),
    "chi2_frequency_ab": lambda s, sf: rounded(
        ab_tests.chi2_frequency_ab(policies(s, sf), "Gender", "Female", "Male")),
    "welch_t": lambda s, sf: rounded(ab_tests.welch_t(
        with_claims(policies(s, sf)), "TotalClaims", "Gender", "Female", "Male"), mean_a=4, mean_b=4),
    "mann_whitney": _mann_whitney(False),
    "mann_whitney_ties": _mann_whitney(True),
    "shapiro_wilk": lambda s, sf: rounded(ab_tests.shapiro_wilk(
        with_claims(policies(s, sf)), "TotalClaims", "MainCrestaZone")),
    "shapiro_wilk_ties": lambda s, sf: rounded(ab_tests.shapiro_wilk(
        _claims(s, sf, "Province", banded=True), "TotalClaims", "Province")),
    "severity_ab": _severity(),
    "severity_ab_normal": _severity(normal=True),
    "severity_ab_welch": _severity(method="welch"),
    "margin_ab": lambda s, sf: rounded(
        ab_tests.margin_ab(policies(s, sf), "Gender", "Female", "Male"),
        group_a_mean_margin=4, group_b_mean_margin=4, margin_difference=4),
    "chi2_frequency_k": lambda s, sf: rounded(group_tests.chi2_frequency_k(policies(s, sf), "Province")),
    "kruskal_k": _kruskal(False),
    "kruskal_k_ties": _kruskal(True),
    "province_risk": lambda s, sf: rounded(group_tests.province_risk(staged(s, sf, *SEGMENTS))),
    "postal_risk": lambda s, sf: rounded(group_tests.postal_risk(staged(s, sf, *SEGMENTS))),
    "postal_risk_top": lambda s, sf: rounded(group_tests.postal_risk(staged(s, sf, *SEGMENTS), k=20)),
    "postal_margin_test": lambda s, sf: rounded(group_tests.postal_margin_test(staged(s, sf, *SEGMENTS))),
    "gender_risk": lambda s, sf: rounded(group_tests.gender_risk(staged(s, sf, *SEGMENTS))),
    "test_summary": lambda s, sf: rounded(hypothesis.test_summary(staged(s, sf, *SEGMENTS))),
    "test_recommendations": lambda s, sf: hypothesis.recommendations(
        hypothesis.test_summary(staged(s, sf, *SEGMENTS))),
}

# --- SQL -------------------------------------------------------------------------------

_RANKS = "rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2e0"


def _claim_values(column="", banded=False):
    value = "floor(TotalClaims / 1000)" if banded else "TotalClaims"
    return f"SELECT {column + ', ' if column else ''}{value} AS v FROM policies WHERE TotalClaims > 0"


def _rank_sql(banded):
    return over_policies(f""", v AS ({_claim_values(banded=banded)}), r AS (SELECT v, {_RANKS} AS r FROM v)
  SELECT v AS value, count(*) AS copies, round(min(r), 6) AS rank FROM r GROUP BY v""")


_PAIR = "WHERE Gender IN ('Female', 'Male')"
_TABLE = f""", t AS (SELECT count(*) FILTER (Gender = 'Female' AND TotalClaims > 0) AS ca,
  count(*) FILTER (Gender = 'Female' AND TotalClaims = 0) AS za, count(*) FILTER (Gender = 'Male' AND TotalClaims > 0) AS cb,
  count(*) FILTER (Gender = 'Male' AND TotalClaims = 0) AS zb, count(*) FILTER (Gender = 'Female') AS na,
  count(*) FILTER (Gender = 'Male') AS nb FROM policies {_PAIR}),
  o AS (SELECT *, ca + za + cb + zb AS n, ca / na AS fa, cb / nb AS fb, unnest([
      (ca + za) * (ca + cb) / (ca + za + cb + zb), (ca + za) * (za + zb) / (ca + za + cb + zb),
      (cb + zb) * (ca + cb) / (ca + za + cb + zb), (cb + zb) * (za + zb) / (ca + za + cb + zb)]) AS e,
      unnest([ca, za, cb, zb]) AS seen FROM t),
  chi AS (SELECT *, sum(power(abs(seen - e) - least(0.5, abs(seen - e)), 2) / e) OVER () AS x FROM o LIMIT 1)"""
_CHI_AB = result(
    "chi", "'Chi-squared test for claim frequency'", "x", "1", chi2_tail("x", "1"), "2", "n", "na + nb - n",
    "round(fa, 6) AS group_a_frequency, round(fb, 6) AS group_b_frequency, round(fb - fa, 6) AS frequency_difference,"
    " round((fb - fa) / fa * 100, 6) AS frequency_difference_pct, na AS group_a_size, nb AS group_b_size,"
    " ca AS claims_a, za AS no_claims_a, cb AS claims_b, zb AS no_claims_b")


def _welch(values):
    """Members v and w of a WITH clause: w is one row with t and the degrees of freedom."""
    return f""", v AS ({values})""" + _welch_row("v")


def _welch_row(v):
    return f""", wg AS (SELECT count(v) FILTER (Gender = 'Female') AS na, count(v) FILTER (Gender = 'Male') AS nb,
  avg(v) FILTER (Gender = 'Female') AS ma, avg(v) FILTER (Gender = 'Male') AS mb,
  var_samp(v) FILTER (Gender = 'Female') AS va, var_samp(v) FILTER (Gender = 'Male') AS vb,
  count(*) FILTER (Gender = 'Female') AS sa, count(*) FILTER (Gender = 'Male') AS sb FROM {v}),
  w AS (SELECT *, (ma - mb) / sqrt(va / na + vb / nb) AS t, power(va / na + vb / nb, 2)
  / (power(va / na, 2) / (na - 1) + power(vb / nb, 2) / (nb - 1)) AS df FROM wg)"""


def _u(banded):
    """Members of a WITH clause: u is one row with U, z and the sizes."""
    return f""", v AS ({_claim_values('Gender', banded)} AND Gender IN ('Female', 'Male')),
  r AS (SELECT Gender, v, {_RANKS} AS r FROM v),
  ties AS (SELECT sum(c * c * c - c) AS t FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM v GROUP BY v)),
  g AS (SELECT CAST(count(*) FILTER (Gender = 'Female') AS DOUBLE) AS na, CAST(count(*) FILTER (Gender = 'Male') AS DOUBLE) AS nb,
        sum(r) FILTER (Gender = 'Female') AS ra FROM r),
  u AS (SELECT na, nb, t, ra - na * (na + 1) / 2 AS u, (greatest(ra - na * (na + 1) / 2, na * nb - ra + na * (na + 1) / 2)
        - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * (na + nb + 1 - t / ((na + nb) * (na + nb - 1)))) AS z FROM g, ties)"""


def _mann_whitney_sql(banded):
    return over_policies(_u(banded) + result(
        "u", "'Mann-Whitney U test'", "u", "CAST(NULL AS DOUBLE)", chi2_tail("z * z", "1"), "2", "na + nb", "0",
        "round(z, 6) AS z, false AS exact"))


def _chi_k(rows, prefix=""):
    """Members of a WITH clause over a list of (k, TotalClaims) rows; chik is one row."""
    p = prefix
    return f""", {p}g AS (SELECT k, count(*) FILTER (TotalClaims > 0) AS c, count(*) FILTER (TotalClaims = 0) AS z,
  count(*) AS n FROM {rows} GROUP BY k),
  {p}tot AS (SELECT sum(c) AS tc, sum(z) AS tz, sum(n) AS tn, count(*) AS groups FROM {p}g),
  {p}chi AS (SELECT sum(power(c - (c + z) * tc / (tc + tz), 2) / ((c + z) * tc / (tc + tz))
    + power(z - (c + z) * tz / (tc + tz), 2) / ((c + z) * tz / (tc + tz))) AS x, max(groups) AS k,
    max(tc + tz) AS n, max(tn - tc - tz) AS dropped FROM {p}g, {p}tot)"""


def _kruskal_members(rows, prefix=""):
    """Members of a WITH clause over (k, v) rows; h is one row."""
    p = prefix
    return f""", {p}r AS (SELECT k, v, {_RANKS} AS r FROM {rows} WHERE v IS NOT NULL),
  {p}ties AS (SELECT sum(c * c * c - c) AS t FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM {p}r GROUP BY v)),
  {p}s AS (SELECT k, CAST(count(*) AS DOUBLE) AS n, avg(r) AS m FROM {p}r GROUP BY k),
  {p}n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {p}r),
  {p}h AS (SELECT 12 / (max(b.n) * (max(b.n) + 1)) * sum(s.n * power(s.m - (b.n + 1) / 2, 2))
    / (1 - max(t) / (power(max(b.n), 3) - max(b.n))) AS h, count(*) AS k, max(b.n) AS n,
    (SELECT count(*) FROM {rows}) - max(b.n) AS dropped FROM {p}s s, {p}n b, {p}ties)"""


def _chi_result(p="", extra=""):
    return result(f"{p}chi", "'Chi-squared test'", "x", "k - 1", chi2_tail("x", "(k - 1)"), "k", "n", "dropped", extra)


def _kruskal_result(p="", extra=""):
    return result(f"{p}h", "'Kruskal-Wallis test'", "h", "k - 1", chi2_tail("h", "(k - 1)"), "k", "n", "dropped", extra)


def _report(name, parts, extra=""):
    """Union of (component, select) with the overall conclusion."""
    rows = " UNION ALL ".join(f"SELECT '{component}' AS component, * FROM ({q}) q" for component, q in parts)
    return (f" SELECT '{name}' AS report, *, CASE WHEN bool_or(reject_null) OVER () THEN 'Reject H₀'"
            f" ELSE 'Fail to reject H₀' END AS overall_conclusion{extra} FROM ({rows}) parts")


_PROVINCE = ", pv AS (SELECT Province AS k, TotalClaims FROM policies WHERE Province IS NOT NULL)"
_PROVINCE += ", pc AS (SELECT k, TotalClaims AS v FROM pv WHERE TotalClaims > 0)"
_PROVINCE_RISK = _PROVINCE + _chi_k("pv", "p_") + _kruskal_members("pc", "p_")
_ZIPS = (", sizes AS (SELECT PostalCode, count(*) AS n FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1 HAVING count(*) >= 30),"
         " zv AS (SELECT PostalCode AS k, TotalPremium, TotalClaims FROM policies WHERE PostalCode IN"
         " (SELECT PostalCode FROM sizes ORDER BY n DESC, PostalCode LIMIT {k})),"
         " zc AS (SELECT k, TotalClaims AS v FROM zv WHERE TotalClaims > 0),"
         " zm AS (SELECT k, TotalPremium - TotalClaims AS v FROM zv)")
_VALID = ", (SELECT count(*) FROM sizes) AS total_valid_groups"


def _postal(k):
    return (_ZIPS.format(k=k) + _chi_k("zv", "z_") + _kruskal_members("zc", "z_"))


def _postal_sql(k):
    return over_policies(_postal(k) + _report(
        "postal_risk", [("frequency", _chi_result("z_")), ("severity", _kruskal_result("z_"))], _VALID))


def _fraction(up, down, x):
    """Quotient of two polynomials, highest power first."""
    def horner(cs):
        total = "0e0"
        for c in cs:
            total = f"({total} * ({x}) + {c!r}e0)" if "e" not in repr(c) else f"({total} * ({x}) + {c!r})"
        return total

    return f"({horner(up)} / {horner(down)})"


def _score(p):
    """Normal quantile in SQL."""
    q, r = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    outer = (f"CASE WHEN {r} <= 5 THEN {_fraction(normality.SIDE_UP, normality.SIDE_DOWN, f'{r} - 1.6')}"
             f" ELSE {_fraction(normality.TAIL_UP, normality.TAIL_DOWN, f'{r} - 5')} END")
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {q} * {_fraction(normality.CENTRE_UP, normality.CENTRE_DOWN, f'0.180625 - {q} * {q}')}"
            f" ELSE sign({q}) * {outer} END)")


def _poly(cs, x):
    return "(" + " + ".join(f"({c}) * power({x}, {i})" for i, c in enumerate(cs)) + ")"


def _shapiro(rows, key, p=""):
    """Members of a WITH clause over (key, v) rows; sw has (grp, n, w, p): weights in order, then W."""
    n, size = "n", "least(ln(n), ln(5000))"
    beyond = "greatest(ln(n) - ln(5000), 0)"
    slopes = [" + ".join(f"{i} * ({c}) * power(ln(5000), {i - 1})" for i, c in enumerate(cs) if i)
              for cs in (kernels.LARGE_MEAN, kernels.LARGE_SPREAD)]
    mean, spread = (f"({_poly(cs, size)} + ({slope}) * {beyond})" for cs, slope in zip((kernels.LARGE_MEAN, kernels.LARGE_SPREAD), slopes))
    z = (f"CASE WHEN n > 11 THEN (ln(1 - w) - {mean}) / exp({spread}) ELSE (-ln({_poly(kernels.SMALL_GAMMA, n)} - ln(1 - w))"
         f" - {_poly(kernels.SMALL_MEAN, n)}) / exp({_poly(kernels.SMALL_SPREAD, n)}) END")
    tail = chi2_tail("least(z * z, 1600)", "1")
    return f""", {p}o AS (SELECT {key} AS grp, v, row_number() OVER (PARTITION BY {key} ORDER BY v) AS i, count(*) OVER (PARTITION BY {key}) AS n
    FROM {rows} WHERE {key} IS NOT NULL AND v IS NOT NULL),
  {p}s AS (SELECT *, {_score("((i - 0.375) / (n + 0.25))")} AS m FROM {p}o),
  {p}q AS (SELECT *, sum(m * m) OVER (PARTITION BY grp) AS sq, max(m) OVER (PARTITION BY grp) AS ml,
    max(CASE WHEN i = n - 1 THEN m END) OVER (PARTITION BY grp) AS mn, 1 / sqrt(n) AS u, avg(v) OVER (PARTITION BY grp) AS av FROM {p}s),
  {p}e AS (SELECT *, {_poly(kernels.WEIGHT_LAST, "u")} + ml / sqrt(sq) AS e1, {_poly(kernels.WEIGHT_NEXT, "u")} + mn / sqrt(sq) AS e2 FROM {p}q),
  {p}a AS (SELECT *, CASE WHEN n = 3 THEN (i - 2) * sqrt(0.5) WHEN i = 1 THEN -e1 WHEN i = n THEN e1 WHEN n > 5 AND i = 2 THEN -e2
    WHEN n > 5 AND i = n - 1 THEN e2 WHEN n > 5 THEN m / sqrt((sq - 2 * ml * ml - 2 * mn * mn) / (1 - 2 * e1 * e1 - 2 * e2 * e2))
    ELSE m / sqrt((sq - 2 * ml * ml) / (1 - 2 * e1 * e1)) END AS a FROM {p}e),
  {p}w AS (SELECT grp, max(n) AS n, CASE WHEN max(n) < 3 THEN NULL WHEN min(v) = max(v) THEN 1e0
    ELSE least(1, power(sum(a * (v - av)), 2) / sum(power(v - av, 2))) END AS w FROM {p}a GROUP BY grp),
  {p}z AS (SELECT *, CASE WHEN n > 3 AND w < 1 THEN {z} END AS z FROM {p}w),
  {p}sw AS (SELECT grp, n, w, CASE WHEN w IS NULL THEN NULL WHEN w >= 1 THEN 1
    WHEN n = 3 THEN 6 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75))) WHEN z > 0 THEN {tail} / 2 ELSE 1 - {tail} / 2 END AS p FROM {p}z)"""


_SHAPIRO_ROWS = " SELECT grp, n, round(w, 6) AS w, round(p, 6) AS p_value, CASE WHEN n < 3 THEN 'insufficient' ELSE 'ok' END AS status FROM sw"

# The severity branch: Welch where the claims of both genders look normal, else U.
_SEVERITY_ROWS = _u(False) + _welch_row("v") + _shapiro("v", "Gender", "n_")
_BOTH_NORMAL = "(SELECT coalesce(bool_and(p > 0.05), false) FROM n_sw)"


def _severity_by(normal):
    return (
        "SELECT * FROM (" + result("u", "'Mann-Whitney U test for claim severity'", "u", "CAST(NULL AS DOUBLE)",
                                   chi2_tail("z * z", "1"), "2", "na + nb", "0") + f") WHERE NOT {normal} UNION ALL SELECT * FROM ("
        + result("w", "'Welch''s t-test for claim severity'", "t", "df", t_tail("t", "df"), "2", "na + nb", "0")
        + f") WHERE {normal}")


def _severity_sql(normal, members=_SEVERITY_ROWS):
    return over_policies(
        members + ", m AS (SELECT avg(v) FILTER (Gender = 'Female') AS ma, avg(v) FILTER (Gender = 'Male') AS mb FROM v)"
        + " SELECT q.*, round(ma, 4) AS group_a_severity, round(mb, 4) AS group_b_severity, round(mb - ma, 4) AS severity_difference,"
          " round((mb - ma) / ma * 100, 6) AS severity_difference_pct, CAST(na AS BIGINT) AS group_a_size,"
          f" CAST(nb AS BIGINT) AS group_b_size, {normal} AS use_parametric FROM ({_severity_by(normal)}) q, m, u")


_SEVERITY = _severity_by(_BOTH_NORMAL)
_PLAIN = "test_name, statistic, dof, p_value, alpha, reject_null, conclusion, n_groups, n_rows, n_dropped, status"
_GENDER = [("frequency", f"SELECT {_PLAIN} FROM ({_CHI_AB}) f"), ("severity", _SEVERITY)]
_SHARES = [f"((CAST('0x' || substr(md5(CAST({ID} AS VARCHAR)), {i}, 8) AS BIGINT) + 0.5e0) / 4294967296e0)" for i in (1, 9)]
_HASHED = f"sqrt(-2 * ln({_SHARES[0]})) * cos(2 * pi() * {_SHARES[1]})"
_NORMAL_ROWS = _SEVERITY_ROWS.replace(
    _claim_values("Gender"), f"SELECT Gender, 50000 + 8000 * {_HASHED} AS v FROM policies WHERE TotalClaims > 0")

SQL = {
    "average_rank": _rank_sql(False),
    "average_rank_ties": _rank_sql(True),
    "ab_groups": over_policies(
        "SELECT UnderwrittenCoverID, Gender, round(TotalClaims, 4) AS TotalClaims,"
        f" CASE WHEN Gender = 'Female' THEN 'A' ELSE 'B' END AS grp FROM policies {_PAIR}"),
    "chi2_frequency_ab": over_policies(_TABLE + _CHI_AB),
    "welch_t": over_policies(_welch(_claim_values("Gender") + " AND Gender IN ('Female', 'Male')") + result(
        "w", "'Welch''s t-test'", "t", "df", t_tail("t", "df"), "2", "na + nb", "sa + sb - na - nb",
        "round(ma, 4) AS mean_a, round(mb, 4) AS mean_b, sa AS group_a_size, sb AS group_b_size")),
    "mann_whitney": _mann_whitney_sql(False),
    "mann_whitney_ties": _mann_whitney_sql(True),
    "shapiro_wilk": over_policies(f", v AS ({_claim_values('MainCrestaZone')})" + _shapiro("v", "MainCrestaZone") + _SHAPIRO_ROWS),
    "shapiro_wilk_ties": over_policies(f", v AS ({_claim_values('Province', True)})" + _shapiro("v", "Province") + _SHAPIRO_ROWS),
    "severity_ab": _severity_sql(_BOTH_NORMAL),
    "severity_ab_normal": _severity_sql(_BOTH_NORMAL, _NORMAL_ROWS),
    "severity_ab_welch": _severity_sql("true"),
    "margin_ab": over_policies(_welch(f"SELECT Gender, TotalPremium - TotalClaims AS v FROM policies {_PAIR}") + result(
        "w", "'Welch''s t-test for margin difference'", "t", "df", t_tail("t", "df"), "2", "na + nb", "sa + sb - na - nb",
        "sa AS group_a_size, sb AS group_b_size, round(ma, 4) AS group_a_mean_margin, round(mb, 4) AS group_b_mean_margin,"
        " round(mb - ma, 4) AS margin_difference, round((mb - ma) / abs(ma) * 100, 6) AS margin_difference_pct")),
    "chi2_frequency_k": over_policies(_PROVINCE_RISK + " " + _chi_result("p_")),
    "kruskal_k": over_policies(_PROVINCE_RISK + " " + _kruskal_result("p_")),
    "kruskal_k_ties": over_policies(
        _PROVINCE + ", pb AS (SELECT k, floor(v / 1000) AS v FROM pc)" + _kruskal_members("pb") + " " + _kruskal_result()),
    "province_risk": over_policies(_PROVINCE_RISK + _report(
        "province_risk", [("frequency", _chi_result("p_")), ("severity", _kruskal_result("p_"))])),
    "postal_risk": _postal_sql("ALL"),
    "postal_risk_top": _postal_sql("20"),
    "postal_margin_test": over_policies(_ZIPS.format(k="ALL") + _kruskal_members("zm", "m_") + _report(
        "postal_margin", [("margin", _kruskal_result("m_"))], _VALID)),
    "gender_risk": over_policies(_TABLE + _SEVERITY_ROWS + _report("gender_risk", _GENDER)),
}

# All four reports at once; the tables of the reports do not share names.
_ALL = _PROVINCE_RISK + _postal("ALL") + _kruskal_members("zm", "m_") + _TABLE + _SEVERITY_ROWS


def _p(query):
    return f"(SELECT p_value FROM ({query}) x)"


def _any(*queries):
    return "(" + " OR ".join(f"(SELECT reject_null FROM ({q}) x)" for q in queries) + ")"


_SUMMARY = _ALL + ", summary AS (" + " UNION ALL ".join(
    f"SELECT '{report}' AS report, '{title}' AS hypothesis, '{kind}' AS test_type, {f} AS p_frequency,"
    f" {s} AS p_severity, {reject} AS reject_null"
    for report, title, kind, f, s, reject in [
        ("province_risk", "H₀: No risk differences across provinces", "Chi-squared (frequency) + Kruskal-Wallis (severity)",
         _p(_chi_result("p_")), _p(_kruskal_result("p_")), _any(_chi_result("p_"), _kruskal_result("p_"))),
        ("postal_risk", "H₀: No risk differences between zip codes", "Chi-squared (frequency) + Kruskal-Wallis (severity)",
         _p(_chi_result("z_")), _p(_kruskal_result("z_")), _any(_chi_result("z_"), _kruskal_result("z_"))),
        ("postal_margin", "H₀: No margin difference between zip codes", "Kruskal-Wallis",
         "NULL", _p(_kruskal_result("m_")), _any(_kruskal_result("m_"))),
        ("gender_risk", "H₀: No risk difference between Women and Men",
         "Chi-squared (frequency) + T-test/Mann-Whitney (severity)",
         _p(_CHI_AB), _p(_SEVERITY), _any(_CHI_AB, _SEVERITY)),
    ]) + ")"

SQL["test_summary"] = over_policies(_SUMMARY + (
    " SELECT report, hypothesis, test_type, CAST(p_frequency AS DOUBLE) AS p_frequency, p_severity,"
    " CASE WHEN reject_null THEN 'Reject H₀' ELSE 'Fail to reject H₀' END AS conclusion FROM summary"))
SQL["test_recommendations"] = over_policies(_SUMMARY + ", rules AS (" + " UNION ALL ".join(
    f"SELECT '{report}' AS report, {str(rejected).lower()} AS reject_null, '{area}' AS area, '{finding}' AS finding,"
    f" '{advice}' AS recommendation, '{priority}' AS priority"
    for report, rejected, area, finding, advice, priority in hypothesis.RECOMMENDATIONS)
    + ") SELECT area, finding, recommendation, priority FROM summary JOIN rules USING (report, reject_null)")
