"""Shared pieces of the registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.sources import POLICIES_SQL, policies, stage
from riskframe.sources.policies import TABLES

VIEW = POLICIES_SQL.format(**{t: t for t in TABLES})
AS_OF_YEAR = 2015
MONEY_DIGITS = 4
DIGITS = 6


def over_policies(body: str) -> str:
    """A statement over the ``policies`` view; further WITH members start with a comma."""
    return f"WITH policies AS ({VIEW}) {body}"


def staged(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The needed columns of the view, written once because several passes read them."""
    return stage(policies(spark, sf_dir).select(*columns))


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Doubles rounded for comparison; amounts named in ``digits`` to fewer places."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits.get(f.name, DIGITS))
        out.append(c.alias(f.name))
    return df.select(out)


MONEY = dict.fromkeys(
    ["TotalPremium", "TotalClaims", "TotalMargin", "ClaimSeverity", "AvgPremium", "AvgClaims",
     "TotalClaims_Sum", "AvgMargin"],
    MONEY_DIGITS,
)

# SQL fragments of the business definitions.
PREMIUM = "round(coalesce(sum(TotalPremium), 0e0), 4)"
CLAIMS = "round(coalesce(sum(TotalClaims), 0e0), 4)"
LOSS = "round(coalesce(sum(TotalClaims), 0e0) / nullif(coalesce(sum(TotalPremium), 0e0), 0), 6)"
FREQUENCY = "round(count(*) FILTER (TotalClaims > 0) / count(*), 6)"
SEVERITY = "round(avg(TotalClaims) FILTER (TotalClaims > 0), 4)"


def chi2_tail(x: str, dof: str) -> str:
    """Chi-squared tail: one minus the power series of the lower gamma function."""
    return (
        f"CASE WHEN {x} = 0 THEN 1 ELSE (SELECT 1 - sum(exp(-({x}) / 2 + (({dof}) / 2.0 + j) * ln(({x}) / 2)"
        f" - lgamma(({dof}) / 2.0 + j + 1))) FROM range(0, 1500) terms(j)) END"
    )


def t_tail(t: str, dof: str) -> str:
    """Two-sided t tail: one minus the hypergeometric series of the beta function."""
    x = f"(({t}) * ({t}) / (({dof}) + ({t}) * ({t})))"
    b = f"(({dof}) / 2)"
    return (
        f"(SELECT 1 - sum(exp(0.5 * ln({x}) + {b} * ln(1 - {x}) + lgamma(0.5 + {b} + j) - lgamma({b})"
        f" - lgamma(1.5 + j) + j * ln({x}))) FROM range(0, 1500) terms(j))"
    )


def result(
    source: str,
    test_name: str,
    statistic: str,
    dof: str,
    p: str,
    n_groups: str,
    n_rows: str,
    n_dropped: str,
    extra: str = "",
    alpha: float = 0.05,
) -> str:
    """SELECT in the common shape of test results, from a one-row source."""
    return (
        f"SELECT {test_name} AS test_name, round({statistic}, 6) AS statistic, round({dof}, 6) AS dof,"
        f" round(p, 6) AS p_value, CAST({alpha} AS DOUBLE) AS alpha, coalesce(p < {alpha}, false) AS reject_null,"
        f" CASE WHEN coalesce(p < {alpha}, false) THEN 'Reject H₀' ELSE 'Fail to reject H₀' END AS conclusion,"
        f" CAST({n_groups} AS BIGINT) AS n_groups, CAST({n_rows} AS BIGINT) AS n_rows,"
        f" CAST({n_dropped} AS BIGINT) AS n_dropped,"
        f" CASE WHEN p IS NULL THEN 'insufficient' ELSE 'ok' END AS status{', ' + extra if extra else ''}"
        f" FROM (SELECT *, {p} AS p FROM {source}) tested"
    )
