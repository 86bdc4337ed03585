"""Model metrics, per-group regression, fits and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.checks.common import AS_OF_YEAR, over_policies, policies, rounded, staged
from riskframe.functions import has_claim
from riskframe.operators import attribution, evaluation, models, zip_regression
from riskframe.operators.features import hash_split
from riskframe.plans import training
from riskframe.sources import stage

ID = "UnderwrittenCoverID"
LINEAR = ["TotalPremium", "SumInsured"]
TREES = ["TotalPremium", "SumInsured", "CalculatedPremiumPerTerm"]
SMALL_ERRORS = {"rmse": 3, "mae": 3}
TASK_INPUTS = [
    ID, "PolicyID", "Province", "Gender", "CoverType", "VehicleType", "RegistrationYear", "SumInsured",
    "CustomValueEstimate", "CalculatedPremiumPerTerm", "TotalPremium", "TotalClaims",
]


def _predicted(s, sf):
    return policies(s, sf).select(
        (F.col("SumInsured") / 120).alias("label"), (F.col("TotalPremium") / 12).alias("prediction"))


def _classified(s, sf):
    return policies(s, sf).select(
        has_claim().alias("label"),
        F.when(F.col("RegistrationYear") < 1975, 1).otherwise(0).alias("prediction"))


def _scored(s, sf):
    return staged(s, sf, "TotalClaims", "CustomValueEstimate").select(
        has_claim().alias("label"), F.col("CustomValueEstimate").alias("score"))


def _split(s, sf, nums, target="TotalClaims"):
    table = stage(hash_split(models.numeric_vectors(policies(s, sf), nums, target, [ID]), [ID]))
    return table.where(~F.col("is_test")), table.where("is_test")


def _zips(s, sf, features):
    fits = zip_regression.zip_regression(
        staged(s, sf, "PostalCode", "TotalClaims", *zip_regression.FEATURES), features=features)
    return fits.select(
        "PostalCode", "SampleSize", "n_used", "RMSE", "R2", "Intercept",
        *[F.col("Coefficients")[i].alias(f"b{i + 1}") for i in range(len(features or zip_regression.FEATURES))])


def _linear_attribution(s, sf):
    train, _ = _split(s, sf, LINEAR)
    model = models.LinearRegression(regParam=0.0).fit(train)
    return rounded(attribution.attribution(model, train), mean_abs_shap=3)


def _linear_importance(s, sf):
    train, test = _split(s, sf, LINEAR)
    return rounded(models.feature_importance(train, models.fit_linear(train, test).model))


def _claim_split(s, sf):
    """Train and test rows for whether a row has a claim."""
    table = policies(s, sf).withColumn("HasClaim", has_claim())
    table = stage(hash_split(models.numeric_vectors(table, TREES, "HasClaim", [ID]), [ID]))
    return table.where(~F.col("is_test")), table.where("is_test")


def _fits(fit, split, nums=None, **options):
    """Metrics of a fit: rows per side as they must be, errors and shares within their bounds."""
    def run(s, sf):
        fitted = fit(*(split(s, sf, nums) if nums else split(s, sf)), **options)
        cols = fitted.metrics.columns
        good = (F.col("r2") <= 1) & (F.col("rmse") >= F.col("mae")) if "r2" in cols else F.col("f1").between(0, 1) & F.col("roc_auc").between(0, 1)
        return fitted.metrics.select("model", "side", "n", good.alias("in_bounds"))

    return run


def _by_nodes(fit, split, nums=None, **options):
    """Whether the prediction of each test row equals the one found by walking the node table."""
    def run(s, sf):
        train, test = split(s, sf, nums) if nums else split(s, sf)
        model = fit(train, test, **options).model
        found = models.predict_by_nodes(model, model.transform(test), [ID, "prediction"])
        near = F.abs(F.col("recomputed") - F.col("prediction")) <= 1e-9 * F.greatest(F.lit(1e0), F.abs("prediction"))
        return found.select(ID, near.alias("equal"))

    return run


def _tree_attribution(s, sf):
    """Whether the Shapley values of each test row and the base add up to its prediction."""
    train, test = _split(s, sf, TREES)
    model = models.fit_boosted(train, test).model
    found = attribution.tree_shap_values(model, model.transform(test), [ID, "prediction"])
    total = F.aggregate("shap", F.col("base"), lambda a, b: a + b)
    return found.select(ID, (F.abs(total - F.col("prediction")) <= 1e-6 * F.greatest(F.lit(1e0), F.abs("prediction"))).alias("adds_up"))


def _task(run, **options):
    """Comparison of a task's models: rows per side, errors within their bounds, one best."""
    def compared(s, sf):
        rows = run(staged(s, sf, *TASK_INPUTS), AS_OF_YEAR, **options).comparison
        good = F.col("r2") <= 1 if "r2" in rows.columns else F.col("f1").between(0, 1)
        return rows.select("model", "side", (F.col("n") > 0).alias("has_rows"), good.alias("in_bounds"))

    return compared


QUERIES = {
    "regression_metrics": lambda s, sf: rounded(evaluation.regression_metrics(_predicted(s, sf)), **SMALL_ERRORS),
    "classification_metrics": lambda s, sf: rounded(evaluation.classification_metrics(_classified(s, sf))),
    "roc_auc": lambda s, sf: rounded(evaluation.roc_auc(_scored(s, sf))),
    "zip_regression": lambda s, sf: rounded(_zips(s, sf, LINEAR), RMSE=3, Intercept=3),
    "zip_regression_three": lambda s, sf: rounded(_zips(s, sf, None), RMSE=3, Intercept=3),
    "zip_regression_summary": lambda s, sf: rounded(zip_regression.zip_regression_summary(_zips(s, sf, LINEAR))),
    "fit_linear": lambda s, sf: rounded(models.fit_linear(*_split(s, sf, LINEAR)).metrics, **SMALL_ERRORS),
    "fit_forest": _fits(models.fit_forest, _split, TREES),
    "fit_forest_depth_5": _fits(models.fit_forest, _split, TREES, depth=5),
    "fit_boosted": _fits(models.fit_boosted, _split, TREES),
    "fit_forest_classes": _fits(models.fit_forest, _claim_split, task=models.CLASSIFICATION),
    "fit_boosted_classes": _fits(models.fit_boosted, _claim_split, task=models.CLASSIFICATION),
    "forest_by_nodes": _by_nodes(models.fit_forest, _split, TREES),
    "boosted_by_nodes": _by_nodes(models.fit_boosted, _split, TREES),
    "forest_classes_by_nodes": _by_nodes(models.fit_forest, _claim_split, task=models.CLASSIFICATION),
    "boosted_classes_by_nodes": _by_nodes(models.fit_boosted, _claim_split, task=models.CLASSIFICATION),
    "feature_importance": _linear_importance,
    "attribution_linear": _linear_attribution,
    "attribution_tree": _tree_attribution,
    "severity_pipeline": _task(training.severity_pipeline),
    "premium_pipeline": _task(training.premium_pipeline, exclude=["TotalPremium", "PremiumCategory"]),
    "claim_probability_pipeline": _task(training.claim_probability_pipeline),
}

# Two-feature least squares by Cramer's rule over one-row moments.
_B1 = "(s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12)"
_B2 = "(s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12)"


def _moments(x1, x2, y):
    return (f"covar_pop({x1}, {x1}) AS s11, covar_pop({x1}, {x2}) AS s12, covar_pop({x2}, {x2}) AS s22,"
            f" covar_pop({x1}, {y}) AS s1y, covar_pop({x2}, {y}) AS s2y, covar_pop({y}, {y}) AS syy,"
            f" avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my, count(*) AS n")


_FIT = f""", t AS (SELECT TotalPremium AS x1, SumInsured AS x2, TotalClaims AS y,
    CAST('0x' || substr(md5(concat(CAST({ID} AS VARCHAR), '|42')), 1, 8) AS BIGINT) / 4294967296.0 < 0.2 AS is_test
    FROM policies WHERE TotalPremium IS NOT NULL AND SumInsured IS NOT NULL AND TotalClaims IS NOT NULL),
  s AS (SELECT {_moments('x1', 'x2', 'y')} FROM t WHERE NOT is_test),
  b AS (SELECT {_B1} AS b1, {_B2} AS b2, my - {_B1} * m1 - {_B2} * m2 AS b0, m1, m2 FROM s)"""

_ZIP = f""", z AS (SELECT PostalCode, count(*) AS size FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1
    HAVING count(*) >= 50),
  t AS (SELECT PostalCode, size, TotalPremium AS x1, SumInsured AS x2, TotalClaims AS y FROM policies JOIN z USING (PostalCode)),
  s AS (SELECT PostalCode, size, {_moments('x1', 'x2', 'y')} FROM t
        WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2),
  b AS (SELECT *, {_B1} AS b1, {_B2} AS b2 FROM s),
  fits AS (SELECT PostalCode, size AS SampleSize, n AS n_used, sqrt(greatest(0, syy - b1 * s1y - b2 * s2y)) AS RMSE,
        1 - greatest(0, syy - b1 * s1y - b2 * s2y) / nullif(syy, 0) AS R2, my - b1 * m1 - b2 * m2 AS Intercept, b1, b2 FROM b)"""



def _det(*c):
    """Determinant of a 3 x 3 matrix given by rows."""
    return (f"({c[0]} * ({c[4]} * {c[8]} - {c[5]} * {c[7]}) - {c[1]} * ({c[3]} * {c[8]} - {c[5]} * {c[6]})"
            f" + {c[2]} * ({c[3]} * {c[7]} - {c[4]} * {c[6]}))")


_ROWS3 = [["s11", "s12", "s13"], ["s12", "s22", "s23"], ["s13", "s23", "s33"]]


def _cramer(i):
    replaced = [[y if j == i else cell for j, cell in enumerate(row)] for row, y in zip(_ROWS3, ("s1y", "s2y", "s3y"))]
    return f"{_det(*sum(replaced, []))} / {_det(*sum(_ROWS3, []))}"


_ZIP3 = f""", z AS (SELECT PostalCode, count(*) AS size FROM policies WHERE PostalCode IS NOT NULL GROUP BY 1
    HAVING count(*) >= 50),
  t AS (SELECT PostalCode, size, TotalPremium AS x1, SumInsured AS x2, CustomValueEstimate AS x3, TotalClaims AS y
        FROM policies JOIN z USING (PostalCode)),
  s AS (SELECT PostalCode, size, {_moments('x1', 'x2', 'y')}, covar_pop(x1, x3) AS s13, covar_pop(x2, x3) AS s23,
        covar_pop(x3, x3) AS s33, covar_pop(x3, y) AS s3y, avg(x3) AS m3 FROM t
        WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2),
  b AS (SELECT *, {_cramer(0)} AS b1, {_cramer(1)} AS b2, {_cramer(2)} AS b3 FROM s)"""


def _tree_rows(target):
    """Member t of a WITH clause: the rows of a tree fit and their side."""
    return f""", t AS (SELECT {ID}, CAST('0x' || substr(md5(concat(CAST({ID} AS VARCHAR), '|42')), 1, 8) AS BIGINT) / 4294967296.0 < 0.2 AS is_test
    FROM policies WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*TREES, *([target] if target else [])])})"""


def _fit_rows(model, target):
    return over_policies(_tree_rows(target) + f""" SELECT '{model}' AS model, CASE WHEN is_test THEN 'test' ELSE 'train' END AS side,
  count(*) AS n, true AS in_bounds FROM t GROUP BY is_test""")


SQL = {
    "regression_metrics": over_policies("""SELECT count(*) AS n, round(sqrt(avg(power(y - p, 2))), 3) AS rmse,
  round(1 - avg(power(y - p, 2)) / var_pop(y), 6) AS r2, round(avg(abs(y - p)), 3) AS mae
  FROM (SELECT SumInsured / 120 AS y, TotalPremium / 12 AS p FROM policies) WHERE y IS NOT NULL AND p IS NOT NULL"""),
    "classification_metrics": over_policies(""", t AS (SELECT CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END AS y,
    CASE WHEN RegistrationYear < 1975 THEN 1 ELSE 0 END AS p FROM policies),
  c AS (SELECT k, count(*) FILTER (y = k) AS s, count(*) FILTER (p = k) AS q, count(*) FILTER (y = k AND p = k) AS h
        FROM t, (VALUES (0), (1)) v(k) GROUP BY k)
  SELECT CAST(sum(s) AS BIGINT) AS n, round(sum(h) / sum(s), 6) AS accuracy,
  round(sum(s * coalesce(h / nullif(q, 0), 0)) / sum(s), 6) AS precision,
  round(sum(s * coalesce(h / nullif(s, 0), 0)) / sum(s), 6) AS recall,
  round(sum(s * coalesce(2 * h / nullif(s + q, 0), 0)) / sum(s), 6) AS f1 FROM c"""),
    "roc_auc": over_policies(""", t AS (SELECT CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END AS y, CustomValueEstimate AS v
    FROM policies WHERE CustomValueEstimate IS NOT NULL),
  r AS (SELECT y, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2e0 AS r FROM t)
  SELECT round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
    / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS roc_auc,
  count(*) FILTER (y = 1) AS n_positive, count(*) FILTER (y = 0) AS n_negative FROM r"""),
    "zip_regression": over_policies(_ZIP + """ SELECT PostalCode, SampleSize, n_used, round(RMSE, 3) AS RMSE,
  round(R2, 6) AS R2, round(Intercept, 3) AS Intercept, round(b1, 6) AS b1, round(b2, 6) AS b2 FROM fits"""),
    "zip_regression_three": over_policies(_ZIP3 + """ SELECT PostalCode, size AS SampleSize, n AS n_used,
  round(sqrt(greatest(0, rss)), 3) AS RMSE, round(1 - greatest(0, rss) / nullif(syy, 0), 6) AS R2,
  round(my - b1 * m1 - b2 * m2 - b3 * m3, 3) AS Intercept, round(b1, 6) AS b1, round(b2, 6) AS b2, round(b3, 6) AS b3
  FROM (SELECT *, syy - b1 * s1y - b2 * s2y - b3 * s3y AS rss FROM b)"""),
    "zip_regression_summary": over_policies(
        _ZIP + " SELECT round(avg(R2), 6) AS mean_r2, count(*) AS n_groups FROM fits"),
    "fit_linear": over_policies(_FIT + """, e AS (SELECT is_test, y, b0 + b1 * x1 + b2 * x2 AS p FROM t, b)
  SELECT 'Linear Regression' AS model, CASE WHEN is_test THEN 'test' ELSE 'train' END AS side, count(*) AS n,
  round(sqrt(avg(power(y - p, 2))), 3) AS rmse, round(1 - avg(power(y - p, 2)) / var_pop(y), 6) AS r2,
  round(avg(abs(y - p)), 3) AS mae FROM e GROUP BY is_test"""),
    **{name: _fit_rows(model, target) for name, model, target in [
        ("fit_forest", "Random Forest Regressor", "TotalClaims"), ("fit_forest_depth_5", "Random Forest Regressor", "TotalClaims"),
        ("fit_boosted", "Boosted Trees Regressor", "TotalClaims"), ("fit_forest_classes", "Random Forest Classifier", None),
        ("fit_boosted_classes", "Boosted Trees Classifier", None)]},
    **{name: over_policies(_tree_rows(target) + f" SELECT {ID}, true AS {mark} FROM t WHERE is_test") for name, target, mark in [
        ("forest_by_nodes", "TotalClaims", "equal"), ("boosted_by_nodes", "TotalClaims", "equal"), ("forest_classes_by_nodes", None, "equal"),
        ("boosted_classes_by_nodes", None, "equal"), ("attribution_tree", "TotalClaims", "adds_up")]},
    **{name: " UNION ALL ".join(f"SELECT '{m}' AS model, '{side}' AS side, true AS has_rows, true AS in_bounds" for m in kinds for side in ("train", "test"))
       for name, kinds in [
           ("severity_pipeline", ["Linear Regression", "Random Forest Regressor", "Boosted Trees Regressor"]),
           ("premium_pipeline", ["Linear Regression", "Random Forest Regressor", "Boosted Trees Regressor"]),
           ("claim_probability_pipeline", ["Random Forest Classifier", "Boosted Trees Classifier"])]},
    "feature_importance": over_policies(_FIT + """ SELECT 'TotalPremium' AS feature, round(abs(b1), 6) AS importance FROM b
  UNION ALL SELECT 'SumInsured', round(abs(b2), 6) FROM b"""),
    "attribution_linear": over_policies(_FIT + """ SELECT 'TotalPremium' AS feature,
  round(avg(abs(b1 * (x1 - m1))), 3) AS mean_abs_shap FROM t, b WHERE NOT is_test
  UNION ALL SELECT 'SumInsured', round(avg(abs(b2 * (x2 - m2))), 3) FROM t, b WHERE NOT is_test"""),
}
