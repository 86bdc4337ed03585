"""One least-squares model per group, all groups in a single aggregation."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import CLAIMS
from riskframe.operators.metrics import top_groups
from riskframe.operators.ordering import clean

FEATURES = ["TotalPremium", "SumInsured", "CustomValueEstimate"]


def _solver():
    def solve(matrix: pd.Series, right: pd.Series) -> pd.Series:
        import numpy as np

        out = []
        for cells, b in zip(matrix, right):
            p = len(b)
            # Least norm for collinear features, as a direct least-squares fit gives.
            beta = np.linalg.lstsq(np.array(cells).reshape(p, p), np.array(b), rcond=1e-13)[0]
            out.append(beta.tolist())
        return pd.Series(out)

    return F.pandas_udf(solve, T.ArrayType(T.DoubleType()))


def zip_regression(
    df: DataFrame,
    min_n: int = 50,
    k: int | None = None,
    features: Sequence[str] | None = None,
    target: str = CLAIMS,
    key: str = "PostalCode",
    nulls: str = "drop_rows",
) -> DataFrame:
    """In-sample fit of the target per postal code: size, RMSE, R2, intercept, coefficients.

    Each group is reduced to its means and centred cross-products, from which the fit and
    its errors follow; the cost does not depend on the number of groups. Rows with a
    missing input are dropped (``n_used``), or skip their group with ``skip_group``.
    """
    if nulls not in ("drop_rows", "skip_group"):
        raise ValueError(f"Unknown treatment of missing inputs: {nulls}")
    names = [f for f in (features or FEATURES) if f in df.columns]
    columns = [*names, target]
    p = len(names)
    rows = top_groups(df.select(key, *columns), key, k, min_n)
    inputs = [clean(F.col(c)) for c in columns]
    complete = F.lit(True)
    for c in inputs:
        complete = complete & c.isNotNull()
    v = [F.when(complete, c) for c in inputs]
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    sums = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("SampleSize"),
        F.count(v[0]).alias("n_used"),
        *[F.avg(v[i]).alias(f"mean{i}") for i in range(p + 1)],
        *[F.covar_pop(v[i], v[j]).alias(f"s{i}_{j}") for i, j in pairs],
    )
    usable = F.col("n_used") > 0
    if nulls == "skip_group":
        usable = F.col("n_used") == F.col("SampleSize")

    def s(i: int, j: int):
        return F.col(f"s{min(i, j)}_{max(i, j)}")

    matrix = F.array(*[s(i, j) for i in range(p) for j in range(p)])
    right = F.array(*[s(i, p) for i in range(p)])
    fitted = sums.where(usable).withColumn("Coefficients", _solver()(matrix, right))
    beta = [F.col("Coefficients")[i] for i in range(p)]
    explained = sum((beta[i] * s(i, p) for i in range(1, p)), beta[0] * s(0, p))
    residual = F.greatest(F.lit(0.0), s(p, p) - explained)
    intercept = F.col(f"mean{p}") - sum(
        (beta[i] * F.col(f"mean{i}") for i in range(1, p)), beta[0] * F.col("mean0")
    )
    return fitted.select(
        key,
        "SampleSize",
        "n_used",
        F.sqrt(residual).alias("RMSE"),
        (F.lit(1.0) - F.try_divide(residual, s(p, p))).alias("R2"),
        intercept.alias("Intercept"),
        "Coefficients",
    )


def zip_regression_summary(fits: DataFrame) -> DataFrame:
    """Mean R2 and number of groups."""
    return fits.agg(F.avg("R2").alias("mean_r2"), F.count(F.lit(1)).alias("n_groups"))
