"""The common shape of test results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT = "Reject H₀"
KEEP = "Fail to reject H₀"

OUTCOME = [
    "test_name", "statistic", "dof", "p_value", "alpha", "reject_null", "conclusion",
    "n_groups", "n_rows", "n_dropped", "status",
]


def outcome(df: DataFrame, test_name: str | Column, alpha: float, extra: list[str] = ()) -> DataFrame:
    """Finish a one-row result that has statistic, dof, p_value, counts and status.

    A missing p-value never rejects, and a test without one is ``insufficient``.
    """
    reject = F.coalesce(F.col("p_value") < alpha, F.lit(False))
    name = F.lit(test_name) if isinstance(test_name, str) else test_name
    full = df.withColumns({
        "test_name": name,
        "alpha": F.lit(float(alpha)),
        "reject_null": reject,
        "conclusion": F.when(reject, REJECT).otherwise(KEEP),
        "statistic": F.col("statistic").cast("double"),
        "dof": F.col("dof").cast("double"),
        "n_groups": F.col("n_groups").cast("bigint"),
        "n_rows": F.col("n_rows").cast("bigint"),
        "n_dropped": F.col("n_dropped").cast("bigint"),
        "status": F.when(F.col("p_value").isNull(), "insufficient").otherwise("ok"),
    })
    return full.select(*OUTCOME, *extra)


def percent_change(base: Column, other: Column, scale: Column | None = None) -> Column:
    """(other - base) / scale in percent, with base as the default scale; 0 for scale 0."""
    by = base if scale is None else scale
    return F.when(by != 0, F.try_divide(other - base, by) * 100).otherwise(F.lit(0e0))
