"""Comparisons of two groups A and B of one table.

Every test is one aggregation down to one row, followed by the p-value of that row.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import kernels
from riskframe.functions.columns import CLAIMS, PREMIUM, margin, ratio
from riskframe.operators.normality import shapiro_wilk
from riskframe.operators.ordering import clean, rank_sums
from riskframe.operators.outcome import OUTCOME, outcome, percent_change
from riskframe.schema import require_columns

EXACT_SMALL = 8
NORMAL_LEVEL = 0.05
METHODS = ("auto", "welch", "mann_whitney")


def ab_groups(df: DataFrame, col: str, a, b) -> DataFrame:
    """Rows of the two groups with ``grp`` = A or B; one scan serves both."""
    require_columns(df, col)
    return df.where(F.col(col).isin(a, b)).withColumn(
        "grp", F.when(F.col(col) == F.lit(a), "A").otherwise("B")
    )


def _in(group: str) -> Column:
    return F.col("grp") == group


def chi2_frequency_ab(
    df: DataFrame, group: str, a, b, claims: str = CLAIMS, alpha: float = 0.05
) -> DataFrame:
    """2x2 chi-squared test of claim frequency, with the Yates correction."""
    claim = F.col(claims)
    rows = ab_groups(df, group, a, b)
    table = rows.agg(
        F.count_if(_in("A") & (claim > 0)).alias("claims_a"),
        F.count_if(_in("A") & (claim == 0)).alias("no_claims_a"),
        F.count_if(_in("B") & (claim > 0)).alias("claims_b"),
        F.count_if(_in("B") & (claim == 0)).alias("no_claims_b"),
        F.count_if(_in("A")).alias("group_a_size"),
        F.count_if(_in("B")).alias("group_b_size"),
    )
    cells = ["claims_a", "no_claims_a", "claims_b", "no_claims_b"]
    ca, za, cb, zb = [F.col(c).cast("double") for c in cells]
    n = ca + za + cb + zb
    expected = [
        F.try_divide((ca + za) * (ca + cb), n),
        F.try_divide((ca + za) * (za + zb), n),
        F.try_divide((cb + zb) * (ca + cb), n),
        F.try_divide((cb + zb) * (za + zb), n),
    ]
    gap = F.abs(ca - expected[0])
    gap = gap - F.least(F.lit(0.5), gap)
    statistic = sum((F.try_divide(gap * gap, e) for e in expected[1:]), F.try_divide(gap * gap, expected[0]))
    fa = ratio(F.col("claims_a"), F.col("group_a_size"))
    fb = ratio(F.col("claims_b"), F.col("group_b_size"))
    tested = table.select(
        *table.columns,
        statistic.alias("statistic"),
        F.lit(1).alias("dof"),
        F.lit(2).alias("n_groups"),
        (F.col("claims_a") + F.col("no_claims_a") + F.col("claims_b") + F.col("no_claims_b")).alias("n_rows"),
        fa.alias("group_a_frequency"),
        fb.alias("group_b_frequency"),
        (fb - fa).alias("frequency_difference"),
        percent_change(fa, fb).alias("frequency_difference_pct"),
    )
    tested = tested.withColumn(
        "n_dropped", F.col("group_a_size") + F.col("group_b_size") - F.col("n_rows")
    ).withColumn("p_value", kernels.chi2_p("statistic", "dof"))
    return outcome(
        tested,
        "Chi-squared test for claim frequency",
        alpha,
        [
            "group_a_frequency", "group_b_frequency", "frequency_difference",
            "frequency_difference_pct", "group_a_size", "group_b_size", *cells,
        ],
    )


def welch_t(
    df: DataFrame,
    value: str,
    group: str,
    a,
    b,
    alpha: float = 0.05,
    test_name: str = "Welch's t-test",
) -> DataFrame:
    """Two-sided t-test with unequal variances over the non-NULL values."""
    v = clean(F.col(value))
    rows = ab_groups(df, group, a, b).select("grp", v.alias("v"))
    side = {g: F.when(_in(g), F.col("v")) for g in "AB"}
    sums = rows.agg(
        *[f(side[g]).alias(f"{name}_{g.lower()}")
          for g in "AB"
          for f, name in ((F.count, "n"), (F.avg, "mean"), (F.var_samp, "var"))],
        F.count_if(_in("A")).alias("group_a_size"),
        F.count_if(_in("B")).alias("group_b_size"),
    )
    qa = F.try_divide(F.col("var_a"), F.col("n_a"))
    qb = F.try_divide(F.col("var_b"), F.col("n_b"))
    na, nb = F.col("n_a") - 1, F.col("n_b") - 1
    dof = F.try_divide((qa + qb) * (qa + qb), F.try_divide(qa * qa, na) + F.try_divide(qb * qb, nb))
    tested = sums.select(
        *sums.columns,
        F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(qa + qb)).alias("statistic"),
        dof.alias("dof"),
        F.lit(2).alias("n_groups"),
        (F.col("n_a") + F.col("n_b")).alias("n_rows"),
        (F.col("group_a_size") + F.col("group_b_size") - F.col("n_a") - F.col("n_b")).alias("n_dropped"),
    ).withColumn("p_value", kernels.t_p("statistic", "dof"))
    return outcome(
        tested, test_name, alpha, ["mean_a", "mean_b", "group_a_size", "group_b_size"]
    )


def mann_whitney(
    df: DataFrame,
    value: str,
    group: str,
    a,
    b,
    alpha: float = 0.05,
    test_name: str = "Mann-Whitney U test",
) -> DataFrame:
    """Two-sided U test; the statistic is U of group A.

    The p-value is exact for untied samples of which one has at most 8 values, else from
    the normal limit with tie and continuity correction (``z``).
    """
    rows = ab_groups(df, group, a, b).select("grp", F.col(value).alias("v"))
    sums = rank_sums(rows, "v", "grp").agg(
        F.coalesce(F.sum(F.when(_in("A"), F.col("rows"))), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum(F.when(_in("B"), F.col("rows"))), F.lit(0)).alias("n_b"),
        F.sum(F.when(_in("A"), F.col("rank_sum"))).alias("rank_sum_a"),
        F.sum("tie_term").alias("tie_term"),
    )
    sizes = rows.agg(F.count(F.lit(1)).alias("all_rows"))
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    u = F.col("rank_sum_a") - na * (na + 1) / 2
    spread = F.sqrt(na * nb / 12 * (n + 1 - F.try_divide(F.col("tie_term"), n * (n - 1))))
    u_max = F.greatest(u, na * nb - u)
    exact = (F.least(na, nb) <= EXACT_SMALL) & (F.col("tie_term") == 0)
    tested = sums.crossJoin(F.broadcast(sizes)).select(
        F.col("n_a"),
        F.col("n_b"),
        F.when((na > 0) & (nb > 0), u).alias("statistic"),
        F.try_divide(u_max - na * nb / 2 - 0.5, spread).alias("z"),
        F.lit(None).cast("double").alias("dof"),
        F.lit(2).alias("n_groups"),
        (F.col("n_a") + F.col("n_b")).alias("n_rows"),
        (F.col("all_rows") - F.col("n_a") - F.col("n_b")).alias("n_dropped"),
        exact.alias("exact"),
        u_max.alias("u_max"),
    )

    def only_if(condition: Column, column: str) -> Column:
        return F.when(condition & F.col("statistic").isNotNull(), F.col(column))

    exact_p = kernels.mann_whitney_exact_p(*[only_if(F.col("exact"), c) for c in ("n_a", "n_b", "u_max")])
    # One-sided z below 0 happens when U is at its centre; the two-sided p is then 1.
    limit_p = kernels.normal_p(only_if(~F.col("exact"), "z"))
    tested = tested.withColumn("_exact_p", exact_p).withColumn("_limit_p", limit_p)
    p = F.when(F.col("exact"), F.col("_exact_p")).when(F.col("z") < 0, F.lit(1e0)).otherwise(F.col("_limit_p"))
    tested = tested.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p))
    return outcome(tested, test_name, alpha, ["z", "exact"])


SEVERITY_COLUMNS = [
    "group_a_severity", "group_b_severity", "severity_difference", "severity_difference_pct",
    "group_a_size", "group_b_size", "use_parametric",
]


def severity_ab(
    df: DataFrame, group: str, a, b, claims: str = CLAIMS, alpha: float = 0.05, method: str = "auto"
) -> DataFrame:
    """Severity of two groups: Welch's t if the claims of both look normal, else U.

    ``method`` is ``auto`` (Shapiro-Wilk decides, whatever the sizes), ``welch`` or
    ``mann_whitney``. Two one-row results decide the branch on the driver.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    rows = (
        ab_groups(df, group, a, b)
        .where(F.col(claims) > 0)
        .select("grp", F.col(claims).cast("double").alias("v"))
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = rows.agg(
            *[f(F.when(_in(g), F.col("v"))).alias(f"{name}_{g.lower()}")
              for g in "AB" for f, name in ((F.count, "n"), (F.avg, "severity"))]
        ).first()
        if not counts.n_a or not counts.n_b:
            parametric = None
        else:
            parametric = method == "welch"
            if method == "auto":
                normal = shapiro_wilk(rows, "v", "grp").collect()
                parametric = all(r.p_value is not None and r.p_value > NORMAL_LEVEL for r in normal)
        spark = df.sparkSession
        facts = spark.range(1).select(
            F.lit(counts.severity_a).cast("double").alias("group_a_severity"),
            F.lit(counts.severity_b).cast("double").alias("group_b_severity"),
            F.lit(counts.n_a).cast("bigint").alias("group_a_size"),
            F.lit(counts.n_b).cast("bigint").alias("group_b_size"),
            F.lit(parametric).cast("boolean").alias("use_parametric"),
        )
        if parametric is None:
            tested = facts.select(
                F.lit(None).cast("double").alias("statistic"),
                F.lit(None).cast("double").alias("dof"),
                F.lit(None).cast("double").alias("p_value"),
                F.lit(2).alias("n_groups"),
                (F.col("group_a_size") + F.col("group_b_size")).alias("n_rows"),
                F.lit(0).alias("n_dropped"),
            )
            result = outcome(tested, "Claim severity test", alpha)
        elif parametric:
            result = welch_t(rows, "v", "grp", "A", "B", alpha, "Welch's t-test for claim severity")
        else:
            result = mann_whitney(
                rows, "v", "grp", "A", "B", alpha, "Mann-Whitney U test for claim severity"
            )
        sa, sb = F.col("group_a_severity"), F.col("group_b_severity")
        row = result.drop("group_a_size", "group_b_size").crossJoin(F.broadcast(facts)).withColumns({
            "severity_difference": sb - sa,
            "severity_difference_pct": percent_change(sa, sb),
        })
        row = row.select(*[c for c in result.columns if c in OUTCOME], *SEVERITY_COLUMNS)
        # One row; computed here so that the claims need not stay cached.
        return spark.createDataFrame(row.collect(), row.schema)
    finally:
        rows.unpersist()


def margin_ab(
    df: DataFrame,
    group: str,
    a,
    b,
    premium: str = PREMIUM,
    claims: str = CLAIMS,
    alpha: float = 0.05,
) -> DataFrame:
    """Welch's t-test of the margin per row; rows without a margin are dropped and counted."""
    tested = welch_t(
        df.withColumn("_margin", margin(premium, claims)),
        "_margin", group, a, b, alpha, "Welch's t-test for margin difference",
    )
    ma, mb = F.col("mean_a"), F.col("mean_b")
    return tested.select(
        *[c for c in tested.columns if c not in ("mean_a", "mean_b")],
        ma.alias("group_a_mean_margin"),
        mb.alias("group_b_mean_margin"),
        (mb - ma).alias("margin_difference"),
        percent_change(ma, mb, F.abs(ma)).alias("margin_difference_pct"),
    )
