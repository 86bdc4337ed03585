"""Tests over all groups of a key, and the risk reports made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions import kernels
from riskframe.functions.columns import CLAIMS, PREMIUM, margin
from riskframe.operators.ab_tests import chi2_frequency_ab, severity_ab
from riskframe.operators.metrics import group_sizes, keyed
from riskframe.operators.ordering import rank_sums, small_side
from riskframe.operators.outcome import KEEP, OUTCOME, REJECT, outcome
from riskframe.sources.tables import stage

REPORT = ["report", "component", *OUTCOME, "overall_conclusion"]


def chi2_frequency_k(
    df: DataFrame, key: str, claims: str = CLAIMS, alpha: float = 0.05
) -> DataFrame:
    """k x 2 chi-squared test of claim frequency (Yates correction for two groups).

    A group without any counted row, or a table with an empty column, has an expected
    count of 0: the result is then ``insufficient``.
    """
    return _chi2_of(keyed(df, key).groupBy(key).agg(*_frequencies(claims)), alpha)


def _frequencies(claims: str) -> list[Column]:
    claim = F.col(claims)
    return [
        F.count_if(claim > 0).cast("double").alias("_hit"),
        F.count_if(claim == 0).cast("double").alias("_none"),
        F.count(F.lit(1)).alias("_rows"),
    ]


def _chi2_of(groups: DataFrame, alpha: float) -> DataFrame:
    """The chi-squared test from the counts of each group."""
    totals = groups.agg(
        F.sum("_hit").alias("_hits"), F.sum("_none").alias("_nones"), F.count(F.lit(1)).alias("_k")
    )
    size, n = F.col("_hit") + F.col("_none"), F.col("_hits") + F.col("_nones")
    gap = F.abs(F.col("_hit") - F.try_divide(size * F.col("_hits"), n))
    gap = F.when(F.col("_k") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    part = F.try_divide(gap * gap * n, size * F.col("_hits")) + F.try_divide(
        gap * gap * n, size * F.col("_nones")
    )
    summed = groups.crossJoin(F.broadcast(totals)).agg(
        F.sum(part).alias("x"),
        F.count_if(part.isNull()).alias("empty"),
        F.count(F.lit(1)).alias("n_groups"),
        F.coalesce(F.sum(size), F.lit(0e0)).alias("n_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("all_rows"),
    )
    valid = (F.col("n_groups") >= 2) & (F.col("empty") == 0)
    tested = summed.select(
        F.when(valid, F.col("x")).alias("statistic"),
        F.when(valid, F.col("n_groups") - 1).cast("double").alias("dof"),
        "n_groups",
        "n_rows",
        (F.col("all_rows") - F.col("n_rows")).alias("n_dropped"),
    ).withColumn("p_value", kernels.chi2_p("statistic", "dof"))
    return outcome(tested, "Chi-squared test", alpha)


def kruskal_k(df: DataFrame, value: str, key: str, alpha: float = 0.05) -> DataFrame:
    """Kruskal-Wallis test with tie correction over the groups that have values.

    Each group's mean rank is compared with the overall mean before squaring, which
    keeps digits when the number of rows is large.
    """
    rows = keyed(df, key).select(key, F.col(value).alias("v"))
    return _kruskal_of(rank_sums(rows, "v", key), rows.agg(F.count(F.lit(1)).alias("all_rows")), alpha)


def _kruskal_of(sums: DataFrame, sizes: DataFrame, alpha: float) -> DataFrame:
    """The Kruskal-Wallis test from the rank sums of each group; ``sizes`` is one row, with ``all_rows``."""
    n = F.col("n").cast("double")
    gap = F.col("rank_sum") / F.col("rows") - (n + 1) / 2
    summed = sums.agg(
        F.sum(F.col("rows") * gap * gap).alias("between"),
        F.sum("tie_term").alias("ties"),
        F.count(F.lit(1)).alias("n_groups"),
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
    )
    untied = F.lit(1.0) - F.try_divide(F.col("ties"), n * (n * n - 1))
    h = F.try_divide(F.col("between") * 12, n * (n + 1))
    valid = F.col("n_groups") >= 2
    tested = summed.crossJoin(F.broadcast(sizes)).select(
        F.when(valid, F.try_divide(h, untied)).alias("statistic"),
        F.when(valid, F.col("n_groups") - 1).cast("double").alias("dof"),
        "n_groups",
        F.col("n").alias("n_rows"),
        (F.col("all_rows") - F.col("n")).alias("n_dropped"),
    ).withColumn("p_value", kernels.chi2_p("statistic", "dof"))
    return outcome(tested, "Kruskal-Wallis test", alpha)


def _report(name: str, parts: dict[str, DataFrame], extra: list[str] = ()) -> DataFrame:
    """One row per sub-test; the overall conclusion rejects if any of them does."""
    tagged = [
        part.select(
            F.lit(name).alias("report"), F.lit(component).alias("component"), *OUTCOME, *extra
        )
        for component, part in parts.items()
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    # One row per sub-test.
    overall = F.max(F.col("reject_null")).over(Window.partitionBy("report"))
    return rows.withColumn("overall_conclusion", F.when(overall, REJECT).otherwise(KEEP)).select(
        *REPORT, *extra
    )


def insufficient(df: DataFrame, name: str, alpha: float) -> DataFrame:
    nothing = df.sparkSession.range(1).select(
        *[F.lit(None).cast("double").alias(c) for c in ("statistic", "dof", "p_value")],
        *[F.lit(0).alias(c) for c in ("n_groups", "n_rows", "n_dropped")],
    )
    return outcome(nothing, name, alpha)


def province_risk(
    df: DataFrame, alpha: float = 0.05, claims: str = CLAIMS, key: str = "Province"
) -> DataFrame:
    """Claim frequency and severity over provinces."""
    if key not in df.columns:
        return _report("province_risk", {"column": insufficient(df, f"{key} column not found", alpha)})
    narrow = df.select(key, claims)
    return _report("province_risk", {
        "frequency": chi2_frequency_k(narrow, key, claims, alpha),
        "severity": kruskal_k(narrow.where(F.col(claims) > 0), claims, key, alpha),
    })


def _tested_groups(df: DataFrame, key: str, k: int | None, min_n: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the groups of at least ``min_n`` rows (the k largest of them), and one row with the number of such groups.

    The sizes are counted once, for both.
    """
    sizes = small_side(group_sizes(df, key, min_n))
    largest = sizes.orderBy(F.col("n").desc(), key).limit(k) if k is not None else sizes
    valid = sizes.agg(F.count(F.lit(1)).alias("total_valid_groups"))
    return df.join(small_side(largest.select(key)), key, "left_semi"), F.broadcast(valid)


def postal_risk(
    df: DataFrame,
    alpha: float = 0.05,
    min_n: int = 30,
    k: int | None = None,
    claims: str = CLAIMS,
    key: str = "PostalCode",
) -> DataFrame:
    """Frequency and severity over all postal codes with at least min_n rows, or the k largest of them."""
    if key not in df.columns:
        nothing = insufficient(df, f"{key} column not found", alpha)
        return _report("postal_risk", {"column": nothing.withColumn(
            "total_valid_groups", F.lit(0).cast("bigint"))}, ["total_valid_groups"])
    narrow = df.select(key, claims)
    rows, valid = _tested_groups(narrow, key, k, min_n)
    parts = {
        "frequency": chi2_frequency_k(rows, key, claims, alpha),
        "severity": kruskal_k(rows.where(F.col(claims) > 0), claims, key, alpha),
    }
    return _report(
        "postal_risk",
        {name: part.crossJoin(valid) for name, part in parts.items()},
        ["total_valid_groups"],
    )


def postal_margin_test(
    df: DataFrame,
    alpha: float = 0.05,
    min_n: int = 30,
    k: int | None = None,
    premium: str = PREMIUM,
    claims: str = CLAIMS,
    key: str = "PostalCode",
) -> DataFrame:
    """Kruskal-Wallis test of the margin per row over all postal codes of min_n rows, or the k largest of them."""
    if key not in df.columns:
        nothing = insufficient(df, f"{key} column not found", alpha)
        return _report("postal_margin", {"column": nothing.withColumn(
            "total_valid_groups", F.lit(0).cast("bigint"))}, ["total_valid_groups"])
    narrow = df.select(key, margin(premium, claims).alias("margin"))
    rows, valid = _tested_groups(narrow, key, k, min_n)
    tested = kruskal_k(rows, "margin", key, alpha)
    return _report("postal_margin", {"margin": tested.crossJoin(valid)}, ["total_valid_groups"])


def group_reports(
    df: DataFrame,
    alpha: float = 0.05,
    min_n: int = 30,
    k: int | None = None,
    premium: str = PREMIUM,
    claims: str = CLAIMS,
    province: str = "Province",
    postal: str = "PostalCode",
) -> list[DataFrame]:
    """``province_risk``, ``postal_risk`` and ``postal_margin_test``, as far as their columns exist, from two scans.

    Each row counts for its province and for its postal code. One aggregate gives the
    frequencies of all groups of both, one order of claims and margin the rank sums; the
    reports are made of those rows.
    """
    keys = [c for c in (province, postal) if c in df.columns]
    if not keys:
        return []
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("_by"), F.col(c).cast("string").alias("_key")) for c in keys])).alias("_p")
    rows = df.select(F.col(claims).alias("_claims"), margin(premium, claims).alias("_margin"), pair)
    rows = rows.select("_p.*", "_claims", "_margin").where(F.col("_key").isNotNull())
    groups = rows.groupBy("_by", "_key").agg(*_frequencies("_claims"))
    groups = stage(groups.where((F.col("_by") != postal) | (F.col("_rows") >= min_n)))
    tested = groups
    if k is not None and postal in keys:
        largest = groups.where(F.col("_by") == postal).orderBy(F.col("_rows").desc(), "_key").limit(k)
        tested = stage(groups.where(F.col("_by") != postal).unionByName(largest))
    values = rows.join(small_side(tested.select("_by", "_key")), ["_by", "_key"], "left_semi").select(
        "_by", "_key", F.when(F.col("_claims") > 0, F.col("_claims")).alias("severity"),
        F.when(F.col("_by") == postal, F.col("_margin")).alias("margin"),
    )
    sums = stage(rank_sums(values, ["severity", "margin"], "_key", within=["_by"]))

    def frequency(by: str) -> DataFrame:
        return _chi2_of(tested.where(F.col("_by") == by), alpha)

    def ranked(by: str, measure: str, counted: str) -> DataFrame:
        sizes = tested.where(F.col("_by") == by).agg(F.coalesce(F.sum(counted), F.lit(0)).cast("bigint").alias("all_rows"))
        return _kruskal_of(sums.where((F.col("_by") == by) & (F.col("measure") == measure)), sizes, alpha)

    reports = []
    if province in keys:
        reports.append(_report("province_risk", {"frequency": frequency(province), "severity": ranked(province, "severity", "_hit")}))
    if postal in keys:
        valid = F.broadcast(groups.where(F.col("_by") == postal).agg(F.count(F.lit(1)).alias("total_valid_groups")))
        parts = {"frequency": frequency(postal), "severity": ranked(postal, "severity", "_hit")}
        extra = ["total_valid_groups"]
        reports.append(_report("postal_risk", {name: part.crossJoin(valid) for name, part in parts.items()}, extra))
        reports.append(_report("postal_margin", {"margin": ranked(postal, "margin", "_rows").crossJoin(valid)}, extra))
    return reports


def compared_values(df: DataFrame, col: str, a: str, b: str) -> tuple | None:
    """(a, b) if both occur, else the two most frequent values (smallest first on ties)."""
    counts = (
        keyed(df, col)
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col(col).isin(a, b).desc(), F.col("n").desc(), col)
        .limit(2)
        .collect()
    )
    values = [r[0] for r in counts]
    if len(values) < 2:
        return None
    if set(values) == {a, b}:
        return a, b
    if set(values) & {a, b}:
        # Only one of the named values occurs: the plain order of frequency decides.
        top = (
            keyed(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), col).limit(2).collect()
        )
        values = [r[0] for r in top]
    return values[0], values[1]


def gender_risk(
    df: DataFrame, alpha: float = 0.05, claims: str = CLAIMS, key: str = "Gender"
) -> DataFrame:
    """Frequency and severity of women against men."""
    if key not in df.columns:
        return _report("gender_risk", {"column": insufficient(df, f"{key} column not found", alpha)})
    narrow = df.select(key, claims)
    pair = compared_values(narrow, key, "Female", "Male")
    if pair is None:
        nothing = insufficient(df, "Need at least 2 gender categories", alpha)
        return _report("gender_risk", {"groups": nothing})
    return _report("gender_risk", {
        "frequency": chi2_frequency_ab(narrow, key, *pair, claims, alpha),
        "severity": severity_ab(narrow, key, *pair, claims, alpha),
    })
