"""Portfolio, segment, time and vehicle aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import CLAIMS, POLICY, PREMIUM, month_of, ratio
from riskframe.operators.ordering import small_side
from riskframe.schema import require_columns
from riskframe.sources.readers import coerce_date


def total(column: str) -> Column:
    """Sum that is 0 when every value is missing."""
    return F.coalesce(F.sum(column).cast("double"), F.lit(0e0))


def loss_ratio(premium: str = PREMIUM, claims: str = CLAIMS) -> Column:
    """Aggregate: sum of claims over sum of premium, NULL for no premium."""
    return ratio(total(claims), total(premium))


def claim_frequency(claims: str = CLAIMS) -> Column:
    """Aggregate: share of all rows that have a claim."""
    return ratio(F.count_if(F.col(claims) > 0), F.count(F.lit(1)))


def claim_severity(claims: str = CLAIMS) -> Column:
    """Aggregate: mean claim over the rows that have one."""
    return F.avg(F.when(F.col(claims) > 0, F.col(claims)))


def correlation(x: str | Column, y: str | Column) -> Column:
    """Aggregate: Pearson correlation over the rows that have both, NULL without variance."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)))


def with_claims(df: DataFrame, claims: str = CLAIMS) -> DataFrame:
    return df.where(F.col(claims) > 0)


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present (missing keys form no group)."""
    require_columns(df, *keys)
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def portfolio_kpis(df: DataFrame, premium: str = PREMIUM, claims: str = CLAIMS) -> DataFrame:
    """One row: totals, margin, loss ratio, claim frequency and severity. One scan."""
    return df.agg(
        F.count(F.lit(1)).alias("Rows"),
        total(premium).alias("TotalPremium"),
        total(claims).alias("TotalClaims"),
        (total(premium) - total(claims)).alias("TotalMargin"),
        loss_ratio(premium, claims).alias("LossRatio"),
        claim_frequency(claims).alias("ClaimFrequency"),
        claim_severity(claims).alias("ClaimSeverity"),
    )


def segment_kpis(
    df: DataFrame,
    keys: Sequence[str],
    premium: str = PREMIUM,
    claims: str = CLAIMS,
    policy: str = POLICY,
) -> DataFrame:
    """KPIs per segment, worst loss ratio first."""
    return (
        keyed(df, *keys)
        .groupBy(*keys)
        .agg(
            total(premium).alias("TotalPremium"),
            total(claims).alias("TotalClaims"),
            F.count(policy).alias("PolicyCount"),
            loss_ratio(premium, claims).alias("LossRatio"),
            claim_frequency(claims).alias("ClaimFrequency"),
            claim_severity(claims).alias("ClaimSeverity"),
        )
        .orderBy(F.col("LossRatio").desc_nulls_last(), *keys)
    )


def distinct_and_top(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values and the most frequent one (smallest value on a tie)."""
    counts = keyed(df, col).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.agg(F.count(F.lit(1)).alias("distinct_values"), first.alias("first")).select(
        F.lit(col).alias("column_name"),
        "distinct_values",
        F.col("first.value").alias("top_value"),
        (-F.col("first.rank")).alias("top_count"),
    )


def category_counts(df: DataFrame, col: str, top_n: int | None = 20) -> DataFrame:
    """Value counts, most frequent first."""
    counts = (
        keyed(df, col)
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "value")
    )
    return counts if top_n is None else counts.limit(top_n)


def temporal_trend(df: DataFrame, date_col: str, value_col: str, how: str = "sum") -> DataFrame:
    """Sum, mean or (for any other name) count of a value per date."""
    value = {"sum": total(value_col), "mean": F.avg(value_col)}.get(how, F.count(value_col))
    dated = keyed(coerce_date(df, date_col), date_col)
    return dated.groupBy(date_col).agg(value.alias("value")).orderBy(date_col)


def loss_ratio_by(df: DataFrame, key: str, top_n: int | None = 15) -> DataFrame:
    """Categories with the highest loss ratio."""
    ranked = segment_kpis(df, [key]).select(key, "TotalClaims", "TotalPremium", "LossRatio")
    return ranked if top_n is None else ranked.limit(top_n)


def risk_return(df: DataFrame, key: str = "Province") -> DataFrame:
    """Average premium per policy against loss ratio, per segment."""
    return segment_kpis(df, [key]).select(
        key,
        "TotalPremium",
        "TotalClaims",
        "PolicyCount",
        "LossRatio",
        ratio(F.col("TotalPremium"), F.col("PolicyCount")).alias("AvgPremium"),
    )


def monthly_kpis(df: DataFrame, date_col: str = "TransactionMonth") -> DataFrame:
    """KPIs per calendar month, in order of time."""
    dated = coerce_date(df, date_col).withColumn("Month", month_of(date_col))
    return segment_kpis(dated, ["Month"]).orderBy("Month")


def vehicle_risk(
    df: DataFrame,
    min_n: int = 50,
    top_n: int | None = 20,
    keys: Sequence[str] = ("Make", "VehicleType"),
) -> DataFrame:
    """Worst loss ratios among the vehicle groups with enough policies."""
    ranked = segment_kpis(df, list(keys)).where(F.col("PolicyCount") >= min_n).select(
        *keys, "TotalPremium", "TotalClaims", "PolicyCount", "LossRatio"
    )
    ranked = ranked.orderBy(F.col("LossRatio").desc_nulls_last(), *keys)
    return ranked if top_n is None else ranked.limit(top_n)


def make_extremes(
    df: DataFrame, n: int = 10, min_n: int = 10, key: str = "Make", claims: str = CLAIMS
) -> DataFrame:
    """The n makes with the most and the n with the least total claims."""
    makes = (
        keyed(df, key)
        .groupBy(key)
        .agg(
            total(claims).alias("TotalClaims_Sum"),
            F.avg(claims).alias("AvgClaims"),
            F.count(claims).alias("PolicyCount"),
        )
        .where(F.col("PolicyCount") >= min_n)
    )
    top = makes.orderBy(F.col("TotalClaims_Sum").desc(), key).limit(n)
    bottom = makes.orderBy(F.col("TotalClaims_Sum").asc(), key).limit(n)
    return top.withColumn("side", F.lit("top")).unionByName(
        bottom.withColumn("side", F.lit("bottom"))
    )


def postal_scatter(df: DataFrame, key: str = "PostalCode") -> DataFrame:
    """Total premium, total claims and policy count per postal code."""
    return (
        keyed(df, key)
        .groupBy(key)
        .agg(
            total(PREMIUM).alias("TotalPremium"),
            total(CLAIMS).alias("TotalClaims"),
            F.count(POLICY).alias("PolicyCount"),
        )
    )


def postal_corr(df: DataFrame, key: str = "PostalCode") -> DataFrame:
    """Correlation of total premium with total claims over the postal codes."""
    return postal_scatter(df, key).agg(
        correlation("TotalPremium", "TotalClaims").alias("correlation"),
        F.count(F.lit(1)).alias("n_groups"),
    )


def postal_margin(
    df: DataFrame, min_n: int = 30, top_n: int | None = 10, key: str = "PostalCode"
) -> DataFrame:
    """Average margin per row of the largest postal codes, best first."""
    sizes = (
        keyed(df, key)
        .groupBy(key)
        .agg(
            ratio(total(PREMIUM) - total(CLAIMS), F.count(F.lit(1))).alias("AvgMargin"),
            F.count(F.lit(1)).alias("PolicyCount"),
        )
        .where(F.col("PolicyCount") >= min_n)
    )
    if top_n is not None:
        sizes = sizes.orderBy(F.col("PolicyCount").desc(), key).limit(top_n)
    return sizes.orderBy(F.col("AvgMargin").desc_nulls_last(), key)


def group_sizes(df: DataFrame, key: str, min_n: int) -> DataFrame:
    """(key, n) of the keys with at least min_n rows."""
    return keyed(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_n)


def min_sample_filter(df: DataFrame, key: str, min_n: int) -> DataFrame:
    """Rows whose key occurs at least min_n times; a long list of keys is joined by a shuffle."""
    return df.join(small_side(group_sizes(df, key, min_n).select(key)), key, "left_semi")


def top_groups(df: DataFrame, key: str, k: int | None = 20, min_n: int = 1) -> DataFrame:
    """Rows of the k most frequent keys with at least min_n rows (smallest key on ties)."""
    if k is None:
        return min_sample_filter(df, key, min_n)
    keys = group_sizes(df, key, min_n).orderBy(F.col("n").desc(), key).limit(k)
    # Found once, so that later passes over the rows need not count the groups again.
    return df.join(small_side(keys.select(key)), key, "left_semi")


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """A repeatable sample of n rows: those with the smallest hash of (keys, seed)."""
    order = F.md5(F.concat_ws("|", *keys, F.lit(str(seed))).cast("binary"))
    return df.orderBy(order, *keys).limit(n)
