"""Shapiro-Wilk normality test of groups of any size, from ranks inside buckets.

W compares the ordered values with normal scores of their ranks, so it is a quotient of
sums over the rows: exact ranks come from ``ordering``, scores are column expressions,
and each group reduces to one row, from which ``kernels`` gets W and p. Copies of a value are counted first; the scores of
their ranks are summed in blocks, which are spread when a value has very many copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions import kernels
from riskframe.operators.ordering import bucket_positions, bucketed, clean, small_side

#: Copies of a value whose ranks are listed where the value is; beyond that in blocks of this size.
BLOCK_ROWS = 4_096

# Rational approximations of the normal quantile (highest power first) of
# Wichura, Applied Statistics 37 (1988), AS241.
CENTRE_UP = [
    2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
    13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080,
]
CENTRE_DOWN = [
    5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867,
    5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0,
]
SIDE_UP = [
    7.7454501427834140764e-4, 0.022723844989269184583, 0.24178072517745061177, 1.2704582524523683826,
    3.6478483247632046050, 5.7694972214606914055, 4.6303378461565452959, 1.4234371107496835773,
]
SIDE_DOWN = [
    1.0507500716444168432e-9, 5.4759380849953449460e-4, 0.015198666563616457197, 0.14810397642748007459,
    0.68976733498510000455, 1.6763848301838038494, 2.0531916266377588219, 1.0,
]
TAIL_UP = [
    2.0103343992922881327e-7, 2.7115555687434875782e-5, 1.2426609473880784386e-3, 0.026532189526576123093,
    0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772,
]
TAIL_DOWN = [
    2.0442631033899397856e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.8686913114561325910e-4,
    0.014875361290850614853, 0.13692988092273580531, 0.59983220655588793769, 1.0,
]

def polynomial(coefficients: list[float], x: Column) -> Column:
    """Value of a polynomial, constant term first."""
    total = F.lit(0e0)
    for c in reversed(coefficients):
        total = total * x + F.lit(float(c))
    return total


def normal_score(p: Column) -> Column:
    """The normal quantile of a probability between 0 and 1."""
    def fraction(up: list[float], down: list[float], x: Column) -> Column:
        return polynomial(up[::-1], x) / polynomial(down[::-1], x)

    q = p - 0.5
    r = F.sqrt(-F.ln(F.least(p, 1 - p)))
    outer = F.when(r <= 5, fraction(SIDE_UP, SIDE_DOWN, r - 1.6)).otherwise(fraction(TAIL_UP, TAIL_DOWN, r - 5))
    return F.when(F.abs(q) <= 0.425, q * fraction(CENTRE_UP, CENTRE_DOWN, 0.180625 - q * q)).otherwise(
        F.when(q < 0, -outer).otherwise(outer)
    )


def _blom(rank: Column, n: Column) -> Column:
    return normal_score((rank - 0.375) / (n + 0.25))


def _score_sums(rows: DataFrame, stats: DataFrame, buckets: int | None) -> DataFrame:
    """Per group: sums of scores times deviations and of squared scores, second and last but one value."""
    cells = bucketed(rows, ["v"], ["grp"], buckets)
    starts = bucket_positions(cells, ["grp"]).select("grp", "bucket", "start")
    counted = cells.groupBy("grp", "bucket", "value").agg(F.count(F.lit(1)).alias("copies"))
    running = Window.partitionBy("grp", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        counted.withColumn("_upto", F.sum("copies").over(running))
        .join(small_side(starts), ["grp", "bucket"])
        .select("grp", "value", (F.col("start") + F.col("_upto") - F.col("copies") + 1).alias("first"), (F.col("start") + F.col("_upto")).alias("last"))
    )
    # Blocks of the ranks of a value: one, unless it has very many copies.
    block = F.explode(F.sequence("first", "last", F.lit(BLOCK_ROWS).cast("long"))).alias("from")
    many = F.col("last") - F.col("first") >= BLOCK_ROWS
    spread = placed.where(many).select("grp", "value", block, "last").repartition("grp", "from")
    blocks = placed.where(~many).withColumnRenamed("first", "from").unionByName(spread)
    ranks = blocks.select(
        "grp", "value", F.explode(F.sequence("from", F.least("last", F.col("from") + (BLOCK_ROWS - 1)))).alias("rank")
    ).join(small_side(stats.select("grp", "n", "mean")), "grp")
    score = _blom(F.col("rank"), F.col("n"))
    return ranks.withColumn("m", score).groupBy("grp").agg(
        F.sum(F.col("m") * (F.col("value") - F.col("mean"))).alias("s"),
        F.sum(F.col("m") * F.col("m")).alias("square"),
        F.max(F.when(F.col("rank") == 2, F.col("value"))).alias("second"),
        F.max(F.when(F.col("rank") == F.col("n") - 1, F.col("value"))).alias("next"),
    )


def shapiro_wilk(df: DataFrame, value: str, group: str, buckets: int | None = None) -> DataFrame:
    """Normality test per group: (grp, n, w, p_value, status), for any number of values from 3 on.

    Fewer values are ``insufficient``; equal values have W = 1. The p-value's formulas were
    fitted up to 5,000 values and go on along their tangents in log n beyond that.
    """
    rows = df.select(F.col(group).cast("string").alias("grp"), clean(F.col(value)).alias("v")).where(
        F.col("grp").isNotNull() & F.col("v").isNotNull()
    )
    stats = rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count(F.lit(1))).alias("spread"),
        F.min("v").alias("low"), F.max("v").alias("high"),
    )
    sums = stats.join(_score_sums(rows, stats, buckets), "grp")
    arguments = [F.col(c).cast("double") for c in ("n", "low", "second", "next", "high", "s", "square", "spread")]
    tested = sums.withColumn("t", kernels.shapiro_w_p(*arguments))
    return tested.select("grp", "n", "t.w", "t.p_value", F.when(F.col("n") < 3, "insufficient").otherwise("ok").alias("status"))
