"""Distribution profile: moments, outliers, histograms, box statistics, correlations."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import schema as catalog
from riskframe.functions.columns import ratio
from riskframe.operators.ordering import clean, exact_quantiles, small_side

STATS_SCHEMA = T.StructType(
    [T.StructField("measure", T.StringType()), T.StructField("n", T.LongType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "mean", "std", "min", "q25", "q50", "q75", "max",
            "skewness", "kurtosis", "coefficient_of_variation",
        )
    ]
)


def numeric_column(df: DataFrame, column: str) -> None:
    """ValueError unless the column exists and is numeric."""
    catalog.require_columns(df, column)
    if catalog.kind_of(df.schema[column].dataType) != "numeric":
        raise ValueError(f"Column '{column}' is not numeric")


def descriptive_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, moments, quartiles, extremes.

    Skewness and kurtosis are the bias-corrected sample forms, NULL below 3 and 4 values.
    Absent columns are ignored; with none left the result is empty.
    """
    chosen = catalog.select_by_kind(df, "numeric") if cols is None else cols
    chosen = [c for c in chosen if c in df.columns]
    if not chosen:
        return df.sparkSession.createDataFrame([], STATS_SCHEMA)
    v, n = F.col("v"), F.col("n").cast("double")
    skew = F.when(n >= 3, F.col("g1") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0e0)))
    kurt = F.when(
        n >= 4, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0e0)) * ((n + 1) * F.col("g2") + 6)
    )
    # One group per column keeps the generated code the same size for any number of them.
    moments = (
        df.select(F.posexplode(F.array(*[clean(F.col(c)) for c in chosen])).alias("i", "v"))
        .groupBy("i")
        .agg(
            F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"),
            F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"),
        )
        .select(
            F.element_at(F.array(*[F.lit(c) for c in chosen]), F.col("i") + 1).alias("measure"),
            "n", "mean", "std", "min", "max",
            skew.alias("skewness"),
            kurt.alias("kurtosis"),
            ratio(F.col("std"), F.col("mean")).alias("coefficient_of_variation"),
        )
    )
    quartiles = exact_quantiles(df, chosen, [0.25, 0.5, 0.75]).select(
        "measure",
        *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
    )
    # One row per column on both sides.
    joined = moments.join(F.broadcast(quartiles), "measure", "left")
    return joined.select(STATS_SCHEMA.fieldNames())


def iqr_fences(df: DataFrame, col: str, factor: float) -> DataFrame:
    """One row (lower_bound, upper_bound, flat); NULL bounds if the column has no value."""
    q = F.col("quantiles")
    iqr = q[1] - q[0]
    bounds = exact_quantiles(df, [col], [0.25, 0.75]).select(
        (q[0] - iqr * factor).alias("lower_bound"),
        (q[1] + iqr * factor).alias("upper_bound"),
        (iqr == 0).alias("flat"),
    )
    return bounds.agg(*[F.max(c).alias(c) for c in bounds.columns])


def _outside(col: str) -> Column:
    value = clean(F.col(col))
    return ~F.col("flat") & (
        (value < F.col("lower_bound")) | (value > F.col("upper_bound"))
    )


def iqr_bounds(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """One row: outlier count, share of all rows in percent, and the bounds.

    With an interquartile range of 0 nothing counts as an outlier.
    """
    numeric_column(df, col)
    return (
        df.select(col)
        .crossJoin(F.broadcast(iqr_fences(df, col, factor)))
        .agg(
            F.count_if(_outside(col)).alias("outlier_count"),
            (ratio(F.count_if(_outside(col)), F.count(F.lit(1))) * 100).alias("outlier_percentage"),
            F.max("lower_bound").alias("lower_bound"),
            F.max("upper_bound").alias("upper_bound"),
        )
    )


def iqr_outliers(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """The rows outside the bounds of ``iqr_bounds``."""
    numeric_column(df, col)
    fences = iqr_fences(df, col, factor)
    return df.crossJoin(F.broadcast(fences)).where(_outside(col)).drop(*fences.columns)


def log1p_if_positive(df: DataFrame, col: str) -> DataFrame:
    """One column ``value``: log1p if every value is positive, else the values as they are."""
    values = df.select(clean(F.col(col)).alias("value")).where(F.col("value").isNotNull())
    lowest = values.agg((F.min("value") > 0).alias("positive"))
    return values.crossJoin(F.broadcast(lowest)).select(
        F.when(F.col("positive"), F.log1p("value")).otherwise(F.col("value")).alias("value")
    )


def histogram(df: DataFrame, col: str, bins: int = 50, log_scale: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed: (bin, low, high, n).

    Empty bins are listed. A column with one distinct value spans a range of 1 around it;
    a column without values gives no rows.
    """
    numeric_column(df, col)
    if log_scale:
        values = log1p_if_positive(df, col)
    else:
        values = df.select(clean(F.col(col)).alias("value")).where(F.col("value").isNotNull())
    one_value = F.min("value") == F.max("value")
    span = values.agg(
        F.when(one_value, F.min("value") - 0.5).otherwise(F.min("value")).alias("lo"),
        F.when(one_value, F.max("value") + 0.5).otherwise(F.max("value")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    guess = F.least(
        F.floor(F.try_divide(F.col("value") - F.col("lo"), F.col("width"))), F.lit(bins - 1)
    )

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.col("hi")).otherwise(F.col("lo") + i * F.col("width"))

    # The quotient may round across an edge; the edges themselves decide.
    placed = values.crossJoin(F.broadcast(span)).withColumn("_g", guess).select(
        F.when(F.col("value") < edge(F.col("_g")), F.col("_g") - 1)
        .when((F.col("value") >= edge(F.col("_g") + 1)) & (F.col("_g") < bins - 1), F.col("_g") + 1)
        .otherwise(F.col("_g"))
        .cast("int")
        .alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = span.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi", "width"
    )
    # At most `bins` rows on both sides.
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def box_stats(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR of the box) and flier count."""
    numeric_column(df, col)
    keys = [by] if by else []
    quartiles = exact_quantiles(df, [col], [0.25, 0.5, 0.75], keys)
    boxes = quartiles.select(
        *keys,
        "n",
        *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))],
    )
    rows = df.select(*keys, clean(F.col(col)).alias("value")).where(F.col("value").isNotNull())
    if by:
        joined = rows.join(small_side(boxes), by)
    else:
        joined = rows.crossJoin(F.broadcast(boxes))
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    low, high, value = F.col("q1") - reach, F.col("q3") + reach, F.col("value")
    group = [*keys, "n", "q1", "median", "q3"]
    return (
        joined.groupBy(*group)
        .agg(
            F.least(F.min(F.when(value >= low, value)), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(value <= high, value)), F.col("q3")).alias("whisker_high"),
            F.count_if((value < low) | (value > high)).alias("n_fliers"),
        )
    )


#: A variance below this share of the mean square is rounding.
FLAT = 1e-12


def _gram(centres: list[float]):
    """Sums over the rows of a task, per pair of columns: one row of k * k numbers each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centres)
        total = np.zeros((4, k, k))
        for batch in batches:
            cells = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.column_stack(cells) - np.array(centres)
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            total += [there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x]
        sums = [pa.array([t.ravel().tolist()], pa.list_(pa.float64())) for t in total]
        yield pa.RecordBatch.from_arrays(sums, ["n", "s", "q", "p"])

    return run


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows that have both: (x, y, r, n).

    Each task sums presence, values, squares and products of its rows as matrices, so one
    row of len(cols)^2 numbers leaves a task, whatever its rows. Values are taken from
    the column means (a first pass) to keep digits; a pair without variance gives NULL.
    """
    chosen = catalog.select_by_kind(df, "numeric") if cols is None else list(cols)
    k = len(chosen)
    rows = df.select(*[clean(F.col(c)).alias(f"c{i}") for i, c in enumerate(chosen)])
    means = rows.agg(*[F.avg(c).alias(c) for c in rows.columns]).first()
    sums = rows.mapInArrow(_gram([m or 0.0 for m in means]), "n array<double>, s array<double>, q array<double>, p array<double>")
    cells = sums.select(F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("at", "c")).groupBy("at").agg(
        *[F.sum(f"c.{c}").alias(c) for c in "nsqp"]
    )
    cells = cells.select(F.floor(F.col("at") / k).cast("int").alias("i"), (F.col("at") % k).alias("j"), *"nsqp")
    # The sums of the other column over the pair's rows stand in the mirrored cell.
    mirrored = cells.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("t"), F.col("q").alias("u"))
    n = F.col("n")
    vx, vy = n * F.col("q") - F.col("s") * F.col("s"), n * F.col("u") - F.col("t") * F.col("t")
    spread = (vx > FLAT * n * F.col("q")) & (vy > FLAT * n * F.col("u"))
    r = (n * F.col("p") - F.col("s") * F.col("t")) / F.sqrt(vx) / F.sqrt(vy)
    r = F.when(spread, F.greatest(F.lit(-1e0), F.least(F.lit(1e0), r)))
    names = F.array(*[F.lit(c) for c in chosen])
    # At most len(cols)^2 rows.
    return cells.join(F.broadcast(mirrored), ["i", "j"]).select(
        F.element_at(names, F.col("i") + 1).alias("x"), F.element_at(names, F.col("j") + 1).alias("y"),
        r.alias("r"), n.cast("bigint").alias("n"),
    )


# Workers then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
