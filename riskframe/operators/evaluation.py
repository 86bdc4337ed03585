"""Model metrics as aggregations over a table of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import ratio
from riskframe.operators.ordering import rank_sums


def regression_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()
) -> DataFrame:
    """RMSE, R2 and MAE over the rows that have both values, optionally per group."""
    rows = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(label) - F.col(prediction)
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("spread"),
    )
    return sums.select(
        *by,
        "n",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - ratio(F.col("mse"), F.col("spread"))).alias("r2"),
        "mae",
    )


def classification_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, optionally per group.

    A class that is never predicted has precision 0. All figures come from the confusion
    counts, one row per pair of classes.
    """
    rows = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    confusion = rows.groupBy(
        *by, F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    sides = F.explode(F.array(
        F.struct(
            F.col("l").alias("cls"),
            F.col("n").alias("support"),
            zero.alias("predicted"),
            F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(zero).alias("hit"),
        ),
        F.struct(
            F.col("p").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hit")
        ),
    ))
    classes = (
        confusion.select(*by, sides.alias("s"))
        .groupBy(*by, "s.cls")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "hit")])
    )
    none = F.lit(0e0)
    precision = F.coalesce(ratio(F.col("hit"), F.col("predicted")), none)
    recall = F.coalesce(ratio(F.col("hit"), F.col("support")), none)
    f1 = F.coalesce(ratio(F.col("hit") * 2, F.col("support") + F.col("predicted")), none)
    n = F.sum("support")
    return classes.groupBy(*by).agg(
        n.alias("n"),
        ratio(F.sum("hit"), n).alias("accuracy"),
        ratio(F.sum(F.col("support") * precision), n).alias("precision"),
        ratio(F.sum(F.col("support") * recall), n).alias("recall"),
        ratio(F.sum(F.col("support") * f1), n).alias("f1"),
    )


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve from mid-ranks; NULL if a class is absent."""
    rows = pred.where(F.col(label).isin(0, 1) & F.col(score).isNotNull()).select(
        F.col(label).cast("int").alias("y"), score
    )
    sums = rank_sums(rows, score, "y").agg(
        F.sum(F.when(F.col("y") == 1, F.col("rows"))).cast("double").alias("n1"),
        F.sum(F.when(F.col("y") == 0, F.col("rows"))).cast("double").alias("n0"),
        F.sum(F.when(F.col("y") == 1, F.col("rank_sum"))).alias("r1"),
    )
    n1, n0 = F.col("n1"), F.col("n0")
    return sums.select(
        ratio(F.col("r1") - n1 * (n1 + 1) / 2, n1 * n0).alias("roc_auc"),
        F.coalesce(n1, F.lit(0e0)).cast("bigint").alias("n_positive"),
        F.coalesce(n0, F.lit(0e0)).cast("bigint").alias("n_negative"),
    )
