"""Attribution of predictions to features (Shapley values), over whole tables."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.models import feature_names, node_table

#: Bytes of trees in one broadcast value; a larger model is sent in several.
GROUP_BYTES = 64 << 20


def linear_attribution(model: Model, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(feature, mean_abs_shap) of a linear model: exact, coefficient * (x - mean).

    Two passes: the means, then the mean absolute deviations.
    """
    names = list(names) if names else feature_names(df)
    scaler = StandardScaler(inputCol="features", outputCol="_centred", withMean=True, withStd=False).fit(df)
    sums = scaler.transform(df).select(
        Summarizer.metrics("normL1", "count").summary(F.col("_centred")).alias("s")
    )
    coefficients = [abs(float(c)) for c in model.coefficients]
    slots = F.posexplode(vector_to_array("s.normL1")).alias("i", "l1")
    return (
        sums.select("s.count", slots)
        .select(
            F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1).alias("feature"),
            (F.element_at(F.array(*[F.lit(c) for c in coefficients]), F.col("i") + 1)
             * F.col("l1") / F.col("count")).alias("mean_abs_shap"),
        )
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )


#: What is known of each tree, as arrays in the order of its nodes.
PARTS = ["left", "right", "feature", "threshold", "categories", "value", "rows"]


def _size(trees: dict[str, list]) -> int:
    """Bytes of a group of trees, about."""
    return sum(a.nbytes for part in PARTS if part != "categories" for a in trees[part])


def trees_of(model: Model) -> list[dict[str, list]]:
    """The model's trees, scaled so that the sum of their outputs is the model's, in groups of at most GROUP_BYTES.

    The output is the mean prediction (forest), the mean probability of class 1 (forest
    classifier), or the weighted sum of the trees (boosted; for a classifier the margin).
    """
    boosted = "GBT" in type(model).__name__
    classifier = type(model).__name__ == "RandomForestClassificationModel"
    table = node_table(model).toPandas().sort_values(["tree", "node"])
    groups = [{part: [] for part in PARTS}]
    count = table["tree"].nunique()
    for _, part in table.groupby("tree"):
        if groups[-1]["left"] and _size(groups[-1]) > GROUP_BYTES:
            groups.append({part: [] for part in PARTS})
        trees = groups[-1]
        value = part["prediction"].to_numpy(float)
        if classifier:
            stats = np.stack(part["stats"].to_numpy())
            value = stats[:, 1] / np.maximum(stats.sum(axis=1), 1e-300) if stats.shape[1] > 1 else np.zeros(len(part))
        trees["left"].append(part["left"].to_numpy(int))
        trees["right"].append(part["right"].to_numpy(int))
        trees["feature"].append(part["feature"].fillna(-1).to_numpy(int))
        trees["threshold"].append(part["threshold"].to_numpy(float))
        trees["categories"].append([None if c is None else list(c) for c in part["categories"]])
        trees["value"].append(value * (float(part["weight"].iloc[0]) if boosted else 1.0 / count))
        trees["rows"].append(part["rows"].to_numpy(float))
    return groups


def expected(trees: dict[str, list]) -> float:
    """Sum over the trees of the mean output, by the rows that reached each leaf."""
    return sum(
        float(np.sum((value * rows)[left < 0]) / rows[0]) for left, value, rows in zip(trees["left"], trees["value"], trees["rows"])
    )


def _weights(m: int) -> list[float]:
    return [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]


def add_shapley(trees: dict[str, list], x: np.ndarray, phi: np.ndarray) -> None:
    """Add each row's Shapley values to ``phi``; one walk through each tree, whose paths share their beginnings.

    On the way down a path's features have a share z of the rows (product over the path)
    and for each row whether it passes (o). The products of (z + o t) over the features
    are kept along the path; a leaf divides one feature out and weighs the coefficients,
    which count the subsets of the others by size.
    """
    n = len(x)
    for left, right, feature, threshold, categories, value, rows in zip(
        *(trees[part] for part in PARTS)
    ):
        # (node, features, shares, passing, polynomial of them)
        stack = [(0, [], [], [], [np.ones(n)])]
        while stack:
            node, features, shares, passing, poly = stack.pop()
            if left[node] < 0:
                m = len(features)
                weights = _weights(m)
                for j in range(m):
                    z, o = shares[j], passing[j]
                    # Divided by (z + t) from the top, where the row passes, else by z.
                    total, last = np.zeros(n), np.zeros(n)
                    for s in range(m - 1, -1, -1):
                        last = poly[s + 1] - z * last
                        total += weights[s] * np.where(o, last, poly[s] / z if z > 0 else 0.0)
                    phi[:, features[j]] += value[node] * (o - z) * total
                continue
            f = feature[node]
            column = x[:, f]
            good = column <= threshold[node] if categories[node] is None else np.isin(column, categories[node])
            for child, passes in ((left[node], good), (right[node], ~good)):
                share = rows[child] / rows[node]
                if f in features:
                    at = features.index(f)
                    z, o = shares[at] * share, passing[at] & passes
                    rest = [(shares[k], passing[k]) for k in range(len(features)) if k != at]
                    names = [k for k in features if k != f]
                    grown = [np.ones(n)]
                    for r in rest:
                        grown = _times(grown, *r)
                else:
                    z, o, rest, names, grown = share, passes, list(zip(shares, passing)), features, poly
                stack.append((child, [*names, f], [*(r[0] for r in rest), z], [*(r[1] for r in rest), o], _times(grown, z, o)))


def _times(poly: list[np.ndarray], z: float, o: np.ndarray) -> list[np.ndarray]:
    """A polynomial times (z + o t)."""
    return [z * poly[0], *(z * b + o * a for a, b in zip(poly, poly[1:])), o * poly[-1]]


def tree_shap_values(model: Model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns, ``shap`` (array of one value per feature) and ``base`` per row."""
    groups = [df.sparkSession.sparkContext.broadcast(t) for t in trees_of(model)]
    base = sum(expected(g.value) for g in groups)
    keep = list(keep)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                phi = np.zeros(x.shape)
                for g in groups:
                    add_shapley(g.value, x, phi)
                yield pdf[keep].assign(shap=list(phi), base=base)

    rows = df.select(*keep, vector_to_array("features").alias("x"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    schema = (kept + ", " if kept else "") + "shap array<double>, base double"
    return rows.mapInPandas(explain, schema)


def tree_attribution(model: Model, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(feature, mean_abs_shap) of a tree model; each batch is summed before it leaves Python."""
    names = list(names) if names else feature_names(df)
    groups = [df.sparkSession.sparkContext.broadcast(t) for t in trees_of(model)]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                phi = np.zeros(x.shape)
                for g in groups:
                    add_shapley(g.value, x, phi)
                total = np.abs(phi).sum(axis=0)
                yield pd.DataFrame({"feature": names, "total": total, "n": len(x)})

    return (
        df.select(vector_to_array("features").alias("x"))
        .mapInPandas(explain, "feature string, total double, n long")
        .groupBy("feature")
        .agg((F.sum("total") / F.sum("n")).alias("mean_abs_shap"))
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )


def attribution(model: Model, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Mean absolute Shapley value per feature, for linear and tree models."""
    if hasattr(model, "coefficients"):
        return linear_attribution(model, df, names)
    return tree_attribution(model, df, names)


# Workers then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
