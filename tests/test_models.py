"""Fits recover planted signals; attributions add up."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import attribution, features, models
from riskframe.plans import eda, hypothesis, training
from riskframe.sources import policies, synthetic_policies


@pytest.fixture(scope="module")
def planted(spark):
    df = synthetic_policies(spark, 1500).select(
        "PolicyID", "TotalPremium", "SumInsured", "CustomValueEstimate", "Gender",
        (5 + 2 * F.col("TotalPremium") - 0.1 * F.col("SumInsured")).alias("y"),
        (F.col("CustomValueEstimate") > 200000).cast("int").alias("flag"),
    )
    return features.hash_split(df, ["PolicyID"])


NUMS = ["TotalPremium", "SumInsured", "CustomValueEstimate"]


def sides(planted, target):
    table, _ = models.assemble(planted, ["Gender"], NUMS, target, ["PolicyID", "is_test"])
    table = table.cache()
    return table.where("not is_test"), table.where("is_test")


def test_linear_recovers_the_signal(planted):
    train, test = sides(planted, "y")
    fitted = models.fit_linear(train, test)
    weights = dict(zip(models.feature_names(train), fitted.model.coefficients))
    assert weights["TotalPremium"] == pytest.approx(2.0) and weights["SumInsured"] == pytest.approx(-0.1)
    assert {r.side: round(r.r2, 6) for r in fitted.metrics.collect()} == {"train": 1.0, "test": 1.0}
    ranked = models.feature_importance(train, fitted.model, top_n=2).collect()
    assert ranked[0].feature == "TotalPremium" and len(ranked) == 2


def test_vector_form_equals_indicator_columns(planted):
    train, _ = sides(planted, "y")
    assert models.feature_names(train) == ["Gender_Male", *NUMS]
    wide = features.one_hot(planted.where("not is_test").select("PolicyID", "Gender"), ["Gender"])
    both = train.select("PolicyID", vector_to_array("features")[0].alias("a")).join(wide, "PolicyID")
    assert both.where("a <> Gender_Male").count() == 0


def test_vectors_of_missing_and_unseen_categories(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "t string, y double")
    table, encoder = models.assemble(df, ["t"], [], "y", ["t"])
    assert models.feature_names(table) == ["t_nan", "t_b"]
    assert [list(r.features.toArray()) for r in table.orderBy("label").collect()] == [[0, 0], [0, 1], [1, 0]]
    new = spark.createDataFrame([("z", 1.0), ("b", 2.0)], "t string, y double")
    seen, _ = models.assemble(new, ["t"], [], "y", encoder=encoder)
    assert [list(r.features.toArray()) for r in seen.orderBy("label").collect()] == [[0, 0], [0, 1]]


def test_column_of_very_many_categories(spark):
    n = 120_000
    df = spark.range(n).select(F.format_string("z%06d", "id").alias("t"), F.col("id").cast("double").alias("y"))
    table, encoder = models.assemble(df, ["t"], [], "y")
    slots = table.select(vector_to_array("features").alias("v")).where("label = 7").first().v
    assert len(slots) == n - 1 and sum(slots) == 1
    new = spark.createDataFrame([("unseen", 1.0), ("z000007", 2.0)], "t string, y double")
    seen, _ = models.assemble(new, ["t"], [], "y", encoder=encoder)
    assert {r.label: int(sum(r.features.toArray())) for r in seen.collect()} == {1.0: 0, 2.0: 1}


def brute_force(root, x):
    """Shapley values of one tree by all subsets, with the cover-weighted value of a subset."""
    used = set()

    def collect(node):
        if node.subtreeDepth():
            used.add(node.split().featureIndex())
            collect(node.leftChild())
            collect(node.rightChild())

    def value(node, known):
        if not node.subtreeDepth():
            return node.prediction()
        split, left, right = node.split(), node.leftChild(), node.rightChild()
        f = split.featureIndex()
        if f in known:
            if split.getClass().getSimpleName() == "ContinuousSplit":
                good = x[f] <= split.threshold()
            else:
                good = x[f] in list(split.leftCategories())
            return value(left if good else right, known)
        share = left.impurityStats().count() / node.impurityStats().count()
        return share * value(left, known) + (1 - share) * value(right, known)

    collect(root)
    used = sorted(used)
    m, phi = len(used), np.zeros(len(x))
    for j in used:
        others = [f for f in used if f != j]
        for size in range(m):
            weight = factorial(size) * factorial(m - 1 - size) / factorial(m)
            for known in combinations(others, size):
                phi[j] += weight * (value(root, {*known, j}) - value(root, set(known)))
    return phi


def test_tree_attribution_equals_brute_force_and_adds_up(planted):
    train, test = sides(planted, "y")
    for fitted in (models.fit_forest(train, test, n=3, depth=3), models.fit_boosted(train, test, n=3, depth=3)):
        model = fitted.model
        explained = attribution.tree_shap_values(model, model.transform(test), ["PolicyID", "prediction"]).collect()
        for r in explained:
            assert r.base + sum(r.shap) == pytest.approx(r.prediction)
        some = test.select("PolicyID", vector_to_array("features").alias("x")).limit(4).collect()
        by_id = {r.PolicyID: r.shap for r in explained}
        weights = list(model.treeWeights) if "GBT" in type(model).__name__ else [1 / 3] * 3
        for r in some:
            want = sum(w * brute_force(t._call_java("rootNode"), r.x) for w, t in zip(weights, model.trees))
            assert by_id[r.PolicyID] == pytest.approx(want.tolist(), abs=1e-6)
        mean = {r.feature: r.mean_abs_shap for r in attribution.attribution(model, test).collect()}
        direct = np.abs(np.array([r.shap for r in explained])).mean(axis=0)
        assert [mean[f] for f in models.feature_names(test)] == pytest.approx(direct.tolist())


def test_trees_sent_in_several_values_give_the_same(planted, monkeypatch):
    train, test = sides(planted, "y")
    model = models.fit_forest(train, test, n=3, depth=6).model
    one = attribution.tree_attribution(model, test).collect()
    monkeypatch.setattr(attribution, "GROUP_BYTES", 1)
    assert len(attribution.trees_of(model)) == 3
    two = attribution.tree_attribution(model, test).collect()
    assert [r.feature for r in one] == [r.feature for r in two]
    assert [r.mean_abs_shap for r in one] == pytest.approx([r.mean_abs_shap for r in two])


def test_node_table_predicts_as_the_model(planted):
    for target, task in (("y", models.REGRESSION), ("flag", models.CLASSIFICATION)):
        train, test = sides(planted, target)
        for fitted in (models.fit_forest(train, test, task, n=4, depth=7), models.fit_boosted(train, test, task, n=3, depth=3)):
            found = models.predict_by_nodes(fitted.model, fitted.model.transform(test), ["PolicyID", "prediction"]).collect()
            assert len(found) == test.count()
            assert [r.recomputed for r in found] == pytest.approx([r.prediction for r in found])
            nodes = models.node_table(fitted.model)
            assert nodes.count() == fitted.model.totalNumNodes and nodes.where("left < 0 and feature >= 0").isEmpty()


def test_linear_attribution_adds_up(planted):
    train, test = sides(planted, "y")
    model = models.fit_linear(train, test).model
    x = np.array([r[0] for r in train.select(vector_to_array("features")).collect()])
    want = np.abs((x - x.mean(axis=0)) * model.coefficients.toArray()).mean(axis=0)
    found = {r.feature: r.mean_abs_shap for r in attribution.attribution(model, train).collect()}
    assert [found[f] for f in models.feature_names(train)] == pytest.approx(want.tolist())


def test_classifiers(planted):
    train, test = sides(planted, "flag")
    results = [
        models.fit_forest(train, test, models.CLASSIFICATION, n=10, depth=4),
        models.fit_boosted(train, test, models.CLASSIFICATION, n=3, depth=3),
    ]
    comparison = models.compare_models(results)
    rows = comparison.where("side = 'test'").collect()
    assert all(r.f1 > 0.9 and r.roc_auc > 0.9 for r in rows)
    best = models.best_model(results, comparison)
    assert best.name == max(rows, key=lambda r: r.f1).model
    assert {r.model for r in rows if r.best} == {best.name}


def test_classifier_attribution_adds_up(planted):
    train, test = sides(planted, "flag")
    model = models.fit_forest(train, test, models.CLASSIFICATION, n=4, depth=3).model
    pred = models.with_predictions(model, test)
    for r in attribution.tree_shap_values(model, pred, ["score"]).collect():
        assert r.base + sum(r.shap) == pytest.approx(r.score)


def test_pipelines(spark):
    df = synthetic_policies(spark, 1200)
    report = training.premium_pipeline(df, 2020, cats=["Province"], n=2, forest_depth=3, boosted_depth=2)
    assert report.status == "ok" and len(report.results) == 3
    assert report.comparison.count() == 6 and report.importance.count() <= 10
    names = models.feature_names(report.train)
    assert not {"CalculatedPremiumPerTerm", "TotalClaims", "HasClaim", "LossRatio"} & set(names)
    assert report.train.count() + report.test.count() == 1200
    few = training.severity_pipeline(df.limit(50), 2020)
    assert few.status == "insufficient" and few.n_rows < 100


def test_reports(spark, sf_small):
    df = policies(spark, sf_small)
    assert {"portfolio", "segment_Province", "monthly", "stats", "correlation"} <= set(eda.eda_report(df))
    assert eda.eda_report(df.select("Gender")).keys() == {"profile", "missing", "quality"}
    summary = hypothesis.test_summary(df.select("Gender", "TotalClaims"))
    assert [r.report for r in summary.collect()] == ["gender_risk"]
    advice = hypothesis.recommendations(summary).collect()
    assert len(advice) == 1 and advice[0].area == "Gender-Based Pricing"


def test_batch_entry_point(spark, tmp_path):
    from riskframe.__main__ import main

    source = str(tmp_path / "policies.csv")
    synthetic_policies(spark, 400, kind="tests").coalesce(1).write.option("header", True).csv(source)
    main(["eda", source, str(tmp_path / "eda")])
    assert spark.read.parquet(str(tmp_path / "eda" / "portfolio")).first().Rows == 400
    main(["hypotheses", source, str(tmp_path / "tests")])
    assert spark.read.parquet(str(tmp_path / "tests" / "summary")).count() == 4


def test_boosting_by_cells_gives_the_trees_of_all_rows(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100
    df = spark.range(3000).select(
        (F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 7 - 3).cast("double").alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("t"),
        ((F.col("id") % 11) * (F.col("id") % 7) + noise).alias("y"), (noise + F.col("id") % 7 > 8).cast("int").alias("flag"),
    )
    for target, task, estimator in (("y", models.REGRESSION, models.GBTRegressor), ("flag", models.CLASSIFICATION, models.GBTClassifier)):
        table, _ = models.assemble(df, ["t"], ["a", "b"], target)
        cells, cuts = models.cells_of(table, task, 32)
        assert cells.count() <= 2 * 11 * 7 * (1 if task == models.REGRESSION else 2) and cuts[2] == [-2.5, -1.5, -0.5, 0.5, 1.5, 2.5]
        assert cells.groupBy().sum("weight").first()[0] == 3000
        want = estimator(maxIter=4, maxDepth=3, stepSize=0.1, seed=42, maxBins=32).fit(table)
        found = models.fit_boosted(table, table, task, n=4, depth=3).model
        columns = ["tree", "node", "left", "right", "feature", "threshold", "categories", "rows"]
        one, two = [models.node_table(m).orderBy("tree", "node").collect() for m in (want, found)]
        assert [[r[c] for c in columns] for r in one] == [[r[c] for c in columns] for r in two]
        assert [r.prediction for r in one] == pytest.approx([r.prediction for r in two])


def test_cells_of_awkward_columns(spark):
    rows = [(1.0, float(i), -0.0 if i % 2 else 0.0, float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "same double, many double, zero double, y double")
    table, _ = models.assemble(df, [], ["same", "many", "zero"], "y")
    cells, cuts = models.cells_of(table, models.REGRESSION, 8)
    assert cuts[0] == [] and len(cuts[1]) == 7 and cells.count() <= 16 and cells.groupBy().sum("weight").first()[0] == 200
    assert models.cells_of(table.select(F.col("features").alias("features", metadata={}), "label"), models.REGRESSION, 8) is None
    assert models.cells_of(table, models.REGRESSION, 200) is None
    fitted = models.fit_boosted(table, table, n=2, depth=3, max_bins=8)
    found = models.predict_by_nodes(fitted.model, fitted.model.transform(table), ["prediction"]).collect()
    assert len(found) == 200 and [r.recomputed for r in found] == pytest.approx([r.prediction for r in found])


def test_forest_by_cells_draws_all_rows_for_each_tree(spark, monkeypatch):
    monkeypatch.setattr(models, "FOREST_ROWS", 0)
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100
    df = spark.range(4000).select(
        (F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 7 - 3).cast("double").alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("t"),
        ((F.col("id") % 11) * (F.col("id") % 7) + noise).alias("y"), (noise + F.col("id") % 7 > 8).cast("int").alias("flag"),
    )
    for target, task in (("y", models.REGRESSION), ("flag", models.CLASSIFICATION)):
        table, _ = models.assemble(df, ["t"], ["a", "b"], target)
        cells, _ = models.bootstrap_cells(table, task, 40, 42, 32)
        counts = np.array(cells.select(*[f"w{t}" for t in range(40)]).collect())
        assert len(counts) <= 2 * 11 * 7 * (1 if task == models.REGRESSION else 2)
        # Poisson: mean and variance are the number of rows.
        assert counts.sum(axis=0).mean() == pytest.approx(4000, rel=0.02)
        assert counts.var(axis=1, ddof=1).sum() == pytest.approx(4000, rel=0.15)
        model = models.fit_forest(table, table, task, n=5).model
        roots = [r.rows for r in models.node_table(model).where("node = 0").orderBy("tree").collect()]
        drawn = models.bootstrap_cells(table, task, 5, 42, 32)[0].collect()
        assert model.getNumTrees == 5 and roots == [sum(r[f"w{t}"] for r in drawn) for t in range(5)] and len(set(roots)) > 1
        if task == models.REGRESSION:
            # Deep trees end in cells: each predicts the mean label of the rows that it drew.
            first = model.trees[0]
            assert sorted(first.predict(r.features) for r in cells_as_rows(table, drawn)) == pytest.approx(
                sorted(r["s0"] / r["w0"] for r in drawn if r["w0"]), abs=1e-9)


def cells_as_rows(table, drawn):
    """One row of the table for each cell that the first tree drew; the columns have few values, so bin k is the k-th."""
    rows = {tuple(r.features.toArray()): r for r in table.collect()}
    known = [sorted({x[i] for x in rows}) for i in range(3)]
    wanted = {(r.features[0], known[1][int(r.features[1]) - 1], known[2][int(r.features[2]) - 1]) for r in drawn if r["w0"]}
    return [r for x, r in rows.items() if x in wanted]


def test_forest_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "FOREST_ROWS", 0)
    df = spark.range(50).select(F.lit(1.0).alias("a"), F.lit("x").alias("t"), F.lit(3.0).alias("y"))
    table, _ = models.assemble(df, [], ["a"], "y")
    assert models.bootstrap_cells(table, models.REGRESSION, 3, 42, 32) is None
    fitted = models.fit_forest(table, table, n=3)
    assert {r.prediction for r in fitted.model.transform(table).collect()} == {3.0}
    found = models.predict_by_nodes(fitted.model, fitted.model.transform(table), ["prediction"]).collect()
    assert len(found) == 50 and {r.recomputed for r in found} == {3.0}


def test_rows_that_no_node_tells_apart_walk_as_one(spark, monkeypatch):
    df = spark.range(2000).select(
        (F.col("id") % 50 / 7).alias("a"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("t"), F.col("id").alias("id"),
        (F.col("id") % 50 * 2 + F.col("id") % 3 + F.col("id") % 13).alias("y"))
    table, _ = models.assemble(df, ["t"], ["a"], "y", ["id"])
    model = models.fit_forest(table, table, n=3).model
    walked, inner = [], models._walked
    monkeypatch.setattr(models, "_walked", lambda m, n, rows, keys: walked.append(rows.count()) or inner(m, n, rows, keys))
    twice = model.transform(table.unionByName(table))
    found = models.predict_by_nodes(model, twice, ["id", "prediction"]).collect()
    assert len(found) == 4000 and [r.recomputed for r in found] == pytest.approx([r.prediction for r in found])
    assert len(walked) == 1 and walked[0] <= 100
    monkeypatch.setattr(models, "MAX_CELLS", 1)
    rows = models.predict_by_nodes(model, twice, ["id", "prediction"]).collect()
    assert walked[1] == 4000 and sorted(r.recomputed for r in rows) == pytest.approx(sorted(r.recomputed for r in found))
