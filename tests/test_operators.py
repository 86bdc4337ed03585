"""Hand-computed results, null rules and invariants."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import kernels, value_band, vehicle_age
from riskframe.operators import ab_tests, evaluation, features, group_tests, metrics, normality, ordering, profile, quality
from riskframe.operators.zip_regression import zip_regression
from riskframe.sources import policies


def column(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def money(spark, rows):
    return spark.createDataFrame(rows, "k string, PolicyID long, TotalPremium double, TotalClaims double")


# --- KPIs and null rules ----------------------------------------------------------------


def test_kpis_follow_the_null_rules(spark):
    df = money(spark, [("a", 1, 10.0, 5.0), ("a", None, None, 0.0), ("a", 3, 10.0, None), (None, 4, 1.0, 1.0),
                       ("zero", 5, 0.0, 2.0), ("none", 6, None, None)])
    rows = {r.k: r for r in metrics.segment_kpis(df, ["k"]).collect()}
    assert set(rows) == {"a", "zero", "none"}
    a = rows["a"]
    assert (a.TotalPremium, a.TotalClaims, a.PolicyCount, a.LossRatio) == (20.0, 5.0, 2, 0.25)
    assert (a.ClaimFrequency, a.ClaimSeverity) == (1 / 3, 5.0)
    assert rows["zero"].LossRatio is None
    assert (rows["none"].TotalPremium, rows["none"].ClaimSeverity) == (0.0, None)
    assert [r.k for r in metrics.segment_kpis(df, ["k"]).collect()][0] == "a"


def test_segments_add_up_to_the_portfolio(spark, sf_small):
    df = policies(spark, sf_small)
    whole = metrics.portfolio_kpis(df).first()
    parts = metrics.segment_kpis(df, ["Province"]).agg(F.sum("TotalPremium"), F.sum("TotalClaims")).first()
    assert parts[0] == pytest.approx(whole.TotalPremium) and parts[1] == pytest.approx(whole.TotalClaims)


def test_figures_of_the_view(spark, sf_small):
    k = metrics.portfolio_kpis(policies(spark, sf_small)).first()
    assert (k.Rows, round(k.TotalPremium, 2), round(k.TotalClaims, 2)) == (6000, 294709500.62, 51996905.99)


def test_trends_read_text_dates_and_drop_bad_ones(spark):
    df = spark.createDataFrame(
        [("2015-01-31", 1, 10.0, 1.0), ("2015-01-02", 2, 10.0, None), ("bad", 3, 1.0, 1.0), (None, 4, 1.0, 1.0)],
        "TransactionMonth string, PolicyID long, TotalPremium double, TotalClaims double")
    months = metrics.monthly_kpis(df).collect()
    assert [(str(r.Month), r.PolicyCount, r.TotalPremium) for r in months] == [("2015-01-01", 2, 20.0)]
    for how, want in (("sum", [0.0, 1.0]), ("mean", [None, 1.0]), ("median", [0, 1])):
        assert [r.value for r in metrics.temporal_trend(df, "TransactionMonth", "TotalClaims", how).collect()] == want


def test_empty_table(spark):
    k = metrics.portfolio_kpis(money(spark, [])).first()
    assert (k.Rows, k.TotalPremium, k.LossRatio, k.ClaimFrequency) == (0, 0.0, None, None)
    report = quality.quality_report(money(spark, [])).collect()
    assert [r.check_name for r in report] == ["empty"]


def test_duplicates_count_null_once(spark):
    df = money(spark, [("a", i, 1.0, 1.0) for i in (1, 1, None, None, 2)])
    found = {r.check_name: r for r in quality.quality_report(df).collect()}
    assert (found["duplicate_ids"].n, found["duplicate_ids"].passed) == (2, False)
    assert found["missing_required"].n == 0


def test_semi_join_without_broadcast_gives_the_same_rows(spark, monkeypatch, sf_small):
    df = policies(spark, sf_small).select("PostalCode")
    small = metrics.min_sample_filter(df, "PostalCode", 30).count()
    monkeypatch.setattr(metrics, "small_side", lambda d: d)
    assert metrics.min_sample_filter(df, "PostalCode", 30).count() == small > 0


def test_small_side_falls_back(spark):
    df = spark.range(10)
    assert ordering.small_side(df, 9) is df
    assert ordering.small_side(df, 10).count() == 10


# --- profile ----------------------------------------------------------------------------


def test_descriptive_stats(spark):
    r = profile.descriptive_stats(column(spark, [1.0, 2.0, 2.0, 3.0, 10.0, 15.0, None, float("nan")])).first()
    assert r.n == 6
    assert (r.q25, r.q50, r.q75, r.min, r.max) == (2.0, 2.5, 8.25, 1.0, 15.0)
    assert r.std == pytest.approx(5.6833088953)
    assert r.skewness == pytest.approx(1.2354900914) and r.kurtosis == pytest.approx(-0.0071887970)


def test_descriptive_stats_edges(spark):
    r = profile.descriptive_stats(column(spark, [1.0, 2.0])).first()
    assert (r.skewness, r.kurtosis) == (None, None)
    r = profile.descriptive_stats(column(spark, [None])).first()
    assert (r.n, r.mean, r.q50) == (0, None, None)
    assert profile.descriptive_stats(column(spark, [1.0]), ["absent"]).count() == 0


def test_iqr_bounds(spark):
    r = profile.iqr_bounds(column(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None]), "v").first()
    assert (r.outlier_count, r.lower_bound, r.upper_bound) == (1, -1.0, 7.0)
    assert r.outlier_percentage == pytest.approx(100 / 6)
    r = profile.iqr_bounds(column(spark, [0.0, 0.0, 0.0, 0.0, 9.0]), "v").first()
    assert (r.outlier_count, r.lower_bound, r.upper_bound) == (0, 0.0, 0.0)
    r = profile.iqr_bounds(column(spark, [None, None]), "v").first()
    assert (r.outlier_count, r.lower_bound, r.upper_bound) == (0, None, None)
    with pytest.raises(ValueError):
        profile.iqr_bounds(column(spark, [1.0]), "absent")
    with pytest.raises(ValueError):
        profile.iqr_bounds(spark.createDataFrame([("a",)], "v string"), "v")


def test_histogram_matches_numpy(spark):
    random.seed(1)
    values = [random.lognormvariate(3, 1) for _ in range(500)] + [0.1 * i for i in range(40)]
    counts, edges = np.histogram(values, bins=17)
    rows = sorted(profile.histogram(column(spark, values), "v", 17).collect())
    assert [r.n for r in rows] == counts.tolist()
    assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())
    one = profile.histogram(column(spark, [4.0, 4.0]), "v", 4).collect()
    assert sum(r.n for r in one) == 2 and min(r.low for r in one) == 3.5
    assert profile.histogram(column(spark, [None]), "v", 4).count() == 0


def test_correlation_is_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (4.0, 4.0, 5.0)],
                               "a double, b double, c double")
    r = {(x.x, x.y): x for x in profile.correlation_matrix(df).collect()}
    assert r["a", "b"].r == pytest.approx(0.7857142857) and r["a", "b"].n == 3
    assert r["b", "a"].r == r["a", "b"].r
    assert r["a", "c"].r is None and r["a", "a"].r == pytest.approx(1.0)


# --- quantiles and ranks ----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_match_numpy_with_a_hot_value(spark, seed):
    rng = random.Random(seed)
    values = [rng.gauss(0, 1) for _ in range(400)] + [0.25] * 300 + [0.0, -0.0, float("inf")]
    df = column(spark, values).repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found = ordering.exact_quantiles(df, ["v"], probs, buckets=20).first()
    finite = np.quantile(values, probs[:-1], method="linear")
    assert found.n == len(values)
    assert found.quantiles[:-1] == pytest.approx(finite.tolist())


def test_grouped_quantiles_with_and_without_broadcast(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"g{i % 9}", rng.choice([rng.random(), 0.5])) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, v double")

    def check():
        for r in ordering.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], ["k"], buckets=16).collect():
            mine = [v for k, v in rows if k == r.k]
            assert r.n == len(mine)
            assert r.quantiles == pytest.approx(np.quantile(mine, [0.25, 0.5, 0.75]).tolist())

    check()
    monkeypatch.setattr(ordering, "small_side", lambda d: d)
    check()


def test_ranks(spark):
    values = [3.0, 1.0, 2.0, 2.0, 2.0, 5.0, -0.0, 0.0, None]
    ranks = {r.value: (r.copies, r["rank"]) for r in ordering.average_rank(column(spark, values), "v").collect()}
    assert ranks == {0.0: (2, 1.5), 1.0: (1, 3.0), 2.0: (3, 5.0), 3.0: (1, 7.0), 5.0: (1, 8.0)}


def test_rank_sums_are_complete_whatever_the_partitioning(spark, sf_small):
    df = policies(spark, sf_small).select("Province", "TotalPremium")
    n = df.where("TotalPremium is not null").count()
    for parts, buckets in ((1, 2), (13, 50)):
        sums = ordering.rank_sums(df.repartition(parts), "TotalPremium", "Province", buckets)
        assert sums.agg(F.sum("rank_sum")).first()[0] == n * (n + 1) / 2


# --- kernels ----------------------------------------------------------------------------


def test_tails_against_tables():
    assert kernels.chi2_sf(7.815, 3) == pytest.approx(0.05, abs=1e-4)
    assert kernels.chi2_sf(3.841, 1) == pytest.approx(0.0500137, abs=1e-7)
    assert kernels.t_two_sided(2.086, 20) == pytest.approx(0.05, abs=1e-4)
    assert kernels.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-7)
    assert kernels.chi2_sf(2.8332113, 4) == pytest.approx(math.exp(-1.41660565) * 2.41660565)
    assert 0 < kernels.chi2_sf(1400.0, 2) == pytest.approx(math.exp(-700.0))
    assert kernels.chi2_sf(0.0, 4) == 1.0 and kernels.t_two_sided(0.0, 7) == 1.0


def test_tails_against_the_math_library_on_the_classpath(spark):
    dist = spark._jvm.org.apache.commons.math3.distribution
    for x, k in ((0.3, 1), (4.2, 5), (33.0, 19), (900.0, 850)):
        assert kernels.chi2_sf(x, k) == pytest.approx(1 - dist.ChiSquaredDistribution(float(k)).cumulativeProbability(x), abs=1e-9)
    for t, k in ((0.4, 2.5), (-2.2, 11.0), (3.1, 40000.0)):
        assert kernels.t_two_sided(t, k) == pytest.approx(2 * dist.TDistribution(k).cumulativeProbability(-abs(t)), abs=1e-9)


def plain_w(values):
    """W of a list, from the weights in order."""
    x, n = sorted(values), len(values)
    m = [statistics.NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    square, u = sum(v * v for v in m), n**-0.5
    poly = lambda c: sum(a * u**i for i, a in enumerate(c))
    if n == 3:
        weights = [-(0.5**0.5), 0.0, 0.5**0.5]
    else:
        edge = [poly(c) + v / square**0.5 for c, v in ((kernels.WEIGHT_LAST, m[-1]), (kernels.WEIGHT_NEXT, m[-2]))]
        k = 2 if n > 5 else 1
        phi = (square - 2 * sum(v * v for v in m[-k:])) / (1 - 2 * sum(e * e for e in edge[:k]))
        weights = [*(-e for e in edge[:k]), *(v / phi**0.5 for v in m[k : n - k]), *edge[:k][::-1]]
    mean = sum(x) / n
    return sum(a * v for a, v in zip(weights, x)) ** 2 / sum((v - mean) ** 2 for v in x)


def normality_of(spark, groups, **how):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    return {r.grp: r for r in normality.shapiro_wilk(spark.createDataFrame(rows, "g string, v double"), "v", "g", **how).collect()}


def test_large_buckets_are_cut_again(spark):
    n, bound = 2_000_000, 5_000
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7.0).alias("v"))
    df = df.unionByName(spark.range(50_000).select(F.lit(3.5).alias("v")))
    cells = ordering.bucketed(df, ["v"], buckets=64, bucket_rows=bound).groupBy("bucket").agg(
        F.count_distinct("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("bucket").collect()
    assert max(c.n for c in cells) <= 2 * bound and len(cells) > 300
    assert all(a.high < b.low for a, b in zip(cells, cells[1:]))
    ranks = ordering.value_ranks(df.limit(20_000), "v", buckets=4, bucket_rows=500)
    plain = df.limit(20_000).groupBy("v").agg(F.count("*").alias("c")).orderBy("v").collect()
    at, expected = 0, {}
    for r in plain:
        expected[r.v] = at + (r.c + 1) / 2
        at += r.c
    assert {r.value: r["rank"] for r in ranks.collect()} == expected


def test_stratified_cut_is_refined(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 3).alias("label"))
    plain = features.stratified_split(df, "label", ["id"])
    fine = features.stratified_split(df, "label", ["id"], ordered_rows=1)
    assert plain.exceptAll(fine).isEmpty()
    assert {r.label: r.n for r in fine.where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()} == {0: 2000, 1: 2000, 2: 2000}


def test_shapiro_published_example_and_plain_sums(spark):
    normal = [random.Random(i).gauss(0, 1) for i in range(300)]
    groups = {
        "published": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], "three": [1, 2, 3], "four": [1, 2, 4, 9], "five": [1, 2, 4, 9, 9],
        "six": [1, 1, 4, 9, 10, 12], "normal": normal, "squares": [v * v for v in normal], "few": [1, 2], "equal": [7] * 40,
        "ties": [0] * 9000 + [1] * 2 + [5] * 5000, "many": [random.Random(i).gauss(0, 1) for i in range(9000)],
    }
    for found in (normality_of(spark, groups), normality_of(spark, groups, buckets=5)):
        assert (found["published"].w, found["published"].p_value) == (pytest.approx(0.78881, abs=1e-5), pytest.approx(0.006704, abs=1e-6))
        assert found["three"].p_value == pytest.approx(1.0) and found["normal"].p_value > 0.01 > 1e-6 > found["squares"].p_value
        assert (found["few"].status, found["few"].w, found["equal"].p_value) == ("insufficient", None, 1.0)
        assert found["many"].p_value > 0.001 and found["ties"].p_value < 1e-9
        for g, values in groups.items():
            assert found[g].n == len(values)
            if g not in ("few", "equal"):
                assert found[g].w == pytest.approx(plain_w(values), rel=1e-9), g


def test_normal_scores(spark):
    ps = [1e-300, 1e-20, 1e-9, 0.01, 0.075, 0.3, 0.5, 0.7, 0.93, 0.999999]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(normality.normal_score(F.col("p"))).collect()
    assert [r[0] for r in got] == pytest.approx([statistics.NormalDist().inv_cdf(p) for p in ps], rel=1e-12)


def test_exact_u_tail_by_enumeration():
    from itertools import combinations

    for m, n in ((2, 3), (4, 4), (3, 6)):
        us = [sum(c) - m * (m + 1) // 2 for c in combinations(range(1, m + n + 1), m)]
        for u in range(m * n + 1):
            assert kernels.rank_count_tail(m, n, u) == pytest.approx(sum(x >= u for x in us) / len(us))


def test_exact_u_tail_of_a_very_large_sample():
    # one value against n: U is uniform on 0..n
    assert kernels.rank_count_tail(1, 10**9, 10**9 - 4) == pytest.approx(5 / (10**9 + 1))
    # close to the normal limit
    n, m = 10**7, 8
    u = int(m * n / 2 + 1.5 * math.sqrt(m * n * (m + n + 1) / 12))
    assert kernels.rank_count_tail(m, n, u) == pytest.approx(kernels.normal_upper(1.5), rel=0.05)


# --- tests ------------------------------------------------------------------------------


def two_groups(spark, a, b):
    rows = [("A", v) for v in a] + [("B", v) for v in b]
    return spark.createDataFrame(rows, "g string, v double")


def test_exact_and_tied_u(spark):
    r = ab_tests.mann_whitney(two_groups(spark, [1.0, 2.0, 3.0], [4.0, 5.0, 6.0, 7.0]), "v", "g", "A", "B").first()
    assert (r.statistic, r.exact) == (0.0, True) and r.p_value == pytest.approx(2 / 35)
    r = ab_tests.mann_whitney(two_groups(spark, [1.0, 2.0, 2.0], [2.0, 5.0, 6.0, 7.0]), "v", "g", "A", "B").first()
    assert not r.exact and 0 < r.p_value < 1
    r = ab_tests.mann_whitney(two_groups(spark, [1.0], []), "v", "g", "A", "B").first()
    assert (r.status, r.reject_null) == ("insufficient", False)


def test_welch_by_hand(spark):
    r = ab_tests.welch_t(two_groups(spark, [1.0, 2.0, 3.0, None], [2.0, 4.0, 9.0]), "v", "g", "A", "B").first()
    qa, qb = 1 / 3, 13 / 3
    assert r.statistic == pytest.approx((2 - 5) / math.sqrt(qa + qb))
    assert r.dof == pytest.approx((qa + qb) ** 2 / (qa**2 / 2 + qb**2 / 2))
    assert r.n_dropped == 1
    assert ab_tests.welch_t(two_groups(spark, [1.0], [2.0, 3.0]), "v", "g", "A", "B").first().status == "insufficient"


def claims(spark, rows):
    return spark.createDataFrame(rows, "g string, TotalPremium double, TotalClaims double")


def test_chi2_by_hand(spark):
    rows = [("A", 1.0, 1.0)] * 10 + [("A", 1.0, 0.0)] * 20 + [("B", 1.0, 1.0)] * 20 + [("B", 1.0, 0.0)] * 15
    r = ab_tests.chi2_frequency_ab(claims(spark, rows + [("B", 1.0, None)]), "g", "A", "B").first()
    n, det = 65, abs(10 * 15 - 20 * 20)
    assert r.statistic == pytest.approx(n * (det - n / 2) ** 2 / (30 * 35 * 30 * 35))
    assert (r.n_dropped, r.group_b_frequency) == (1, 20 / 36)
    both = group_tests.chi2_frequency_k(claims(spark, rows), "g").first()
    assert both.statistic == pytest.approx(r.statistic) and both.dof == 1


def test_insufficient_instead_of_errors(spark):
    one = claims(spark, [("A", 1.0, 1.0), ("A", 1.0, 0.0)])
    none = claims(spark, [("A", 1.0, 0.0), ("B", 1.0, 0.0), (None, 1.0, 1.0)])
    for df in (one, none):
        assert group_tests.chi2_frequency_k(df, "g").first().status == "insufficient"
        assert group_tests.kruskal_k(metrics.with_claims(df), "TotalClaims", "g").first().status == "insufficient"
        assert ab_tests.severity_ab(df, "g", "A", "B").first().status == "insufficient"
        assert ab_tests.chi2_frequency_ab(df, "g", "A", "B").first().status == "insufficient"
    same = two_groups(spark, [1.0, 1.0], [1.0])
    assert group_tests.kruskal_k(same, "v", "g").first().status == "insufficient"
    assert group_tests.province_risk(one.withColumnRenamed("g", "x")).first().status == "insufficient"
    assert group_tests.gender_risk(one.withColumnRenamed("g", "Gender")).first().status == "insufficient"
    assert group_tests.postal_risk(one.withColumnRenamed("g", "PostalCode")).first().status == "insufficient"


def test_kruskal_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 4.0), ("c", 5.0), ("c", 6.0), ("c", None)], "g string, v double")
    r = group_tests.kruskal_k(df, "v", "g").first()
    assert r.statistic == pytest.approx(12 / 42 * (9 / 2 + 49 / 2 + 121 / 2) - 21)
    assert (r.dof, r.n_dropped) == (2.0, 1)


def test_severity_branches(spark):
    rng = random.Random(0)
    normal = [("A", 1.0, 1000 + rng.gauss(0, 10)) for _ in range(200)] + [("B", 1.0, 1000 + rng.gauss(0, 10)) for _ in range(200)]
    r = ab_tests.severity_ab(claims(spark, normal), "g", "A", "B").first()
    assert r.use_parametric and r.test_name.startswith("Welch")
    skewed = [(g, p, math.exp((v - 1000) / 5)) for g, p, v in normal]
    r = ab_tests.severity_ab(claims(spark, skewed), "g", "A", "B").first()
    assert not r.use_parametric and r.test_name.startswith("Mann-Whitney")
    large = [("A", 1.0, math.exp(rng.gauss(0, 1))) for _ in range(5001)] + skewed[200:]
    assert not ab_tests.severity_ab(claims(spark, large), "g", "A", "B").first().use_parametric
    assert ab_tests.severity_ab(claims(spark, large), "g", "A", "B", method="welch").first().test_name.startswith("Welch")
    assert not ab_tests.severity_ab(claims(spark, normal), "g", "A", "B", method="mann_whitney").first().use_parametric
    with pytest.raises(ValueError):
        ab_tests.severity_ab(claims(spark, normal), "g", "A", "B", method="other")


def test_pair_of_genders(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("Male",)] * 2 + [("y",)] * 3 + [(None,)] * 9, "Gender string")
    assert group_tests.compared_values(df, "Gender", "Female", "Male") == ("x", "y")
    both = df.union(spark.createDataFrame([("Female",)], "Gender string"))
    assert group_tests.compared_values(both, "Gender", "Female", "Male") == ("Female", "Male")


# --- features ---------------------------------------------------------------------------


def test_value_band_edges(spark):
    df = column(spark, [0.0, 1.0, 50000.0, 50001.0, 1e9, None, -1.0])
    assert [r[0] for r in df.select(value_band("v")).collect()] == [None, "Low", "Low", "Medium", "VeryHigh", None, None]


def test_vehicle_age_is_clipped_and_keeps_null(spark):
    df = column(spark, [1900.0, 2010.0, 2030.0, None])
    assert [r[0] for r in df.select(vehicle_age(2015, "v")).collect()] == [50.0, 5.0, 0.0, None]


def test_quantile_band_with_repeated_edges(spark):
    df = column(spark, [0.0, 0.0, 0.0, 0.0, 1.0, 2.0, None])
    bands = [(r.v, r.BandOrdinal, r.Band) for r in features.quantile_band(df, "v", "Band").collect()]
    assert set(bands) == {(0.0, 1, "Low"), (1.0, 2, "Medium"), (2.0, 2, "Medium"), (None, None, None)}
    flat = features.quantile_band(column(spark, [3.0, 3.0]), "v", "Band").collect()
    assert {r.Band for r in flat} == {"Low"}


def test_engineer_features_uses_what_exists(spark):
    df = spark.createDataFrame([(2000.0,)], "RegistrationYear double")
    assert features.engineer_features(df, 2015).columns == ["RegistrationYear", "VehicleAge"]


def test_no_leakage(spark, sf_small):
    df = features.engineer_features(policies(spark, sf_small), 2015)
    for target, hidden in (
        ("TotalClaims", {"TotalClaims", "HasClaim", "LossRatio"}),
        ("HasClaim", {"TotalClaims", "HasClaim", "LossRatio"}),
        ("TotalPremium", {"TotalPremium", "LossRatio", "PremiumToSumInsuredRatio", "PremiumCategory", "PremiumOrdinal"}),
    ):
        table, cats, nums = features.feature_frame(df, target)
        assert not hidden & {*cats, *nums}
        assert table.columns[-1] == target and "TransactionMonth" not in table.columns


def test_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "t string")
    fitted = features.categories(df, ["t"])
    assert fitted == {"t": ["a", "b", "c", None]}
    out = features.one_hot(df, ["t"], fitted)
    assert out.columns == ["t_b", "t_c", "t_nan"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0)]
    unseen = features.one_hot(spark.createDataFrame([("z",)], "t string"), ["t"], fitted)
    assert tuple(unseen.first()) == (0, 0, 0)
    with pytest.raises(ValueError):
        features.categories(spark.range(50).select(F.col("id").cast("string").alias("t")), ["t"], limit=10)


def test_label_codes_over_many_buckets(spark):
    words = sorted({f"w{i * 7919 % 9973}" for i in range(5000)})
    df = spark.createDataFrame([(w,) for w in words] * 2, "t string")
    out = features.label_codes(df, ["t"]).collect()
    assert {r.value: r.code for r in out} == {w: i for i, w in enumerate(words)}


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (9.0, None), (None, "b"), (None, "a")], "n double, t string")
    assert features.fit_imputer(df) == {"n": 2.0, "t": "a"}
    assert features.fit_imputer(df, "mean", "constant") == {"n": 4.0, "t": "missing_value"}
    assert features.fit_imputer(df, "most_frequent") == {"n": 1.0, "t": "a"}
    assert features.impute(df).where("n is null or t is null").count() == 0


def test_splits(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    split = features.hash_split(df, ["id"])
    assert abs(split.where("is_test").count() - 1000) < 120
    assert split.exceptAll(features.hash_split(df.repartition(7), ["id"])).count() == 0
    exact = features.stratified_split(df, "y", ["id"]).groupBy("y").agg(F.count_if("is_test").alias("n")).collect()
    assert {r.y: r.n for r in exact} == {0: 900, 1: 100}


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    one = metrics.sample_n(df, 20, ["id"]).collect()
    assert one == metrics.sample_n(df.repartition(9), 20, ["id"]).collect() and len(one) == 20
    assert one != metrics.sample_n(df, 20, ["id"], seed=7).collect()


# --- model metrics ----------------------------------------------------------------------


def test_classification_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    r = evaluation.classification_metrics(df).first()
    assert (r.accuracy, r.precision, r.recall) == (0.5, 0.25, 0.5)
    assert r.f1 == pytest.approx(1 / 3)


def test_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, score double")
    assert evaluation.roc_auc(df).first().roc_auc == 0.75
    assert evaluation.roc_auc(df.where("label = 1")).first().roc_auc is None


def test_zip_regression_matches_least_squares(spark):
    rng = random.Random(2)
    rows = []
    for z in "pq":
        for i in range(80):
            a, b, c = rng.uniform(0, 9), rng.uniform(0, 99), rng.uniform(0, 5)
            rows.append((z, a, b, c, 3 + 2 * a - b + 0.5 * c + rng.gauss(0, 1)))
    rows.append(("p", None, 1.0, 1.0, 1.0))
    df = spark.createDataFrame(
        rows, "PostalCode string, TotalPremium double, SumInsured double, CustomValueEstimate double, TotalClaims double")
    for r in zip_regression(df).collect():
        data = np.array([x[1:] for x in rows if x[0] == r.PostalCode and None not in x])
        design = np.column_stack([np.ones(len(data)), data[:, :3]])
        beta, *_ = np.linalg.lstsq(design, data[:, 3], rcond=None)
        error = data[:, 3] - design @ beta
        assert [r.Intercept, *r.Coefficients] == pytest.approx(beta.tolist())
        assert r.RMSE == pytest.approx(math.sqrt((error**2).mean()))
        assert r.n_used == len(data)
    assert [r.PostalCode for r in zip_regression(df, nulls="skip_group").collect()] == ["q"]
