import numpy as np
import pytest
from pyspark.sql import functions as F

from creditframe.operators import validation


def frame(spark, ys, ss):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(ys, ss)], "y int, s double")


def brute(ys, ss):
    ys, ss = np.asarray(ys), np.asarray(ss)
    pos, neg = ss[ys == 1], ss[ys == 0]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    cuts = np.unique(ss)[::-1]
    tpr = np.array([(pos >= c).mean() for c in cuts])
    fpr = np.array([(neg >= c).mean() for c in cuts])
    precision = np.array([ys[ss >= c].mean() for c in cuts])
    pr = np.sum(np.diff(np.concatenate([[0], tpr])) * precision)
    return auc, np.max(tpr - fpr), pr, np.mean((ss - ys) ** 2)


@pytest.mark.parametrize("case", ["continuous", "ties", "one_hot_score", "two_scores"])
def test_metrics_equal_brute_force(spark, case):
    rng = np.random.default_rng(3)
    n = 3000
    s = rng.beta(1, 30, n)
    if case == "ties":
        s = np.round(s, 2)
    if case == "one_hot_score":
        s[: n // 3] = 0.0123
    if case == "two_scores":
        s = np.where(s > 0.03, 0.9, 0.1)
    y = (rng.random(n) < 0.1 + s).astype(int)
    got = validation.rank_metrics(frame(spark, y, s), "y", "s").first()
    auc, ks, pr, brier = brute(y, s)
    assert np.allclose([got.roc_auc, got.ks, got.pr_auc, got.brier], [auc, ks, pr, brier], atol=1e-12)
    assert got.n == n and np.isclose(got.gini, 2 * auc - 1)


def test_groups_are_ranked_apart(spark):
    rng = np.random.default_rng(4)
    y, s = rng.integers(0, 2, 400), rng.random(400)
    df = frame(spark, y, s).withColumn("g", (F.col("s") * 1000).cast("int") % 2)
    for row in validation.rank_metrics(df, "y", "s", by="g").collect():
        part = [(r.y, r.s) for r in df.where(F.col("g") == row.g).collect()]
        assert np.isclose(row.roc_auc, brute(*zip(*part))[0])


def test_one_class_has_no_auc(spark):
    row = validation.rank_metrics(frame(spark, [0, 0, 0], [0.1, 0.2, 0.2]), "y", "s").first()
    assert row.n == 3 and row.roc_auc is None and row.base_rate == 0.0


def test_unknown_scores_are_left_out(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.5)], "y int, s double")
    assert validation.rank_metrics(df, "y", "s").first().n == 2


def test_reliability_equals_numpy_quantiles(spark):
    rng = np.random.default_rng(6)
    s = np.round(rng.beta(2, 20, 2000), 3)
    y = (rng.random(2000) < s).astype(int)
    edges = np.percentile(s, np.linspace(0, 100, 11))[1:-1]
    bins = np.searchsorted(edges, s)
    got = {r.bin: r for r in validation.reliability(frame(spark, y, s), "y", "s").collect()}
    assert set(got) == set(bins)
    for b, row in got.items():
        inside = bins == b
        assert row.n == inside.sum() and np.isclose(row.mean_predicted, s[inside].mean()) and np.isclose(row.observed_rate, y[inside].mean())


def test_deciles_share_mean_ranks(spark):
    s = [0.9, 0.8, 0.8, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]
    got = {r.decile: r.loans for r in validation.deciles(frame(spark, [0] * 10, s), "y", "s").collect()}
    ranks = [1, 3, 3, 3, 5, 6, 7, 8, 9, 10]
    expected = {}
    for rank in ranks:
        expected[rank * 10 // 11] = expected.get(rank * 10 // 11, 0) + 1
    assert got == expected


def test_threshold_equals_trying_every_score(spark):
    rng = np.random.default_rng(8)
    s = np.round(rng.random(600), 2)
    y = (rng.random(600) < s).astype(int)
    e = rng.uniform(1, 5, 600)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, s, e)], "y int, s double, e double")
    got = validation.choose_threshold(df, "y", "s", F.col("y") * F.col("e"), F.col("e"), 0.2).first()
    best = None
    for cut in np.unique(s):
        low = s < cut
        if low.any() and (y * e)[low].sum() / e[low].sum() <= 0.2:
            youden = (s[y == 1] >= cut).mean() - (s[y == 0] >= cut).mean()
            best = max(best or (-9, 0), (youden, cut))
    assert np.isclose(got.youden, best[0]) and got.threshold == best[1] and got.accepted == (s < best[1]).sum()


def test_drift_is_zero_against_itself_and_grows(spark):
    rng = np.random.default_rng(9)
    rows = [("a", float(x)) for x in rng.normal(0, 1, 2000)] + [("b", float(x)) for x in rng.normal(1, 1, 2000)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.psi for r in validation.drift(df, "x", "g", "a").collect()}
    assert got["a"] == 0 and got["b"] > 0.25


def test_subgroups(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.9), ("m", 0, 0.1), ("f", 1, 0.1)], "g string, y int, s double")
    got = {r.g: r for r in validation.subgroup_outcomes(df, "y", "s", "g", 0.5).collect()}
    assert got["m"].true_positive_rate == 1 and got["m"].false_positive_rate == 0.5
    assert got["f"].true_positive_rate == 0 and got["f"].false_positive_rate is None


def test_null_groups_are_groups(spark):
    rows = [(["a", "b", None][k % 3], k % 2, (k * 37 % 100) / 100) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.g: r.n for r in validation.rank_metrics(df, "y", "s", by="g").collect()}
    assert got == {"a": 100, "b": 100, None: 100}
