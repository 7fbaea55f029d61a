import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import queries
from creditframe.functions.hazards import PUBLISHED_DEFAULT
from creditframe.operators import boosting, pd_models, scorecard, validation
from creditframe.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loans(spark):
    return queries.features_view(spark, SF).persist()


def test_bucket_count_does_not_change_ranks(spark):
    rng = np.random.default_rng(3)
    rows = [(float(s), int(y)) for s, y in zip(rng.integers(0, 300, 2000) / 300, rng.integers(0, 2, 2000))]
    df = spark.createDataFrame(rows, "score double, y int")
    tables = [sorted(map(tuple, validation.rank_table(df, "y", "score", side=side).collect())) for side in (2, 32)]
    assert tables[0] == tables[1]


def test_hazard_fit_equals_newton(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2)) * [3.0, 0.5] + [10.0, -1.0]
    y = (rng.random(4000) < 1 / (1 + np.exp(-(-2 + 0.3 * (x[:, 0] - 10) - 1.0 * (x[:, 1] + 1))))).astype(float)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(x, y)], "a double, b double, t int")
    hazard = pd_models.fit_hazard(df, "t", ["a", "b"])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    design, w = np.c_[np.ones(len(z)), z], np.zeros(3)
    ridge = np.diag([0.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, design.T @ (p - y) + ridge @ w)
    assert np.allclose([hazard.intercept, hazard.coef["a"], hazard.coef["b"]], w, atol=1e-8)
    direct = df.select(hazard.score().alias("p")).agg(F.avg("p")).first()[0]
    assert np.isclose(direct, y.mean(), atol=1e-3)


def test_parameter_table(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 3), i % 2) for i in range(300)], "a double, b double, t int")
    hazard = pd_models.fit_hazard(df, "t", ["a", "b"])
    rows = {r.term: r for r in pd_models.parameter_table(spark, hazard).collect()}
    assert rows["(intercept)"].coefficient == hazard.intercept and rows["a"].mean == hazard.mean["a"]
    assert rows["b"].scale == hazard.scale["b"] and np.isclose(rows["a"].hazard_at_mean, 1 / (1 + np.exp(-hazard.intercept)))


def test_unknown_inputs_are_imputed_for_the_fit(spark):
    df = spark.createDataFrame([(float(i % 7) if i % 5 else None, i % 2) for i in range(200)], "a double, t int")
    assert np.isfinite(pd_models.fit_hazard(df, "t", ["a"]).coef["a"])


def counted_panel(spark, rows=200):
    """A panel and how often its rows have been computed."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def reading(x):
        seen.add(1)
        return float(x % 7)

    ids = spark.range(rows, numPartitions=2)
    return ids.select(reading("id").alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 2).alias("t"), (F.col("id") % 5 < 1).cast("int").alias("u")), seen


def test_a_fit_computes_its_panel_once(spark):
    panel, seen = counted_panel(spark)
    pd_models.fit_hazard(panel, "t", ["a", "b"])
    assert seen.value == 200


def test_platt_computes_its_scores_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def scores(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame.assign(score=frame["id"] % 7 / 7.0, y=(frame["id"] % 2).astype("int32"))[["score", "y"]]

    scored = spark.range(200, numPartitions=2).mapInPandas(scores, "score double, y int")
    pd_models.fit_platt(scored, "y", "score")
    assert seen.value == 200


def test_signs_are_reported(spark):
    rows = {r.feature: r.sign_ok for r in pd_models.coefficient_table(spark, PUBLISHED_DEFAULT).collect()}
    assert rows["unemployment_rate"] and rows["fico"] and rows["current_ltv"] and rows["odti"] and rows["orig_rate"] is None


def test_logit_ranks_and_ignores_unknown_categories(spark, loans):
    model = pd_models.fit_logit(loans.where("split = 'train'"))
    scored = model.score(loans.where("split = 'test'"))
    assert validation.rank_metrics(scored, "default_flag", "pd").first().roc_auc > 0.55
    odd = loans.limit(1).withColumn("state", F.lit("nowhere")).withColumn("channel", F.lit(None).cast("string"))
    assert 0 < model.score(odd).first().pd < 1


def test_rare_categories_are_pooled_and_unknown_ones_are_not(spark, loans):
    known = pd_models.categories(loans.fillna("missing", subset=["channel"]), ["channel", "state"])
    counts = {r.state: r["count"] for r in loans.groupBy("state").count().collect()}
    assert known["state"] == (sorted(s for s, n in counts.items() if n >= 50), sorted(s for s, n in counts.items() if n < 50))
    assert "missing" in known["channel"][0]
    model = pd_models.PdModel(None, {"state": (["A"], ["B"])})
    df = loans.limit(1).withColumn("state", F.explode(F.array(F.lit("A"), F.lit("B"), F.lit("C"))))
    assert [r.state for r in model.prepare(df).collect()] == ["A", "(rare)", "(unseen)"]


def test_all_categories_are_kept(spark):
    df = spark.range(20_050).selectExpr("string(IF(id < 20000, id, 7)) AS c")
    frequent, rare = pd_models.categories(df, ["c"])["c"]
    assert frequent == ["7"] and len(rare) == 19_999


def test_boosted_and_calibrated_scores(spark, loans):
    train, test = loans.where("split = 'train'"), loans.where("split = 'test'")
    calibrated = pd_models.calibrate(train, trees=3)
    scored = calibrated.score(test)
    assert scored.count() == test.count()
    row = validation.rank_metrics(scored, "default_flag", "pd").first()
    mean = scored.agg(F.avg("pd")).first()[0]
    assert 0.4 < row.roc_auc < 1 and abs(mean - row.base_rate) < 0.1


def test_boosted_fit_computes_its_rows_once(spark, loans):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def reading(state):
        seen.add(1)
        return state

    # Computed once, so the reading is done where the rows are stored and not moved or merged.
    train = loans.repartition(3).withColumn("state", reading("state"))
    pd_models.fit_boosted(train, trees=1)
    assert seen.value == train.where("default_flag IS NOT NULL").count()


def test_more_trees_start_no_more_jobs(spark, loans):
    counts = []
    for trees in (1, 4):
        spark.sparkContext.setJobGroup(f"trees-{trees}", "")
        assert len(pd_models.fit_boosted(loans, trees=trees).trees.value) == trees
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees-{trees}")))
    spark.sparkContext.setJobGroup("", "")
    assert counts[0] == counts[1]


@pytest.mark.parametrize("copies", [1, 14])
def test_boosted_trees_are_those_of_spark(spark, loans, monkeypatch, copies):
    """``copies`` of the rows: with 14, splits come from a sample and tasks hold several partitions."""
    train = loans.where("split = 'train'").crossJoin(spark.range(copies)).repartition(1 if copies == 1 else 7, "fico").sortWithinPartitions("loan_sequence_number", "id")
    test = loans.where("split = 'test'")
    own = pd_models.fit_boosted(train, trees=5).score(test).orderBy("loan_sequence_number").toPandas()["pd"]
    monkeypatch.setattr(boosting, "possible", lambda spark: False)
    model = pd_models.fit_boosted(train, trees=5)
    assert model.trees is None
    assert np.allclose(own, model.score(test).orderBy("loan_sequence_number").toPandas()["pd"], rtol=0, atol=1e-12)


def test_draws_are_those_of_spark(spark):
    jumps = boosting._jumps(2 * 5000)
    for seed in (43, 0, -7):
        theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        found = boosting.uniforms(seed, 5000, jumps)
        assert len(found) == 5000 and [theirs.nextDouble() for _ in range(300)] == found[:300].tolist()
    assert len(boosting.uniforms(1, 0, boosting._jumps(2))) == 0


def test_unsplit_trees_give_the_mean(spark, loans):
    flat = loans.withColumns({c: F.lit(1) for c in pd_models.NUMERIC} | {c: F.lit("a") for c in pd_models.CATEGORICAL})
    model = pd_models.fit_boosted(flat, trees=2)
    assert model.score(flat).select("pd").distinct().count() == 1


def test_rows_of_a_boosted_fit_fill_their_tasks(spark, monkeypatch):
    ensure_checkpoint_dir(spark)
    monkeypatch.setattr(pd_models, "ROWS_PER_TASK", 30)
    few = 2 * spark.sparkContext.defaultParallelism
    stored = pd_models._stored_for_trees(spark.range(0, 1000, 1, 50), 1000)
    assert stored.rdd.getNumPartitions() == 34 and stored.distinct().count() == 1000
    assert pd_models._stored_for_trees(spark.range(0, 100, 1, 50), 100).rdd.getNumPartitions() == few
    assert pd_models._stored_for_trees(spark.range(0, 100, 1, 2), 100).rdd.getNumPartitions() == 2
    assert pd_models._stored_for_trees(spark.range(0), 0).count() == 0


def test_segments_and_components(spark, loans):
    table = pd_models.profiles(pd_models.segments(loans, starts=2)).orderBy("risk_rank").collect()
    assert [r.risk_rank for r in table] == [1, 2, 3, 4, 5] and sum(r.loans for r in table) == loans.count()
    rates = [r.default_rate_pct for r in table]
    assert rates == sorted(rates, reverse=True)
    rows, explained = pd_models.pca(loans)
    assert explained == sorted(explained, reverse=True) and 0 < sum(explained) <= 1
    assert abs(rows.agg(F.avg("pc1")).first()[0]) < 1e-9


def test_segments_are_a_fixed_point(spark, loans):
    clustered = pd_models.segments(loans, k=4, starts=3, steps=500, tol=0.0).toPandas()  # run to convergence
    assert len(clustered) == loans.count() and clustered["cluster"].between(0, 3).all()
    x = loans.select(*pd_models.SEGMENT_FEATURES).toPandas().astype(float)
    x = x.fillna(x.median()).to_numpy()
    z = (x - x.mean(0)) / np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), 1.0)
    labels = clustered["cluster"].to_numpy()
    means = np.array([z[labels == c].mean(0) if (labels == c).any() else np.full(z.shape[1], np.inf) for c in range(4)])
    distances = ((z[:, None, :] - means[None, :, :]) ** 2).sum(2)
    own = distances[np.arange(len(z)), labels]
    assert (own <= distances.min(1) + 1e-3).all()  # each row is nearest to its own cluster's mean


def test_components_equal_numpy(spark, loans):
    rows, explained = pd_models.pca(loans, k=7)
    found = rows.select(*[f"pc{i}" for i in range(1, 8)]).toPandas().to_numpy()
    x = loans.select(*pd_models.SEGMENT_FEATURES).toPandas().astype(float)
    x = x.fillna(x.median()).to_numpy()
    z = (x - x.mean(0)) / np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), 1.0)
    values = np.linalg.eigvalsh(np.cov(z, rowvar=False))[::-1]
    assert np.isclose(sum(explained), 1.0) and np.allclose(explained, values / values.sum())
    # Component variances are the eigenvalues, components are uncorrelated, and the trace is kept.
    assert np.allclose(found.var(0, ddof=1), values, atol=1e-8)
    assert np.allclose(np.corrcoef(found, rowvar=False)[np.triu_indices(7, 1)], 0, atol=1e-7)
    assert np.isclose(found.var(0, ddof=1).sum(), np.trace(np.cov(z, rowvar=False)))


def test_scorecard_values_and_reasons(spark):
    df = spark.createDataFrame([(1, 150000.0, 35, 0, 2, 2), (2, 10000.0, 60, 8, 9, 1)], "id int, limit double, age int, pay_status int, education int, marital int")
    rows = {r.id: r for r in scorecard.reason_codes(scorecard.score_applicants(df, 0.2)).collect()}
    assert np.isclose(rows[1].pd, 1 / (1 + np.exp(1.55))) and rows[1].decision == "APPROVE" and rows[1].colour == "amber"
    assert [(x.reason, x.direction) for x in rows[1].reasons] == [("Recent repayment status", "neutral"), ("Credit limit", "neutral"), ("Age", "neutral")]
    z = -1.55 + 0.62 * 8 + 3e-6 * 140000 - 0.25 + 0 + 0.05
    assert np.isclose(rows[2].pd, 1 / (1 + np.exp(-z))) and rows[2].colour == "red"
    assert [x.reason for x in rows[2].reasons] == ["Recent repayment status", "Credit limit", "Age"]
    assert [x.direction for x in rows[2].reasons] == ["raises", "raises", "lowers"]


def test_a_constant_feature_does_not_stop_scoring(spark):
    df = spark.createDataFrame([(1.0, float(i % 7), i % 2) for i in range(200)], "a double, b double, t int")
    hazard = pd_models.fit_hazard(df, "t", ["a", "b"])
    assert hazard.scale["a"] == 1.0 and hazard.coef["a"] == 0.0
    assert 0 < df.select(hazard.score().alias("p")).first().p < 1


def test_logit_contributions_add_up_to_the_score(spark, loans):
    train, test = loans.where("split = 'train'"), loans.where("split = 'test'")
    model = pd_models.fit_logit(train)
    table = {r.feature: r for r in pd_models.logit_contributions(model, test).collect()}
    assert set(table) == set(pd_models.NUMERIC) | set(pd_models.CATEGORICAL)
    assert sorted(r.importance_rank for r in table.values()) == list(range(1, len(table) + 1))
    assert table["fico"].sign_ok == (table["fico"].coefficient < 0)
    # The terms and the intercept give the model's own log-odds on a row.
    one = test.limit(5)
    scored = model.score(one).toPandas()
    imputer, scaler, indexer, logit = model.pipeline.stages[0], model.pipeline.stages[2], model.pipeline.stages[3], model.pipeline.stages[-1]
    medians, coef = imputer.surrogateDF.first(), list(logit.coefficients)
    prepared = model.prepare(one).toPandas()
    for (_, row), pd_value in zip(prepared.iterrows(), scored["pd"]):
        z = logit.intercept
        for i, name in enumerate(pd_models.NUMERIC):
            x = row[name] if row[name] == row[name] else medians[name]
            z += coef[i] * (x - scaler.mean[i]) / (scaler.std[i] or 1.0)
        at = len(pd_models.NUMERIC)
        for name, labels in zip(pd_models.CATEGORICAL, indexer.labelsArray):
            z += coef[at + list(labels).index(row[name])] if row[name] in labels else 0.0
            at += len(labels)
        assert np.isclose(1 / (1 + np.exp(-z)), pd_value, atol=1e-9)


def test_one_class_can_be_fitted(loans):
    model = pd_models.fit_logit(loans.where("default_flag = 0"))
    assert model.score(loans).agg(F.max("pd")).first()[0] < 0.5


def test_many_categories_can_be_fitted(loans):
    wide = loans.withColumn("property_state", F.concat(F.lit("s"), F.pmod(F.xxhash64("loan_sequence_number"), F.lit(90)).cast("string")))
    wide = wide.unionByName(wide).unionByName(wide).unionByName(wide)
    model = pd_models.fit_boosted(wide, trees=1)
    assert model.score(loans.limit(5)).count() == 5


def test_registered_queries_fit_all_trees(monkeypatch):
    class Reached(Exception):
        pass

    given = []
    monkeypatch.setattr(queries, "split_view", lambda spark, d, name: None)
    monkeypatch.setattr(pd_models, "fit_boosted", lambda train, trees=400, seed=42: given.append(trees) or stop())
    monkeypatch.setattr(pd_models, "calibrate", lambda train, folds=3, trees=400, seed=42: given.append(trees) or stop())

    def stop():
        raise Reached

    for name in ("boosted_train_test_metrics", "calibrated_test_reliability"):
        with pytest.raises(Reached):
            queries.REGISTRY[name](None, "")
    assert given == [400, 400]
