import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditframe.functions.hazards import ASSUMED_LGD, CONSTANT_PREPAY, PUBLISHED_DEFAULT, Hazard
from creditframe.operators import loss, macro, marts, projection, segments
from creditframe.plans import scenarios

BOOK = "loan_sequence_number string, fico double, oltv double, odti double, orig_rate double, orig_upb double"
# The published representative loan.
REPRESENTATIVE = (747.3425468636736, 75.67738417034192, 35.42892371061385, 4.388861925763335)


@pytest.fixture(scope="module")
def book(spark):
    rng = np.random.default_rng(5)
    rows = [
        (f"L{i}", float(rng.integers(580, 820)), float(rng.integers(40, 98)), float(rng.integers(10, 60)), float(rng.uniform(3, 6)), 1e5 + i)
        for i in range(40)
    ]
    return spark.createDataFrame(rows, BOOK)


def brute(book, paths, hazard, prepay):
    """Survival and expected defaults by a plain loop."""
    out = {}
    by_scenario = {}
    for p in paths.collect():
        by_scenario.setdefault(p.scenario, []).append(p)
    for loan in book.collect():
        for scenario, points in by_scenario.items():
            alive, steps = 1.0, []
            for p in sorted(points, key=lambda p: p.quarter_index):
                age = 6 + p.quarter_index
                x = {
                    "loan_age_q": age, "loan_age_q_sq": age * age, "fico": loan.fico, "odti": loan.odti,
                    "orig_rate": loan.orig_rate, "current_ltv": min(loan.oltv * 100 / p.hpi, 250.0), **p.asDict(),
                }
                score = lambda h: 1 / (1 + math.exp(-(h.intercept + sum(h.coef[f] * (x[f] - h.mean[f]) / h.scale[f] for f in h.features))))
                hd = score(hazard)
                hp = score(prepay) if isinstance(prepay, Hazard) else prepay
                steps.append((alive * hd, alive * max(1 - hd - hp, 0)))
                alive = steps[-1][1]
            out[(loan.loan_sequence_number, scenario)] = steps
    return out


@pytest.mark.parametrize(
    "prepay",
    [
        CONSTANT_PREPAY,
        0.9999,
        Hazard(-3.0, {"fico": 0.4, "hpi_yoy": 0.3, "mortgage_rate": -0.5, "loan_age_q": 0.1},
               {"fico": 700, "hpi_yoy": 1, "mortgage_rate": 5, "loan_age_q": 10}, {"fico": 50, "hpi_yoy": 8, "mortgage_rate": 1, "loan_age_q": 9}),
    ],
)
def test_roll_forward_equals_a_plain_loop(spark, book, prepay):
    paths = scenarios.scenario_paths(spark)
    expected = brute(book, paths, PUBLISHED_DEFAULT, prepay)
    rows = projection.roll_forward(book, paths, PUBLISHED_DEFAULT, prepay).collect()
    assert len(rows) == 80
    for r in rows:
        for t, (d, s) in enumerate(expected[(r.loan_sequence_number, r.scenario)], 1):
            assert math.isclose(r[f"def_{t}"], d, rel_tol=1e-9, abs_tol=1e-15)
            assert math.isclose(r[f"surv_{t}"], s, rel_tol=1e-9, abs_tol=1e-15)


def test_survival_never_rises_and_nothing_is_lost(spark, book):
    for r in projection.roll_forward(book, scenarios.scenario_paths(spark)).collect():
        survival = [1.0] + [r[f"surv_{t}"] for t in range(1, 14)]
        assert all(0 <= b <= a <= 1 for a, b in zip(survival, survival[1:]))
        assert sum(r[f"def_{t}"] for t in range(1, 14)) + survival[-1] <= 1 + 1e-12


def test_scenarios_do_not_depend_on_each_other(spark, book):
    grid = scenarios.shock_paths(spark, [5.0, 9.0], [0.0, 10.0, 20.0])
    whole = sorted(projection.roll_forward(book, grid).where("scenario = '9.0/10.0'").collect())
    assert sorted(projection.roll_forward(book, grid.where("scenario = '9.0/10.0'")).collect()) == whole


def test_a_hole_in_the_prices_shows(spark, book):
    paths = scenarios.scenario_paths(spark)
    for hole in (F.lit(None).cast("double"), F.lit(0.0)):
        holed = paths.withColumn("hpi", F.when(F.col("quarter_index") == 4, hole).otherwise(F.col("hpi")))
        row = projection.roll_forward(book, holed).first()
        assert not math.isnan(row.def_3) and math.isnan(row.def_4)


def test_a_hole_in_a_path_shows(spark, book):
    paths = scenarios.scenario_paths(spark).where("quarter_index <> 4")
    row = projection.roll_forward(book, paths).first()
    assert not math.isnan(row.surv_3) and math.isnan(row.def_4)


def test_no_join_and_no_shuffle_of_the_book(spark, book):
    rolled = projection.roll_forward(book, scenarios.scenario_paths(spark))
    top = rolled._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in top and "Cartesian" not in top


@pytest.mark.parametrize(
    "peak, decline, default_pct, loss_pct",
    [(4.5, 0, 0.5308, 0.1593), (10.0, 0, 1.8426, 0.5528), (4.5, 30, 0.7858, 0.2358), (10.0, 30, 2.8779, 0.8634), (15.0, 50, 17.6295, 5.2888)],
)
def test_published_what_if_values(spark, peak, decline, default_pct, loss_pct):
    loan = spark.createDataFrame([("L", *REPRESENTATIVE, 1.0)], BOOK)
    paths = scenarios.shock_paths(spark, [peak], [float(decline)])
    row = projection.shock_grid(loan, paths, ASSUMED_LGD).first()
    assert round(row.cumulative_default_pct, 4) == default_pct
    assert round(row.cumulative_loss_pct, 4) == loss_pct


def test_scenario_anchors(spark):
    rows = {(r.scenario, r.quarter_index): r for r in scenarios.scenario_paths(spark).collect()}
    assert len(rows) == 26
    severe = [rows[("severely_adverse", t)] for t in range(1, 14)]
    assert [round(r.unemployment_rate, 2) for r in severe[:4]] == [5.6, 6.47, 7.33, 8.2]
    assert severe[7].hpi == 70.0 and severe[0].hpi_yoy == -4.0 and severe[4].hpi_yoy == round((80.5 / 96 - 1) * 100, 3)
    assert rows[("baseline", 4)].hpi == 102.0 and severe[12].quarter == "2029Q1"
    assert scenarios.scenario_long(spark).count() == 130


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(-5, 20), st.floats(-100, 100), min_size=1, max_size=8))
def test_interpolation_equals_numpy(spark, anchors):
    df = spark.createDataFrame([("a", t, v) for t, v in anchors.items()], "k string, t int, value double")
    got = [r.value for r in macro.interpolate(df, 13, ["k"]).orderBy("t").collect()]
    xs = sorted(anchors)
    assert np.allclose(got, np.interp(np.arange(1, 14), xs, [anchors[x] for x in xs]))


def test_growth_and_index(spark):
    df = spark.createDataFrame([(t, 100.0 * 1.1**t) for t in range(6)], "quarter_key int, v double")
    assert [round(r.g, 6) for r in macro.yoy(df, "v", "g", base=50.0).orderBy("quarter_key").collect()][:2] == [100.0, 120.0]
    assert macro.yoy(df, "v", "g").orderBy("quarter_key").first().g is None
    assert round(macro.annualised(df, "v", "g").where("quarter_key = 1").first().g, 6) == 40.0
    flat = spark.createDataFrame([(t, 10.0) for t in range(4)], "quarter_key int, g double")
    assert round(macro.compound_index(flat, "g", "i").where("quarter_key = 3").first().i, 9) == 110.0


def test_alignment_keeps_every_key_and_drops_empty_rows(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None)], "quarter_key int, a double")
    b = spark.createDataFrame([(3, 3.0), (2, None)], "quarter_key int, b double")
    assert sorted((r.quarter_key, r.a, r.b) for r in macro.align([a, b]).collect()) == [(1, 1.0, None), (3, None, 3.0)]


def test_published_severe_end(spark):
    projection_end = spark.createDataFrame(
        [("baseline", 13, 0.0, 0.613, 217370457.0, 35446498000.0), ("severely_adverse", 13, 0.1, 3.2815, 1174426240.0, 35446498000.0)],
        "scenario string, quarter_index int, quarterly_default_rate_pct double, cumulative_default_rate_pct double, cumulative_defaulted_upb double, portfolio_upb0 double",
    )
    row = loss.headline(loss.expected_loss(projection_end, ASSUMED_LGD)).first()
    assert (row.severe_default_pct, row.severe_loss_pct, row.severe_loss_usd) == (3.28, 0.99, 352327872)
    assert row.base_loss_usd == 65211137 and row.severe_to_base == 5.4


def test_segments_add_up_to_the_book(spark, book):
    loans = segments.with_bands(book).withColumn("loan_purpose", F.lit("P")).withColumn("state", F.lit("NY"))
    per_loan = projection.by_loan(projection.roll_forward(loans, scenarios.scenario_paths(spark)), ASSUMED_LGD)
    report = segments.segment_report(segments.cells(per_loan))
    total = {r.scenario: r.x for r in per_loan.groupBy("scenario").agg(F.sum("exp_loss").alias("x")).collect()}
    for r in report.groupBy("scenario", "dimension").agg(F.sum("exp_loss").alias("x"), F.sum("loans").alias("n")).collect():
        assert math.isclose(r.x, total[r.scenario], rel_tol=1e-9) and r.n == 40


def test_unmatched_scenario_gets_no_key(spark):
    dim = spark.createDataFrame([(1, "baseline")], "scenario_id int, scenario string")
    report = spark.createDataFrame([("baseline", 1), ("other", 2)], "scenario string, x int")
    assert sorted((r.x, r.scenario_id) for r in marts.fact_segment(report, dim).collect()) == [(1, 1), (2, None)]
