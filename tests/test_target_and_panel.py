import pytest

from creditframe.operators import features, loss, panel, portfolio, target

PERF = (
    "loan_sequence_number string, monthly_reporting_period int, current_delinquency_status string, loan_age int, "
    "zero_balance_code string, zero_balance_effective_date int, zero_balance_removal_upb double, actual_loss_calculation double"
)


def month(loan, period, status, age, code=None, upb=None, lost=None):
    return (loan, period, status, age, code, period if code else None, upb, lost)


@pytest.fixture
def perf(spark):
    return spark.createDataFrame(
        [
            month("F05Q10000001", 200504, "0", 1),
            month("F05Q10000001", 200505, "6", 2),
            month("F05Q10000001", 200509, "9", 6, "09", 90.0, 30.0),
            month("F05Q10000002", 200504, "XX", 1),
            month("F05Q10000002", 200507, "0", 4, "01", 50.0),
            month("F05Q10000003", 200504, "RA", 1),
            month("F05Q10000004", 200506, "2", 3),
            month("F05Q10000004", 200508, "0", 5, "03", 70.0, 10.0),
            month("F05Q10000004", 200511, "0", 8),
        ],
        PERF,
    )


def test_summary_and_outcome(spark, perf):
    orig = spark.createDataFrame(
        [(f"F05Q1000000{i}", 2005, "200503") for i in range(1, 6)],
        "loan_sequence_number string, vintage_year int, first_payment_date string",
    )
    rows = {r.loan_sequence_number[-1]: r for r in target.loan_target(orig, target.performance_summary(perf)).collect()}
    assert [rows[i].outcome for i in "12345"] == ["default", "prepaid", "active_or_censored", "default", "active_or_censored"]
    assert [rows[i].default_flag for i in "12345"] == [1, 0, 0, 1, None]
    assert [rows[i].months_to_event for i in "12345"] == [2, 4, 1, 5, None]
    summary = {r.loan_sequence_number[-1]: r for r in target.performance_summary(perf).collect()}
    assert summary["3"].max_dq is None and summary["3"].any_termination == 0
    assert summary["1"].term_age == 6 and summary["1"].term_period == 200509 and summary["1"].first_180_age == 2


def test_panel_stops_at_first_event(perf):
    kept = panel.stop_at_event(panel.loan_quarters(perf))
    rows = sorted((r.loan_sequence_number[-1], r.quarter_key - 2005 * 4, r.default_event, r.prepay_event, r.age_m) for r in kept.collect())
    assert rows == [("1", 1, 1, 0, 1), ("2", 1, 0, 0, 1), ("2", 2, 0, 1, 4), ("3", 1, 0, 0, 1), ("4", 1, 0, 0, 3), ("4", 2, 1, 0, 5)]


def test_one_loan_with_a_third_of_all_rows(spark):
    hot = spark.range(60_000).selectExpr("'F05Q10000001' AS loan", "id")
    rest = spark.range(120_000).selectExpr("concat('F05Q1', lpad(string(1000 + id % 4000), 7, '0')) AS loan", "id")
    perf = hot.unionAll(rest).selectExpr(
        "loan AS loan_sequence_number", "int(200504 + id % 3) AS monthly_reporting_period",
        "string(id % 7) AS current_delinquency_status", "int(id % 3) AS loan_age", "string(NULL) AS zero_balance_code",
        "int(NULL) AS zero_balance_effective_date", "double(NULL) AS zero_balance_removal_upb", "double(NULL) AS actual_loss_calculation",
    )
    assert target.performance_summary(perf).count() == 4001
    quarters = panel.loan_quarters(perf)
    assert quarters.where("loan_sequence_number = 'F05Q10000001'").count() == 1
    # Months are folded before they are shuffled.
    plan = quarters._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


def test_panel_joins_both_quarters(spark, perf):
    clean = spark.createDataFrame(
        [("F05Q10000001", 700, 80, 30, 5.0), ("F05Q10000004", 650, None, 40, 6.0)],
        "loan_sequence_number string, fico int, oltv int, odti int, orig_rate double",
    )
    macro = spark.createDataFrame(
        [(8020, 5.0, None, 6.0, 100.0), (8021, 5.5, None, 6.1, 80.0), (8022, 6.0, None, 6.2, 50.0)],
        "quarter_key int, unemployment_rate double, hpi_yoy double, mortgage_rate double, hpi double",
    )
    rows = {(r.loan_sequence_number[-1], r.quarter_key): r for r in panel.hazard_panel(perf, clean, macro).collect()}
    assert set(rows) == {("1", 8021), ("4", 8021), ("4", 8022)}
    first = rows[("1", 8021)]
    assert first.current_ltv == 100.0 and first.unemployment_rate == 5.5 and first.cal_year == 2005 and first.cal_q == 2
    assert round(first.hpi_growth_since_orig, 9) == -20.0
    assert rows[("4", 8022)].current_ltv == 250.0


def test_lgd_needs_enough_credible_losses(spark):
    table = spark.createDataFrame(
        [(1, 100.0, 30.0), (1, 100.0, 20.0), (1, 100.0, None), (1, None, -5.0), (0, 100.0, 90.0)],
        "default_flag int, ead_upb double, actual_loss double",
    )
    assumed = loss.lgd(table).first()
    assert (assumed.method, assumed.lgd, assumed.n_with_loss) == ("assumed", 0.3, 2)
    trusted = loss.lgd(table, min_n=2).first()
    assert trusted.method == "empirical" and abs(trusted.lgd - 0.25) < 1e-12
    assert loss.lgd(table, min_n=2, floor=0.26).first().method == "assumed"
    assert loss.lgd(table.where("false")).first().lgd == 0.3


def test_fill_and_book(spark):
    df = spark.createDataFrame([(None, "covid", 700, None), ("Y", "covid", 700, 80), ("N", "crisis", 700, 80)], "fthb string, cohort string, fico int, oltv int")
    assert [r.fthb for r in features.fill_categories(df, ["fthb"]).collect()] == ["missing", "Y", "N"]
    assert features.as_of_book(df, required=["fico", "oltv"]).count() == 1


def test_migration_counts_consecutive_months_across_the_year(spark):
    rows = [month("F05Q10000001", p, d, 0) for p, d in ((200511, "0"), (200512, "1"), (200601, "0"), (200603, "6"), (200604, "XX"))]
    got = {(r.from_status[0], r.to_status[0]): (r.n, r.share_pct) for r in portfolio.migration_matrix(spark.createDataFrame(rows, PERF)).collect()}
    assert got == {("0", "1"): (1, 100.0), ("1", "0"): (1, 100.0), ("3", "4"): (1, 100.0)}
