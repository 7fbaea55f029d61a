"""The registered queries: each reads whole driver tables through the loan views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from creditframe.functions.bands import FICO_MART
from creditframe.functions.hazards import ASSUMED_LGD, PUBLISHED_DEFAULT
from creditframe.functions.scalars import quarter_key, round_half_up, vintage_of_key
from creditframe.operators import features as feat
from creditframe.operators import (
    loss, macro, marts, panel, pd_models, portfolio, projection, sampling, scorecard, segments, target, validation,
)
from creditframe.plans import scenarios
from creditframe.sources import files

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
LOAN = target.LOAN


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns so that both engines print the same value."""
    return df.select(
        *[round_half_up(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- loading and sampling ---------------------------------------------------------------------


@register
def typed_performance(spark, d):
    return files.type_performance(views.as_text(views.performance(spark, d)))


@register
def typed_origination(spark, d):
    raw = views.as_text(views.origination(spark, d).drop("vintage_year"))
    return files.type_loans(raw)


@register
def sampled_performance(spark, d):
    return sampling.sample_by_key(views.performance(spark, d), LOAN, 0.05).select(
        LOAN, "monthly_reporting_period", "loan_age", "current_delinquency_status"
    )


@register
def panel_sample_loans(spark, d):
    return sampling.sample_by_key(views.origination(spark, d), LOAN, 0.4, seed=7).select(LOAN, "vintage_year")


@register
def performance_of_defaulted_loans(spark, d):
    perf = views.performance(spark, d)
    keys = target_view(spark, d).where(F.col("outcome") == "default")
    return sampling.keep_keys(perf, keys, LOAN).select(LOAN, "monthly_reporting_period", "loan_age", "zero_balance_code")


@register
def load_summary(spark, d):
    loans, perf = views.origination(spark, d), views.performance(spark, d)
    return sampling.load_summary(
        loans, sampling.sample_by_key(loans, LOAN, 0.05), sampling.sample_by_key(perf, LOAN, 0.05)
    )


@register
def hash_ordered_sample(spark, d):
    sample = sampling.first_n_by_hash(features_view(spark, d), LOAN, 3000)
    return sample.select(LOAN, "fico", "oltv", "default_flag")


# --- target and features ----------------------------------------------------------------------


def target_view(spark, d):
    return target.loan_target(views.origination(spark, d), target.performance_summary(views.performance(spark, d)))


def features_view(spark, d):
    return feat.features_from_performance(views.origination(spark, d), views.performance(spark, d))


@register
def performance_summary(spark, d):
    return target.performance_summary(views.performance(spark, d))


@register
def loan_target(spark, d):
    return target_view(spark, d)


@register
def target_summary(spark, d):
    return target.target_summary(target_view(spark, d))


@register
def features(spark, d):
    return feat.features(views.origination(spark, d), target_view(spark, d))


@register
def features_one_join(spark, d):
    return features_view(spark, d)


@register
def filled_categories(spark, d):
    filled = feat.fill_categories(feat.clean_origination(views.origination(spark, d)))
    return filled.select(LOAN, "fthb", "channel", "occupancy")


@register
def as_of_book(spark, d):
    return feat.as_of_book(feat.clean_origination(views.origination(spark, d))).select(LOAN, *feat.BOOK_COLUMNS)


@register
def split_summary(spark, d):
    return feat.split_summary(features_view(spark, d))


# --- portfolio reports ------------------------------------------------------------------------


@register
def portfolio_snapshot(spark, d):
    return portfolio.snapshot(features_view(spark, d))


@register
def vintage_default_table(spark, d):
    return portfolio.vintage_table(features_view(spark, d))


@register
def vintage_default_crosstab(spark, d):
    return portfolio.vintage_crosstab(features_view(spark, d))


@register
def fico_ltv_grid(spark, d):
    return portfolio.band_grid(features_view(spark, d))


@register
def vintage_seasoning(spark, d):
    return portfolio.seasoning(
        views.performance(spark, d), feat.clean_origination(views.origination(spark, d))
    )


@register
def states_by_default_rate(spark, d):
    # The report's 1000-loan floor is a parameter; the driver's tables hold 25 small states.
    return portfolio.top_states(features_view(spark, d), min_loans=20)


@register
def worst_delinquency(spark, d):
    return portfolio.worst_status(views.performance(spark, d))


# --- macro ------------------------------------------------------------------------------------


def quarterly_view(spark, d):
    return macro.to_quarterly(views.macro_observations(spark, d))


def macro_view(spark, d):
    return macro.macro_table(views.macro_observations(spark, d))


@register
def macro_quarterly_means(spark, d):
    return rounded(quarterly_view(spark, d), value=6)


@register
def macro_year_on_year(spark, d):
    grown = macro.yoy(quarterly_view(spark, d), "value", "growth", by=["series"], base=100.0)
    return rounded(grown.drop("value"), growth=6)


@register
def macro_annualised_growth(spark, d):
    grown = macro.annualised(quarterly_view(spark, d), "value", "growth", by=["series"])
    return rounded(grown.drop("value"), growth=6)


@register
def compounded_price_index(spark, d):
    """A price index per state from a yearly growth figure taken from its loans."""
    growth = (
        views.origination(spark, d)
        .groupBy(F.col("property_state").alias("state"), vintage_of_key(F.col(LOAN)).alias("vintage"))
        .agg(F.avg((F.col("oltv") % 16 - 6).cast("double")).alias("growth"))
    )
    index = macro.compound_index(growth, "growth", "hpi", by=["state"], order="vintage")
    return rounded(index.drop("growth"), hpi=6)


@register
def macro_aligned(spark, d):
    return rounded(macro_view(spark, d), unemployment_rate=6, mortgage_rate=6, gdp_growth=6, hpi=6, hpi_yoy=6)


@register
def macro_wide(spark, d):
    wide = macro.widen(quarterly_view(spark, d), ["quarter_key"], ["unemployment_rate", "hpi"], variable="series")
    return rounded(wide, unemployment_rate=6, hpi=6)


@register
def interpolated_balances(spark, d):
    """Every loan's balance on a 13-step age grid, averaged by vintage."""
    points = (
        views.performance(spark, d)
        .groupBy(LOAN, F.col("loan_age").alias("t"))
        .agg(F.min("current_actual_upb").alias("value"))
    )
    grid = macro.interpolate(points, 13, [LOAN])
    means = grid.groupBy(F.substring(LOAN, 2, 2).alias("vintage"), "t").agg(
        F.count("*").alias("loans"), F.avg("value").alias("mean_upb")
    )
    return rounded(means, mean_upb=3)


# --- panel ------------------------------------------------------------------------------------


def panel_view(spark, d):
    clean = feat.clean_origination(views.origination(spark, d))
    return panel.hazard_panel(views.performance(spark, d), clean, macro_view(spark, d))


@register
def calendar_split(spark, d):
    period = F.col("monthly_reporting_period")
    counts = views.performance(spark, d).groupBy(period.alias("period")).agg(F.count("*").alias("n"))
    key = quarter_key(F.col("period"))
    return counts.select(
        "period", F.floor(key / 4.0).cast("int").alias("cal_year"), (key % 4 + 1).alias("cal_q"),
        key.alias("quarter_key"), "n",
    )


@register
def loan_quarters(spark, d):
    return panel.loan_quarters(views.performance(spark, d))


@register
def quarters_until_event(spark, d):
    return panel.stop_at_event(panel.loan_quarters(views.performance(spark, d)))


@register
def hazard_panel(spark, d):
    return rounded(
        panel_view(spark, d), loan_age_q=6, loan_age_q_sq=6, unemployment_rate=6, hpi_yoy=6, mortgage_rate=6,
        hpi_growth_since_orig=6, current_ltv=6,
    )


@register
def default_rate_by_quarter(spark, d):
    return rounded(panel.rate_by_quarter(panel_view(spark, d)), default_rate=8, unemployment_rate=6)


@register
def panel_summary(spark, d):
    return rounded(panel.panel_summary(panel_view(spark, d)), default_hazard=8, prepay_hazard=8)


@register
def published_hazard_scores(spark, d):
    scored = panel_view(spark, d).withColumn("hazard", PUBLISHED_DEFAULT.score())
    means = scored.groupBy("cal_year", "cal_q").agg(
        F.count("hazard").alias("scored"), F.avg("hazard").alias("mean_hazard"), F.max("hazard").alias("max_hazard")
    )
    return rounded(means, mean_hazard=8, max_hazard=8)


# --- projection and loss ----------------------------------------------------------------------


def book_view(spark, d):
    return segments.with_bands(feat.as_of_book(feat.clean_origination(views.origination(spark, d))))


def rolled_view(spark, d):
    return projection.roll_forward(book_view(spark, d), scenarios.scenario_paths(spark))


def projection_view(spark, d):
    return projection.by_quarter(rolled_view(spark, d), scenarios.scenario_paths(spark))


def losses_view(spark, d):
    return loss.expected_loss(projection_view(spark, d), ASSUMED_LGD)


def cells_view(spark, d):
    return segments.cells(projection.by_loan(rolled_view(spark, d), ASSUMED_LGD))


@register
def empirical_lgd(spark, d):
    return rounded(loss.lgd(target_view(spark, d)), total_loss=2, total_ead=2, empirical_lgd=8, lgd=8)


@register
def book_stats(spark, d):
    return rounded(loss.book_stats(book_view(spark, d)), fico=6, oltv=6, odti=6, orig_rate=6)


@register
def loan_paths_by_band(spark, d):
    paths = projection.loan_quarter_path(rolled_view(spark, d), [LOAN, "fico_band"])
    means = paths.groupBy("scenario", "quarter_index", "fico_band").agg(
        F.count("*").alias("loans"), F.avg("survival").alias("mean_survival"), F.avg("exp_default").alias("mean_default")
    )
    return rounded(means, mean_survival=6, mean_default=8)


@register
def book_by_quarter(spark, d):
    return rounded(projection_view(spark, d), defaulted_upb=2)


@register
def loan_expected_loss(spark, d):
    loans = projection.by_loan(rolled_view(spark, d), ASSUMED_LGD)
    return rounded(loans.select("scenario", LOAN, "exp_default", "exp_loss"), exp_default=6, exp_loss=2)


@register
def expected_loss(spark, d):
    severity = loss.lgd(target_view(spark, d)).select("lgd").scalar()
    losses = loss.expected_loss(projection_view(spark, d), severity)
    columns = losses.select("scenario", "quarter_index", "expected_loss", "cumulative_loss_rate_pct")
    return rounded(columns, expected_loss=2, cumulative_loss_rate_pct=6)


@register
def horizon_end(spark, d):
    return rounded(loss.horizon_end(losses_view(spark, d)), cumulative_loss_rate_pct=6, expected_loss=2)


@register
def stress_headline(spark, d):
    return loss.headline(losses_view(spark, d))


@register
def shock_grid(spark, d):
    paths = scenarios.shock_paths(spark, [4.5, 10.0, 15.0], [0.0, 30.0, 50.0])
    grid = projection.shock_grid(book_view(spark, d), paths, ASSUMED_LGD)
    return rounded(grid, cumulative_default_pct=6, cumulative_loss_pct=6, loss_rate_pct=6, exp_loss=2)


# --- segments and marts -----------------------------------------------------------------------

SEGMENT_DIGITS = {"exp_loss": 2, "loss_rate_pct": 6, "default_rate_pct": 6}


@register
def loss_by_segment(spark, d):
    return rounded(segments.loss_by_segment(cells_view(spark, d)), **SEGMENT_DIGITS)


@register
def loss_by_top_states(spark, d):
    return rounded(segments.loss_by_top_states(cells_view(spark, d)), **SEGMENT_DIGITS)


@register
def segment_report(spark, d):
    return rounded(segments.segment_report(cells_view(spark, d)), **SEGMENT_DIGITS)


@register
def severe_losses_by_fico_band(spark, d):
    report = segments.segment_report(cells_view(spark, d))
    view = segments.segment_view(report, "severely_adverse", "fico_band", FICO_MART)
    return rounded(view.select("segment", "position", "loss_rate_pct"), loss_rate_pct=2)


@register
def states_by_expected_loss(spark, d):
    report = segments.segment_report(cells_view(spark, d))
    top = segments.top_states_by_loss(report, "severely_adverse")
    return rounded(top.select("segment", "loss_rate_pct", "exp_loss"), loss_rate_pct=6, exp_loss=2)


@register
def dim_scenario(spark, d):
    return rounded(marts.dim_scenario(projection_view(spark, d)), hpi_trough_pct=6)


@register
def fact_projection(spark, d):
    losses = losses_view(spark, d)
    fact = marts.fact_projection(losses, marts.dim_scenario(losses))
    return rounded(fact, cumulative_loss_rate_pct=6, expected_loss=2)


@register
def fact_segment_loss(spark, d):
    report = segments.segment_report(cells_view(spark, d))
    return rounded(marts.fact_segment(report, marts.dim_scenario(projection_view(spark, d))), **SEGMENT_DIGITS)


@register
def mart_measures(spark, d):
    losses = losses_view(spark, d)
    dim = marts.dim_scenario(losses)
    table = marts.measures(marts.fact_projection(losses, dim), dim)
    return rounded(table, mean_loss_rate_pct=6, expected_loss=2, times_base=6)


@register
def series_bundle(spark, d):
    arrays = marts.series_bundle(losses_view(spark, d))
    names = [name for name in arrays.columns if name != "scenario"]
    rows = arrays.select("scenario", F.posexplode(F.arrays_zip(*names)).alias("position", "p"))
    return rows.select("scenario", "position", *[F.col(f"p.{name}").alias(name) for name in names])


# --- scorecard --------------------------------------------------------------------------------

THRESHOLD = 0.087


@register
def applicant_scores(spark, d):
    scored = scorecard.score_applicants(views.applicants(spark, d), THRESHOLD)
    columns = scored.select("applicant_id", "pd", "decision", "colour", "expected_loss")
    return rounded(columns, pd=8, expected_loss=2)


@register
def applicant_reasons(spark, d):
    coded = scorecard.reason_codes(views.applicants(spark, d))
    rows = coded.select("applicant_id", F.posexplode("reasons").alias("position", "r"))
    return rows.select("applicant_id", "position", "r.reason", "r.direction")


@register
def applicant_portfolio_loss(spark, d):
    totals = scorecard.portfolio_loss(scorecard.score_applicants(views.applicants(spark, d), THRESHOLD))
    return rounded(totals, limit=2, expected_loss=2, loss_rate_pct=6, mean_pd=8)


# --- validation -------------------------------------------------------------------------------

METRIC_DIGITS = dict.fromkeys(["base_rate", "roc_auc", "gini", "ks", "pr_auc", "brier"], 8)


def scored_view(spark, d):
    """Every loan with the published hazard at a fixed age and unemployment as its score."""
    at = {"loan_age_q": F.lit(12.0), "loan_age_q_sq": F.lit(144.0), "current_ltv": F.col("oltv"), "unemployment_rate": F.lit(6.5)}
    score = PUBLISHED_DEFAULT.score(lambda name: at.get(name, F.col(name)))
    return features_view(spark, d).select(LOAN, "split", "default_flag", round_half_up(score, 6).alias("score"))


@register
def score_ranking_metrics(spark, d):
    return rounded(validation.rank_metrics(scored_view(spark, d), "default_flag", "score"), **METRIC_DIGITS)


@register
def train_test_ranking_metrics(spark, d):
    return rounded(validation.rank_metrics(scored_view(spark, d), "default_flag", "score", by="split"), **METRIC_DIGITS)


@register
def score_reliability(spark, d):
    table = validation.reliability(scored_view(spark, d), "default_flag", "score")
    return rounded(table, mean_predicted=8, observed_rate=8)


@register
def score_deciles(spark, d):
    return rounded(validation.deciles(scored_view(spark, d), "default_flag", "score"), default_rate_pct=6)


@register
def threshold_under_loss_limit(spark, d):
    """Cut-off for a 6% loss rate on the accepted loans, at 45% severity."""
    upb = views.origination(spark, d).select(LOAN, "orig_upb")
    rows = scored_view(spark, d).join(upb, LOAN)
    lost = F.col("default_flag") * F.lit(0.45) * F.col("orig_upb")
    best = validation.choose_threshold(rows, "default_flag", "score", lost, F.col("orig_upb"), 0.06)
    return rounded(best, sensitivity=8, specificity=8, youden=8, accepted_loss_rate=8)


@register
def subgroup_outcomes(spark, d):
    groups = views.origination(spark, d).select(LOAN, "occupancy_status")
    rows = scored_view(spark, d).join(groups, LOAN)
    table = validation.subgroup_outcomes(rows, "default_flag", "score", "occupancy_status", 0.001)
    return rounded(table, base_rate=8, declined_rate=8, true_positive_rate=8, false_positive_rate=8)


@register
def score_drift(spark, d):
    return rounded(validation.drift(scored_view(spark, d), "score", "split", "train"), psi=8)


@register
def delinquency_migration(spark, d):
    return portfolio.migration_matrix(views.performance(spark, d))


@register
def hazard_contributions(spark, d):
    table = pd_models.contributions(panel_view(spark, d), PUBLISHED_DEFAULT)
    return rounded(table, mean_abs=6, correlation=6)


# --- fitted models (rows-only: no SQL equivalent) ---------------------------------------------


def fitted_hazard(spark, d, target_name, names):
    return pd_models.fit_hazard(panel_view(spark, d), target_name, names)


@register
def default_hazard_coefficients(spark, d):
    hazard = fitted_hazard(spark, d, "default_event", pd_models.DEFAULT_FEATURES)
    return pd_models.coefficient_table(spark, hazard)


@register
def prepay_hazard_coefficients(spark, d):
    hazard = fitted_hazard(spark, d, "prepay_event", pd_models.PREPAY_FEATURES)
    return pd_models.coefficient_table(spark, hazard)


@register
def default_hazard_parameters(spark, d):
    hazard = fitted_hazard(spark, d, "default_event", pd_models.DEFAULT_FEATURES)
    return pd_models.parameter_table(spark, hazard)


@register
def fitted_stress_projection(spark, d):
    """Panel, both fitted hazards, roll-forward and loss in one go."""
    wanted = {"default_event": pd_models.DEFAULT_FEATURES, "prepay_event": pd_models.PREPAY_FEATURES}
    default, prepay = pd_models.fit_hazards(panel_view(spark, d), wanted).values()
    paths = scenarios.scenario_paths(spark)
    rolled = projection.roll_forward(book_view(spark, d), paths, default, prepay)
    return loss.expected_loss(projection.by_quarter(rolled, paths), ASSUMED_LGD)


def split_view(spark, d, name):
    return features_view(spark, d).where(F.col("split") == name)


@register
def logit_test_metrics(spark, d):
    scored = pd_models.fit_logit(split_view(spark, d, "train")).score(split_view(spark, d, "test"))
    return validation.rank_metrics(scored, "default_flag", "pd")


@register
def pd_logit_contributions(spark, d):
    model = pd_models.fit_logit(split_view(spark, d, "train"))
    return pd_models.logit_contributions(model, split_view(spark, d, "test"))


@register
def boosted_train_test_metrics(spark, d):
    model = pd_models.fit_boosted(split_view(spark, d, "train"))
    return validation.rank_metrics(model.score(features_view(spark, d)), "default_flag", "pd", by="split")


@register
def calibrated_test_reliability(spark, d):
    model = pd_models.calibrate(split_view(spark, d, "train"))
    return validation.reliability(model.score(split_view(spark, d, "test")), "default_flag", "pd")


@register
def platt_scaled_test_metrics(spark, d):
    scored = scored_view(spark, d)
    model = pd_models.fit_platt(scored.where(F.col("split") == "train"), "default_flag", "score")
    scaled = pd_models.platt_scaled(model, scored.where(F.col("split") == "test"), "score")
    return validation.rank_metrics(scaled, "default_flag", "pd")


@register
def principal_components(spark, d):
    return pd_models.pca(features_view(spark, d))[0].select(LOAN, "pc1", "pc2", "pc3")


@register
def principal_component_variance(spark, d):
    return pd_models.explained_variance(spark, features_view(spark, d))


@register
def risk_segment_profiles(spark, d):
    return pd_models.profiles(pd_models.segments(features_view(spark, d)))
