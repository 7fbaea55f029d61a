"""Competing-risk roll-forward of a loan book along macro paths."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.hazards import (
    CONSTANT_PREPAY,
    HORIZON_Q,
    HPI_AS_OF,
    LTV_CAP,
    PUBLISHED_DEFAULT,
    START_AGE_Q,
    Hazard,
)
from creditframe.functions.scalars import round_half_up, sigmoid_of_negative

_LTV = "current_ltv"
_AGES = ("loan_age_q", "loan_age_q_sq")


def _known(value: Column) -> Column:
    """NaN for NULL: a hole in an input shows in the result, and the expression is known not to be NULL."""
    return F.coalesce(value, F.lit(math.nan))


def _split(hazard: Hazard, path_columns) -> tuple[list[str], list[str]]:
    """Feature names that the path supplies and that the loan supplies."""
    on_path = [f for f in hazard.features if f in path_columns or f in _AGES]
    return on_path, [f for f in hazard.features if f not in on_path and f != _LTV]


def roll_forward(
    book: DataFrame,
    paths: DataFrame,
    default: Hazard = PUBLISHED_DEFAULT,
    prepay: Hazard | float = CONSTANT_PREPAY,
    horizon: int = HORIZON_Q,
    start_age: int = START_AGE_Q,
    hpi_as_of: float = HPI_AS_OF,
) -> DataFrame:
    """Book columns x scenario with expected defaults ``def_t`` and survival ``surv_t`` after quarter t.

    In quarter t, def_t = surv_{t-1} * h_default and surv_t = surv_{t-1} * max(1 - h_default - h_prepay, 0).

    A hazard's log-odds split into a part the loan fixes, a part the path fixes and the LTV term. The
    path parts are folded into one flat row per scenario, a few numbers per quarter, which every loan
    is expanded by. The result has one row per loan and scenario: no join, no shuffle and no row per
    quarter, and the quarters run as plain generated code over primitive columns. The generated method
    must stay under the size the JVM still compiles, hence log-odds carried with their sign turned.
    """
    path_columns = set(paths.columns)
    on_path, on_loan = _split(default, path_columns)
    loan_part = -(F.lit(default.intercept) + default.terms(on_loan))
    if _LTV in default.coef:
        loan_part = loan_part + F.lit(default.coef[_LTV] * default.mean[_LTV] / default.scale[_LTV])
        ltv_weight = F.lit(-default.coef[_LTV] / default.scale[_LTV])
    else:
        ltv_weight = F.lit(0.0)
    if isinstance(prepay, Hazard):
        pp_on_path, pp_on_loan = _split(prepay, path_columns)
        prepay_loan = -(F.lit(prepay.intercept) + prepay.terms(pp_on_loan))
        prepay_path = -prepay.terms(pp_on_path)
    else:
        prepay_loan, prepay_path = F.lit(float(prepay)), F.lit(0.0)

    age = (F.lit(start_age) + F.col("quarter_index")).cast("double")
    aged = paths.withColumn("loan_age_q", age).withColumn("loan_age_q_sq", age * age)
    points = aged.select(
        "scenario",
        "quarter_index",
        (-default.terms(on_path)).alias("path_part"),
        F.try_divide(F.lit(hpi_as_of), F.col("hpi")).alias("price_ratio"),
        prepay_path.alias("prepay_part"),
    )
    quarters = range(1, horizon + 1)
    carried = book.withColumn("loan_part", _known(loan_part)).withColumn("prepay_loan", _known(prepay_loan))
    carried = carried.withColumn("ltv_known", _known(F.col("oltv").cast("double")))

    at = [
        _known(F.max(F.when(F.col("quarter_index") == t, F.col(name)))).alias(f"{short}_{t}")
        for t in quarters
        for name, short in (("path_part", "zd"), ("price_ratio", "pr"), ("prepay_part", "zp"))
    ]
    flat = points.groupBy("scenario").agg(*at)
    # A few numbers for each scenario, whatever the size of the book.
    rows = flat.agg(F.collect_list(F.struct("*")).alias("rows"))
    wide = carried.select("*", F.inline(rows.scalar())).withColumn("surv_0", F.lit(1.0))
    for t in quarters:
        moved = F.col("ltv_known") * F.col(f"pr_{t}")
        # ``least`` takes NaN for the largest number and would hide a hole in the prices behind the cap.
        ltv = F.when(F.isnan(moved), moved).otherwise(F.least(moved, F.lit(LTV_CAP)))
        hazard = sigmoid_of_negative(F.col("loan_part") + F.col(f"zd_{t}") + ltv_weight * ltv)
        leaving = (
            sigmoid_of_negative(F.col("prepay_loan") + F.col(f"zp_{t}"))
            if isinstance(prepay, Hazard)
            else F.col("prepay_loan")
        )
        left = F.lit(1.0) - F.col(f"haz_{t}") - leaving
        wide = wide.withColumn(f"haz_{t}", hazard).withColumn(
            f"surv_{t}", F.col(f"surv_{t - 1}") * F.greatest(left, F.lit(0.0))
        )
    return wide.select(
        *book.columns,
        "scenario",
        *[(F.col(f"surv_{t - 1}") * F.col(f"haz_{t}")).alias(f"def_{t}") for t in quarters],
        *[F.col(f"surv_{t}") for t in quarters],
    )


def loan_quarter_path(rolled: DataFrame, keep: list[str], horizon: int = HORIZON_Q) -> DataFrame:
    """The roll-forward in long form, one row per loan, scenario and quarter."""
    steps = F.array(
        *[
            F.struct(
                F.lit(t).alias("quarter_index"), F.col(f"def_{t}").alias("exp_default"), F.col(f"surv_{t}").alias("survival")
            )
            for t in range(1, horizon + 1)
        ]
    )
    return rolled.select(*keep, "scenario", F.inline(steps))


def by_quarter(rolled: DataFrame, paths: DataFrame, horizon: int = HORIZON_Q) -> DataFrame:
    """Book totals per scenario and quarter.

    Sums are taken over the wide rows, so each task emits one partial row per scenario; only that
    one row per scenario is turned into quarters.
    """
    quarters = range(1, horizon + 1)
    sums = rolled.groupBy("scenario").agg(
        F.count("*").alias("n_loans"),
        F.sum("orig_upb").alias("upb"),
        *[F.sum(f"surv_{t}").alias(f"s_{t}") for t in quarters],
        *[F.sum(f"def_{t}").alias(f"d_{t}") for t in quarters],
        *[F.sum(F.col(f"def_{t}") * F.col("orig_upb")).alias(f"u_{t}") for t in quarters],
    )
    steps = F.array(
        *[
            F.struct(
                F.lit(t).alias("quarter_index"),
                F.col(f"s_{t}").alias("alive"),
                F.col(f"d_{t}").alias("defaults"),
                F.col(f"u_{t}").alias("defaulted_upb"),
            )
            for t in quarters
        ]
    )
    long = sums.select("scenario", "n_loans", "upb", F.inline(steps))
    running = W.partitionBy("scenario").orderBy("quarter_index")
    long = long.withColumn("cum_defaults", F.sum("defaults").over(running)).withColumn(
        "cum_upb", F.sum("defaulted_upb").over(running)
    )
    labels = [name for name in ("quarter",) if name in paths.columns]
    points = paths.select("scenario", "quarter_index", *labels, "unemployment_rate", "hpi")
    return long.join(points, ["scenario", "quarter_index"]).select(
        "scenario",
        "quarter_index",
        *labels,
        round_half_up(F.col("unemployment_rate"), 2).alias("unemployment_rate"),
        round_half_up(F.col("hpi"), 1).alias("hpi_index"),
        round_half_up(F.col("alive") / F.col("n_loans"), 4).alias("surviving_frac"),
        round_half_up(F.lit(100.0) * F.col("defaults") / F.col("n_loans"), 4).alias("quarterly_default_rate_pct"),
        round_half_up(F.lit(100.0) * F.col("cum_defaults") / F.col("n_loans"), 4).alias("cumulative_default_rate_pct"),
        "defaulted_upb",
        F.round("cum_upb", 0).alias("cumulative_defaulted_upb"),
        F.round("upb", 0).alias("portfolio_upb0"),
        "n_loans",
    )


def by_loan(rolled: DataFrame, lgd: float, horizon: int = HORIZON_Q) -> DataFrame:
    """Expected default fraction and loss of each loan at the end of the horizon."""
    total = reduce(lambda a, b: a + b, [F.col(f"def_{t}") for t in range(1, horizon + 1)])
    drop = [f"{name}_{t}" for t in range(1, horizon + 1) for name in ("def", "surv")]
    return (
        rolled.withColumn("exp_default", total)
        .withColumn("exp_loss", F.col("exp_default") * F.col("orig_upb") * F.lit(lgd))
        .drop(*drop)
    )


def shock_grid(
    book: DataFrame,
    paths: DataFrame,
    lgd: float,
    default: Hazard = PUBLISHED_DEFAULT,
    prepay: float = CONSTANT_PREPAY,
    horizon: int = HORIZON_Q,
) -> DataFrame:
    """Default and loss of the whole book at each point of a what-if grid of paths."""
    loans = by_loan(roll_forward(book, paths, default, prepay, horizon), lgd, horizon)
    totals = loans.groupBy("scenario").agg(
        F.count("*").alias("loans"),
        F.avg("exp_default").alias("mean_default"),
        F.sum("exp_loss").alias("exp_loss"),
        F.sum("orig_upb").alias("upb"),
    )
    points = paths.select("scenario", "peak", "decline").distinct()
    return totals.join(points, "scenario").select(
        "peak",
        "decline",
        "loans",
        (F.lit(100.0) * F.col("mean_default")).alias("cumulative_default_pct"),
        (F.lit(100.0) * F.col("mean_default") * F.lit(lgd)).alias("cumulative_loss_pct"),
        F.try_divide(F.lit(100.0) * F.col("exp_loss"), F.col("upb")).alias("loss_rate_pct"),
        "exp_loss",
    )
