"""The loan-quarter panel that the hazards are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.scalars import (
    DEFAULT_STATUS,
    PREPAY_CODE,
    as_int,
    current_ltv,
    is_credit_event,
    origination_quarter_of_key,
    quarter_key,
)
from creditframe.operators.target import LOAN

PANEL_FEATURES = ["fico", "oltv", "odti", "orig_rate"]


def loan_quarters(perf: DataFrame) -> DataFrame:
    """Months rolled up to loan-quarters.

    Each task folds its months before the shuffle, so a loan arrives as at most one row per task and
    quarter. Partitioning by the loan beforehand would save the later window its shuffle but send
    every raw month over the network, and all months of one loan to one task.
    """
    return perf.groupBy(LOAN, quarter_key(F.col("monthly_reporting_period")).alias("quarter_key")).agg(
        F.max(as_int(F.col("current_delinquency_status"))).alias("max_dq"),
        F.max(F.when(is_credit_event(), 1).otherwise(0)).alias("credit_event"),
        F.max(F.when(F.col("zero_balance_code") == PREPAY_CODE, 1).otherwise(0)).alias("prepaid"),
        F.min("loan_age").alias("age_m"),
    )


def stop_at_event(quarters: DataFrame) -> DataFrame:
    """Keep each loan up to its first default or prepayment quarter, with the event flags.

    The window is over one loan's quarters, which the calendar bounds.
    """
    loan = W.partitionBy(LOAN)
    defaulted = (F.col("max_dq") >= DEFAULT_STATUS) | (F.col("credit_event") == 1)
    first_default = F.min(F.when(defaulted, F.col("quarter_key"))).over(loan)
    first_prepay = F.min(F.when(F.col("prepaid") == 1, F.col("quarter_key"))).over(loan)
    marked = quarters.select(
        "*",
        first_default.alias("def_q"),
        first_prepay.alias("pp_q"),
        F.max("quarter_key").over(loan).alias("last_q"),
    )
    return marked.where(F.col("quarter_key") <= F.least("def_q", "pp_q", "last_q")).select(
        LOAN,
        "quarter_key",
        "age_m",
        F.coalesce((F.col("quarter_key") == F.col("def_q")).cast("int"), F.lit(0)).alias("default_event"),
        F.coalesce((F.col("quarter_key") == F.col("pp_q")).cast("int"), F.lit(0)).alias("prepay_event"),
    )


def hazard_panel(perf: DataFrame, features: DataFrame, macro: DataFrame) -> DataFrame:
    """One row per loan and quarter until the stop quarter, with loan and macro covariates.

    ``features`` needs the origination columns only. ``macro`` has one row per ``quarter_key`` and is
    joined twice, at the current and at the origination quarter.
    """
    # One row for each quarter of the calendar, however long the input is. Of several rows of one quarter
    # the least (compared column by column) counts, so the choice is the same in every run.
    others = [c for c in macro.columns if c != "quarter_key"]
    one = macro.groupBy("quarter_key").agg(F.min(F.struct(*others)).alias("_row")).select("quarter_key", "_row.*")
    macro = F.broadcast(one)
    now = macro.select(
        "quarter_key", "unemployment_rate", "hpi_yoy", "mortgage_rate", F.col("hpi").alias("hpi_now")
    )
    then = macro.select(F.col("quarter_key").alias("orig_quarter_key"), F.col("hpi").alias("hpi_orig"))
    age_q = F.col("age_m") / F.lit(3.0)
    rows = (
        stop_at_event(loan_quarters(perf))
        .join(features.select(LOAN, *PANEL_FEATURES), LOAN)
        .withColumn("orig_quarter_key", origination_quarter_of_key(F.col(LOAN)))
        .join(now, "quarter_key")
        .join(then, "orig_quarter_key")
    )
    return rows.select(
        LOAN,
        F.floor(F.col("quarter_key") / F.lit(4.0)).cast("int").alias("cal_year"),
        (F.col("quarter_key") % F.lit(4) + F.lit(1)).alias("cal_q"),
        "quarter_key",
        age_q.alias("loan_age_q"),
        (age_q * age_q).alias("loan_age_q_sq"),
        "default_event",
        "prepay_event",
        *PANEL_FEATURES,
        "unemployment_rate",
        "hpi_yoy",
        "mortgage_rate",
        ((F.try_divide("hpi_now", "hpi_orig") - F.lit(1.0)) * F.lit(100.0)).alias("hpi_growth_since_orig"),
        current_ltv(F.col("oltv"), F.col("hpi_orig"), F.col("hpi_now")).alias("current_ltv"),
    )


def rate_by_quarter(panel: DataFrame) -> DataFrame:
    return panel.groupBy("cal_year", "cal_q").agg(
        F.count("*").alias("loans"),
        F.avg("default_event").alias("default_rate"),
        F.avg("unemployment_rate").alias("unemployment_rate"),
    )


def panel_summary(panel: DataFrame) -> DataFrame:
    """Rows, loans and raw hazards; counts per loan first, which keeps the panel's loan partitioning."""
    per_loan = panel.groupBy(LOAN).agg(
        F.count("*").alias("n"), F.sum("default_event").alias("d"), F.sum("prepay_event").alias("p")
    )
    return per_loan.agg(
        F.sum("n").alias("panel_rows"),
        F.count("*").alias("loans"),
        F.sum("d").alias("default_events"),
        F.sum("p").alias("prepay_events"),
        (F.sum("d") / F.sum("n")).alias("default_hazard"),
        (F.sum("p") / F.sum("n")).alias("prepay_hazard"),
    )
