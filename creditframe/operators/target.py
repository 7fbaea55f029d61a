"""Default target with prepayment as a competing outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.functions.scalars import (
    DEFAULT_STATUS,
    PREPAY_CODE,
    as_int,
    is_credit_event,
    mean_percent,
    round_half_up,
)

LOAN = "loan_sequence_number"


def performance_summary(perf: DataFrame) -> DataFrame:
    """One row per loan from its monthly history.

    All measures are fixed-width MIN/MAX states, so each task folds its rows first and only one
    partial row per loan and task is shuffled, however many months one loan has.
    """
    status = as_int(F.col("current_delinquency_status"))
    ended = F.coalesce(F.col("zero_balance_code") != "", F.lit(False))

    def flag(condition: Column) -> Column:
        return F.max(F.when(condition, 1).otherwise(0))

    return perf.groupBy(LOAN).agg(
        F.max(status).alias("max_dq"),
        F.max("loan_age").alias("last_age"),
        flag(is_credit_event()).alias("credit_event_zb"),
        flag(F.col("zero_balance_code") == PREPAY_CODE).alias("prepay_zb"),
        flag(ended).alias("any_termination"),
        F.max(F.when(ended, F.col("loan_age"))).alias("term_age"),
        F.max(F.when(ended, F.col("zero_balance_effective_date"))).alias("term_period"),
        F.min(F.when(status >= DEFAULT_STATUS, F.col("loan_age"))).alias("first_180_age"),
        F.max("zero_balance_removal_upb").alias("ead_upb"),
        F.max("actual_loss_calculation").alias("actual_loss"),
    ).withColumn(
        "default_flag",
        F.when((F.col("max_dq") >= DEFAULT_STATUS) | (F.col("credit_event_zb") == 1), 1).otherwise(0),
    )


def outcome_columns() -> dict[str, Column]:
    """Target columns computed from a left-joined summary; all NULL-safe for loans without history."""
    return {
        "default_flag": F.col("default_flag"),
        "prepaid_flag": F.col("prepay_zb"),
        "outcome": F.when(F.col("default_flag") == 1, "default")
        .when(F.col("prepay_zb") == 1, "prepaid")
        .otherwise("active_or_censored"),
        "months_to_event": F.coalesce("first_180_age", "term_age", "last_age"),
        "last_age": F.col("last_age"),
        "ead_upb": F.col("ead_upb"),
        "actual_loss": F.col("actual_loss"),
    }


def loan_target(orig: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per originated loan; flags stay NULL for a loan without performance rows."""
    joined = orig.select(LOAN, "vintage_year", "first_payment_date").join(summary, LOAN, "left")
    return joined.select(
        LOAN,
        "vintage_year",
        "first_payment_date",
        *[column.alias(name) for name, column in outcome_columns().items()],
    )


def target_summary(target: DataFrame) -> DataFrame:
    return target.agg(
        F.count("*").alias("loans"),
        F.sum("default_flag").alias("defaults"),
        round_half_up(mean_percent(F.col("default_flag")), 2).alias("default_rate_pct"),
        F.sum("prepaid_flag").alias("prepaid"),
        round_half_up(mean_percent(F.col("prepaid_flag")), 2).alias("prepay_rate_pct"),
    )
