"""Portfolio reports: snapshot, vintages, band grids, seasoning, states and worst status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.bands import FICO_REPORT, LTV_REPORT, WORST_STATUS, WORST_STATUS_UNKNOWN, band
from creditframe.functions.scalars import as_int, is_default_month, mean_percent, percent, round_half_up
from creditframe.operators.target import LOAN


def snapshot(features: DataFrame) -> DataFrame:
    """Headline counts, rates and averages; the features already carry the outcome flags."""
    return features.agg(
        F.count("*").alias("loans"),
        round_half_up(mean_percent(F.col("default_flag")), 2).alias("default_rate_pct"),
        round_half_up(mean_percent(F.col("prepaid_flag")), 2).alias("prepay_rate_pct"),
        round_half_up(F.avg("fico"), 0).alias("avg_fico"),
        round_half_up(F.avg("oltv"), 1).alias("avg_oltv"),
        round_half_up(F.avg("odti"), 1).alias("avg_dti"),
    )


def vintage_table(features: DataFrame) -> DataFrame:
    return features.groupBy("vintage").agg(
        F.count("*").alias("loans"),
        F.sum("default_flag").alias("n_default"),
        round_half_up(mean_percent(F.col("default_flag")), 2).alias("default_rate_pct"),
        round_half_up(mean_percent(F.col("prepaid_flag")), 2).alias("prepay_rate_pct"),
    )


def vintage_crosstab(features: DataFrame) -> DataFrame:
    """Loans per vintage and default flag, with the share of each flag in its vintage."""
    counts = features.groupBy("vintage").agg(
        F.count(F.when(F.col("default_flag") == 0, 1)).alias("performing"),
        F.count(F.when(F.col("default_flag") == 1, 1)).alias("defaulted"),
        F.count("default_flag").alias("known"),
    )
    return counts.select(
        "vintage",
        "performing",
        "defaulted",
        round_half_up(percent(F.col("performing"), F.col("known")), 2).alias("performing_pct"),
        round_half_up(percent(F.col("defaulted"), F.col("known")), 2).alias("defaulted_pct"),
    )


def band_grid(features: DataFrame, fico_bands=FICO_REPORT, ltv_bands=LTV_REPORT) -> DataFrame:
    return features.groupBy(
        band(F.col("fico"), fico_bands).alias("fico_band"),
        band(F.col("oltv"), ltv_bands).alias("ltv_band"),
    ).agg(
        F.count("*").alias("loans"),
        round_half_up(mean_percent(F.col("default_flag")), 2).alias("default_rate_pct"),
    )


def seasoning(perf: DataFrame, features: DataFrame, max_q: int = 20) -> DataFrame:
    """Running share of each vintage in default by loan-age quarter.

    Performance is folded to one row per loan before it meets the features, and loans without a
    default in the age range leave there. The running window sees vintages x ages rows only.
    """
    first = (
        perf.groupBy(LOAN)
        .agg(F.min(F.when(is_default_month(), F.col("loan_age"))).alias("age"))
        .select(LOAN, F.floor(F.col("age") / F.lit(3.0)).cast("int").alias("age_q"))
        .where(F.col("age_q").between(0, max_q))
    )
    by_age = first.join(features.select(LOAN, "vintage"), LOAN).groupBy("vintage", "age_q").agg(
        F.count("*").alias("n_def")
    )
    size = features.groupBy("vintage").agg(F.count("*").alias("loans"))
    running = F.sum("n_def").over(W.partitionBy("vintage").orderBy("age_q"))
    return by_age.join(size, "vintage").select(
        "vintage",
        "age_q",
        "n_def",
        round_half_up(percent(running, F.col("loans")), 3).alias("cum_default_pct"),
    )


def top_states(features: DataFrame, min_loans: int = 1000, n: int = 15) -> DataFrame:
    """States ranked by default rate; ties share a rank, so the row limit breaks them by name."""
    states = (
        features.groupBy("state")
        .agg(
            F.count("*").alias("loans"),
            round_half_up(mean_percent(F.col("default_flag")), 2).alias("default_rate_pct"),
        )
        .where(F.col("loans") >= min_loans)
    )
    # One row per state reaches this window.
    rank = F.rank().over(W.orderBy(F.col("default_rate_pct").desc_nulls_last()))
    return states.withColumn("risk_rank", rank).orderBy("risk_rank", "state").limit(n)


def worst_status(perf: DataFrame) -> DataFrame:
    """Loans by the worst delinquency they ever reached, with the share of all loans."""
    worst = perf.groupBy(LOAN).agg(F.max(as_int(F.col("current_delinquency_status"))).alias("max_dq"))
    label = F.when(F.col("max_dq") >= 0, band(F.col("max_dq"), WORST_STATUS)).otherwise(WORST_STATUS_UNKNOWN)
    counts = worst.groupBy(label.alias("worst_status")).agg(F.count("*").alias("loans"))
    # At most five rows reach this window.
    total = F.sum("loans").over(W.partitionBy())
    return counts.withColumn("pct_of_book", round_half_up(percent(F.col("loans"), total), 2))


def migration_matrix(perf: DataFrame) -> DataFrame:
    """Moves between delinquency bands from one month to the next, with the share of each start band.

    Rows are folded to one per loan and month first, so the window over a loan is bounded by the
    calendar. A pair counts when both months are reported.
    """
    period = F.col("monthly_reporting_period")
    month = F.floor(period / F.lit(100.0)).cast("int") * F.lit(12) + period % F.lit(100)
    months = perf.groupBy(LOAN, month.alias("month")).agg(
        F.max(as_int(F.col("current_delinquency_status"))).alias("dq")
    )
    label = F.when(F.col("dq") >= 0, band(F.col("dq"), WORST_STATUS)).otherwise(WORST_STATUS_UNKNOWN)
    following = W.partitionBy(LOAN).orderBy("month")
    moves = months.select("month", label.alias("from_status"), LOAN).select(
        "from_status",
        F.lead("from_status").over(following).alias("to_status"),
        (F.lead("month").over(following) - F.col("month")).alias("gap"),
    )
    counts = moves.where(F.col("gap") == 1).groupBy("from_status", "to_status").agg(F.count("*").alias("n"))
    # At most 25 rows reach this window.
    start = F.sum("n").over(W.partitionBy("from_status"))
    return counts.withColumn("share_pct", round_half_up(percent(F.col("n"), start), 2))
