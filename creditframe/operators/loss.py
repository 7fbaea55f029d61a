"""Loss given default, expected loss and headline figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.functions.hazards import ASSUMED_LGD
from creditframe.functions.scalars import round_half_up


def lgd(
    target: DataFrame, floor: float = 0.12, cap: float = 0.80, min_n: int = 1000, fallback: float = ASSUMED_LGD
) -> DataFrame:
    """One row: the realised loss severity of defaulted loans, or the fallback where it is not credible."""
    loss_known = F.col("actual_loss") > 0
    totals = (
        target.where(F.col("default_flag") == 1)
        .agg(
            F.sum(F.when(loss_known, F.col("actual_loss")).otherwise(0.0)).alias("total_loss"),
            F.sum(F.when(loss_known, F.col("ead_upb"))).alias("total_ead"),
            F.count(F.when(loss_known, 1)).alias("n_with_loss"),
        )
        .withColumn(
            "empirical_lgd",
            F.when(F.col("total_ead") > 0, F.try_divide(F.col("total_loss"), F.col("total_ead"))),
        )
    )
    credible = (F.col("n_with_loss") >= min_n) & F.col("empirical_lgd").between(floor, cap)
    return totals.select(
        "total_loss",
        "total_ead",
        "n_with_loss",
        "empirical_lgd",
        F.when(credible, "empirical").otherwise("assumed").alias("method"),
        F.when(credible, F.col("empirical_lgd")).otherwise(fallback).alias("lgd"),
    )


def expected_loss(projection: DataFrame, lgd: float | Column) -> DataFrame:
    """Cumulative expected loss and its share of the opening book per scenario and quarter.

    ``lgd`` may be a number or a scalar subquery such as ``loss.lgd(target).select("lgd").scalar()``.
    """
    rate = lgd if isinstance(lgd, Column) else F.lit(lgd)
    return projection.withColumn("expected_loss", F.col("cumulative_defaulted_upb") * rate).withColumn(
        "cumulative_loss_rate_pct", F.try_divide(F.lit(100.0) * F.col("expected_loss"), F.col("portfolio_upb0"))
    )


def horizon_end(losses: DataFrame) -> DataFrame:
    """Last-quarter figures and the peak quarterly default rate of each scenario."""
    last = lambda name: F.max_by(name, "quarter_index").alias(name)
    return losses.groupBy("scenario").agg(
        F.max("quarter_index").alias("horizon_quarters"),
        F.max("quarterly_default_rate_pct").alias("peak_quarterly_default_pct"),
        last("cumulative_default_rate_pct"),
        last("cumulative_loss_rate_pct"),
        last("expected_loss"),
        last("portfolio_upb0"),
    )


def headline(losses: DataFrame, base: str = "baseline", severe: str = "severely_adverse") -> DataFrame:
    """One row with both scenarios' end figures and how many times the base loss the severe one is."""
    ends = horizon_end(losses)

    def of(scenario: str, name: str) -> Column:
        return F.max(F.when(F.col("scenario") == scenario, F.col(name)))

    floor = F.greatest(of(base, "cumulative_loss_rate_pct"), F.lit(1e-9))
    return ends.agg(
        F.max("portfolio_upb0").cast("bigint").alias("portfolio_upb"),
        F.max("horizon_quarters").alias("horizon_quarters"),
        round_half_up(of(base, "cumulative_default_rate_pct"), 2).alias("base_default_pct"),
        round_half_up(of(severe, "cumulative_default_rate_pct"), 2).alias("severe_default_pct"),
        round_half_up(of(base, "cumulative_loss_rate_pct"), 2).alias("base_loss_pct"),
        round_half_up(of(severe, "cumulative_loss_rate_pct"), 2).alias("severe_loss_pct"),
        F.floor(of(base, "expected_loss")).alias("base_loss_usd"),
        F.floor(of(severe, "expected_loss")).alias("severe_loss_usd"),
        round_half_up(of(severe, "cumulative_loss_rate_pct") / floor, 1).alias("severe_to_base"),
    )


def book_stats(book: DataFrame) -> DataFrame:
    """Size and average loan of a book."""
    return book.agg(
        F.count("*").alias("loans"),
        F.sum("orig_upb").alias("upb"),
        F.avg("fico").alias("fico"),
        F.avg("oltv").alias("oltv"),
        F.avg("odti").alias("odti"),
        F.avg("orig_rate").alias("orig_rate"),
    )
