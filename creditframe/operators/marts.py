"""Star-schema marts over the projection and the segment losses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.scalars import round_half_up

PROJECTION_MEASURES = [
    "quarter", "quarter_index", "unemployment_rate", "hpi_index", "quarterly_default_rate_pct",
    "cumulative_default_rate_pct", "cumulative_loss_rate_pct", "expected_loss",
]


def dim_scenario(projection: DataFrame) -> DataFrame:
    """One row per scenario with its unemployment peak and house-price trough (NULL if prices never fall)."""
    trough = F.min("hpi_index") - F.lit(100.0)
    peaks = projection.groupBy("scenario").agg(
        F.max("unemployment_rate").alias("peak_unemployment_pct"),
        F.when(trough < 0, trough).alias("hpi_trough_pct"),
    )
    # One row per scenario reaches this window.
    number = F.row_number().over(W.orderBy("scenario"))
    return peaks.select(
        number.alias("scenario_id"),
        "scenario",
        F.initcap(F.replace("scenario", F.lit("_"), F.lit(" "))).alias("scenario_label"),
        "peak_unemployment_pct",
        "hpi_trough_pct",
    )


def _with_id(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Scenario name replaced by its key, NULL where the dimension lacks it."""
    return fact.join(dim.select("scenario", "scenario_id"), "scenario", "left").drop("scenario")


def fact_projection(losses: DataFrame, dim: DataFrame) -> DataFrame:
    return _with_id(losses.select("scenario", *PROJECTION_MEASURES), dim)


def fact_segment(report: DataFrame, dim: DataFrame) -> DataFrame:
    return _with_id(report, dim)


def measures(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Report measures: mean loss rate, horizon-end loss and the severe-to-base ratio.

    ``expected_loss`` is cumulative, so the loss measure is each scenario's last value, not its sum.
    """
    rows = fact.join(dim, "scenario_id")
    per_scenario = rows.groupBy("scenario", "scenario_label").agg(
        F.avg("cumulative_loss_rate_pct").alias("mean_loss_rate_pct"),
        F.max_by("expected_loss", "quarter_index").alias("expected_loss"),
    )
    # One row per scenario reaches this window.
    base = F.max(F.when(F.col("scenario") == "baseline", F.col("mean_loss_rate_pct"))).over(W.partitionBy())
    return per_scenario.withColumn("times_base", F.try_divide("mean_loss_rate_pct", base))


def series_bundle(losses: DataFrame) -> DataFrame:
    """One row per scenario with its quarterly series as arrays; the horizon bounds their length."""
    point = F.struct(
        "quarter_index",
        "quarter",
        round_half_up(F.col("cumulative_default_rate_pct"), 3).alias("cum_default_pct"),
        round_half_up(F.col("cumulative_loss_rate_pct"), 3).alias("cum_loss_pct"),
        round_half_up(F.col("quarterly_default_rate_pct"), 4).alias("quarterly_default_pct"),
        F.col("unemployment_rate").alias("unemployment"),
    )
    rows = losses.groupBy("scenario").agg(F.sort_array(F.collect_list(point)).alias("points"))
    names = ["quarter", "cum_default_pct", "cum_loss_pct", "quarterly_default_pct", "unemployment"]
    return rows.select("scenario", *[F.col(f"points.{name}").alias(name) for name in names])
