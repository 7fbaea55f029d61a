"""The two supervisory macro scenarios, built from their published anchors."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditframe.functions.hazards import BASE_UNEMPLOYMENT, HORIZON_Q, HPI_AS_OF
from creditframe.functions.scalars import quarter_key_of_label, quarter_label, round_half_up
from creditframe.operators import macro

# Anchors {quarter_index: value} per scenario and variable, linear in between.
ANCHORS = {
    "baseline": {
        "unemployment_rate": {1: 4.6, 3: 4.6, 13: 4.2},
        "gdp_growth": {1: 1.4, 5: 2.1, 13: 2.0},
        "mortgage_rate": {1: 6.15, 11: 5.7, 13: 5.7},
    },
    "severely_adverse": {
        "unemployment_rate": {1: 5.6, 4: 8.2, 7: 10.0, 10: 9.4, 13: 8.6},
        "hpi": {1: 96.0, 4: 84.0, 8: 70.0, 13: 71.0},
        "mortgage_rate": {1: 6.4, 3: 6.5, 7: 5.9, 13: 5.4},
        "gdp_growth": {1: -6.5, 3: -7.5, 6: 0.0, 9: 4.0, 13: 3.5},
    },
}
BASELINE_HPI_GROWTH_PCT = 2.0
FIRST_QUARTER = "2026Q1"
VARIABLES = ["unemployment_rate", "hpi", "hpi_yoy", "mortgage_rate", "gdp_growth"]


def _rows(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    values = ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else f"{x}" for x in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def scenario_long(spark: SparkSession, horizon: int = HORIZON_Q) -> DataFrame:
    """Scenario values as (scenario, quarter, quarter_index, variable, value)."""
    anchors = _rows(
        spark,
        [
            (scenario, variable, t, f"{value}")
            for scenario, variables in ANCHORS.items()
            for variable, points in variables.items()
            for t, value in points.items()
        ],
        "scenario, variable, quarter_index, value",
    ).withColumn("value", F.col("value").cast("double"))
    paths = macro.interpolate(anchors, horizon, ["scenario", "variable"], t="quarter_index")
    grid = spark.range(1, horizon + 1).select(
        F.lit("baseline").alias("scenario"),
        F.lit("hpi").alias("variable"),
        F.col("id").cast("int").alias("quarter_index"),
        F.lit(BASELINE_HPI_GROWTH_PCT).alias("growth"),
    )
    rising = macro.compound_index(grid, "growth", "value", by=["scenario"], order="quarter_index", start=HPI_AS_OF)
    paths = paths.unionByName(rising.drop("growth"))
    prices = macro.yoy(
        paths.where(F.col("variable") == "hpi"), "value", "growth", by=["scenario"], order="quarter_index", base=HPI_AS_OF
    )
    growth = prices.select("scenario", F.lit("hpi_yoy").alias("variable"), "quarter_index", F.col("growth").alias("value"))
    first = quarter_key_of_label(F.lit(FIRST_QUARTER))
    return paths.unionByName(growth).select(
        "scenario",
        quarter_label(first + F.col("quarter_index") - F.lit(1)).alias("quarter"),
        "quarter_index",
        "variable",
        round_half_up(F.col("value"), 3).alias("value"),
    )


def scenario_paths(spark: SparkSession, horizon: int = HORIZON_Q) -> DataFrame:
    """One row per scenario and quarter with all variables side by side."""
    return macro.widen(scenario_long(spark, horizon), ["scenario", "quarter_index", "quarter"], VARIABLES)


def shock_paths(
    spark: SparkSession, peaks: list[float], declines: list[float], horizon: int = HORIZON_Q
) -> DataFrame:
    """A grid of what-if paths: unemployment ramps to a peak over 7 quarters, prices fall over 8."""
    t = F.col("quarter_index")
    base = F.lit(BASE_UNEMPLOYMENT)
    points = _rows(spark, [(f"{u}", f"{d}") for u in peaks for d in declines], "u, d").selectExpr(
        "double(u) AS peak", "double(d) AS decline"
    )
    grid = points.select("peak", "decline", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("quarter_index"))
    return grid.select(
        F.concat_ws("/", F.col("peak").cast("string"), F.col("decline").cast("string")).alias("scenario"),
        "peak",
        "decline",
        "quarter_index",
        (base + (F.col("peak") - base) * F.least(t, F.lit(7)) / F.lit(7.0)).alias("unemployment_rate"),
        (F.lit(HPI_AS_OF) * (F.lit(1.0) - F.col("decline") / F.lit(100.0) * F.least(t, F.lit(8)) / F.lit(8.0))).alias("hpi"),
    )
