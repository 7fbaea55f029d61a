"""Batch scorecard for applicant tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.functions.scalars import percent, sigmoid

# Scorecard weights, points and cut-offs.
INTERCEPT = -1.55
PAY_WEIGHT = 0.62
LIMIT_WEIGHT, LIMIT_CENTRE = -0.0000030, 150000.0
AGE_WEIGHT, AGE_CENTRE = -0.010, 35.0
EDUCATION_POINTS = {1: -0.15, 2: 0.0, 3: 0.12, 4: 0.05}
MARITAL_POINTS = {1: 0.05, 2: 0.0, 3: 0.03}
RED_PD, AMBER_PD = 0.30, 0.12
LGD = 0.45
NEUTRAL_BELOW = 0.001
REASON_LABELS = ["Recent repayment status", "Credit limit", "Age", "Education", "Marital status"]


def _points(code: Column, table: dict[int, float]) -> Column:
    """Points of a code; an unlisted code gets none."""
    expr = F
    for value, points in table.items():
        expr = expr.when(code == value, F.lit(points))
    return expr.otherwise(F.lit(0.0))


def parts() -> list[Column]:
    """Log-odds contributions in the order of ``REASON_LABELS``."""
    return [
        F.lit(PAY_WEIGHT) * F.col("pay_status"),
        F.lit(LIMIT_WEIGHT) * (F.col("limit") - F.lit(LIMIT_CENTRE)),
        F.lit(AGE_WEIGHT) * (F.col("age") - F.lit(AGE_CENTRE)),
        _points(F.col("education"), EDUCATION_POINTS),
        _points(F.col("marital"), MARITAL_POINTS),
    ]


def score_applicants(df: DataFrame, threshold: float) -> DataFrame:
    """PD, decision, colour and expected loss of every applicant; a narrow projection."""
    total = F.lit(INTERCEPT)
    for part in parts():
        total = total + part
    scored = df.withColumn("pd", sigmoid(total))
    return (
        scored.withColumn("decision", F.when(F.col("pd") >= threshold, "REVIEW / DECLINE").otherwise("APPROVE"))
        .withColumn("colour", F.when(F.col("pd") >= RED_PD, "red").when(F.col("pd") >= AMBER_PD, "amber").otherwise("green"))
        .withColumn("expected_loss", F.col("pd") * F.lit(LGD) * F.col("limit"))
    )


def reason_codes(df: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` largest contributions of each applicant, ties in the order of the labels."""
    entries = []
    for position, (label, part) in enumerate(zip(REASON_LABELS, parts())):
        direction = F.when(part > NEUTRAL_BELOW, "raises").when(part < -NEUTRAL_BELOW, "lowers").otherwise("neutral")
        entries.append(
            F.struct(
                (-F.abs(part)).alias("order"),
                F.lit(position).alias("position"),
                F.lit(label).alias("reason"),
                direction.alias("direction"),
            )
        )
    top = F.slice(F.sort_array(F.array(*entries)), 1, n)
    return df.withColumn("reasons", F.transform(top, lambda e: F.struct(e["reason"], e["direction"])))


def portfolio_loss(scored: DataFrame) -> DataFrame:
    """Totals per decision: applicants, limits, expected loss and loss rate."""
    return scored.groupBy("decision").agg(
        F.count("*").alias("applicants"),
        F.sum("limit").alias("limit"),
        F.sum("expected_loss").alias("expected_loss"),
        percent(F.sum("expected_loss"), F.sum("limit")).alias("loss_rate_pct"),
        F.avg("pd").alias("mean_pd"),
    )
