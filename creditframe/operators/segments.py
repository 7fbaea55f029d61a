"""Projected loss by risk segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.bands import FICO_MART, LTV_MART, Bands, band, band_rank

DIMENSIONS = ["fico_band", "ltv_band", "loan_purpose"]
_SUMS = ["loans", "upb", "exp_loss", "exp_default"]


def with_bands(book: DataFrame) -> DataFrame:
    return book.withColumn("fico_band", band(F.col("fico"), FICO_MART)).withColumn(
        "ltv_band", band(F.col("oltv"), LTV_MART)
    )


def cells(per_loan: DataFrame, dims=(*DIMENSIONS, "state")) -> DataFrame:
    """Additive sums per combination of all dimensions.

    One pass over the loans serves every segment report: the combinations are few, so tasks fold
    their loans to them before the shuffle and the reports below read the folded rows only.
    """
    return per_loan.groupBy("scenario", *dims).agg(
        F.count("*").alias("loans"),
        F.sum("orig_upb").alias("upb"),
        F.sum("exp_loss").alias("exp_loss"),
        F.sum("exp_default").alias("exp_default"),
    )


def loss_by_segment(cells: DataFrame, dims=DIMENSIONS) -> DataFrame:
    """Loss and default rates per scenario, dimension and segment; unknown segments are left out."""
    labels = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("segment")) for d in dims])
    rows = cells.select("scenario", *_SUMS, F.inline(labels)).where(F.col("segment").isNotNull())
    sums = rows.groupBy("scenario", "dimension", "segment").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return sums.select(
        "scenario",
        "dimension",
        "segment",
        "loans",
        "upb",
        "exp_loss",
        F.try_divide(F.lit(100.0) * F.col("exp_loss"), F.col("upb")).alias("loss_rate_pct"),
        (F.lit(100.0) * F.col("exp_default") / F.col("loans")).alias("default_rate_pct"),
    )


def keep_largest(report: DataFrame, dimension: str, n: int) -> DataFrame:
    """The ``n`` segments of one dimension with the largest exposure, all rows of the others.

    The choice is made on the finished report, one row per segment, so the loans are read once. Every
    scenario holds the same book and hence keeps the same segments.
    """
    by_exposure = W.partitionBy("scenario", "dimension").orderBy(F.col("upb").desc(), "segment")
    ranked = report.withColumn("_rank", F.row_number().over(by_exposure))
    return ranked.where((F.col("dimension") != dimension) | (F.col("_rank") <= n)).drop("_rank")


def loss_by_top_states(cells: DataFrame, n: int = 10) -> DataFrame:
    return keep_largest(loss_by_segment(cells, ["state"]), "state", n)


def segment_report(cells: DataFrame, n_states: int = 10) -> DataFrame:
    """All dimensions and the largest states in one table."""
    return keep_largest(loss_by_segment(cells, [*DIMENSIONS, "state"]), "state", n_states)


def segment_view(report: DataFrame, scenario: str, dimension: str, bands: Bands) -> DataFrame:
    """One dimension of one scenario in band order."""
    rows = report.where((F.col("scenario") == scenario) & (F.col("dimension") == dimension))
    return rows.withColumn("position", band_rank(F.col("segment"), bands)).orderBy("position")


def top_states_by_loss(report: DataFrame, scenario: str, n: int = 10) -> DataFrame:
    rows = report.where((F.col("scenario") == scenario) & (F.col("dimension") == "state"))
    return rows.orderBy(F.col("exp_loss").desc(), "segment").limit(n)
