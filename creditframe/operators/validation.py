"""Exact ranking and calibration metrics of a score.

All of them follow from one table: the distinct scores with their positives and negatives and how
many of each lie above. ``rank_table`` builds it without putting the scores in one ordered task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets are ``SIDE * SIDE`` ranges of scores; a parameter of ``rank_table``.
SIDE = 32


def rank_table(
    df: DataFrame, y: str, score: str, by: str | None = None, measures: dict[str, Column] | None = None, side: int = SIDE
) -> DataFrame:
    """Per distinct score: n, pos, neg, the counts above it and the totals of its group.

    ``measures`` names further additive columns, carried the same way as ``pos`` and ``neg``. ``side``
    sets the number of buckets (``side * side``), which only spreads the work: results are the same.

    1. Equal scores are folded first, so a score that many rows share is one row.
    2. Approximate quantiles of the distinct scores cut them into buckets of similar size. They only
       balance the work: any cut keeps equal scores together and buckets in score order.
    3. Bucket totals give each bucket its offset; a window inside the bucket adds the rest.

    The window and the join with the offsets share one partitioning by (group, bucket).
    """
    keys = [by] if by else []
    folded = (
        df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(
            F.sum(F.col(y).cast("bigint")).alias("pos"),
            F.sum((F.lit(1) - F.col(y)).cast("bigint")).alias("neg"),
            *[F.sum(column).alias(name) for name, column in (measures or {}).items()],
        )
    )
    names = ["pos", "neg", *(measures or {})]
    _SIDE, BUCKETS = side, side * side  # noqa: N806
    quantiles = F.expr("array(" + ", ".join(f"{k / BUCKETS}D" for k in range(1, BUCKETS)) + ")")
    # The sums keep the columns of this aggregate's input equal to those of the main branch, which
    # lets Spark reuse the fold for both.
    edges = folded.agg(
        F.percentile_approx("score", quantiles).alias("fine"),
        *[F.sum(name).alias(name) for name in names],
    ).select(
        F.struct(
            "fine",
            F.transform(F.sequence(F.lit(1), F.lit(_SIDE - 1)), lambda j: F.get("fine", j * _SIDE - 1)).alias("coarse"),
            *names,
        ).alias("edges")
    )
    # Two short searches of side - 1 edges instead of one over side * side - 1. The bucket is never NULL, and saying so
    # keeps the optimiser from testing it on the rows below the fold.
    known = lambda size: F.coalesce(size, F.lit(0))
    cut = folded.withColumn("edges", edges.scalar())
    cut = cut.withColumn("coarse", known(F.size(F.filter("edges.coarse", lambda e: e < F.col("score")))))
    near = F.slice("edges.fine", F.col("coarse") * _SIDE + 1, F.lit(_SIDE - 1))
    fine = known(F.size(F.filter(near, lambda e: e < F.col("score"))))
    cut = cut.select(*keys, "score", *names, known(F.col("coarse") * _SIDE + fine).alias("bucket"))

    group = W.partitionBy(*keys)
    higher_buckets = group.orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    # At most BUCKETS rows per group reach these windows.
    totals = cut.groupBy(*keys, "bucket").agg(*[F.sum(name).alias(f"b_{name}") for name in names])
    offsets = totals.select(
        *keys,
        "bucket",
        *[F.coalesce(F.sum(f"b_{name}").over(higher_buckets), F.lit(0)).alias(f"{name}_before") for name in names],
        *[F.sum(f"b_{name}").over(group).alias(f"{name}_total") for name in names],
    )
    inside = W.partitionBy(*keys, "bucket").orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)
    ranked = cut.select(
        "*", *[F.coalesce(F.sum(name).over(inside), F.lit(0)).alias(f"{name}_in") for name in names]
    )
    # A group may be NULL.
    named = offsets.select([F.col(c).alias(f"_{c}") if c in (*keys, "bucket") else F.col(c) for c in offsets.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "bucket")]
    return ranked.join(named, same).select(
        *keys,
        "score",
        (F.col("pos") + F.col("neg")).alias("n"),
        *names,
        *[(F.col(f"{name}_before") + F.col(f"{name}_in")).alias(f"{name}_above") for name in names],
        *[f"{name}_total" for name in names],
    )


def rank_metrics(df: DataFrame, y: str, score: str, by: str | None = None) -> DataFrame:
    """ROC AUC, Gini, KS, PR-AUC, Brier score and base rate, per group where one is named."""
    hits = F.col("pos_above") + F.col("pos")
    alarms = F.col("neg_above") + F.col("neg")
    p, n = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    s = F.col("score")
    table = rank_table(df, y, score, by)
    sums = table.groupBy(*([by] if by else [])).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("positives"),
        F.sum(F.try_divide(F.col("neg") * (F.col("pos_above") + F.col("pos") / F.lit(2.0)), p * n)).alias("roc_auc"),
        F.max(F.try_divide(hits, p) - F.try_divide(alarms, n)).alias("ks"),
        F.sum(F.try_divide(F.col("pos"), p) * (hits / (hits + alarms))).alias("pr_auc"),
        F.sum(F.col("pos") * (F.lit(1.0) - s) * (F.lit(1.0) - s) + F.col("neg") * s * s).alias("squares"),
    )
    return sums.select(
        *([by] if by else []),
        "n",
        F.try_divide(F.col("positives"), F.col("n")).alias("base_rate"),
        "roc_auc",
        (F.lit(2.0) * F.col("roc_auc") - F.lit(1.0)).alias("gini"),
        "ks",
        "pr_auc",
        F.try_divide(F.col("squares"), F.col("n")).alias("brier"),
    )


def quantile_edges(table: DataFrame, bins: int) -> DataFrame:
    """One row with the inner quantile edges of the scores, exact and linearly interpolated.

    Each edge lies between two order statistics. The rank table says which scores hold them, so only
    those few rows are picked out; nothing is collected per quantile.
    """
    total = F.col("pos_total") + F.col("neg_total")
    start = total - F.col("pos_above") - F.col("neg_above") - F.col("n")
    wanted = []
    for j in range(1, bins):
        at = (total - 1) * F.lit(float(j)) / F.lit(float(bins))
        wanted += [
            F.struct(F.lit(j).alias("j"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"), at.alias("at"))
            for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at)))
        ]
    held = F.filter(F.array(*wanted), lambda w: w["rank"].between(F.col("first"), F.col("first") + F.col("n") - 1))
    points = table.withColumn("first", start).select("score", F.inline(held))
    sides = points.groupBy("j").agg(
        F.max(F.when(F.col("side") == "lo", F.col("score"))).alias("lo"),
        F.max(F.when(F.col("side") == "hi", F.col("score"))).alias("hi"),
        F.max("at").alias("at"),
    )
    edge = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return sides.agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def reliability(df: DataFrame, y: str, score: str, bins: int = 10) -> DataFrame:
    """Mean predicted against observed rate in quantile bins; an edge belongs to the bin below it."""
    table = rank_table(df, y, score)
    edges = quantile_edges(table, bins).scalar()
    placed = table.withColumn("edges", edges)
    placed = placed.withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("score"))))
    return placed.groupBy("bin").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum(F.col("score") * F.col("n")), F.sum("n")).alias("mean_predicted"),
        F.try_divide(F.sum("pos"), F.sum("n")).alias("observed_rate"),
    )


def deciles(df: DataFrame, y: str, score: str, groups: int = 10) -> DataFrame:
    """Observed rate by score group from the highest down; tied scores share their mean rank."""
    total = F.col("pos_total") + F.col("neg_total")
    mean_rank = F.col("pos_above") + F.col("neg_above") + (F.col("n") + F.lit(1)) / F.lit(2.0)
    place = F.floor(mean_rank * F.lit(float(groups)) / (total + F.lit(1))).cast("int")
    return rank_table(df, y, score).groupBy(place.alias("decile")).agg(
        F.sum("n").alias("loans"),
        F.sum("pos").alias("defaults"),
        F.try_divide(F.lit(100.0) * F.sum("pos"), F.sum("n")).alias("default_rate_pct"),
    )


def choose_threshold(
    df: DataFrame, y: str, score: str, loss: Column, exposure: Column, max_loss_rate: float
) -> DataFrame:
    """The cut-off with the largest TPR - FPR whose accepted rows keep within a loss rate.

    Rows at or above the cut-off are declined. Every distinct score is tried; the result is one row.
    """
    table = rank_table(df, y, score, measures={"loss": loss, "exposure": exposure})
    tpr = F.try_divide(F.col("pos_above") + F.col("pos"), F.col("pos_total"))
    fpr = F.try_divide(F.col("neg_above") + F.col("neg"), F.col("neg_total"))
    below = {name: F.col(f"{name}_total") - F.col(f"{name}_above") - F.col(name) for name in ("pos", "neg", "loss", "exposure")}
    rows = table.select(
        F.col("score").alias("threshold"),
        tpr.alias("sensitivity"),
        (F.lit(1.0) - fpr).alias("specificity"),
        (tpr - fpr).alias("youden"),
        (below["pos"] + below["neg"]).alias("accepted"),
        F.try_divide(below["loss"], below["exposure"]).alias("accepted_loss_rate"),
    )
    allowed = rows.where(F.col("accepted_loss_rate") <= max_loss_rate)
    best = allowed.agg(F.max_by(F.struct("*"), F.struct("youden", "threshold")).alias("best"))
    return best.select("best.*")


def subgroup_outcomes(df: DataFrame, y: str, score: str, group: str, threshold: float) -> DataFrame:
    """Base rate, share declined and error rates per subgroup at one cut-off."""
    declined = (F.col(score) >= threshold).cast("int")
    known = df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
    sums = known.groupBy(group).agg(
        F.count("*").alias("n"),
        F.sum(y).alias("p"),
        F.sum(declined).alias("d"),
        F.sum(declined * F.col(y)).alias("hit"),
    )
    return sums.select(
        group,
        "n",
        F.try_divide("p", "n").alias("base_rate"),
        F.try_divide("d", "n").alias("declined_rate"),
        F.try_divide("hit", "p").alias("true_positive_rate"),
        F.try_divide(F.col("d") - F.col("hit"), F.col("n") - F.col("p")).alias("false_positive_rate"),
    )


def drift(df: DataFrame, value: str, by: str, base: str, bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """Population stability index of a value per group against the base group, in base quantile bins."""
    rows = df.where(F.col(value).isNotNull()).withColumn("_one", F.lit(1))
    edges = quantile_edges(rank_table(rows.where(F.col(by) == base), "_one", value), bins).scalar()
    folded = rows.groupBy(by, F.col(value).cast("double").alias("value")).agg(F.count("*").alias("n"))
    placed = folded.withColumn("edges", edges)
    placed = placed.withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))))
    # The rest works on one row per group and bin.
    grid = placed.groupBy(by).pivot("bin", list(range(bins))).agg(F.sum("n"))
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(str(i)), F.lit(0)) for i in range(bins)])
    shares = grid.select(
        by, *[F.greatest(F.coalesce(F.col(str(i)), F.lit(0)) / total, F.lit(floor)).alias(f"s{i}") for i in range(bins)]
    )
    reference = [F.max(F.when(F.col(by) == base, F.col(f"s{i}"))).over(W.partitionBy()).alias(f"b{i}") for i in range(bins)]
    both = shares.select("*", *reference)
    terms = [(F.col(f"s{i}") - F.col(f"b{i}")) * F.log(F.col(f"s{i}") / F.col(f"b{i}")) for i in range(bins)]
    return both.select(by, reduce(lambda a, b: a + b, terms).alias("psi"))
