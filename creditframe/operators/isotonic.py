"""Isotonic regression by pool-adjacent-violators, fitted in ranges of scores merged as a tree.

Equal scores are first folded to one weighted point by a grouping with partial aggregation. The points
are range-partitioned by score; each range is sorted and pooled on its own, giving increasing pools
(first score, last score, weight, weighted label sum): the slopes of the greatest convex minorant of
its cumulative (weight, label) diagram. Two adjacent ranges are merged by pooling their pools again:
each side is increasing already, so only pools next to the border can join, into one. Ranges are merged
pairwise, ``log2(ranges)`` rounds of one small grouping each; a task holds the pools of two neighbours,
never the points. The fit is the final list of pools, which is also what every scorer of the model
holds; nothing is merged on the driver.

Predictions follow Spark's isotonic model: each pool gives its mean at its first and last score,
scores between pools are interpolated linearly, and scores outside all pools take the nearest pool's
mean.

Edge cases: rows with a null score, label or weight, or a weight of 0 or less, are left out; an empty
input gives no pools, and then every prediction is null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

POOLS = "part long, lo double, hi double, w double, s double"


def pool(lo: np.ndarray, hi: np.ndarray, w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pools of points (or pools) in score order: adjacent violators joined until means increase."""
    stack_lo, stack_hi, stack_w, stack_s = [], [], [], []
    for a, b, weight, total in zip(lo.tolist(), hi.tolist(), w.tolist(), s.tolist()):
        while stack_w and stack_s[-1] * weight >= total * stack_w[-1]:  # previous mean >= this mean
            a = stack_lo.pop()
            stack_hi.pop()
            weight += stack_w.pop()
            total += stack_s.pop()
        stack_lo.append(a)
        stack_hi.append(b)
        stack_w.append(weight)
        stack_s.append(total)
    return np.array(stack_lo), np.array(stack_hi), np.array(stack_w), np.array(stack_s)


def _pooled(part: int, frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("lo", kind="stable")
    lo, hi, w, s = pool(frame["lo"].to_numpy(), frame["hi"].to_numpy(), frame["w"].to_numpy(), frame["s"].to_numpy())
    return pd.DataFrame({"part": np.full(len(lo), part, np.int64), "lo": lo, "hi": hi, "w": w, "s": s})


def _ranges(frames):
    parts = [f for f in frames if len(f)]
    if parts:
        frame = pd.concat(parts, ignore_index=True)
        yield _pooled(int(frame["part"].iloc[0]), frame)


def fit(df: DataFrame, score: str, label: str, weight: str | None = None, ranges: int = 64) -> pd.DataFrame:
    """Pools of the isotonic fit of ``label`` on ``score``: ``lo, hi, w, s`` (mean is ``s / w``)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(score).cast("double").alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("w").isNotNull() & (F.col("w") > 0))
    points = rows.groupBy("x").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("s"))
    ranged = points.repartitionByRange(ranges, "x").select(
        F.spark_partition_id().cast("long").alias("part"), F.col("x").alias("lo"), F.col("x").alias("hi"), "w", "s"
    )
    # Each range partition is pooled where it lies; only pools move from here on.
    pools = ranged.mapInPandas(_ranges, POOLS)
    levels = max(1, int(np.ceil(np.log2(max(ranges, 2)))))
    for _ in range(levels):
        # Ranges are numbered in score order, so halving the number pairs neighbours.
        pools = pools.withColumn("part", F.shiftright("part", 1)).groupBy("part").applyInPandas(
            lambda f: _pooled(int(f["part"].iloc[0]), f), POOLS
        )
    found = pools.toPandas().sort_values("lo", kind="stable")
    return found[["lo", "hi", "w", "s"]].reset_index(drop=True)


def knots(pools: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries and predictions, as Spark's isotonic model keeps them."""
    xs, ys = [], []
    for row in pools.itertuples(index=False):
        mean = row.s / row.w
        xs.append(row.lo)
        ys.append(mean)
        if row.hi != row.lo:
            xs.append(row.hi)
            ys.append(mean)
    return np.array(xs, np.float64), np.array(ys, np.float64)


def predict(pools: pd.DataFrame, score: Column) -> Column:
    """The fitted value of each score: an Arrow-batched interpolation over the pools' knots."""
    xs, ys = knots(pools)

    @F.pandas_udf(DoubleType())
    def interpolate(values: pd.Series) -> pd.Series:
        out = np.interp(values.to_numpy(np.float64, na_value=np.nan), xs, ys) if len(xs) else np.full(len(values), np.nan)
        return pd.Series(out).where(values.notna())

    return interpolate(score.cast("double"))
