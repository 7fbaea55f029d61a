"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _rows
from creditframe.session import ensure_checkpoint_dir


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links from the neighbours of each node to the least of them and it; ``edges`` lead from larger to smaller."""
    around = edges.union(edges.select("low", "high").toDF("high", "low")) if both_ways else edges
    least = around.groupBy("high").agg(F.min("low").alias("least"))
    least = least.select("high", F.least("least", "high").alias("least"))
    joined = _rows.hot_join(around, least, ["high"])
    if both_ways:  # only the larger neighbours move
        moved = joined.where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
    else:
        moved = joined.select(F.col("low").alias("high"), F.col("least").alias("low")).union(least.toDF("high", "low"))
    return moved.where("high != low")


def _is_done(edges: DataFrame) -> bool:
    """Whether every node has one link, to a node without any."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("low", F.lit(0), F.lit(1)))
    open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0")
    return open_.agg(F.count("*")).first()[0] == 0


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and its ``component``, the smallest node it is linked with, for every node that has a link.

    Each round writes its links to the checkpoint folder; the number of rounds grows with the logarithm of
    the longest path. The links of a node are never gathered in one place.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high != low")
    while True:
        edges = _star(_star(edges, True).checkpoint(), False).distinct().checkpoint()
        if _is_done(edges):
            break
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.union(edges.select("low", "low").distinct())
