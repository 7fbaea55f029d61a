"""Macro series: resampling, growth rates, indices, alignment and interpolation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.scalars import quarter_key


def to_quarterly(observations: DataFrame) -> DataFrame:
    """Mean of the readings (series, yyyymm, value) of each series and quarter."""
    return observations.groupBy("series", quarter_key(F.col("yyyymm")).alias("quarter_key")).agg(
        F.avg("value").alias("value")
    )


def one_series(quarterly: DataFrame, name: str) -> DataFrame:
    """One series of a long quarterly table as (quarter_key, <name>)."""
    return quarterly.where(F.col("series") == name).select("quarter_key", F.col("value").alias(name))


def yoy(df: DataFrame, value: str, name: str, by=(), order: str = "quarter_key", lag: int = 4, base=None) -> DataFrame:
    """Growth in percent over the value ``lag`` periods earlier, or over ``base`` where there is none.

    ``order`` numbers the periods, so one that is missing is no value rather than a shift. The window holds
    one row per period of a series; callers aggregate to that grain first.
    """
    earlier = F.max(value).over(W.partitionBy(*by).orderBy(order).rangeBetween(-lag, -lag))
    if base is not None:
        earlier = F.coalesce(earlier, base if isinstance(base, Column) else F.lit(base))
    return df.withColumn(name, (F.try_divide(F.col(value), earlier) - F.lit(1.0)) * F.lit(100.0))


def annualised(df: DataFrame, value: str, name: str, by=(), order: str = "quarter_key") -> DataFrame:
    """Growth in percent over the quarter before, times four; NULL where that one is missing."""
    earlier = F.max(value).over(W.partitionBy(*by).orderBy(order).rangeBetween(-1, -1))
    return df.withColumn(name, (F.try_divide(F.col(value), earlier) - F.lit(1.0)) * F.lit(400.0))


def compound_index(
    df: DataFrame, growth_pct: str, name: str, by=(), order: str = "quarter_key", start: float = 100.0
) -> DataFrame:
    """Index that starts from ``start`` and compounds a quarter of the annual growth in each row."""
    running = F.sum(F.log1p(F.col(growth_pct) / F.lit(100.0)) / F.lit(4.0)).over(W.partitionBy(*by).orderBy(order))
    return df.withColumn(name, F.lit(start) * F.exp(running))


def align(series: list[DataFrame], on: str = "quarter_key") -> DataFrame:
    """Full outer alignment of frames that hold one row per key; rows without any value are dropped.

    One grouping over the union instead of a chain of full outer joins: one shuffle for any number
    of series.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), series)
    values = [name for name in union.columns if name != on]
    return union.groupBy(on).agg(*[F.max(name).alias(name) for name in values]).dropna("all", subset=values)


def widen(long: DataFrame, keys: list[str], variables: list[str], variable: str = "variable") -> DataFrame:
    """Long to wide; the variable names are given, so no extra job is needed to find them."""
    return long.groupBy(*keys).pivot(variable, variables).agg(F.avg("value"))


def macro_table(observations: DataFrame) -> DataFrame:
    """Quarterly macro history from monthly readings: one row per quarter, all series side by side."""
    quarterly = to_quarterly(observations)
    output = annualised(one_series(quarterly, "real_gdp"), "real_gdp", "gdp_growth")
    table = align(
        [
            one_series(quarterly, "unemployment_rate"),
            one_series(quarterly, "mortgage_rate"),
            output.select("quarter_key", "gdp_growth"),
            one_series(quarterly, "hpi"),
        ]
    )
    return yoy(table, "hpi", "hpi_yoy")


def interpolate(anchors: DataFrame, n: int, keys: list[str], t: str = "t", value: str = "value") -> DataFrame:
    """Piecewise-linear values on the grid 1..n per key, flat outside the anchors.

    ``t`` is a whole number and unique within a key. Only anchors on the grid and the nearest one on
    either side of it matter, so each key is first folded to at most n + 2 anchors with a partial
    aggregate; the array built afterwards has that bound whatever the number of anchors.
    """
    cell = F.greatest(F.lit(0), F.least(F.col(t), F.lit(n + 1))).cast("int")
    point = F.struct(F.col(t).cast("double").alias("t"), F.col(value).alias("v"))
    cells = anchors.groupBy(*keys, cell.alias("cell")).agg(F.min(point).alias("first"), F.max(point).alias("last"))
    nearest = F.when(F.col("cell") == 0, F.col("last")).otherwise(F.col("first"))
    paths = cells.groupBy(*keys).agg(F.sort_array(F.collect_list(nearest)).alias("points"))
    grid = paths.select(*keys, "points", F.explode(F.sequence(F.lit(1), F.lit(n))).alias(t))
    at = F.col(t).cast("double")
    sides = grid.select(
        *keys,
        t,
        F.try_element_at(F.filter("points", lambda p: p["t"] <= at), F.lit(-1)).alias("lo"),
        F.try_element_at(F.filter("points", lambda p: p["t"] >= at), F.lit(1)).alias("hi"),
    )
    slope = F.try_divide(F.col("hi.v") - F.col("lo.v"), F.col("hi.t") - F.col("lo.t"))
    inside = slope * (F.col(t).cast("double") - F.col("lo.t")) + F.col("lo.v")
    return sides.select(*keys, t, F.coalesce(inside, F.col("lo.v"), F.col("hi.v")).alias(value))
