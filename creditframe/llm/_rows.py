"""Rows taken apart for a join or a Python stage and put together again, whatever their columns are called."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apart(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` as long, ``text``, and all columns but the text as the struct ``rest``."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.struct(*rest).alias("rest")
    )


def together(df: DataFrame, columns: list[str], text_col: str, added: dict[str, Column]) -> DataFrame:
    """The columns in their order and the added ones; of equal names the added one stays."""
    own = [
        F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in columns if c not in added
    ]
    return df.select(*own, *[c.alias(name) for name, c in added.items()])


def salted(df: DataFrame, salts: int) -> DataFrame:
    """Each row once for every salt, to meet rows of which each has one."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join whose left side may have very frequent keys.

    A hash of the keys is a further key, so that both sides are shuffled for this join alone, whatever
    their partitioning was, and Spark can split the partitions of frequent keys at run time.
    """
    spread = F.xxhash64(*keys, F.lit("join")).alias("spread")
    return left.select("*", spread).join(right.select("*", spread), ["spread", *keys], how).drop("spread")


def bitmap(ids: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size in which the place of each value of the only column, modulo ``bits``, is set.

    Values are folded into words before they reach the driver: at most ``bits / 64`` rows, however many there are.
    """
    place = F.col(ids.columns[0]).bitwiseAND(bits - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    folded = ids.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[folded.column("word").to_numpy()] = folded.column("bits").to_numpy().view(np.uint64)
    return words


def marked(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values have their place of the bitmap set."""
    at = values.astype(np.uint64) & np.uint64(64 * len(words) - 1)
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
