"""Key-hash sampling and key filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditframe.functions.scalars import key_fraction


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Keep a fixed share of the keys, each with all its rows.

    The decision depends on the key alone, so two tables that carry the key are sampled alike
    without a join or a shuffle.
    """
    return df.where(key_fraction(F.col(key), seed) < F.lit(fraction))


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``, for a key list that is no function of the key.

    Spark broadcasts the list where it turns out short at run time. Else both sides are shuffled by the
    key and a hash of it; as that serves this join alone, the partitions of a key that holds a large
    share of the rows are split by size at run time.
    """
    spread = F.xxhash64(key, F.lit("keep")).alias("_spread")
    wanted = keys.select(key).distinct().select(key, spread)
    return df.select("*", spread).join(wanted, on=[key, "_spread"], how="left_semi").select(*df.columns)


def first_n_by_hash(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` rows, in hash order with the key as tie-break."""
    rank = F.md5(F.concat(F.col(key), F.lit(str(seed))).cast("binary"))
    return df.orderBy(rank, F.col(key)).limit(n)


def load_summary(raw_loans: DataFrame, kept_loans: DataFrame, kept_rows: DataFrame) -> DataFrame:
    """Row counts of a load: all loans, kept loans, kept performance rows and loans per vintage.

    Each table is counted per partition before anything moves; the result has one row per measure.
    """
    counts = (
        raw_loans.agg(F.count("*").alias("n")).select(F.lit("loans_read").alias("measure"), "n")
        .unionAll(kept_loans.agg(F.count("*").alias("n")).select(F.lit("loans_kept"), "n"))
        .unionAll(kept_rows.agg(F.count("*").alias("n")).select(F.lit("performance_rows_kept"), "n"))
    )
    vintages = kept_loans.groupBy("vintage_year").agg(F.count("*").alias("n")).select(
        F.concat(F.lit("loans_kept_"), F.coalesce(F.col("vintage_year").cast("string"), F.lit("unknown"))), "n"
    )
    return counts.unionAll(vintages)
