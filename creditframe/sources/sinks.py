"""Writers for typed tables, features and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from creditframe.functions.scalars import vintage_of_key


def write_by_vintage(df: DataFrame, path: str, key: str = "loan_sequence_number") -> None:
    """Parquet partitioned by origination vintage, so vintage filters prune folders.

    Raw files hold one vintage each, so tasks write few folders and no shuffle is needed.
    """
    df.withColumn("vintage_part", vintage_of_key(df[key])).write.mode("overwrite").partitionBy("vintage_part").parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A table as parquet, CSV with a header, or JSON lines."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def write_marts(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Each named mart under its own folder."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", fmt)
