"""Origination features, cohort labels and the out-of-time split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditframe.functions.scalars import in_range, mean_percent, percent, round_half_up, vintage_of_key
from creditframe.operators.target import LOAN, outcome_columns, performance_summary

# Vintages of the out-of-time split and the last crisis vintage.
TRAIN_VINTAGES = [2005, 2006, 2017, 2018]
TEST_VINTAGES = [2007, 2008, 2019]
LAST_CRISIS_VINTAGE = 2009

NUMERIC = [
    "fico", "oltv", "ocltv", "odti", "orig_upb", "orig_rate", "mi_pct", "num_units", "num_borrowers", "loan_term",
]
CATEGORICAL = ["fthb", "loan_purpose", "occupancy", "property_type", "channel", "state"]
BOOK_COLUMNS = ["fico", "oltv", "odti", "orig_rate", "orig_upb"]


def clean_origination(orig: DataFrame, train=TRAIN_VINTAGES, test=TEST_VINTAGES) -> DataFrame:
    """Origination features of the listed vintages, without the outcome.

    A narrow projection: the vintage comes from the loan key, so the filter needs no join and is
    inferred for the other side of a later join on the key.
    """
    vintage = vintage_of_key(F.col(LOAN))
    return (
        orig.where(vintage.isin([*train, *test]))
        .select(
            LOAN,
            vintage.alias("vintage"),
            in_range("credit_score").alias("fico"),
            in_range("oltv").alias("oltv"),
            in_range("ocltv").alias("ocltv"),
            in_range("odti").alias("odti"),
            "orig_upb",
            F.col("orig_interest_rate").alias("orig_rate"),
            F.coalesce(in_range("mi_pct"), F.lit(0)).alias("mi_pct"),
            in_range("num_units").alias("num_units"),
            in_range("num_borrowers").alias("num_borrowers"),
            F.col("first_time_homebuyer_flag").alias("fthb"),
            "loan_purpose",
            F.col("occupancy_status").alias("occupancy"),
            "property_type",
            "channel",
            F.col("property_state").alias("state"),
            F.col("orig_loan_term").alias("loan_term"),
        )
        .withColumn("cohort", F.when(F.col("vintage") <= LAST_CRISIS_VINTAGE, "crisis").otherwise("covid"))
        .withColumn(
            "split",
            F.when(F.col("vintage").isin(train), "train").when(F.col("vintage").isin(test), "test").otherwise("other"),
        )
    )


def features(orig: DataFrame, target: DataFrame, train=TRAIN_VINTAGES, test=TEST_VINTAGES) -> DataFrame:
    """Features joined with an existing target table on the loan key."""
    outcome = target.select(LOAN, "default_flag", "prepaid_flag", "months_to_event", "ead_upb")
    return clean_origination(orig, train, test).join(outcome, LOAN)


def features_from_performance(orig: DataFrame, perf: DataFrame, train=TRAIN_VINTAGES, test=TEST_VINTAGES) -> DataFrame:
    """The same table straight from performance: one left join instead of two joins on the loan key."""
    clean = clean_origination(orig, train, test)
    joined = clean.join(performance_summary(perf), LOAN, "left")
    outcome = outcome_columns()
    return joined.select(
        *clean.columns,
        *[outcome[name].alias(name) for name in ("default_flag", "prepaid_flag", "months_to_event", "ead_upb")],
    )


def fill_categories(df: DataFrame, columns=CATEGORICAL) -> DataFrame:
    """Name the unknown category."""
    return df.fillna("missing", subset=list(columns))


def as_of_book(df: DataFrame, cohort: str = "covid", required=BOOK_COLUMNS) -> DataFrame:
    """The loans of one cohort whose projection inputs are all known."""
    return df.where(F.col("cohort") == cohort).dropna(subset=list(required))


def split_summary(df: DataFrame) -> DataFrame:
    missing = F.sum(F.when(F.col("fico").isNull(), 1).otherwise(0))
    return df.groupBy("split").agg(
        F.count("*").alias("n"),
        F.sum("default_flag").alias("n_default"),
        round_half_up(mean_percent(F.col("default_flag")), 2).alias("default_rate_pct"),
        round_half_up(percent(missing, F.count("*")), 2).alias("fico_missing_pct"),
    )
