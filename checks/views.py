"""Loan-shaped views over the driver's tables (Spark side; ``oracle.py`` holds the SQL side)."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession


_VIEWS: dict[tuple, DataFrame] = {}


def cache(fn):
    """One DataFrame per view, session and folder; views of stopped sessions are let go at the next call."""

    @wraps(fn)
    def view(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key in [k for k, df in _VIEWS.items() if df.sparkSession.sparkContext._jsc is None]:
            del _VIEWS[key]
        key = (fn.__name__, id(spark), sf_dir)
        if key not in _VIEWS:
            _VIEWS[key] = fn(spark, sf_dir)
        return _VIEWS[key]

    return view


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the loan attributes that depend on the order alone."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey AS k", "o_custkey AS c", "o_totalprice", "left(o_orderpriority, 1) AS priority",
            "CASE WHEN year(o_orderdate) <= 1998 THEN year(o_orderdate) + 10 ELSE year(o_orderdate) + 18 END AS vint",
            "quarter(o_orderdate) AS q", "580 + (o_custkey * 37 + o_orderkey * 11) % 241 AS score0",
        )
        .selectExpr(
            "*",
            "concat('F', lpad(string(vint % 100), 2, '0'), 'Q', string(q), lpad(string(k), 7, '0'))"
            " AS loan_sequence_number",
            "CASE WHEN k % 97 = 0 THEN 999 ELSE 40 + (k * 17 + c) % 58 END AS ltv0",
            # The loan starts in its quarter and pays first two months later, maybe in the next year.
            "vint * 12 + (q - 1) * 3 + k % 3 + 2 AS fpm",
        )
    )


@cache
def origination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    home = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    rows = loans(spark, sf_dir)
    return rows.join(home, rows.c == home.c_custkey).selectExpr(
        "loan_sequence_number",
        "int(CASE WHEN k % 53 = 0 THEN 9999 ELSE score0 END) AS credit_score",
        "string((fpm div 12) * 100 + fpm % 12 + 1) AS first_payment_date",
        "CASE k % 5 WHEN 0 THEN 'Y' WHEN 4 THEN NULL ELSE 'N' END AS first_time_homebuyer_flag",
        "int(CASE WHEN k % 61 = 0 THEN 999 WHEN ltv0 > 80 THEN 25 ELSE 0 END) AS mi_pct",
        "int(CASE WHEN k % 71 = 0 THEN 99 ELSE 1 + k % 4 END) AS num_units",
        "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'P'"
        " WHEN c_mktsegment = 'FURNITURE' THEN 'I' ELSE 'S' END AS occupancy_status",
        "int(ltv0 + k % 9) AS ocltv",
        "int(CASE WHEN k % 41 = 0 THEN 999 ELSE 10 + (k * 29) % 56 END) AS odti",
        "double(floor(o_totalprice / 1000) * 1000) AS orig_upb",
        "int(ltv0) AS oltv",
        "3.5D + (k % 33) / 16D AS orig_interest_rate",
        "CASE WHEN k % 3 = 0 THEN 'R' WHEN k % 3 = 1 THEN 'B' WHEN k % 7 > 0 THEN 'C' END AS channel",
        "n_name AS property_state",
        "CASE k % 4 WHEN 0 THEN 'SF' WHEN 1 THEN 'PU' WHEN 2 THEN 'CO' ELSE 'MH' END AS property_type",
        "CASE WHEN priority IN ('1', '2') THEN 'P' WHEN priority IN ('3', '4') THEN 'C' ELSE 'N' END AS loan_purpose",
        "CASE WHEN k % 10 < 8 THEN 360 WHEN k % 10 = 8 THEN 180 ELSE 240 END AS orig_loan_term",
        "int(CASE WHEN k % 59 = 0 THEN 99 ELSE 1 + k % 3 END) AS num_borrowers",
        "int(fpm div 12) AS vintage_year",
    )


@cache
def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan-month per line item."""
    keys = loans(spark, sf_dir).select("k", "loan_sequence_number", "vint", "q", "score0")
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(keys, lines.l_orderkey == keys.k)
        .selectExpr(
            "loan_sequence_number", "l_extendedprice AS price", "l_discount",
            "int(l_linenumber * 3 - l_partkey % 3) AS loan_age",
            "vint * 12 + (q - 1) * 3 + l_linenumber * 3 - l_partkey % 3 AS m",
            "CASE WHEN l_quantity >= CASE WHEN score0 < 660 THEN 47 WHEN score0 < 720 THEN 49 ELSE 50 END THEN '6'"
            " WHEN l_quantity >= 44 THEN '3' WHEN l_quantity >= 38 THEN '1' WHEN l_quantity = 37 THEN 'XX'"
            " WHEN l_quantity = 36 THEN 'RA' ELSE '0' END AS current_delinquency_status",
            "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount >= 0.1D THEN '03'"
            " WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_tax >= 0.07D THEN '01' END AS zero_balance_code",
        )
        .selectExpr(
            "loan_sequence_number",
            "int((m div 12) * 100 + m % 12 + 1) AS monthly_reporting_period",
            "price AS current_actual_upb",
            "current_delinquency_status",
            "loan_age",
            "zero_balance_code",
            "CASE WHEN zero_balance_code IS NOT NULL THEN int((m div 12) * 100 + m % 12 + 1) END"
            " AS zero_balance_effective_date",
            "CASE WHEN zero_balance_code = '03' THEN price * (0.2D + l_discount) END AS actual_loss_calculation",
            "CASE WHEN zero_balance_code = '03' THEN price * 0.75D END AS net_sales_proceeds",
            "CASE WHEN zero_balance_code IS NOT NULL THEN price END AS zero_balance_removal_upb",
        )
    )


def as_text(df: DataFrame) -> DataFrame:
    """The same table as the all-text raw load it would come from."""
    return df.selectExpr(*[f"string({name}) AS {name}" for name in df.columns])


@cache
def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly readings of four series, several per month, taken from the orders.

    All values are multiples of 1/16 so that sums are exact in any order. The last two quarters have
    no reading and the mortgage rate starts one quarter late.
    """
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey AS k", "o_custkey AS c", "o_orderkey % 204 AS m")
        .selectExpr(
            "int((2005 + m div 12) * 100 + m % 12 + 1) AS yyyymm",
            "m",
            """stack(4,
               'unemployment_rate', 4D + abs(m % 96 - 48) / 16D + (c % 8) / 8D,
               'mortgage_rate', CASE WHEN m >= 3 THEN 3D + abs(m % 120 - 60) / 16D + (k % 4) / 4D END,
               'real_gdp', 15000D + m * 16D + (c % 16) * 8D,
               'hpi', 100D + abs(m % 144 - 72) / 2D + (c % 8) / 8D) AS (series, value)""",
        )
        .selectExpr("series", "yyyymm", "CASE WHEN m < 198 THEN value END AS value")
    )


@cache
def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One applicant per customer; education 5 and marital 4 are outside the point tables."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS applicant_id",
        "10000D + (c_acctbal + 1000D) * 40D AS limit",
        "int(18 + c_custkey % 58) AS age",
        "int(c_custkey % 11 - 2) AS pay_status",
        "int(1 + c_custkey % 5) AS education",
        "int(1 + c_custkey % 4) AS marital",
    )
