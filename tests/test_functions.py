from pyspark.sql import functions as F

from creditframe.functions import bands
from creditframe.functions.scalars import (
    current_ltv,
    in_range,
    key_fraction,
    origination_quarter_of_key,
    quarter_key,
    quarter_key_of_label,
    quarter_label,
    round_half_up,
    vintage_of_key,
)


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_band_edges_and_null(spark):
    df = spark.createDataFrame([(619,), (620,), (779,), (780,), (None,)], "x int")
    assert values(df, bands.band(F.col("x"), bands.FICO_MART)) == ["<620", "620-659", "740-779", "780+", "780+"]
    df = spark.createDataFrame([(60,), (61,), (90,), (91,), (None,)], "x int")
    assert values(df, bands.band(F.col("x"), bands.LTV_MART)) == ["<=60", "61-70", "81-90", "91+", "91+"]
    assert values(df, bands.band(F.col("x"), bands.LTV_REPORT)) == ["1:<=60", "2:61-80", "3:81-90", "4:91+", "4:91+"]


def test_unknown_codes_become_null(spark):
    df = spark.createDataFrame([(299,), (300,), (850,), (9999,), (None,)], "credit_score int")
    assert values(df, in_range("credit_score")) == [None, 300, 850, None, None]


def test_quarter_is_a_whole_number_for_every_month(spark):
    df = spark.createDataFrame([(200500 + m,) for m in range(1, 13)], "p int")
    assert [k - 2005 * 4 for k in values(df, quarter_key(F.col("p")))] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3]


def test_quarter_labels_round_trip(spark):
    df = spark.createDataFrame([("2005Q1",), ("2021Q4",)], "q string")
    assert values(df, quarter_label(quarter_key_of_label(F.col("q")))) == ["2005Q1", "2021Q4"]


def test_key_parts(spark):
    df = spark.createDataFrame([("F05Q10000001",), ("F19Q40000002",)], "k string")
    assert values(df, vintage_of_key(F.col("k"))) == [2005, 2019]
    assert values(df, origination_quarter_of_key(F.col("k"))) == [2005 * 4, 2019 * 4 + 3]


def test_missing_ltv_takes_the_cap(spark):
    df = spark.createDataFrame([(80.0, 100.0, 50.0), (200.0, 100.0, 50.0), (None, 100.0, 50.0)], "l double, a double, b double")
    assert values(df, current_ltv(F.col("l"), F.col("a"), F.col("b"))) == [160.0, 250.0, 250.0]


def test_rounding_is_half_up_on_the_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (0.125,), (None,)], "x double")
    assert values(df, round_half_up(F.col("x"), 2)) == [1.0, 2.5, 0.13, None]


def test_key_fraction_is_fixed(spark):
    df = spark.createDataFrame([("F05Q10000001",)], "k string")
    first = values(df, key_fraction(F.col("k"), 42))[0]
    assert 0 <= first < 1 and first == values(df, key_fraction(F.col("k"), 42))[0]
    assert first != values(df, key_fraction(F.col("k"), 7))[0]
