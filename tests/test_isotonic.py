import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from creditframe.operators import isotonic


def brute(x, y, w):
    """Pool-adjacent-violators over all points at once, equal scores folded first."""
    order = sorted(set(x))
    lo = np.array(order, float)
    ww = np.array([sum(wi for xi, wi in zip(x, w) if xi == v) for v in order])
    ss = np.array([sum(wi * yi for xi, yi, wi in zip(x, y, w) if xi == v) for v in order])
    return isotonic.pool(lo, lo, ww, ss)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 1), st.sampled_from([1.0, 2.0, 0.5])), max_size=120),
       st.sampled_from([1, 4, 16]))
@settings(max_examples=20, deadline=None)
def test_tree_merge_equals_one_pass(spark, rows, ranges):
    df = spark.createDataFrame([(float(x) / 7, float(y), w) for x, y, w in rows] + [(None, 1.0, 1.0), (0.5, None, 1.0), (0.5, 1.0, 0.0)], "score double, y double, w double")
    pools = isotonic.fit(df, "score", "y", "w", ranges=ranges)
    if not rows:
        assert len(pools) == 0
        return
    lo, hi, w, s = brute([x / 7 for x, _, _ in rows], [float(y) for _, y, _ in rows], [w for *_, w in rows])
    assert np.allclose(pools["lo"], lo) and np.allclose(pools["hi"], hi) and np.allclose(pools["w"], w) and np.allclose(pools["s"], s)
    means = pools["s"] / pools["w"]
    assert (np.diff(means) > 0).all()  # strictly increasing once equal means are pooled
    assert np.isclose(pools["s"].sum(), sum(w * y for _, y, w in rows))  # weighted means kept


def test_predictions_equal_spark_isotonic(spark):
    rng = np.random.default_rng(5)
    x = rng.random(3000).round(3)
    y = (rng.random(3000) < x).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "raw double, label double")
    pools = isotonic.fit(df, "raw", "label", ranges=8)
    ours = df.select("raw", isotonic.predict(pools, F.col("raw")).alias("ours"))
    theirs = IsotonicRegression(featuresCol="raw", labelCol="label").fit(df).transform(ours)
    got = theirs.select("ours", "prediction").toPandas()
    assert np.allclose(got["ours"], got["prediction"])
