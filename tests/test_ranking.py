"""Distributed prefix sums and quantiles against brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yieldlens.functions.ranking import cumulative, exact_quantiles


def test_cumulative_matches_brute_force(spark):
    rows = [(k, float(v), int(c)) for k in ("a", "b", "c") for v, c in zip(range(50), range(1, 51))]
    df = spark.createDataFrame(rows, "k string, v double, c long")
    got = {(r.k, r.v): r.cum_c for r in cumulative(df, ["k"], ["v"], ["c"], partitions=7).collect()}
    for k in ("a", "b", "c"):
        run = 0
        for v, c in zip(range(50), range(1, 51)):
            run += c
            assert got[(k, float(v))] == run


def test_cumulative_independent_of_partitioning(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 101).cast("double").alias("v"),
                                    F.lit(1).alias("c")).groupBy("k", "v").agg(F.sum("c").alias("c"))
    a = sorted(cumulative(df, ["k"], ["v"], ["c"], partitions=2).collect())
    b = sorted(cumulative(df.repartition(11), ["k"], ["v"], ["c"], partitions=13).collect())
    assert a == b


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy_linear(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.j: r.quantile for r in exact_quantiles(df, [], "value", probs, partitions=3).collect()}
    want = np.quantile(np.array(xs), probs)
    for j, w in enumerate(want):
        assert abs(got[j] - w) <= 1e-9 * max(1.0, abs(w))


def test_previous_in_order_with_hot_key_equals_window_lag(spark):
    from pyspark.sql import Window

    from yieldlens.functions.ranking import previous_in_order

    df = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"),
                                     ((F.col("id") * 7919) % 10007).alias("t"), F.col("id").alias("v"))
    got = previous_in_order(df, ["k"], ["t"], ["v"], partitions=9)
    want = df.select("*", F.lag("v").over(Window.partitionBy("k").orderBy("t")).alias("prev_v"))
    assert sorted(got.select("k", "t", "v", "prev_v").collect()) == sorted(want.collect())


def test_helpers_carry_state_across_small_arrow_batches(spark):
    """Partitions larger than one Arrow batch: running sums and lags must continue across batches."""
    from pyspark.sql import Window

    from yieldlens.functions.ranking import previous_in_order

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.range(0, 3000).select((F.col("id") % 4).alias("k"), ((F.col("id") * 7919) % 10007).alias("t"),
                                         F.col("id").alias("v"))
        got = previous_in_order(df, ["k"], ["t"], ["v"], partitions=3)
        want = df.select("*", F.lag("v").over(Window.partitionBy("k").orderBy("t")).alias("prev_v"))
        assert sorted(got.select("k", "t", "v", "prev_v").collect()) == sorted(want.collect())
        c = cumulative(df.withColumn("one", F.lit(1)), ["k"], ["t"], ["one"], partitions=3)
        w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
        want2 = df.select("k", "t", F.count(F.lit(1)).over(w).alias("cum_one"))
        assert sorted(c.select("k", "t", "cum_one").collect()) == sorted(want2.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_column_quantiles_are_those_of_the_long_form(spark, monkeypatch):
    from yieldlens.functions import ranking as R

    rows = [(float(i * 7919 % 5000) / 3, float(i % 3), 1.0, None if i % 4 else float(-i), float("nan") if i % 2 else float(i), None) for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(5)
    cols, probs = df.columns, [0.0, 0.05, 0.5, 0.975, 1.0]
    long = df.select(*[R.finite(c).alias(c) for c in cols]).unpivot([], cols, "feature", "value")
    want = sorted((r["feature"], r["j"], r["prob"], r["quantile"]) for r in R.exact_quantiles(long, ["feature"], "value", probs).collect())
    for sketched in (R.SKETCHED, 1000, 2):  # all rows, some, so few that all values are ranked
        monkeypatch.setattr(R, "SKETCHED", sketched)
        got = R.column_quantiles(df, cols, probs).collect()
        assert sorted((r["feature"], r["j"], r["prob"], r["quantile"]) for r in got) == want
    assert R.column_quantiles(df.limit(0), cols, probs).count() == 0


def test_only_values_near_a_quantile_are_handed_on():
    import pyarrow as pa

    from yieldlens.functions.ranking import _between

    batch = pa.RecordBatch.from_pydict({"a": [*map(float, range(1000)), None], "b": [1.0] * 1001})
    rows = pa.Table.from_batches(list(_between({("a", 0): (499.0, 501.0), ("b", 0): (1.0, 1.0)})([batch]))).to_pylist()
    assert [(r["feature"], r["value"], r["_c"], r["_n"], r["_below"]) for r in rows] == [
        ("a", 499.0, 1, 0, 0), ("a", 500.0, 1, 0, 0), ("a", 501.0, 1, 0, 0), ("b", 1.0, 1001, 0, 0), ("a", None, 0, 1000, 499), ("b", None, 0, 1001, 0)]
