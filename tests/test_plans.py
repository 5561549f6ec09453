"""Plan shape: the distributed prefix sum never gathers rows into one partition."""

from pyspark.sql import functions as F

from yieldlens.functions.ranking import cumulative


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cumulative_has_no_single_partition_exchange_on_rows(spark):
    df = spark.range(0, 2000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"),
                                     F.lit(1).alias("c"))
    out = cumulative(df, ["k"], ["v"], ["c"], partitions=8)
    plan = _plan(out)
    # the only windows run over the small per-partition totals table; rows are joined to it by broadcast
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert out.count() == 2000
