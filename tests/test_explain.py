"""Rankings of attributions."""

from yieldlens.operators import explain


def test_recurrence_covers_all_features(spark):
    rows = [(r, f"s{f:02d}", (-1.0) ** r * f, r % 2) for r in range(6) for f in range(30)]
    att = spark.createDataFrame(rows, "record_id int, feature string, contribution double, target int")
    assert explain.failure_features(att).count() == explain.GROUP_TOP
    got = explain.failure_features(att, None).orderBy("feature_rank").collect()
    assert [r["feature"] for r in got] == [f"s{f:02d}" for f in reversed(range(30))]
    assert got[0]["mean_absolute_contribution"] == 29.0 and got[-1]["mean_absolute_contribution"] == 0.0


def test_attributions_dealt_by_record_are_not_dealt_again(spark):
    from pyspark.sql import functions as F

    from yieldlens.operators import explain as X

    cols = ["a", "b", "c"]
    wide = spark.range(300).select(F.col("id").cast("string").alias("record_id"), (F.col("id") % 2).alias("target"), F.when(
        F.col("id") % 3 == 0, "reference").otherwise("current").alias("side"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.lit(None).cast("double").alias("c")).cache()
    dealt = X.attributions(wide, cols, tasks=3)
    assert dealt.exceptAll(X.attributions(wide, cols)).isEmpty() and dealt.count() == 600
    plan = X.local_top_k(dealt)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(record_id") == 1
