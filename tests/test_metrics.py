"""Rank metrics against brute force and under monotone maps."""

from pyspark.sql import functions as F

from yieldlens.operators import metrics as M


def _auc_brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_matches_brute_force_and_is_monotone_invariant(spark):
    pairs = [((i * 37) % 23 / 23.0, 1 if (i * 11) % 7 < 3 else 0) for i in range(120)]
    df = spark.createDataFrame(pairs, "probability double, target int")
    auc = M.roc_auc(M.ranked_scores(df, []), []).first().roc_auc
    assert abs(auc - _auc_brute(pairs)) < 1e-12
    df2 = df.withColumn("probability", F.exp(F.col("probability") * 3))
    auc2 = M.roc_auc(M.ranked_scores(df2, []), []).first().roc_auc
    assert abs(auc - auc2) < 1e-12


def test_grid_cell_exact_on_edges(spark):
    df = spark.createDataFrame([(k / 200.0,) for k in range(201)], "p double")
    got = [r.g for r in df.select(M.grid_cell(F.col("p"), 200).alias("g")).collect()]
    assert got == list(range(201))


def test_calibration_error_ece_le_mce(spark):
    pairs = [((i % 50) / 50.0, 1 if i % 9 == 0 else 0) for i in range(300)]
    df = spark.createDataFrame(pairs, "probability double, target int")
    r = M.calibration_error(df, []).first()
    assert r.ece <= r.mce + 1e-12
