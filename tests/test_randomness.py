"""Hash randomness: cells are blanked independently, replicates are independent."""

import numpy as np
from pyspark.sql import functions as F

from yieldlens.operators.features import inject_missingness
from yieldlens.operators.models import unit_hash


def test_blanked_cells_are_independent(spark):
    cols = [f"s{i}" for i in range(20)]
    wide = spark.range(4000).select(F.col("id").alias("o_orderkey"), F.col("id").alias("record_id"), *[F.lit(1.0).alias(c) for c in cols])
    gone = inject_missingness(wide, cols, 0.2).toPandas()[cols].isna().to_numpy()
    assert abs(gone.mean() - 0.2) < 0.01
    assert abs(gone.sum(1).var() - 20 * 0.2 * 0.8) < 0.4  # binomial, not all cells of a row together
    corr = np.corrcoef(gone.T.astype(float))[np.triu_indices(20, 1)]
    assert abs(corr).max() < 0.08


def test_replicates_are_independent(spark):
    u = spark.range(3000).select(*[unit_hash(F.col("id"), F.lit(r), salt=42).alias(f"r{r}") for r in range(30)]).toPandas().to_numpy()
    assert abs(u.mean() - 0.5) < 0.005 and 0 <= u.min() and u.max() < 1
    assert abs(np.corrcoef(u.T)[np.triu_indices(30, 1)]).max() < 0.09


def test_forest_does_not_depend_on_row_order(spark):
    from yieldlens.operators.models import isolation_scores

    wide = spark.range(3000).select(F.col("id").alias("o_orderkey"), F.col("id").cast("string").alias("record_id"), F.lit("reference").alias("side"),
                                    F.lit(0).alias("target"), *[unit_hash(F.col("id"), F.lit(c), salt=5).alias(f"s{c}") for c in range(4)])
    one, other = ({r["record_id"]: r["anomaly_score"] for r in isolation_scores(w, [f"s{c}" for c in range(4)], trees=3).collect()}
                  for w in (wide.coalesce(1), wide.orderBy(F.desc("o_orderkey")).repartition(7)))
    assert one == other


def test_isolation_reads_records_once_and_keeps_repeated_ids(spark, monkeypatch):
    from yieldlens.operators import models as MO

    stored = []
    monkeypatch.setattr(MO, "_stored", lambda wide, *a, f=MO._stored: stored.append(1) or f(wide, *a))
    one = spark.range(600).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") != 7, F.col("id").cast("string")).alias("record_id"),
                                  F.lit("reference").alias("side"), F.lit(0).alias("target"), F.rand(1).alias("a"), F.rand(2).alias("b")).cache()
    got = MO.isolation_scores(one, ["a", "b"], trees=4).groupBy("record_id").count().collect()
    assert stored == [1] and len(got) == 599 and {r["count"] for r in got} == {1}
    twice = MO.isolation_scores(one.unionByName(one.where("o_orderkey = 3")), ["a", "b"], trees=4)
    assert twice.where("record_id = '3'").count() == 4 and twice.count() == 602  # each row with each key of its id, as ever


def test_path_lengths_follow_the_trees():
    from yieldlens.operators.models import path_lengths

    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    trees = [([rng.integers(0, 3, 1 << d) for d in range(3)], [rng.normal(size=1 << d) for d in range(3)], rng.normal(size=8)) for _ in range(4)]
    want = np.zeros(200)
    for feats, splits, leaves in trees:
        for i, row in enumerate(x):
            at = 0
            for f, s in zip(feats, splits):
                at = 2 * at + int(not row[f[at]] < s[at])
            want[i] += leaves[at]
    assert (path_lengths(x, trees) == want).all()


def test_stress_scores_records_without_a_row_for_each_cell(spark, monkeypatch):
    from yieldlens.catalog import features_q as Q

    unpivoted, long = [], Q.to_long
    monkeypatch.setattr(Q, "to_long", lambda *a, **k: unpivoted.append(a[1]) or long(*a, **k))
    got = {r["rate"]: r["missing_cell_rate"] for r in Q.q_missingness_stress(spark, "/root/testdata/sf0.001").collect()}
    assert unpivoted == [["record_id"]]  # the reference side's means only
    assert sorted(got) == [0.0, 0.05, 0.1, 0.2, 0.3, 0.4] and all(got[a] < got[b] for a, b in zip(sorted(got), sorted(got)[1:]))
