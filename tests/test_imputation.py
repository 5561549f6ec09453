"""Chained imputation comes closer to hidden cells than medians, and leaves observed cells alone."""

import numpy as np
from pyspark.sql import functions as F

from yieldlens.operators import imputation as IM
from yieldlens.operators import models as MO

COLS = ["a", "b", "c", "d"]


def made(spark, n=800, seed=1):
    rng = np.random.default_rng(seed)
    z = rng.normal(0, 1, n)
    x = np.column_stack([z, z**2 + rng.normal(0, 0.2, n), -2 * z + rng.normal(0, 0.3, n), rng.normal(0, 1, n)])
    gone = rng.random((n, 4)) < 0.2
    gone[:, 3] = False
    y = (rng.random(n) < 1 / (1 + np.exp(2 - 2 * z))).astype(int)
    rows = [(f"r{i:04d}", int(y[i]), "reference" if i % 2 else "current", *[None if gone[i, j] else float(x[i, j]) for j in range(4)], None)
            for i in range(n)]
    return x, gone, spark.createDataFrame(rows, "record_id string, target int, side string, a double, b double, c double, d double, e double")


def test_hidden_cells_are_closer_than_medians(spark):
    x, gone, wide = made(spark)
    got = IM.chained_impute(wide.repartition(3), [*COLS, "e"], F.col("side") == "reference", rounds=3).orderBy("record_id").collect()
    v = np.array([[r[c] for c in COLS] for r in got])
    assert len(got) == 800 and all(r["e"] is None for r in got)
    assert np.allclose(v[~gone], x[~gone], atol=1e-6)
    for j in range(3):
        median = np.median(x[~gone[:, j], j])
        error = lambda w: np.sqrt(((w - x[gone[:, j], j]) ** 2).mean())
        assert error(v[gone[:, j], j]) < 0.7 * error(median), COLS[j]


def test_nothing_missing_and_no_rows(spark):
    x, gone, wide = made(spark, 60)
    full = wide.na.fill(0.0, COLS)
    got = IM.chained_impute(full, COLS, F.col("side") == "reference").orderBy("record_id").collect()
    assert np.allclose([[r[c] for c in COLS] for r in got], np.where(gone, 0.0, x), atol=1e-6)
    assert IM.chained_impute(wide.limit(0), COLS, F.col("side") == "reference").count() == 0


def test_ranking_names_both(spark):
    _, _, wide = made(spark)
    got = MO.imputation_ranking(wide, COLS, rounds=1, trees=2).collect()
    assert {r["model"] for r in got} == {"median_imputation", "chained_imputation"}


def test_blocks_hold_rows_of_one_side_and_refill_without_dealing_rows():
    import pyarrow as pa

    nan, edges = float("nan"), [np.array([1.0, 2.0]), np.array([5.0])]
    o = [[1.0, nan], [nan, 4.0], [2.5, 6.0]]
    batch = pa.record_batch([pa.array(["a", None, "c"]), pa.array([True, False, True]), pa.array([1, 2, 3]), pa.array(o)], names=["id", "fit", "key", "o"])
    blocks = list(IM._started(edges, np.array([1.5, 7.0]))([batch, batch]))
    assert [(b.column("fit")[0].as_py(), b.column("n")[0].as_py()) for b in blocks] == [(True, 4), (False, 2)]
    assert blocks[0].column("ids")[0].as_py() == ["a", "c", "a", "c"] and blocks[1].column("ids")[0].as_py() == [None, None]
    assert list(blocks[0].column("x")[0].as_py()) == [1, 2, 3, 2] * 2
    rows = [r for b in blocks for out in IM._refilled(edges, None, [0, 1], 1, np.zeros(2), np.array([1.5, 7.0]), True)([b]) for r in out.to_pylist()]
    assert [(r["id"], r["v"]) for r in rows] == [("a", [1.0, 7.0]), ("c", [2.5, 6.0])] * 2 + [(None, [1.5, 4.0])] * 2
