"""Merged isotonic fits against a single pass over all scores."""

import numpy as np
import pytest

from yieldlens.operators import isotonic as IS
from yieldlens.operators import models as MO
from yieldlens.sources import fixtures as fx


def single_pass(x, y):
    """Knots of the isotonic fit: pool adjacent violators over sorted distinct scores, one list."""
    means = []
    for v in np.unique(x):
        means.append([y[x == v].sum(), (x == v).sum(), v, v])
        while len(means) > 1 and means[-2][0] / means[-2][1] >= means[-1][0] / means[-1][1]:
            s, n, lo, hi = means.pop()
            means[-1] = [means[-1][0] + s, means[-1][1] + n, means[-1][2], hi]
    knots = [(v, s / n) for s, n, lo, hi in means for v in ({lo, hi} if lo != hi else {lo})]
    return np.array(sorted(knots))


def check(got, folds):
    for i in range(folds):
        x, y = (np.array([r[c] for r in got if r["fold"] != i]) for c in ("score", "label"))
        knots = single_pass(x, y)
        held = [r for r in got if r["fold"] == i]
        want = np.interp([r["score"] for r in held], knots[:, 0], knots[:, 1])
        assert np.allclose([r["fitted"] for r in held], want, atol=1e-12)
        by = sorted((r["score"], r["fitted"]) for r in held)
        assert all(a[1] <= b[1] + 1e-12 for a, b in zip(by, by[1:]))


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_equals_a_single_pass(spark, partitions):
    rng = np.random.default_rng(partitions)
    x = np.round(rng.random(900), 2 if partitions == 3 else 6)
    y = (rng.random(900) < x**2).astype(float)
    rows = [(float(a), float(b), int(f)) for a, b, f in zip(x, y, rng.integers(0, 5, 900))]
    df = spark.createDataFrame(rows, "score double, label double, fold int")
    check(IS.cross_fitted(df, 5, partitions).collect(), 5)


def test_query_equals_a_single_pass(spark):
    oof = fx.scores(spark, "/root/testdata/sf0.01").where("side = 'reference'").select("record_id", "target", "probability")
    got = {r["record_id"]: r["calibrated_probability"] for r in MO.calibrate(oof, "isotonic").collect()}
    rows = oof.selectExpr("record_id", "least(greatest(probability, 1e-6), 1 - 1e-6) p", "target", "abs(xxhash64(record_id, 142)) % 5 f").collect()
    assert len(got) == len(rows)
    for i in range(5):
        rest = [r for r in rows if r["f"] != i]
        knots = single_pass(np.array([r["p"] for r in rest]), np.array([float(r["target"]) for r in rest]))
        held = [r for r in rows if r["f"] == i]
        want = np.interp([r["p"] for r in held], knots[:, 0], knots[:, 1])
        assert np.allclose([got[r["record_id"]] for r in held], want, atol=1.1e-6)


def test_scores_outside_the_fit_and_empty(spark):
    rows = [(0.2, 0.0, 0), (0.6, 1.0, 0), (0.1, 1.0, 1), (0.4, 1.0, 1), (0.9, 0.0, 1)]
    df = spark.createDataFrame(rows, "score double, label double, fold int")
    got = {r["score"]: r["fitted"] for r in IS.cross_fitted(df, 2, 2).where("fold = 1").collect()}
    assert got == {0.1: 0.0, 0.4: pytest.approx(0.5), 0.9: 1.0}
    assert IS.cross_fitted(df.where("fold > 5"), 2, 2).count() == 0
