"""Permutation importance against a plain loop with the same permutations."""

import numpy as np
import pytest

from yieldlens.operators import permutation as PM


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 5001])
def test_positions_are_permuted(n):
    seen = [PM.permuted(np.arange(n), n, key) for key in (1, 2)]
    assert all(sorted(p) == list(range(n)) for p in seen)
    assert n < 17 or ((seen[0] != seen[1]).mean() > 0.8 and (seen[0] != np.arange(n)).mean() > 0.8)
    if n == 5001:
        assert abs(np.corrcoef(seen[0], np.arange(n))[0, 1]) < 0.08 and abs(np.corrcoef(seen[0], seen[1])[0, 1]) < 0.08


def precision(y, s):
    ap, P = 0.0, y.sum()
    for v in np.unique(s):
        at, up = s == v, s >= v
        ap += y[at].sum() / P * y[up].sum() / up.sum()
    return ap


def test_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    n = 500
    x = rng.normal(0, 1, (n, 3))
    gone = rng.random((n, 3)) < 0.1
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] + 0.5 * x[:, 1] - 1)))).astype(int)
    cols = ["a", "b", "z"]
    rows = [(f"r{i:04d}", int(y[i]), *[None if gone[i, j] else float(x[i, j]) for j in range(3)], "clash") for i in range(n)]
    df = spark.createDataFrame([*rows, ("q", None, 1.0, 1.0, 1.0, "clash")], "record_id string, target int, a double, b double, z double, c string")
    w, m, fill = {"a": 2.0, "b": 0.5, "z": 0.0}, {"a": -0.3, "b": 0.2, "z": 0.0}, {"a": 0.1, "b": 0.0, "z": 0.0}
    got = {r["feature"]: r for r in PM.permutation_importance(df.repartition(4), cols, w, m, -1.0, fill, repeats=4).collect()}
    c = np.array([[(fill[f] if gone[i, j] else x[i, j]) * w[f] + (m[f] if gone[i, j] else 0.0) for j, f in enumerate(cols)] for i in range(n)])
    c[:, 0] += -1.0
    score = lambda z: np.rint(PM.STEPS / (1 + np.exp(-z)))
    base = precision(y, score(c.sum(1)))
    for j, f in enumerate(cols):
        drops = []
        for r in range(4):
            donor = np.empty(n, int)
            donor[PM.permuted(np.arange(n), n, PM.SEED + r)] = np.arange(n)
            drops.append(base - precision(y, score(c.sum(1) - c[:, j] + c[donor, j])))
        assert got[f]["importance_mean"] == pytest.approx(np.mean(drops), abs=2e-6)
        assert got[f]["importance_std"] == pytest.approx(np.std(drops, ddof=1), abs=2e-6)
    assert got["a"]["positive_importance"] and got["a"]["importance_mean"] > 0.1 and not got["z"]["positive_importance"]
