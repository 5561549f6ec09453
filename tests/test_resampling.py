"""Bootstrap intervals: replicates against plain weighted metrics, the AUC's width against its formula, and corners."""

import numpy as np
import pytest

from yieldlens.operators import resampling as RS

SCHEMA = "probability double, target int, replicate int"


def rows(n, seed=1, digits=2, shift=1.0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.2).astype(int)
    p = 1 / (1 + np.exp(-(rng.normal(0, 1, n) + shift * y - 1)))
    return [(round(float(a), digits), int(b), 0) for a, b in zip(p, y)]


def plain(data, replicates, threshold=0.5):
    """The six metrics of the table and of each replicate, from the weights of the distinct scores."""
    s = np.array(sorted({r[0] for r in data}))
    count = lambda t: np.array([sum(1 for p, y, _ in data if p == v and y == t) for v in s])
    pos, neg = RS.draws(s, count(1), 1, replicates), RS.draws(s, count(0), 0, replicates)
    out = []
    for k in range(replicates + 1):
        w1, w0 = pos[:, k].astype(float), neg[:, k].astype(float)
        P, N = w1.sum(), w0.sum()
        auc = sum(w1[i] * (w0[:i].sum() + 0.5 * w0[i]) for i in range(len(s))) / (P * N)
        ap = sum(w1[i] / P * w1[i:].sum() / (w1[i:].sum() + w0[i:].sum()) for i in range(len(s)) if w1[i])
        tp, fp = w1[s >= threshold].sum(), w0[s >= threshold].sum()
        out.append([auc, ap, tp / P, tp / (tp + fp) if tp + fp else 0, 2 * tp / (tp + fp + P), (tp / P + 1 - fp / N) / 2])
    return np.array(out)


@pytest.mark.parametrize("block", [RS.BLOCK, 7])
def test_replicates_equal_plain_weighted_metrics(spark, monkeypatch, block):
    monkeypatch.setattr(RS, "BLOCK", block)
    monkeypatch.setattr(RS, "SLICE", 5)
    data = rows(400)
    df = spark.createDataFrame([*data, (None, 1, 0), (0.5, None, 0)], SCHEMA).repartition(5)
    got = RS.replicate_metrics(df, 20).orderBy("replicate").collect()
    assert np.allclose([[r[m] for m in RS.METRICS] for r in got], plain(data, 20))


def test_width_of_the_auc_follows_its_formula(spark):
    data = rows(3000, seed=3, digits=6)
    got = {r["metric"]: r for r in RS.bootstrap_ci(spark.createDataFrame(data, SCHEMA)).collect()}
    assert sorted(got) == sorted(RS.METRICS) and {r["replicates"] for r in got.values()} == {2000}
    p, n = (np.array([s for s, y, _ in data if y == t]) for t in (1, 0))
    wins = (p[:, None] > n[None]) + 0.5 * (p[:, None] == n[None])
    se = np.sqrt(wins.mean(1).var(ddof=1) / len(p) + wins.mean(0).var(ddof=1) / len(n))
    auc = got["roc_auc"]
    assert abs(auc["estimate"] - wins.mean()) < 1e-6
    assert abs((auc["upper_95"] - auc["lower_95"]) / (2 * 1.96 * se) - 1) < 0.1
    assert all(r["lower_95"] <= r["median"] <= r["upper_95"] for r in got.values())


def test_one_class_and_no_rows(spark):
    one = {r["metric"]: r for r in RS.bootstrap_ci(spark.createDataFrame([(0.9, 1, 0)] * 5, SCHEMA), 10).collect()}
    assert one["roc_auc"]["estimate"] is None and one["recall"]["estimate"] == 1.0
    none = RS.bootstrap_ci(spark.createDataFrame([], SCHEMA), 10).collect()
    assert all(r["estimate"] is None for r in none)
