"""Histogram trees: balanced bags, splits against brute force, boosting by hand, missing values, and scores that separate classes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.operators import trees as TR

COLS = ["a", "b", "c", "d"]
SCHEMA = "record_id string, side string, target int, a double, b double, c double, d double, key string, x string"


def made(spark, n=1200, seed=2, missing=0.0, informative_missing=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 4))
    y = (rng.random(n) < 1 / (1 + np.exp(-(2.5 * x[:, 0] * (x[:, 1] > 0) - 3)))).astype(int)
    gone = rng.random((n, 4)) < missing
    if informative_missing:
        gone[:, 3] = rng.random(n) < np.where(y == 1, 0.8, 0.1)
    rows = [(f"r{i:05d}", "reference" if i % 2 else "current", int(y[i]), *[None if gone[i, j] else float(x[i, j]) for j in range(4)], "k", "x")
            for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def REF():
    return F.col("side") == "reference"


def CUR():
    return F.col("side") == "current"


def auc(rows):
    p, n = ([r["probability"] for r in rows if r["target"] == t] for t in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in p for b in n])


def test_bags_are_balanced_and_differ():
    rng = np.random.default_rng(1)
    key, y = rng.integers(0, 2**63, 20000).astype(np.uint64), (rng.random(20000) < 0.05).astype(int)
    small = int(y.sum())
    bags = np.array([TR.bag(key, y, t, 1, small / (len(y) - small)) for t in range(60)])
    for w in bags:
        assert abs(w[y == 1].sum() - small) < 5 * math.sqrt(small) and abs(w[y == 0].sum() - small) < 5 * math.sqrt(small)
    assert abs(bags[:, y == 1].var() - 1) < 0.05 and len({w.tobytes() for w in bags}) == 60
    corr = np.corrcoef(bags[:, y == 1][:12])
    assert abs(corr[np.triu_indices(12, 1)]).max() < 0.15


def test_balanced_forest_separates_and_ignores_row_order(spark):
    wide = made(spark)
    one = {r["record_id"]: r for r in TR.balanced_forest(wide, COLS, REF(), CUR(), trees=40, depth=4).collect()}
    other = {r["record_id"]: r for r in TR.balanced_forest(wide.orderBy(F.desc("record_id")).repartition(7), COLS, REF(), CUR(), trees=40, depth=4).collect()}
    assert one == other and len(one) == 600
    assert auc(list(one.values())) > 0.75


def test_levels_in_several_jobs_give_the_same_trees(spark, monkeypatch):
    rows = TR.binned(made(spark, 400), COLS, REF()).where("fit")
    one = TR.fit_balanced_forest(rows, 4, trees=6, depth=3)
    monkeypatch.setattr(TR, "HISTOGRAM_BYTES", 1)
    other = TR.fit_balanced_forest(rows, 4, trees=6, depth=3)
    assert all((getattr(one, f) == getattr(other, f)).all() for f in ("feature", "upto", "missing_left", "value"))


def test_root_split_equals_brute_force(spark):
    wide = made(spark, 500, seed=5, missing=0.2)
    rows = TR.binned(wide, COLS, REF()).where("fit")
    data = rows.collect()
    x, y = np.array([list(r["x"]) for r in data]), np.array([r["target"] for r in data])
    weigh = lambda x, y, key, t: (np.arange(len(x)), (y == 1).astype(float), (y != 1).astype(float))
    _, roots = TR.grow(rows, 4, 1, 1, weigh)
    worth = lambda m: (y[m].sum() ** 2 + (1 - y[m]).sum() ** 2) / m.sum()
    best = 0
    for f in range(4):
        for upto in range(1, TR.BINS + 1):
            for side in (False, True):
                left = np.where(x[:, f] == 0, side, x[:, f] <= upto)
                if left.sum() >= 2 and (~left).sum() >= 2:
                    best = max(best, worth(left) + worth(~left) - worth(np.ones(len(y), bool)))
    assert roots[0]["gain"] == pytest.approx(best)


def test_first_stumps_follow_adaboost_by_hand(spark):
    # one feature; values 1..6, the best stump is x > 3 with one row wrong of 8
    values = [(1.0, 0), (2.0, 0), (3.0, 0), (3.0, 0), (4.0, 1), (5.0, 1), (6.0, 1), (1.0, 1)]
    rows = [(f"r{i}", "reference", y, v, None, None, None, "k", "x") for i, (v, y) in enumerate(values)]
    fit = TR.binned(spark.createDataFrame(rows, SCHEMA), ["a"], REF()).where("fit")
    scores, votes = TR.fit_easy_ensemble(fit, 1, members=1, stumps=1)
    assert votes[0] == [pytest.approx(math.log(7))]
    at = {list(r["x"])[0]: r["target"] for r in fit.collect()}
    assert sorted({round(float(scores[0, 0, b]), 9) for b in at}) == [round(-math.log(7), 9), round(math.log(7), 9)]
    _, two = TR.fit_easy_ensemble(fit, 1, members=1, stumps=2)
    # then the wrong row weighs 7 / 14 and each other row 1 / 14; the best stumps are wrong for 4 / 14
    assert two[0] == [pytest.approx(math.log(7)), pytest.approx(math.log(2.5))]


def test_easy_ensemble_separates(spark):
    got = TR.easy_ensemble(made(spark), COLS, REF(), CUR(), members=4, stumps=10).collect()
    assert len(got) == 600 and auc(got) > 0.7


def test_boosting_learns_from_missing_values(spark):
    plain = auc(TR.boosted_trees(made(spark), COLS, REF(), CUR(), rounds=8, depth=3).collect())
    told = auc(TR.boosted_trees(made(spark, informative_missing=True), COLS, REF(), CUR(), rounds=8, depth=3).collect())
    assert plain > 0.7 and told > plain + 0.05


def test_one_class_gives_no_scores(spark):
    wide = made(spark, 100).withColumn("target", F.lit(0))
    for model in (TR.balanced_forest, TR.easy_ensemble, TR.boosted_trees):
        got = model(wide, COLS, REF(), CUR()).collect()
        assert len(got) == 50 and all(r["probability"] is None for r in got)


def test_nodes_follow_the_splits_one_by_one():
    rng = np.random.default_rng(5)
    forest = TR.Forest.empty(3, 4)
    forest.feature[:, :15] = rng.integers(-1, 6, (3, 15))
    forest.upto[:, :15] = rng.integers(1, 16, (3, 15))
    forest.missing_left[:, :15] = rng.random((3, 15)) < 0.5
    x = rng.integers(0, 17, (500, 6)).astype(np.uint8)
    for t in range(3):
        for row, got in zip(x, forest.nodes(t, x)):
            at = 0
            while forest.feature[t, at] >= 0:
                v = row[forest.feature[t, at]]
                at = 2 * at + 2 - int(forest.missing_left[t, at] if v == 0 else v <= forest.upto[t, at])
            assert at == got


def test_poisson_numbers_invert_the_distribution():
    u = np.array([0.0, math.exp(-1.0) - 1e-12, math.exp(-1.0) + 1e-12, 0.74, 0.95, 1 - 1e-16])
    assert TR.poisson(u, 1.0).tolist() == [0, 0, 1, 2, 3, 12]


def test_a_task_takes_many_batches_at_once():
    import pyarrow as pa

    batch = pa.record_batch([pa.array([b"\x01\x02"] * 10), pa.array([1] * 10), pa.array(range(10))], names=["x", "target", "key"])
    chunks = list(TR._chunks([batch] * 7, 2))
    assert [len(c[0]) for c in chunks] == [70] and chunks[0][0].shape == (70, 2)


def test_the_margin_of_boosted_trees_is_stored_every_few_rounds(spark, monkeypatch):
    stored, cut = [], TR.cut_lineage
    monkeypatch.setattr(TR, "cut_lineage", lambda df: stored.append(df) or cut(df))
    rows = [(f"r{i}", int(i % 4 == 0), True, i, bytes([1 + i % 7 + 8 * (i % 4 == 0), i % 5])) for i in range(300)]
    train = spark.createDataFrame(rows, "record_id string, target int, fit boolean, key long, x binary")
    monkeypatch.setattr(TR, "MARGIN_ROUNDS", 100)
    plain = TR.fit_boosted_trees(train, 2, rounds=5, depth=2)[1]
    assert not stored
    monkeypatch.setattr(TR, "MARGIN_ROUNDS", 2)
    kept = TR.fit_boosted_trees(train, 2, rounds=5, depth=2)[1]
    assert len(stored) == 2
    assert (plain.feature == kept.feature).all() and (plain.upto == kept.upto).all() and np.allclose(plain.value, kept.value)


def test_boosting_takes_all_rounds_and_grows_the_trees_of_single_levels(spark):
    import inspect

    assert inspect.signature(TR.boosted_trees).parameters["rounds"].default == 500 and TR.LEARNING_RATE == 0.03
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 17, (900, 5)), rng.random(900) < 0.2
    y |= (x[:, 1] > 12) & (x[:, 3] == 0)
    train = spark.createDataFrame([(f"r{i}", int(y[i]), True, i, bytes(x[i].tolist())) for i in range(900)],
                                  "record_id string, target int, fit boolean, key long, x binary").repartition(5)
    got = TR.fit_boosted_trees(train, 5, rounds=3, depth=3, rate=0.5)[1]
    weight, margin, by_key = {1: (~y).sum() / y.sum(), 0: 1.0}, np.zeros(900), x.astype(np.uint8)
    for r in range(3):
        def weigh(x, y, key, tree, margin=margin.copy()):
            p, w = 1 / (1 + np.exp(-margin[key.astype(int)])), np.where(y == 1, weight[1], weight[0])
            return np.arange(len(x)), w * (p - y), w * p * (1 - p)

        one, _ = TR.grow(train, 5, 1, 3, weigh, "newton", per_node=4, least=TR.MIN_HESSIAN, seed=TR.SEED + r)
        inner = one.feature[0] >= 0
        assert (got.feature[r] == one.feature[0]).all() and (got.upto[r][inner] == one.upto[0][inner]).all()
        assert np.allclose(got.value[r], 0.5 * one.value[0]) and np.allclose(got.cover[r], one.cover[0])
        margin += 0.5 * one.value[0][one.nodes(0, by_key)]
