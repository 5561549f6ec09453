"""Contributions of fitted trees: against Shapley values over all subsets, additivity, summaries, tables without both classes."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_trees import COLS, CUR, REF, made
from yieldlens.operators import contributions as CO
from yieldlens.operators import explain as X
from yieldlens.operators import priority as PR
from yieldlens.operators import trees as TR


def random_forest_of(rng, trees, depth, width):
    forest = TR.Forest.empty(trees, depth)
    for t in range(trees):
        todo = [(0, 0, 100.0)]
        while todo:
            node, level, cover = todo.pop()
            forest.cover[t, node], forest.value[t, node] = cover, rng.normal()
            if level < depth and rng.random() < 0.85:
                forest.feature[t, node], forest.upto[t, node] = rng.integers(width), rng.integers(1, TR.BINS)
                forest.missing_left[t, node] = rng.random() < 0.5
                part = cover * rng.uniform(0.05, 0.95)
                todo += [(2 * node + 1, level + 1, part), (2 * node + 2, level + 1, cover - part)]
    return forest


def expected(forest, t, x, known, node=0):
    """Mean score of a tree where only the ``known`` features of a record are given."""
    f = forest.feature[t, node]
    if f < 0:
        return forest.value[t, node]
    children = 2 * node + 1, 2 * node + 2
    if f in known:
        left = forest.missing_left[t, node] if x[f] == 0 else x[f] <= forest.upto[t, node]
        return expected(forest, t, x, known, children[0] if left else children[1])
    c = [forest.cover[t, child] for child in children]
    return sum(ci * expected(forest, t, x, known, child) for ci, child in zip(c, children)) / sum(c)


@pytest.mark.parametrize("depth", [0, 1, 3, 5])
def test_against_all_subsets(depth):
    rng = np.random.default_rng(depth)
    width, trees = 4, 6
    forest = random_forest_of(rng, trees, depth, width)
    x = rng.integers(0, TR.BINS + 1, (25, width)).astype(np.uint8)
    got = CO.contributions(forest, x)
    for row, phi in zip(x, got):
        for i in range(width):
            others, want = [f for f in range(width) if f != i], 0.0
            for size in range(width):
                weight = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
                for some in itertools.combinations(others, size):
                    want += weight * sum(expected(forest, t, row, {*some, i}) - expected(forest, t, row, set(some)) for t in range(trees))
            assert phi[i] == pytest.approx(want, abs=1e-9)
    score = sum(forest.value[t][forest.nodes(t, x)] for t in range(trees))
    assert np.allclose(got.sum(1) + CO.base_value(forest), score, atol=1e-9)


def test_deep_paths_with_small_shares_stay_additive():
    rng = np.random.default_rng(9)
    forest = random_forest_of(rng, 20, 8, 20)
    x = rng.integers(0, TR.BINS + 1, (300, 20)).astype(np.uint8)
    score = sum(forest.value[t][forest.nodes(t, x)] for t in range(20))
    assert np.allclose(CO.contributions(forest, x).sum(1) + CO.base_value(forest), score, atol=1e-7)


def test_forest_contributions_sum_to_its_scores(spark):
    wide = made(spark, missing=0.1)
    att = CO.forest_attributions(wide, COLS, REF(), CUR(), trees=30, depth=4).cache()
    sums = att.groupBy("record_id").agg(F.sum("contribution").alias("s"), F.first("base_value").alias("b"), F.first("score").alias("p"),
                                        F.count("*").alias("n")).collect()
    scores = {r["record_id"]: r["probability"] for r in TR.balanced_forest(wide, COLS, REF(), CUR(), trees=30, depth=4).collect()}
    assert len(sums) == len(scores) == 600
    for r in sums:
        assert r["n"] == len(COLS) and r["s"] + r["b"] == pytest.approx(r["p"], abs=1e-9)
        assert r["p"] == pytest.approx(scores[r["record_id"]], abs=1e-6)
    values = {(r["record_id"], r["feature"]): r["value"] for r in att.collect()}
    for r in wide.where(CUR()).collect():
        assert all(values[r["record_id"], c] == r[c] for c in COLS)
    importance = [r["feature"] for r in X.global_importance(att).orderBy("importance_rank").collect()]
    assert importance[0] == "a"  # the table's target follows a, where b is positive
    ranked = PR.sensor_priority(att, wide, COLS, X.global_importance(att), X.failure_features(att, None))
    assert ranked.count() == 2400 and ranked.select("record_id", "feature").distinct().count() == 2400
    assert X.local_top_k(att, 2).count() == 1200 and X.local_summary(att).count() == 600


def test_one_class_and_empty_tables_have_no_rows(spark):
    wide = made(spark, 60)
    for table in (wide.withColumn("target", F.lit(0)), wide.where("false")):
        out = CO.forest_attributions(table, COLS, REF(), CUR(), trees=3, depth=2)
        assert out.columns == ["record_id", "target", "feature", "value", "contribution", "base_value", "score"] and out.count() == 0


def test_leaves_are_looked_up_together():
    forest = TR.Forest.empty(1, 5)
    rng = np.random.default_rng(3)
    forest.feature[0, :31] = rng.integers(0, 4, 31)
    forest.upto[0, :31] = rng.integers(1, 16, 31)
    forest.value[0] = rng.random(63)
    forest.cover[0] = 1.0
    blocks = CO._blocks(forest, 0, TR.BINS)
    assert len(CO.leaves(forest, 0)) == 32 and len(blocks) == 8  # one table for four leaves
    x = rng.integers(0, 17, (200, 4)).astype(np.uint8)
    sums = CO.contributions(forest, x).sum(1) + CO.base_value(forest)
    assert np.allclose(sums, forest.value[0][forest.nodes(0, x)])


def test_tables_of_a_tree_serve_many_rows():
    import pyarrow as pa

    from yieldlens.operators import contributions as CO

    batch = pa.record_batch([pa.array(np.arange(10_000))], names=["a"])
    assert [b.num_rows for b in CO._chunks(pa, [batch] * 20)] == [200_000]
