"""Bootstrap intervals of rank and threshold metrics from weights drawn for score counts.

A class-stratified bootstrap gives every row a Poisson(1) weight in each replicate.  Rows of one score and class add up, so the
weight of ``c`` such rows is Poisson(c): it is drawn for the distinct score, from a counter-based generator whose key
is the score's bits and the class.  Draws therefore depend on nothing but the table's contents, and any task can draw them
again.

Distinct scores are put into blocks of consecutive scores by a distributed prefix sum.  A block holds its draws as a matrix of scores x
replicates, slice by slice, and gives one row of sums for a replicate; neither records nor scores are multiplied
by replicates as rows.  Ranks across blocks come from prefix sums over blocks, replicate by replicate.  A second pass adds up
the average precision, which needs the totals above a block; its task draws the same weights again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import r6
from ..functions.ranking import cumulative
from ..session import cut_lineage

REPLICATES = 2000
THRESHOLD = 0.5
BLOCK = 1 << 15         # distinct scores of a block
SLICE = 256             # distinct scores of one matrix of draws
METRICS = ("roc_auc", "average_precision", "recall", "precision", "f1", "balanced_accuracy")


def draws(scores: np.ndarray, counts: np.ndarray, label: int, replicates: int) -> np.ndarray:
    """Weights (scores, 1 + replicates) of ``counts`` rows at each score; column 0 holds the counts themselves."""
    out = np.empty((len(scores), replicates + 1), np.int64)
    out[:, 0] = counts
    bits = np.asarray(scores, np.float64).view(np.uint64).tolist()
    for i, (key, c) in enumerate(zip(bits, counts.tolist())):
        out[i, 1:] = np.random.Generator(np.random.Philox(key=[key, label])).poisson(c, replicates) if c else 0
    return out


def _slices(t, replicates: int):
    """(scores, pos weights, neg weights) of a block, highest scores first."""
    order = np.argsort(-t.column("score").to_numpy(), kind="stable")
    score, pos, neg = (t.column(c).to_numpy()[order] for c in ("score", "pos", "neg"))
    for a in range(0, len(order), SLICE):
        s = score[a : a + SLICE]
        yield s, draws(s, pos[a : a + SLICE], 1, replicates), draws(s, neg[a : a + SLICE], 0, replicates)


def _sums(replicates: int, threshold: float):
    """Task function over a block: its sums for each replicate."""

    def run(t):
        import pyarrow as pa

        zero = lambda: np.zeros(replicates + 1)
        pos, neg, tp, fp, beaten = zero(), zero(), zero(), zero(), zero()
        for s, p, n in _slices(t, replicates):
            above = pos + np.cumsum(p, axis=0) - p  # positives with higher scores in the block
            beaten += (n * (above + 0.5 * p)).sum(0)
            pos, neg = pos + p.sum(0), neg + n.sum(0)
            tp, fp = tp + p[s >= threshold].sum(0), fp + n[s >= threshold].sum(0)
        block = np.full(replicates + 1, t.column("block")[0].as_py(), np.int64)
        return pa.table([pa.array(block), pa.array(np.arange(replicates + 1, dtype=np.int32)), *map(pa.array, (pos, neg, tp, fp, beaten))],
                        names=["block", "replicate", "pos", "neg", "tp", "fp", "beaten"])

    return run


def _precision(replicates: int):
    """Task function over a block and its offsets: the block's part of each replicate's average precision."""

    def run(t, offsets):
        import pyarrow as pa

        part = np.zeros(replicates + 1)
        if t.num_rows and offsets.num_rows:
            at = np.argsort(offsets.column("replicate").to_numpy())
            tp, fp, total = (offsets.column(c).to_numpy()[at].copy() for c in ("above_pos", "above_neg", "all_pos"))
            for _, p, n in _slices(t, replicates):
                hit, miss = tp + np.cumsum(p, axis=0), fp + np.cumsum(n, axis=0)
                part += np.divide(p * hit, (hit + miss) * total, out=np.zeros(p.shape), where=p > 0).sum(0)
                tp, fp = hit[-1], miss[-1]
        return pa.table([pa.array(np.arange(replicates + 1, dtype=np.int32)), pa.array(part)], names=["replicate", "part"])

    return run


def replicate_metrics(scores: DataFrame, replicates: int = REPLICATES, threshold: float = THRESHOLD) -> DataFrame:
    """replicate (0: the table itself) and the six metrics of each; NULL where a replicate lacks a class.

    Rows without a score or target are left out."""
    known = scores.where(F.col("probability").isNotNull() & F.col("target").isNotNull())
    counts = known.groupBy(F.col("probability").cast("double").alias("score")).agg(
        F.sum((F.col("target") == 1).cast("long")).alias("pos"), F.sum((F.col("target") != 1).cast("long")).alias("neg"), F.lit(1).alias("one"))
    placed = cumulative(counts, [], ["score"], ["one"], bounded_keys=True)
    blocks = cut_lineage(placed.select("score", "pos", "neg", F.floor((F.col("cum_one") - 1) / BLOCK).alias("block")))
    sums = cut_lineage(blocks.groupBy("block").applyInArrow(
        _sums(replicates, threshold), "block long, replicate int, pos double, neg double, tp double, fp double, beaten double"))
    higher = Window.partitionBy("replicate").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    whole = Window.partitionBy("replicate")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    offsets = sums.select("block", "replicate", zero(F.sum("pos").over(higher)).alias("above_pos"),
                          zero(F.sum("neg").over(higher)).alias("above_neg"), F.sum("pos").over(whole).alias("all_pos"), "neg", "beaten")
    offsets = cut_lineage(offsets)
    parts = blocks.groupBy("block").cogroup(offsets.groupBy("block")).applyInArrow(_precision(replicates), "replicate int, part double")
    ap = parts.groupBy("replicate").agg(F.sum("part").alias("ap"))
    beaten = offsets.groupBy("replicate").agg(F.sum(F.col("beaten") + F.col("neg") * F.col("above_pos")).alias("u"))
    total = sums.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp")])
    p, n, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    both = (p > 0) & (n > 0)
    return total.join(beaten, "replicate").join(ap, "replicate").select(
        "replicate", F.when(both, F.col("u") / (p * n)).alias("roc_auc"), F.when(p > 0, F.col("ap")).alias("average_precision"),
        F.when(p > 0, tp / p).alias("recall"), F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(tp + fp + p > 0, 2 * tp / (tp + fp + p)).otherwise(0.0).alias("f1"),
        F.when(both, (tp / p + (n - fp) / n) / 2).alias("balanced_accuracy"))


def bootstrap_ci(scores: DataFrame, replicates: int = REPLICATES, threshold: float = THRESHOLD) -> DataFrame:
    """metric, estimate, and the 2.5, 50 and 97.5 % points of ``replicates`` class-stratified bootstrap replicates."""
    per = replicate_metrics(scores, replicates, threshold).unpivot(["replicate"], list(METRICS), "metric", "value")
    drawn = F.when(F.col("replicate") > 0, F.col("value"))
    at = F.percentile(drawn, F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))  # of one row a replicate
    q = per.groupBy("metric").agg(F.max(F.when(F.col("replicate") == 0, F.col("value"))).alias("estimate"), at.alias("q"))
    return q.select("metric", r6(F.col("estimate")).alias("estimate"), r6(F.get("q", F.lit(0))).alias("lower_95"),
                    r6(F.get("q", F.lit(1))).alias("median"), r6(F.get("q", F.lit(2))).alias("upper_95"),
                    F.lit(replicates).alias("replicates"))
