"""Isotonic regression as a mergeable aggregate: pooled blocks of ranges of scores, merged range by range.

Pooling adjacent violators gives the same blocks whether it starts from single scores or from blocks that were pooled
before, so each range of distinct scores is pooled where it lies, neighbouring ranges are merged ``FAN`` at a time, and
the last merge holds the steps of the fitted function only (about the cube root of the number of scores for noisy outcomes).
Steps stay a table; nothing comes to the driver.  All cross-fitting folds are fitted in the same jobs: a distinct score carries its
counts by fold, and the fit for a fold leaves that fold's counts out.

Between steps the function is linear, outside it is constant.  A score finds its step by a distributed prefix sum over
step starts, then by an equi-join on the step's number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import cumulative
from ..session import cut_lineage

FAN = 16
BLOCKS = "fold int, part int, lo double, hi double, w double, y double"


def pooled(lo: np.ndarray, hi: np.ndarray, w: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Blocks (lo, hi, weight, weighted sum) with increasing means from blocks in order of lo."""
    out: list[tuple] = []
    for a, b, n, s in zip(lo.tolist(), hi.tolist(), w.tolist(), y.tolist()):
        while out and out[-1][3] * n >= s * out[-1][2]:  # the mean before is not below this one
            a, _, m, t = out.pop()
            n, s = n + m, s + t
        out.append((a, b, n, s))
    return out


def _table(rows: list[tuple]):
    import pyarrow as pa

    types = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.float64())
    cols = list(zip(*rows)) or [[]] * 6
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["fold", "part", "lo", "hi", "w", "y"])


def _local(folds: int):
    """Task function over one range of distinct scores (_pid, score, n0.., y0..): its blocks for each fold left out."""

    def run(t):
        order = np.argsort(t.column("score").to_numpy())
        col = lambda c: t.column(c).to_numpy()[order].astype(np.float64)
        score, part = col("score"), t.column("_pid")[0].as_py()
        n, y = (np.array([col(f"{c}{i}") for i in range(folds)]) for c in ("n", "y"))
        rows = []
        for i in range(folds):
            w, s = n.sum(0) - n[i], y.sum(0) - y[i]
            own = w > 0
            rows += [(i, part, *b) for b in pooled(score[own], score[own], w[own], s[own])]
        return _table(rows)

    return run


def _merged(t):
    order = np.argsort(t.column("lo").to_numpy(), kind="stable")
    lo, hi, w, y = (t.column(c).to_numpy()[order] for c in ("lo", "hi", "w", "y"))
    fold, part = t.column("fold")[0].as_py(), t.column("part")[0].as_py() // FAN
    return _table([(fold, part, *b) for b in pooled(lo, hi, w, y)])


def steps(data: DataFrame, folds: int, partitions: int | None = None) -> DataFrame:
    """fold, lo, hi, value: the steps fitted to all rows (score, label, fold) but those of the fold."""
    one = lambda i, v: F.sum(F.when(F.col("fold") == i, v).otherwise(0.0))
    counts = data.groupBy("score").agg(*[one(i, F.lit(1.0)).alias(f"n{i}") for i in range(folds)],
                                       *[one(i, F.col("label").cast("double")).alias(f"y{i}") for i in range(folds)])
    n = partitions or int(data.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # the number of a range is stored with its rows: later readers and retried tasks see the same ranges
    ranged = cut_lineage(counts.repartitionByRange(n, "score").withColumn("_pid", F.spark_partition_id()))
    blocks = ranged.groupBy("_pid").applyInArrow(_local(folds), BLOCKS)
    while n > 1:
        blocks = cut_lineage(blocks).groupBy("fold", F.floor(F.col("part") / FAN)).applyInArrow(lambda key, t: _merged(t), BLOCKS)
        n = -(-n // FAN)
    return cut_lineage(blocks.select("fold", "lo", "hi", (F.col("y") / F.col("w")).alias("value")))


def predicted(data: DataFrame, fitted: DataFrame) -> DataFrame:
    """fold, score, fitted value of the distinct (fold, score) of ``data`` under the steps of their fold."""
    asked = data.select("fold", "score").distinct().select("fold", F.col("score").alias("x"), F.lit(0).alias("start"), F.lit(1).alias("late"))
    starts = fitted.select("fold", F.col("lo").alias("x"), F.lit(1).alias("start"), F.lit(0).alias("late"), "hi", "value")
    both = asked.withColumn("hi", F.lit(None).cast("double")).withColumn("value", F.lit(None).cast("double")).unionByName(starts)
    placed = cumulative(both, ["fold"], ["x", "late"], ["start"], bounded_keys=True, materialize=True)
    step = placed.where("start = 1").select("fold", F.col("cum_start").alias("number"), F.col("x").alias("lo"), "hi", "value")
    after = step.select("fold", (F.col("number") - 1).alias("number"), F.col("lo").alias("next_lo"), F.col("value").alias("next_value"))
    first = after.where("number = 0").select("fold", F.col("next_value").alias("first_value"))  # one row a fold
    rows = placed.where("start = 0").select("fold", F.col("x").alias("score"), F.col("cum_start").alias("number"))
    met = rows.join(step, ["fold", "number"], "left").join(after, ["fold", "number"], "left").join(F.broadcast(first), "fold", "left")
    share = (F.col("score") - F.col("hi")) / (F.col("next_lo") - F.col("hi"))
    between = F.col("value") + share * (F.col("next_value") - F.col("value"))
    value = (F.when(F.col("number") == 0, F.col("first_value"))
             .when((F.col("score") <= F.col("hi")) | F.col("next_lo").isNull(), F.col("value")).otherwise(between))
    return met.select("fold", "score", value.alias("fitted"))


def cross_fitted(data: DataFrame, folds: int, partitions: int | None = None) -> DataFrame:
    """The rows of ``data`` (score, label, fold) with ``fitted``: the isotonic fit to the other folds at their score."""
    values = predicted(data, steps(data, folds, partitions))
    return data.join(values, ["fold", "score"], "left")
