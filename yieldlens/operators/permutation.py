"""Permutation importance of a fitted score: a shuffled column is one equi-join on permuted positions.

Records get positions 0..n-1.  A keyed Feistel network over the positions is a permutation for every repeat, computed for
any position on its own: a record sends its column contributions to the position that the network gives, once a repeat, and an
equi-join brings them to the record there.  With both lists at hand all columns are swapped in turn in numpy, and each task counts
scores, rounded to 1 / ``STEPS``, by column, repeat and class.  So neither records x columns x repeats nor their scores are
ever rows.  Average precision comes from these counts, the same way for the unshuffled scores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..functions.expressions import r6
from ..functions.ranking import cumulative
from ..session import cut_lineage
from . import metrics as M

REPEATS = 20
STEPS = 10_000
SEED = 42
ROUNDS = 4


def permuted(position: np.ndarray, n: int, key: int) -> np.ndarray:
    """The keyed permutation of 0..n-1 at the given positions: Feistel rounds on two halves of the bits, walked until below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = position.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(ROUNDS):
            z = right ^ np.uint64(((key + 1) * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
            left, right = right, left ^ ((z ^ (z >> np.uint64(31))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _sent(n: int, repeats: int):
    """Task function over (pos, c): (repeat, pos it is sent to, c) for every repeat."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.column(0).to_numpy()
            for r in range(repeats):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r, np.int32)), pa.array(permuted(at, n, SEED + r)), batch.column(1)],
                                                 names=["repeat", "to", "d"])

    return run


def _counted(width: int):
    """Task function over (repeat, target, c, d): counts of rounded scores by column and class, column i swapped for d's."""

    def run(batches):
        import pyarrow as pa

        def matrix(column):
            return column.flatten().to_numpy().reshape(len(column), -1)

        def table(r, h):
            column, step = np.nonzero(h.any(2))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(step), r, np.int32)), pa.array(column.astype(np.int32)), pa.array(step.astype(np.int32)),
                 pa.array(h[column, step, 1]), pa.array(h[column, step, 0])], names=["repeat", "column", "step", "pos", "neg"])

        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            repeat, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            c, d = matrix(batch.column(2)), matrix(batch.column(3))
            margin = c.sum(1)
            for r in np.unique(repeat).tolist():
                own = repeat == r
                h = sums.setdefault(r, np.zeros((width, STEPS + 1, 2), np.int64))
                for j in range(width):
                    z = margin[own] - c[own, j] + d[own, j]
                    step = np.rint(STEPS / (1 + np.exp(-np.clip(z, -40, 40)))).astype(np.int64)
                    np.add.at(h[j], (step, y[own]), 1)
            if len(sums) * width > 1 << 10:  # a bound on the task's memory: hand over what there is
                yield from (table(r, h) for r, h in sums.items())
                sums = {}
        yield from (table(r, h) for r, h in sums.items())

    return run


def _precision(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average precision by keys from counts (step, pos, neg)."""
    summed = counts.groupBy(*keys, "step").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return M.average_precision(cumulative(summed, list(keys), ["step"], ["pos", "neg"], with_totals=True, bounded_keys=True), list(keys))


def permutation_importance(wide: DataFrame, features: Sequence[str], weights: dict[str, float], missing: dict[str, float], offset: float,
                           fill: dict[str, float], repeats: int = REPEATS, key: str = "record_id") -> DataFrame:
    """feature, importance_mean, importance_std, positive_importance: the drop in average precision of the logistic score
    offset + sum(weights x + missing [x is missing]) when a column is permuted, over ``repeats`` permutations.

    ``fill`` stands for missing values.  Rows without a target are left out; a table without positives gives NULLs."""
    cols = list(features)
    parts = []
    for i, f in enumerate(cols):
        x = finite(f)
        part = F.coalesce(x, F.lit(float(fill.get(f) or 0.0))) * F.lit(float(weights[f])) + F.when(x.isNull(), F.lit(float(missing[f]))).otherwise(0.0)
        parts.append(part + F.lit(float(offset)) if i == 0 else part)
    rows = wide.where(F.col("target").isNotNull()).select(F.col(key).alias("_key"), F.col("target").cast("int").alias("target"),
                                                          F.array(*parts).alias("c"), F.lit(1).alias("one"))
    placed = cut_lineage(cumulative(rows, [], ["_key"], ["one"], bounded_keys=True).select((F.col("cum_one") - 1).alias("pos"), "target", "c"))
    n = placed.count()
    margin = F.aggregate("c", F.lit(0.0), lambda a, b: a + b)
    step = F.rint(F.lit(float(STEPS)) / (1 + F.exp(-margin))).cast("int")
    base = placed.select(step.alias("step"), F.col("target").cast("long").alias("pos"), (1 - F.col("target")).cast("long").alias("neg"))
    sent = placed.select("pos", "c").mapInArrow(_sent(n, repeats), "repeat int, to long, d array<double>")
    met = placed.join(sent, placed["pos"] == sent["to"]).select("repeat", "target", "c", "d")
    counts = met.mapInArrow(_counted(len(cols)), "repeat int, column int, step int, pos long, neg long")
    drops = _precision(counts, ["repeat", "column"]).crossJoin(F.broadcast(_precision(base, []).select(F.col("average_precision").alias("_base"))))
    name = F.get(F.array(*[F.lit(f) for f in cols]), F.col("column"))
    drop = F.col("_base") - F.col("average_precision")
    return drops.groupBy(name.alias("feature")).agg(r6(F.avg(drop)).alias("importance_mean"), r6(F.stddev_samp(drop)).alias("importance_std"),
                                                    (F.avg(drop) > 0).alias("positive_importance"))
