"""Chained imputation by bootstrapped regression trees, all incomplete columns in one job a tree level.

Missing cells start as medians.  In every round each incomplete column gets its own trees, fitted to the rows where it was
observed, on bins of the other columns as they are filled so far; a tree's bootstrap weights come from a hash of row and
tree.  The trees of all columns grow together from one pass over the rows a level (``trees.grow``: histograms of
sums, one row a node to the driver).  Then one pass refills all missing cells with the means of their column's trees, and the
round's table is written: blocks of rows, with the cells as given and the bins as filled so far.  Observed cells never change.

Fitted on the ``fit`` rows, applied to all.  A column without any observed value stays NULL and is no input to others;
a table without missing cells is returned as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..functions.expressions import r6
from ..functions.ranking import column_quantiles
from ..session import cut_lineage
from . import trees as TR

ROUNDS = 10
TREES = 5
DEPTH = 5
MIN_ROWS = 5.0
BLOCK_ROWS = 1 << 15


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _started(edges: list[np.ndarray], medians: np.ndarray):
    """Task function over (id, fit, key, o): blocks of rows that are all fitted on or all not, with the ids, the keys, the columns of ``o``
    one after the other (NaN where missing) and the bins ``x`` of the values filled so far."""

    def run(batches):
        import pyarrow as pa

        held: dict = {True: [], False: []}

        def block(fit):
            ids, key, o = zip(*held[fit])
            held[fit] = []
            o = np.concatenate(o)
            x = np.stack([1 + np.searchsorted(e, np.where(np.isnan(o[:, j]), medians[j], o[:, j]), "left") for j, e in enumerate(edges)], 1)
            ids = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([fit]), pa.array([len(o)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 *[pa.array([v.tobytes()], pa.binary()) for v in (np.concatenate(key), np.ascontiguousarray(o.T), x.astype(np.uint8))]],
                names=["fit", "n", "ids", "key", "o", "x"])

        for batch in batches:
            if not batch.num_rows:
                continue
            own, key, o = batch.column(1).to_numpy(zero_copy_only=False).astype(bool), batch.column(2).to_numpy(), _matrix(batch.column(3), len(edges))
            for fit in (True, False):
                at = np.flatnonzero(own == fit)
                if len(at):
                    held[fit].append((batch.column(0).take(pa.array(at)), key[at], o[at]))
                if sum(len(k) for _, k, _ in held[fit]) >= BLOCK_ROWS:
                    yield block(fit)
        for fit in (True, False):
            if held[fit]:
                yield block(fit)

    return run


def _refilled(edges: list[np.ndarray], forest: TR.Forest | None, columns: list[int], per: int, means: np.ndarray, medians: np.ndarray, last: bool):
    """Task function over blocks: missing cells of ``columns`` become the means of their ``per`` trees (medians without a forest).
    Gives the blocks with their new bins, or at ``last`` the rows (id, v) with their values."""

    def run(batches):
        import pyarrow as pa

        width = len(edges)
        steps = [forest.steps(t) for t in range(len(forest.feature))] if forest else []
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("n")[i].as_py()
                o = np.frombuffer(batch.column("o")[i].as_buffer()).reshape(width, n)
                x = np.frombuffer(batch.column("x")[i].as_buffer(), np.uint8).reshape(n, width)
                flat, new, v = x.ravel(), x.copy(), np.where(np.isnan(o), medians[:, None], o) if last else None
                for k, c in enumerate(columns if forest else []):
                    gone = np.flatnonzero(np.isnan(o[c]))
                    if len(gone):
                        at = gone * width
                        fill = means[c] + sum(forest.value[t].take(TR.walked(steps[t], flat, at)) for t in range(k * per, (k + 1) * per)) / per
                        new[gone, c] = 1 + np.searchsorted(edges[c], fill, "left")
                        if last:
                            v[c, gone] = fill
                if last:
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(v.T.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, lists], names=["id", "v"])
                else:
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in ("fit", "n", "ids", "key", "o")],
                                                      pa.array([new.tobytes()], pa.binary())], names=["fit", "n", "ids", "key", "o", "x"])

    return run


def _weigh(owner: list[int], means: np.ndarray, seed: int, width: int):
    """``weigh`` of the columns' trees: the rows where a tree's column was observed, with bootstrap weights."""
    chances = [TR.least_drawn(c) for c in TR.poisson_steps(1.0)]
    held: list = [None, None, None, None]

    def weigh(x, y, key, tree):
        c = owner[tree]
        if held[0] is not y or held[1] != c:  # one block after the other, a column's trees together
            value = y.reshape(width, -1)[c]
            rows = np.flatnonzero(~np.isnan(value))
            held[:] = y, c, rows, value.take(rows) - means[c]
        rows = held[2]
        z = TR.drawn(key.take(rows), tree, seed)
        own = np.flatnonzero(z >= chances[0])
        z, w = z.take(own), np.ones(len(own))
        for chance in chances[1:]:
            more = z >= chance
            if not more.any():
                break
            w += more
        return rows.take(own), -w * held[3].take(own), w

    return weigh


def chained_impute(wide: DataFrame, features: Sequence[str], fit, rounds: int = ROUNDS, trees: int = TREES, depth: int = DEPTH,
                   id_col: str = "record_id") -> DataFrame:
    """id and the columns with their missing cells filled (6 decimals)."""
    cols = list(features)
    o = F.array(*[F.coalesce(finite(c).cast("double"), F.lit(float("nan"))) for c in cols])
    held = cut_lineage(wide.select(F.col(id_col).alias("id"), F.coalesce(fit, F.lit(False)).alias("fit"),
                                   F.xxhash64(F.col(id_col).cast("string")).alias("key"), o.alias("o")))
    each = [F.get("o", F.lit(j)) for j in range(len(cols))]
    facts = held.agg(*[F.max(F.isnan(c)).alias(f"m{j}") for j, c in enumerate(each)],
                     *[F.avg(F.when(F.col("fit") & ~F.isnan(c), c)).alias(f"a{j}") for j, c in enumerate(each)]).first()
    cuts: dict = {c: {} for c in cols}
    at = column_quantiles(held.where("fit").select(*[F.when(~F.isnan(c), c).alias(cols[j]) for j, c in enumerate(each)]), cols,
                          [i / TR.BINS for i in range(1, TR.BINS)])
    for r in at.select("feature", "j", "quantile").collect():  # columns x bins
        cuts[r["feature"]][r["j"]] = r["quantile"]
    edges = [np.array(sorted(set(cuts[c].values()))) for c in cols]
    medians = np.array([cuts[c].get(TR.BINS // 2 - 1, 0.0) for c in cols])
    means = np.array([0.0 if facts[f"a{j}"] is None else facts[f"a{j}"] for j in range(len(cols))])
    known = [j for j in range(len(cols)) if facts[f"a{j}"] is not None]
    gone = [j for j in known if facts[f"m{j}"]]
    kind = held.schema["id"].dataType.simpleString()
    schema, forest = f"fit boolean, n int, ids array<{kind}>, key binary, o binary, x binary", None
    now = cut_lineage(held.mapInArrow(_started(edges, medians), schema), "none")
    owner = [c for c in gone for _ in range(trees)]
    closed = [[c, *[j for j in range(len(cols)) if j not in known]] for c in owner]  # no tree sees its own column

    rounds = rounds if gone and len(known) > 1 else 0
    for r in range(rounds):
        if r:
            now = cut_lineage(now.mapInArrow(_refilled(edges, forest, gone, trees, means, medians, False), schema), "none")
        forest, _ = TR.grow(now.where("fit").select("n", "x", F.col("o").alias("target"), "key"), len(cols), len(owner), depth,
                            _weigh(owner, means, TR.SEED + 100 * (r + 1), len(cols)), "newton", per_node=max(1, len(known) // 3), least=MIN_ROWS,
                            seed=TR.SEED + r, closed=closed)
    now = now.mapInArrow(_refilled(edges, forest, gone, trees, means, medians, True), f"id {kind}, v array<double>")
    filled = [r6(F.get("v", F.lit(j))) if j in known else F.lit(None).cast("double") for j in range(len(cols))]
    return cut_lineage(now).select(F.col("id").alias(id_col), *[c.alias(cols[j]) for j, c in enumerate(filled)])
