"""Exact contributions of the features to the score of fitted trees, path by path.

A tree's score for a record, with only some features known, is the mean over the leaves that the known features admit, each split on
an unknown feature sharing its weight as the fitting rows did.  A feature's contribution is its Shapley value in that game.  A leaf is a product of
one factor for each feature on its path (1 or 0 if the feature is known, the share of the fitting rows if not), so its Shapley
values depend only on which of these features the record follows.  They are computed once for each such pattern (2 ** m for the m
features of a path, m <= depth) for all leaves of a tree together, and the records of a batch look their patterns up.

Contributions of a record sum to its score less the base value, the mean score of the fitting rows as the trees weigh them.  Rows
that were fitted on, and rows of a table without both classes, have none.  Nothing is collected but the trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees as TR

BLOCK = 2
SLICE = 1 << 13
CHUNK_ROWS = 1 << 18


def leaves(forest: TR.Forest, tree: int, bins: int = TR.BINS) -> list[tuple[float, dict, list]]:
    """(value, share, path) of each leaf: by feature, the share of the fitting rows that its splits pass on; the splits from the
    root on as (node, whether the leaf is on its left)."""
    out, todo = [], [(0, {}, [])]
    while todo:
        node, share, path = todo.pop()
        f = int(forest.feature[tree, node])
        if f < 0:
            out.append((float(forest.value[tree, node]), share, path))
            continue
        both = sum(forest.cover[tree, child] for child in (2 * node + 1, 2 * node + 2))
        for child, left in ((2 * node + 1, True), (2 * node + 2, False)):
            part = float(forest.cover[tree, child] / both) if both else 0.5
            todo.append((child, {**share, f: share.get(f, 1.0) * part}, [*path, (node, left)]))
    return out


def base_value(forest: TR.Forest) -> float:
    """Sum over the trees of the mean leaf value of the fitting rows."""
    return sum(value * math.prod(share.values()) for t in range(len(forest.feature)) for value, share, _ in leaves(forest, t))


def pattern_table(value: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of leaves with m features each, of shape (leaves, 2 ** m, m): bit j of a pattern says that feature j is followed.

    The sum over all sets of other features, by size, is a product of (share + follows t); dividing by a feature's own factor gives the
    others' sums."""
    n, m = share.shape
    follows = (np.arange(2**m)[:, None] >> np.arange(m) & 1).astype(np.float64)[None]
    z = share[:, None, :]
    product = np.zeros((n, 2**m, m + 1))
    product[..., 0] = 1.0
    for j in range(m):
        zj, fj = z[..., j:j + 1], follows[..., j:j + 1]
        product[..., 1:j + 2] = product[..., 1:j + 2] * zj + product[..., :j + 1] * fj
        product[..., 0] *= zj[..., 0]
    total = rest = np.zeros((n, 2**m, m))
    for size in range(m - 1, -1, -1):
        rest = np.where(follows == 1, product[..., size + 1:size + 2] - z * rest, product[..., size:size + 1] / z)
        total = total + math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m) * rest
    return value[:, None, None] * (follows - z) * total


def _blocks(forest: TR.Forest, tree: int, bins: int) -> dict[int, tuple[list, np.ndarray, list]]:
    """Leaves taken together below the nodes BLOCK splits above the deepest: by node, the splits down to it and below it, a table of
    contributions by which of these splits a record goes left at (bit i: split i) and the features of its lines."""
    by_size: dict[int, list] = {}
    for leaf in leaves(forest, tree, bins):
        by_size.setdefault(len(leaf[1]), []).append(leaf)
    by_size.pop(0, None)  # a tree without splits gives every record its base value
    groups: dict[int, list] = {}
    depth = max(0, _longest(forest, tree) - BLOCK)
    for group in by_size.values():
        used = [sorted(share) for _, share, _ in group]
        tables = pattern_table(np.array([v for v, _, _ in group]), np.array([[share[f] for f in fs] for (_, share, _), fs in zip(group, used)]))
        for (_, _, path), fs, table in zip(group, used, tables):
            groups.setdefault(path[min(len(path) - 1, depth)][0], []).append((path, fs, table))
    out = {}
    for top, members in groups.items():
        splits = sorted({node for path, _, _ in members for node, _ in path})  # heap order: from the root on
        bit = {node: i for i, node in enumerate(splits)}
        lines = sorted({f for _, fs, _ in members for f in fs})
        left = (np.arange(2 ** len(splits)) >> np.arange(len(splits))[:, None] & 1).astype(bool)
        total = np.zeros((len(lines), 2 ** len(splits)))
        for path, fs, table in members:
            follows = {f: np.ones(left.shape[1], bool) for f in fs}
            for node, to_left in path:
                follows[int(forest.feature[tree, node])] &= left[bit[node]] == to_left
            pattern = sum(follows[f].astype(np.int64) << j for j, f in enumerate(fs))
            for j, f in enumerate(fs):
                total[lines.index(f)] += table[pattern, j]
        out[top] = splits, total, lines
    return out


def _longest(forest: TR.Forest, tree: int) -> int:
    """Splits on the tree's longest path."""
    inner = np.nonzero(forest.feature[tree] >= 0)[0]
    return int(inner[-1] + 1).bit_length() if len(inner) else 0


def _most_splits(forest: TR.Forest) -> int:
    """The most splits that a block can have: on the way to its top, and below."""
    return max((_longest(forest, t) for t in range(len(forest.feature))), default=0) + 2 ** BLOCK


def contributions(forest: TR.Forest, x: np.ndarray, bins: int = TR.BINS) -> np.ndarray:
    """(rows, features): contributions to the sum of the trees' values for binned rows."""
    columns = np.ascontiguousarray(x.T)
    out = np.zeros(columns.shape)
    kind = np.uint16 if _most_splits(forest) <= 16 else np.uint64
    for t in range(len(forest.feature)):
        blocks = _blocks(forest, t, bins)
        sides = {}
        for node in {node for splits, _, _ in blocks.values() for node in splits}:
            sides[node] = (np.arange(bins + 1) <= forest.upto[t, node]).astype(kind)
            sides[node][0] = forest.missing_left[t, node]
        for start in range(0, columns.shape[1], SLICE):
            own, added = columns[:, start:start + SLICE], out[:, start:start + SLICE]
            left = {node: side.take(own[forest.feature[t, node]]) for node, side in sides.items()}
            paths: dict = {(): np.zeros(own.shape[1], kind)}  # patterns of the splits that blocks have in common
            at, found = np.empty(own.shape[1], np.intp), np.empty(own.shape[1])
            for splits, table, lines in blocks.values():
                for i, node in enumerate(splits):
                    path = tuple(splits[:i + 1])
                    if path not in paths:
                        paths[path] = paths[path[:-1]] | left[node] << kind(i)
                np.copyto(at, paths[tuple(splits)])
                for f, line in zip(lines, table):
                    line.take(at, out=found, mode="clip")
                    added[f] += found
    return out.T


def _chunks(pa, batches):
    """The rows of many batches at once: a tree's tables are made once for each call."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK_ROWS:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def explained(rows: DataFrame, features: Sequence[str], forest: TR.Forest, scale: float = 1.0, id_col: str = "record_id") -> DataFrame:
    """id, target, feature, value, contribution, base_value, score of stored binned rows with ``values`` (see ``trees.binned``);
    ``scale`` times the sum of the trees' values is the score."""
    cols = list(features)
    base = scale * base_value(forest)

    def run(batches):
        import pyarrow as pa

        for batch in _chunks(pa, batches):
            x = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, len(cols))
            phi = scale * contributions(forest, x)
            score = scale * sum(forest.value[t][forest.nodes(t, x)] for t in range(len(forest.feature)))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(cols))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.ListArray.from_arrays(offsets, pa.array(phi.ravel())), pa.array(score)],
                names=[id_col, "target", "values", "phi", "score"])

    kind = rows.schema[id_col].dataType.simpleString()
    few = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)  # every task makes the tables of all trees
    out = few.select(id_col, "target", "values", "x").mapInArrow(
        run, f"{id_col} {kind}, target int, values array<double>, phi array<double>, score double")
    names = F.array(*[F.lit(c) for c in cols])
    out = out.select(id_col, "target", "score", F.explode(F.arrays_zip(names.alias("feature"), F.col("values").alias("value"),
                                                                       F.col("phi").alias("contribution"))).alias("_c"))
    return out.select(id_col, "target", F.col("_c")["feature"].alias("feature"), F.col("_c")["value"].alias("value"),
                      F.col("_c")["contribution"].alias("contribution"), F.lit(base).alias("base_value"), "score")


def forest_attributions(wide: DataFrame, features: Sequence[str], fit, test, trees: int = TR.TREES, depth: int = TR.DEPTH,
                        id_col: str = "record_id") -> DataFrame:
    """Contributions to the failure probability of a balanced forest fitted on the ``fit`` rows, for the ``test`` rows: the same
    columns as ``explain.attributions``, so all its summaries apply, with the base value and the score of the record."""
    rows = TR.binned(wide.where(fit | test), features, fit, id_col, values=True)
    forest = TR.fit_balanced_forest(rows.where("fit"), len(features), trees, depth)
    rest = rows.where("not fit")
    if forest is None:
        return explained(rest.where("false"), features, TR.Forest.empty(0, 0), 1.0, id_col)
    return explained(rest, features, forest, 1.0 / trees, id_col)
