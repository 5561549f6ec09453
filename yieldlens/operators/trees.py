"""Tree ensembles grown level by level from histograms, with a weight for each (tree, row) and a bin for missing values.

Rows are binned once (bin 0: missing, then up to ``BINS`` quantile bins of the fitting rows) and stored.  One job grows one level
of all trees: tasks add up two numbers for each (tree, node, feature, bin) over their rows, Spark sums these histograms, the best
split of a node is computed from its row of sums, and the driver receives one row a node.  Where the nodes of a
level need more than ``HISTOGRAM_BYTES`` in a task, the level takes several jobs of some trees each.  No row is copied for a tree: the weight of
a row in a tree is drawn in the task from a hash of both.

A split sends bins up to a limit to the left, and the missing bin to whichever side gains more; a split that parts missing from
known values is possible.  Nothing is filled in.

* ``balanced_forest``: every tree draws its own balanced bag, with replacement: Poisson(1) for rows of the smaller class,
  Poisson(smaller / larger) for the others.
* ``easy_ensemble``: every member boosts stumps (weights exp(-y F / 2), AdaBoost's) on all rows of the smaller class and an
  equal share of the larger one, all members at once.
* ``boosted_trees``: gradient boosting on the logistic loss with Newton leaves and a weight for the smaller class.

Results don't depend on partitioning or row order beyond the last digits of float sums.  A null target is not fitted
on; a table without both classes gives NULL probabilities.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..functions.expressions import r6
from ..functions.ranking import column_quantiles
from ..session import cut_lineage
from . import together as TG

BINS = 16
TREES = 500
DEPTH = 8
MEMBERS = 20
STUMPS = 50
ROUNDS = 500
BOOSTED_DEPTH = 4
LEARNING_RATE = 0.03
MIN_SPLIT = 6.0
MIN_LEAF = 2.0
MIN_HESSIAN = 3.0
L2 = 1.0
SEED = 42
HISTOGRAM_BYTES = 96 << 20
CHUNK_ROWS = 1 << 16
MARGIN_ROUNDS = 100
PACKED = "n int, x binary, target binary, key binary"


@dataclass(frozen=True)
class Forest:
    """Trees in heap order (children of i: 2 i + 1 and 2 i + 2): ``feature`` (-1: leaf), ``upto`` (last bin that goes left),
    ``missing_left``, ``value`` and ``cover`` (weight of the fitting rows), each of shape (trees, nodes)."""

    feature: np.ndarray
    upto: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @staticmethod
    def empty(trees: int, depth: int) -> "Forest":
        shape = (trees, 2 ** (depth + 1) - 1)
        return Forest(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape, bool), np.zeros(shape), np.zeros(shape))

    def steps(self, tree: int, bins: int = BINS) -> tuple[np.ndarray, np.ndarray, int]:
        """What ``walked`` needs of a tree: the child for each (node, bin), the nodes' features, the levels with a split."""
        feature = self.feature[tree]
        inner = np.nonzero(feature >= 0)[0]
        step = np.repeat(np.arange(len(feature)), bins + 1).reshape(-1, bins + 1)  # a leaf leads to itself
        left = np.arange(bins + 1) <= self.upto[tree, inner, None]
        left[:, 0] = self.missing_left[tree, inner]
        step[inner] = 2 * inner[:, None] + 2 - left
        return step.ravel(), np.maximum(feature, 0).astype(np.int64), int(inner[-1] + 1).bit_length() if len(inner) else 0

    def nodes(self, tree: int, x: np.ndarray, bins: int = BINS) -> np.ndarray:
        """The node that each row of binned values ends in."""
        return walked(self.steps(tree, bins), np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], bins)


def walked(steps: tuple, flat: np.ndarray, start: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The node that each row ends in; a row's binned values begin at its place ``start`` in ``flat``."""
    step, column, levels = steps
    at = np.zeros(len(start), np.int64)
    for _ in range(levels):
        held = flat.take(start + column.take(at))
        at *= bins + 1
        at += held
        at = step.take(at)
    return at


def drawn(key: np.ndarray, tree: int, seed: int = SEED) -> np.ndarray:
    """53 random bits from a mixing hash of 64-bit keys and a tree's number."""
    start = (seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1B54A32D192ED03) % 2**64
    z = key.astype(np.uint64, copy=False) ^ np.uint64(start)
    high = np.empty_like(z)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        np.right_shift(z, np.uint64(shift), out=high)
        z ^= high
        z *= np.uint64(factor)
    np.right_shift(z, np.uint64(31), out=high)
    z ^= high
    z >>= np.uint64(11)
    return z


def uniform(key: np.ndarray, tree: int, seed: int = SEED) -> np.ndarray:
    """Numbers in [0, 1) from ``drawn``."""
    return drawn(key, tree, seed).astype(np.float64) / (1 << 53)


def least_drawn(chance: float) -> np.uint64:
    """The smallest ``drawn`` whose number is ``chance`` or more."""
    return np.uint64(math.ceil(chance * (1 << 53)))


def poisson_steps(rate: float) -> list[float]:
    """Where the distribution of a Poisson number (rate 1 at most) rises to the next number, up to 12."""
    term = total = math.exp(-rate)
    steps = [total]
    for k in range(1, 12):
        term = term * rate / k
        total += term
        steps.append(total)
    return steps


def poisson(u: np.ndarray, rate: float) -> np.ndarray:
    """Poisson numbers of the given rate (1 at most) by inverting its distribution at u; at most 12."""
    return np.searchsorted(np.array(poisson_steps(rate)), u, "right")


def bag(key: np.ndarray, y: np.ndarray, tree: int, small: int, share: float) -> np.ndarray:
    """Weights of the rows in a tree's balanced bag; ``share`` is the smaller class's size by the larger one's."""
    u, few = uniform(key, tree), y == small
    out = np.zeros(len(u), np.int64)
    for rows, rate in ((np.nonzero(few & (u >= math.exp(-1.0)))[0], 1.0), (np.nonzero(~few & (u >= math.exp(-share)))[0], share)):
        out[rows] = poisson(u[rows], rate)
    return out


def _bags(small: int, share: float):
    """``weigh`` of a balanced forest: the rows of ``bag`` with their weights, and 0 for class 1, 1 for the other."""
    chances = [[least_drawn(c) for c in poisson_steps(rate)] for rate in (share, 1.0)]
    held: list = [None, None, None]

    def weigh(x, y, key, tree):
        if held[0] is not y:  # one chunk after the other
            few = y == small
            held[:] = y, few, np.where(few, chances[1][0], chances[0][0])
        z = drawn(key, tree)
        rows = np.flatnonzero(z >= held[2])
        z, few = z.take(rows), held[1].take(rows)
        w = np.ones(len(rows))
        for many, one in zip(chances[0][1:], chances[1][1:]):
            more = z >= np.where(few, one, many)
            if not more.any():
                break
            w += more
        return rows, w, (few if small == 0 else ~few).astype(np.int64)

    return weigh


def binned(wide: DataFrame, features: Sequence[str], fit, id_col: str = "record_id", bins: int = BINS, values: bool = False) -> DataFrame:
    """id, target, fit, key and ``x`` (a byte for each feature), stored; bins are quantiles of the rows where ``fit`` holds.
    With ``values`` the features themselves come along as the array ``values``."""
    cols = list(features)
    held = cut_lineage(wide.select(F.col(id_col), "target", F.coalesce(fit & F.col("target").isNotNull(), F.lit(False)).alias("fit"),
                                   F.xxhash64(F.col(id_col).cast("string")).alias("key"), *[finite(c).alias(c) for c in cols]))
    at = column_quantiles(held.where("fit").select(*cols), cols, [i / bins for i in range(1, bins)])
    cuts = {c: set() for c in cols}
    for r in at.select("feature", "quantile").collect():  # features x bins
        cuts[r["feature"]].add(r["quantile"])
    edges = [np.array(sorted(cuts[c])) for c in cols]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.zeros((batch.num_rows, len(cols)), np.uint8)
            for j, edge in enumerate(edges):
                v = batch.column(4 + j).to_numpy(zero_copy_only=False).astype(np.float64)
                x[:, j] = np.where(np.isnan(v), 0, 1 + np.searchsorted(edge, v, "left"))
            packed = _binary(pa, x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], packed, *batch.columns[4 + len(cols):]],
                                             names=[id_col, "target", "fit", "key", "x", *(["values"] if values else [])])

    kind = wide.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, target int, fit boolean, key long, x binary" + (", values array<double>" if values else "")
    source = held.withColumn("values", F.array(*[F.col(c).cast("double") for c in cols])) if values else held
    return cut_lineage(source.mapInArrow(run, schema))


def _binary(pa, x: np.ndarray):
    """An array of binaries, one for each row of the bytes ``x``."""
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])


def _bytes(column) -> np.ndarray:
    """The bytes of all binaries of a column without nulls, one after the other."""
    if not len(column):
        return np.empty(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)


def _rows(batch, width: int):
    """Binned values, target (a matrix where it is a list) and key of a batch of (x, target, key)."""
    y = batch.column(1)
    y = y.to_numpy(zero_copy_only=False) if not hasattr(y, "flatten") or not hasattr(y.type, "value_type") else (
        y.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
    return (_bytes(batch.column(0)).reshape(batch.num_rows, width), y,
            batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))


def _chunks(batches, width: int):
    """What ``_rows`` gives, for many batches at once: the work of a tree has a fixed part for each call."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_rows(batch, width))
            n += batch.num_rows
        if n >= CHUNK_ROWS:
            yield tuple(np.concatenate(part) for part in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(part) for part in zip(*held))


def packed(rows: DataFrame, width: int, block: int = CHUNK_ROWS) -> DataFrame:
    """``rows`` (x, target, key) as blocks of up to about ``block`` of them: n, and the bytes of all x, targets (doubles; of all columns
    where the target is a list) and keys.  Rows that are read many times over cost little to read like this."""

    def run(batches):
        import pyarrow as pa

        held, n = [], 0

        def blocks():
            x, y, key = (np.concatenate(part) for part in zip(*held))
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int32()), *[pa.array([np.ascontiguousarray(v).tobytes()], pa.binary())
                                                   for v in (x, y.astype(np.float64), key)]], names=["n", "x", "target", "key"])

        for batch in batches:
            if batch.num_rows:
                held.append(_rows(batch, width))
                n += batch.num_rows
            if n >= block:
                yield from blocks()
                held, n = [], 0
        if held:
            yield from blocks()

    return rows.select("x", "target", "key").mapInArrow(run, PACKED)


def _blocks(batches, width: int):
    """The blocks of a packed table: x, target (a matrix where it has several columns) and key."""
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column(0)[i].as_py()
            x, y, key = (np.frombuffer(batch.column(1 + k)[i].as_buffer(), kind) for k, kind in enumerate((np.uint8, np.float64, np.uint64)))
            yield x.reshape(n, width), y if len(y) == n else y.reshape(n, -1), key


def _score(kind: str, s: np.ndarray) -> np.ndarray:
    """What a node with the sums ``s`` (last axis: two numbers) is worth; a split's gain is the sides' worth less its own."""
    a, b = s[..., 0], s[..., 1]
    if kind == "newton":
        return a * a / (b + L2)
    if kind == "error":
        return np.maximum(a, b)
    return np.divide(a * a + b * b, a + b, out=np.zeros_like(a), where=a + b > 0)


def _best_splits(kind: str, h: np.ndarray, least: float) -> list[np.ndarray]:
    """The best split of each histogram of ``h`` (lines, bins + 1, 2): gain, upto, missing_left, the sums on its left and of all."""
    bins = h.shape[1] - 1
    total = h.sum(1)
    known = np.cumsum(h[:, 1:], axis=1)
    left = np.stack([known, known + h[:, :1]], 1)                 # missing right, missing left
    right = total[:, None, None] - left
    weight = (lambda s: s[..., 1]) if kind == "newton" else (lambda s: s.sum(-1))
    gain = _score(kind, left) + _score(kind, right) - _score(kind, total)[:, None, None]
    gain = np.where((weight(left) >= least) & (weight(right) >= least), gain, -1.0)
    flat = gain.reshape(len(h), -1).argmax(1)
    at = np.arange(len(h))
    chosen = left.reshape(len(h), -1, 2)[at, flat]
    return [gain.reshape(len(h), -1)[at, flat], (flat % bins + 1).astype(np.int32), flat >= bins, chosen[:, 0], chosen[:, 1],
            total[:, 0], total[:, 1]]


def _best(kind: str, bins: int, least: float):
    """Task function over (tree, node, feature, h0, h1, ...): the best split of each, with the sums on its left."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h = np.stack([batch.column(3 + i).to_numpy(zero_copy_only=False) for i in range(2 * (bins + 1))], 1).reshape(-1, bins + 1, 2)
            out = _best_splits(kind, h, least)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, out)],
                                             names=["tree", "node", "feature", "gain", "upto", "missing_left", "l0", "l1", "t0", "t1"])

    return run


def _histograms(forest: Forest, trees: list[int], slots: dict, subset: dict, width: int, bins: int, weigh):
    """Task function over packed rows: the sums of each open node of ``trees`` for its features.

    ``slots[t]`` numbers the open nodes of tree t (-1: closed), ``subset[t]`` has their features; ``weigh`` gives the rows that count in a
    tree and their two numbers, or one number and which of the two it is (whole numbers)."""

    def run(batches):
        import pyarrow as pa

        sums = {t: np.zeros((2, subset[t].size * (bins + 1))) for t in trees}
        steps = {t: forest.steps(t, bins) for t in trees}
        parts = {t: np.ascontiguousarray(subset[t].T) for t in trees}
        for x, y, key in _blocks(batches, width):
            flat = np.ascontiguousarray(x).ravel()
            for t in trees:
                rows, first, second = weigh(x, y, key, t)
                start = rows * width
                slot = slots[t].take(walked(steps[t], flat, start, bins))
                open_ = np.flatnonzero(slot >= 0)
                if len(open_) < len(slot):
                    slot, start, first, second = slot.take(open_), start.take(open_), first.take(open_), second.take(open_)
                m, size = len(parts[t]), sums[t].shape[1]
                coded = second.dtype.kind == "i"
                base = slot * (m * (bins + 1))
                if coded:
                    base += second * size
                for j, part in enumerate(parts[t]):
                    cell = flat.take(start + part.take(slot)) + base
                    if j:
                        cell += j * (bins + 1)
                    if coded:
                        sums[t] += np.bincount(cell, first, 2 * size).reshape(2, size)
                    else:
                        for i, v in enumerate((first, second)):
                            sums[t][i] += np.bincount(cell, v, size)
        for t in trees:
            h = np.stack(sums[t], 1).reshape(subset[t].size, -1)
            used = np.nonzero(h.any(1))[0]
            node = np.nonzero(slots[t] >= 0)[0][used // subset[t].shape[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), t, np.int32)), pa.array(node.astype(np.int32)), pa.array(subset[t].ravel()[used].astype(np.int32)),
                 *[pa.array(np.ascontiguousarray(h[used, i])) for i in range(h.shape[1])]],
                names=["tree", "node", "feature", *[f"h{i}" for i in range(h.shape[1])]])

    return run


def grow(rows: DataFrame, width: int, trees: int, depth: int, weigh, kind: str = "gini", bins: int = BINS, per_node: int | None = None,
         least: float = MIN_LEAF, seed: int = SEED, closed: list[list[int]] | None = None) -> tuple[Forest, dict]:
    """A forest over stored binned ``rows`` (x, target, key; or a packed table) and the root splits' rows by tree; ``closed`` names for
    each tree the columns that it may not split on (``per_node`` leaves room for them)."""
    forest = Forest.empty(trees, depth)
    if "n" not in rows.columns:
        rows = cut_lineage(packed(rows, width), "none")
    m = per_node or width
    open_nodes = {t: [0] for t in range(trees)}
    roots: dict = {}
    columns = [f"h{i}" for i in range(2 * (bins + 1))]
    schema = "tree int, node int, feature int, " + ", ".join(f"{c} double" for c in columns)
    for level in range(depth):
        todo = [t for t in range(trees) if open_nodes[t]]
        found = []
        while todo:
            size, some = 0, []
            while todo and (not some or size + len(open_nodes[todo[0]]) * m * (bins + 1) * 16 <= HISTOGRAM_BYTES):
                size += len(open_nodes[todo[0]]) * m * (bins + 1) * 16
                some.append(todo.pop(0))
            slots, subset = {}, {}
            for t in some:
                nodes = np.array(sorted(open_nodes[t]))
                slots[t] = np.full(forest.feature.shape[1], -1)
                slots[t][nodes] = np.arange(len(nodes))
                dice = np.stack([uniform(nodes.astype(np.uint64), t * width + j, seed + 1) for j in range(width)], 1)
                if closed:
                    dice[:, closed[t]] = 2.0
                subset[t] = np.sort(np.argsort(dice, axis=1)[:, :m], axis=1)
            sums = rows.mapInArrow(_histograms(forest, some, slots, subset, width, bins, weigh), schema)
            sums = sums.groupBy("tree", "node", "feature").agg(*[F.sum(c).alias(c) for c in columns])
            best = sums.mapInArrow(_best(kind, bins, least), "tree int, node int, feature int, gain double, upto int, "
                                                             "missing_left boolean, l0 double, l1 double, t0 double, t1 double")
            order = F.struct("gain", (-F.col("feature")).alias("f"))
            found += best.groupBy("tree", "node").agg(F.max_by(F.struct(*best.columns[2:]), order).alias("b")).collect()
        open_nodes = {t: [] for t in range(trees)}
        for r in found:
            t, node, b = r["tree"], r["node"], r["b"]
            left, total = np.array([b["l0"], b["l1"]]), np.array([b["t0"], b["t1"]])
            forest.value[t, node], forest.cover[t, node] = _leaf(kind, total), _cover(kind, total)
            if node == 0:
                roots[t] = b
            if b["gain"] <= 1e-9:
                continue
            forest.feature[t, node], forest.upto[t, node], forest.missing_left[t, node] = b["feature"], b["upto"], b["missing_left"]
            for child, side in ((2 * node + 1, left), (2 * node + 2, total - left)):
                forest.value[t, child], forest.cover[t, child] = _leaf(kind, side), _cover(kind, side)
                enough = side[1] >= 2 * least if kind == "newton" else side.sum() >= MIN_SPLIT and min(side) > 0
                if level + 1 < depth and enough:
                    open_nodes[t].append(child)
    return forest, roots


def _leaf(kind: str, s: np.ndarray) -> float:
    if kind == "newton":
        return float(-s[0] / (s[1] + L2))
    return float(s[0] / s.sum()) if s.sum() > 0 else 0.0


def _cover(kind: str, s: np.ndarray) -> float:
    return float(s[1]) if kind == "newton" else float(s.sum())


def _classes(train: DataFrame) -> tuple[int, float] | None:
    """The smaller class and its size by the larger one's; None where a class is missing."""
    n = {r["target"]: r["count"] for r in train.groupBy("target").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    return (1, n[1] / n[0]) if n[1] <= n[0] else (0, n[0] / n[1])


def _scored(rows: DataFrame, width: int, chance, name: str, id_col: str) -> DataFrame:
    """id, target, model, probability of the rows that were not fitted on; ``chance`` maps binned rows to probabilities."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, _, _ = _rows(batch.select(["x", "target", "key"]), width) if batch.num_rows else (np.zeros((0, width), np.uint8), 0, 0)
            p = chance(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], names=[id_col, "target", "p"])

    kind = rows.schema[id_col].dataType.simpleString()
    out = rows.select(id_col, "target", "key", "x").mapInArrow(run, f"{id_col} {kind}, target int, p double")
    return out.select(id_col, "target", F.lit(name).alias("model"), r6(F.col("p")).alias("probability"))


def _unfitted(rows: DataFrame, name: str, id_col: str) -> DataFrame:
    return rows.select(id_col, "target", F.lit(name).alias("model"), F.lit(None).cast("double").alias("probability"))


def fit_balanced_forest(train: DataFrame, width: int, trees: int = TREES, depth: int = DEPTH) -> Forest | None:
    """A forest whose trees each draw a balanced bag of the stored binned rows."""
    classes = _classes(train)
    if classes is None:
        return None
    return grow(train, width, trees, depth, _bags(*classes), "gini", per_node=max(1, int(math.sqrt(width))))[0]


def balanced_forest(wide: DataFrame, features: Sequence[str], fit, test, trees: int = TREES, depth: int = DEPTH,
                    id_col: str = "record_id", name: str = "balanced_forest") -> DataFrame:
    """id, target, model, probability of the ``test`` rows from a balanced forest fitted on the ``fit`` rows."""
    rows = binned(wide.where(fit | test), features, fit, id_col)
    forest = fit_balanced_forest(rows.where("fit"), len(features), trees, depth)
    rest = rows.where("not fit")
    if forest is None:
        return _unfitted(rest, name, id_col)
    mean = lambda x: sum(forest.value[t][forest.nodes(t, x)] for t in range(trees)) / trees
    return _scored(rest, len(features), mean, name, id_col)


def fit_easy_ensemble(train: DataFrame, width: int, members: int = MEMBERS, stumps: int = STUMPS, bins: int = BINS):
    """(scores, votes): for each member the sum of its stumps' votes by feature and bin, and the stumps' weights in order."""
    classes = _classes(train)
    if classes is None:
        return None
    fitted = TG.run_together(packed(train, width), partial(TG.stumps, width, bins, members, stumps, *classes), "fitted binary").collect()
    return pickle.loads(fitted[0]["fitted"])


def easy_ensemble(wide: DataFrame, features: Sequence[str], fit, test, members: int = MEMBERS, stumps: int = STUMPS,
                  id_col: str = "record_id", name: str = "easy_ensemble") -> DataFrame:
    """id, target, model, probability of the ``test`` rows: mean over members of the chance 1 / (1 + exp(-F))."""
    width = len(features)
    rows = binned(wide.where(fit | test), features, fit, id_col)
    fitted = fit_easy_ensemble(rows.where("fit"), width, members, stumps)
    rest = rows.where("not fit")
    if fitted is None:
        return _unfitted(rest, name, id_col)
    scores = fitted[0]
    margin = lambda t, x: scores[t][np.arange(width)[None, :], x].sum(1)
    mean = lambda x: sum(1 / (1 + np.exp(-np.clip(margin(t, x), -40, 40))) for t in range(members)) / members
    return _scored(rest, width, mean, name, id_col)


def fit_boosted_trees(train: DataFrame, width: int, rounds: int = ROUNDS, depth: int = BOOSTED_DEPTH, rate: float = LEARNING_RATE):
    """(start, forest): log odds to start from and the trees, whose values are steps of the margin already times ``rate``."""
    classes = _classes(train)
    if classes is None:
        return None
    small, share = classes
    weight = {small: 1.0 / share, 1 - small: 1.0}  # both classes weigh the same, so the margin starts at 0
    rows = packed(train.select("x", F.array(F.col("target").cast("double"), F.lit(0.0)).alias("target"), "key"), width)
    names = ("feature", "upto", "missing_left", "value", "cover")
    done = [[getattr(Forest.empty(0, depth), name) for name in names]]
    for first in range(0, rounds, MARGIN_ROUNDS):
        some, more = min(MARGIN_ROUNDS, rounds - first), first + MARGIN_ROUNDS < rounds
        task = partial(TG.boosting, width, BINS, first, some, depth, rate, weight, max(1, math.ceil(0.7 * width)), MIN_HESSIAN, SEED + 1, more)
        out = TG.run_together(rows, task, PACKED + ", forest binary")
        out = cut_lineage(out) if more else out
        done.append(pickle.loads(out.where("forest is not null").select("forest").collect()[0]["forest"]))
        rows = out.where("forest is null").select("n", "x", "target", "key")
    return 0.0, Forest(*[np.concatenate(part) for part in zip(*done)])


def boosted_trees(wide: DataFrame, features: Sequence[str], fit, test, rounds: int = ROUNDS, depth: int = BOOSTED_DEPTH,
                  id_col: str = "record_id", name: str = "boosted") -> DataFrame:
    """id, target, model, probability of the ``test`` rows from gradient-boosted trees that take missing values as they are."""
    rows = binned(wide.where(fit | test), features, fit, id_col)
    fitted = fit_boosted_trees(rows.where("fit"), len(features), rounds, depth)
    rest = rows.where("not fit")
    if fitted is None:
        return _unfitted(rest, name, id_col)
    start, forest = fitted
    margin = lambda x: start + sum(forest.value[t][forest.nodes(t, x)] for t in range(len(forest.feature)))
    return _scored(rest, len(features), lambda x: 1 / (1 + np.exp(-np.clip(margin(x), -40, 40))) + np.zeros(len(x)), name, id_col)
