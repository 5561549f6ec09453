"""Boosting in one stage: tasks that run at the same time each hold a share of the binned rows and add up their sums at every step.

A round of boosting needs the one before, so with a Spark job for each level of each round the jobs' fixed cost and the reading of the rows
would be most of the time.  Here the tasks of one barrier stage read packed rows (``trees.packed``) once, keep them with what changes
from round to round (margins, gradients, nodes), and exchange only tables of sums of fixed size: nodes x features x bins.  All tasks
choose the same splits from the same sums, and the first one gives the result.  A lost task repeats the stage.

Columns share a code, as many as fit into ``CELLS`` (three of 17 bins each): sums are taken by code, once for all its columns, and
then added up by column.  A task holds about 70 bytes for a row of 20 columns.
"""

from __future__ import annotations

import base64
import math
import os
import re
import time
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path

CELLS = 5000
CHUNK = 1 << 16
#: Each task receives the sums of all tasks, through the driver.
MOST_TASKS = 32


def tasks_at_once(spark: SparkSession) -> int:
    """How many tasks can be sure to run together; 0 where the session has no barrier stages (dynamic allocation)."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    sc = spark.sparkContext._jsc.sc()
    return min(MOST_TASKS, int(sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile())))


def run_together(rows: DataFrame, task, schema: str) -> DataFrame:
    """What ``task(folder)`` gives over packed rows, dealt to as many tasks as run together (one without barrier stages)."""
    tasks = tasks_at_once(rows.sparkSession)
    folder = re.sub("^file:/*", "/", shared_path(rows.sparkSession, "sums"))
    folder = folder if folder.startswith("/") else None
    return rows.repartition(max(1, tasks)).mapInArrow(task(folder), schema, barrier=tasks > 0)


class Meeting:
    """Adds up arrays of the tasks of a barrier stage, in the order of their numbers, so that all get the same sum.

    ``allGather`` answers once a second only, so it serves to agree on a name; the arrays go through files in the shared folder.  A task
    that has seen all files of a step knows that those of the step before were read, and takes its own away.  Where the shared folder is
    no path of the file system, ``allGather`` is all there is."""

    def __init__(self, folder: str | None):
        from pyspark import BarrierTaskContext, TaskContext

        context = TaskContext.get()
        self.context, self.own, self.step = context if isinstance(context, BarrierTaskContext) else None, context.partitionId(), 0
        self.leads, self.folder, self.tasks = self.own == 0, None, 1
        if self.context is not None:
            names = self.context.allGather(uuid.uuid4().hex)  # another attempt of the stage has another name
            self.tasks = len(names)
            if folder is not None:
                self.folder = f"{folder}/{names[0]}"
                os.makedirs(self.folder, exist_ok=True)

    def _place(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def total(self, own: np.ndarray) -> np.ndarray:
        if self.tasks == 1:
            return own
        own = np.ascontiguousarray(own, np.float64)
        if self.folder is None:
            parts = [base64.b64decode(p) for p in self.context.allGather(base64.b64encode(own.tobytes()).decode())]
            return sum(np.frombuffer(p).reshape(own.shape) for p in parts)
        mine = self._place(self.step, self.own)
        with open(f"{mine}.part", "wb") as f:
            f.write(own.tobytes())
        os.rename(f"{mine}.part", mine)
        out = np.zeros(own.shape)
        for task in range(self.tasks):
            while not os.path.exists(self._place(self.step, task)):
                time.sleep(0.0005)
            with open(self._place(self.step, task), "rb") as f:
                out += np.frombuffer(f.read()).reshape(own.shape)
        if self.step:
            os.remove(self._place(self.step - 1, self.own))
        self.step += 1
        return out


class Codes:
    """How the bins of several columns become one code."""

    def __init__(self, width: int, bins: int):
        self.width, self.bins = width, bins
        self.each = max(1, min(width, int(math.log(CELLS + 0.5, bins + 1))))
        self.cells = (bins + 1) ** self.each
        self.groups = -(-width // self.each)

    def of(self, x: np.ndarray) -> np.ndarray:
        """(groups, rows): the codes of binned rows."""
        out = np.zeros((self.groups, len(x)), np.uint16 if self.cells <= 1 << 16 else np.uint32)
        for c in range(self.groups * self.each):
            own = out[c // self.each]
            own *= self.bins + 1
            if c < self.width:
                own += x[:, c]
        return out

    def group(self, column: int) -> int:
        return column // self.each

    def bin_of_code(self, column: int) -> np.ndarray:
        """The column's bin for each code of its group."""
        return np.arange(self.cells) // (self.bins + 1) ** (self.each - 1 - column % self.each) % (self.bins + 1)

    def by_column(self, sums: np.ndarray) -> np.ndarray:
        """(slots, columns, bins + 1, kinds) from (groups, kinds, slots, cells)."""
        groups, kinds, slots, _ = sums.shape
        cube = sums.reshape(groups, kinds, slots, *[self.bins + 1] * self.each)
        axes = range(3, 3 + self.each)
        out = np.stack([cube.sum(tuple(a for a in axes if a != own)) for own in axes], 1)  # groups, each, kinds, slots, bins + 1
        return out.reshape(-1, kinds, slots, self.bins + 1)[:self.width].transpose(2, 0, 3, 1)


def first_best(gain: np.ndarray) -> int:
    """The first place of the largest gain, last digits aside: equal columns must not take turns."""
    most = gain.max()
    return int(np.flatnonzero(gain >= most - 1e-9 * abs(most))[0])


def boosting(width: int, bins: int, first: int, rounds: int, depth: int, rate: float, weight: dict, per_node: int, least: float, seed: int,
             keep: bool, folder: str | None):
    """Barrier task function over packed rows with (target, margin): grows the trees of ``rounds`` rounds from ``first`` on.

    The first task gives a row whose ``forest`` has the trees; with ``keep`` all give their rows back with the new margins."""

    def run(batches):
        import pickle

        import pyarrow as pa

        from . import trees as TR

        meeting = Meeting(folder)
        codes, own = Codes(width, bins), []
        for x, y, _ in TR._blocks(batches, width):
            n = len(x)
            own.append((codes.of(x), y[:, 0] == 1, y[:, 1].copy(), np.empty((2, n)), np.zeros(n, np.int16), x if keep else None))

        def sums(forest, nodes):
            """Sums by column of the rows in ``nodes``, over all tasks."""
            slots = np.full(forest.feature.shape[1], -1)
            slots[nodes] = np.arange(len(nodes))
            out = np.zeros((codes.groups, 2, len(nodes) * codes.cells))
            for code, _, _, moments, at, _ in own:
                if nodes == [0]:
                    rows, base, moved = slice(None), 0, moments
                else:
                    slot = slots.take(at)
                    rows = np.flatnonzero(slot >= 0)
                    base, moved = slot.take(rows) * codes.cells, moments.take(rows, axis=1)
                for q in range(codes.groups):
                    cell = code[q][rows] + base
                    for i in range(2):
                        out[q, i] += np.bincount(cell, moved[i], out.shape[2])
            return meeting.total(codes.by_column(out.reshape(codes.groups, 2, len(nodes), -1)))

        grown = []
        for r in range(first, first + rounds):
            forest = TR.Forest.empty(1, depth)
            for _, y, margin, moments, at, _ in own:
                p = np.clip(margin, -40, 40)
                np.negative(p, out=p)
                np.exp(p, out=p)
                p += 1
                np.reciprocal(p, out=p)
                w = np.where(y, weight[1], weight[0])
                np.multiply(w, p - y, out=moments[0])
                np.multiply(w, p * (1 - p), out=moments[1])
                at.fill(0)
            known, open_ = {0: sums(forest, [0])[0]}, [0]
            for level in range(depth):
                split = []
                for node in open_:
                    dice = np.concatenate([TR.uniform(np.array([node], np.uint64), j, seed + r) for j in range(width)])
                    some = np.sort(np.argsort(dice)[:per_node])
                    gain, upto, missing_left, l0, l1, t0, t1 = TR._best_splits("newton", known[node][some], least)
                    b = first_best(gain)
                    left, total = np.array([l0[b], l1[b]]), np.array([t0[b], t1[b]])
                    forest.value[0, node], forest.cover[0, node] = TR._leaf("newton", total), TR._cover("newton", total)
                    if gain[b] <= 1e-9:
                        continue
                    forest.feature[0, node], forest.upto[0, node], forest.missing_left[0, node] = some[b], upto[b], missing_left[b]
                    sides = {2 * node + 1: left, 2 * node + 2: total - left}
                    for child, side in sides.items():
                        forest.value[0, child], forest.cover[0, child] = TR._leaf("newton", side), TR._cover("newton", side)
                    split.append((node, [child for child, side in sides.items() if level + 1 < depth and side[1] >= 2 * least]))
                for code, _, _, _, at, _ in own:
                    moved = [(np.flatnonzero(at == node), node) for node, _ in split]
                    for rows, node in moved:
                        f = forest.feature[0, node]
                        side = codes.bin_of_code(f)
                        goes = np.where(side == 0, forest.missing_left[0, node], side <= forest.upto[0, node])
                        at[rows] = (2 * node + 2 - goes).astype(np.int16).take(code[codes.group(f)].take(rows))
                # the smaller child is summed, the other one is what is left of its parent
                counted = [min(children, key=lambda c: forest.cover[0, c]) for _, children in split if children]
                found = dict(zip(counted, sums(forest, counted))) if counted else {}
                for node, children in split:
                    for child in children:
                        if child not in found:
                            found[child] = known[node] - found[next(c for c in children if c != child)]
                open_ = sorted(found)
                known = found
            forest.value[:] *= rate
            for _, _, margin, _, at, _ in own:
                margin += forest.value[0].take(at)
            grown.append(forest)
        names = ["n", "x", "target", "key", "forest"]
        if meeting.leads:
            trees = [np.concatenate([getattr(f, name) for f in grown]) for name in ("feature", "upto", "missing_left", "value", "cover")]
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), *[pa.array([b""], pa.binary())] * 3, pa.array([pickle.dumps(trees)])],
                                             names=names)
        for _, y, margin, _, _, x in own if keep else []:
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in (
                    np.ascontiguousarray(x), np.stack([y.astype(np.float64), margin], 1))], pa.array([b""], pa.binary()),
                 pa.array([None], pa.binary())], names=names)

    return run


def stumps(width: int, bins: int, members: int, rounds: int, small: int, share: float, folder: str | None):
    """Barrier task function over packed rows: AdaBoost of stumps, all members at once; the first task gives (scores, votes)."""

    def run(batches):
        import pickle

        import pyarrow as pa

        from . import trees as TR

        meeting = Meeting(folder)
        codes, own = Codes(width, bins), []
        for x, y, key in TR._blocks(batches, width):
            few = y == small
            rows = [np.flatnonzero(few | (TR.uniform(key, t) < share)).astype(np.int32) for t in range(members)]
            own.append((codes.of(x), [(r, y.take(r) == 1, np.zeros(len(r))) for r in rows]))
        scores = np.zeros((members, width, bins + 1))
        votes: list[list[float]] = [[] for _ in range(members)]
        going = list(range(members))
        for _ in range(rounds):
            if not going:
                break
            out = np.zeros((len(going), codes.groups, 2 * codes.cells))
            for code, member in own:
                for i, t in enumerate(going):
                    rows, one, f = member[t]
                    w = np.exp(np.where(one, -0.5, 0.5) * f)
                    base = np.where(one, 0, codes.cells)
                    for q in range(codes.groups):
                        out[i, q] += np.bincount(code[q].take(rows) + base, w, 2 * codes.cells)
            h = codes.by_column(out.reshape(len(going), codes.groups, 2, codes.cells).transpose(1, 2, 0, 3))
            h, stopped = meeting.total(h), []
            for i, t in enumerate(going):
                gain, upto, missing_left, l0, l1, t0, t1 = TR._best_splits("error", h[i], 1e-12)
                b = first_best(gain)
                left, total = np.array([l0[b], l1[b]]), np.array([t0[b], t1[b]])
                right = total - left
                wrong = 1 - (left.max() + right.max()) / total.sum() if total.sum() > 0 else 0.5
                if wrong >= 0.5:
                    stopped.append(t)
                    continue
                alpha = math.log((1 - wrong) / max(wrong, 1e-10))
                side = np.where(np.arange(bins + 1) <= upto[b], *[1.0 if s[0] >= s[1] else -1.0 for s in (left, right)])
                side[0] = side[1] if missing_left[b] else (1.0 if right[0] >= right[1] else -1.0)
                scores[t, b] += alpha * side
                votes[t].append(alpha)
                if wrong <= 1e-10:
                    stopped.append(t)
                step, q = alpha * side[codes.bin_of_code(b)], codes.group(b)
                for code, member in own:
                    member[t][2].__iadd__(step.take(code[q].take(member[t][0])))
            going = [t for t in going if t not in stopped]
        if meeting.leads:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((scores, votes))])], names=["fitted"])

    return run
