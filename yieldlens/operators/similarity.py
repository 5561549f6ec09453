"""Historical similarity: exact k nearest reference cases through a partition tree, block by block.

1. A bounded sample of the reference vectors gives an orthogonal basis (principal axes first) and a tree of median splits
   along them; every reference row falls into one leaf, whose bounding ball (centre from the sample, radius over all
   members) is exact.
2. Best partitions first: each query visits the leaves nearest to it until they hold ``k`` members several times over; its k-th
   distance there bounds the search.  Then it visits only leaves whose ball reaches into that bound.
3. Leaves share slabs of rows (a full leaf has several), and the queries that visit a slab are dealt in blocks, so neither a
   full leaf nor a popular one is one task's work.  A task takes the leaves of its slab nearest first: a leaf's rows and
   the queries that it can still serve are one matrix product over the leading axes.  With what the other axes add at least
   (the gap of the two lengths there) it never exceeds a distance, so only pairs below the running k-th distance
   are computed in full.  A slab gives at most k rows for a query; no row is made for a pair.

The result is exact whatever the data; how much is skipped depends on them.  Vectors without any structure (directions drawn at
random in 64 dimensions) reach into every ball, and only the matrix product saves work.  Rows without a vector
are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import r6
from ..functions.ranking import exact_quantiles
from ..session import cut_lineage

K = 10
SAMPLE = 16_384         # reference vectors that shape the tree
LEAVES = 1024           # leaves at most
LEAF_ROWS = 4096        # reference rows of a leaf, about, while there are fewer leaves
SLAB = 65_536           # reference rows, about, that one task holds
BLOCK = 8192            # queries that it holds, about
SLICE = 512             # queries of one matrix product, at most
CELLS = 1 << 21         # cells of one matrix product: a task's memory does not grow with its leaf
LEADING = 0.9           # share of the variance that the leading axes hold
FIRST_VISIT = 8         # members of the first leaves, in multiples of k
STRENGTH = [(0.75, "Very Strong"), (0.55, "Strong"), (0.35, "Moderate"), (0.20, "Weak")]
WILSON_Z = 1.96
RETRIEVAL_LEVELS = [1, 2, 3, 5]


@dataclass(frozen=True)
class Tree:
    """Orthogonal ``basis`` (columns are axes, ``leading`` of them in front) about ``mean``; ``splits`` of inner nodes as
    (axis, value, left, right), leaves being negative numbers -1 - leaf; ``centres`` and ``radii`` of the leaves' balls."""

    mean: np.ndarray
    basis: np.ndarray
    leading: int
    splits: tuple
    centres: np.ndarray
    radii: np.ndarray | None = None
    members: np.ndarray | None = None

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if self.splits else np.full(len(x), -1)
        y = (x - self.mean) @ self.basis
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                axis, value, left, right = self.splits[node]
                own = at == node
                at[own] = np.where(y[own, axis] < value, left, right)
        return -1 - at

    def balls(self, x: np.ndarray) -> np.ndarray:
        """A lower bound of the distance from each row of x to any member of each leaf."""
        out, slack, lengths = np.empty((len(x), len(self.centres))), _slack(x), (self.centres**2).sum(1)
        for a in range(0, len(x), SLICE):
            q = x[a : a + SLICE]
            to = np.sqrt(np.maximum((q**2).sum(1)[:, None] - 2 * q @ self.centres.T + lengths, 0))
            out[a : a + SLICE] = np.maximum(to - self.radii - slack, 0.0)
        return out


def _slack(x: np.ndarray) -> float:
    """What rounding may take from a distance computed through products."""
    return 1e-6 * (1.0 + float(np.abs(x).max(initial=0.0)))


def plant(sample: np.ndarray, leaves: int) -> Tree:
    """A tree of up to ``leaves`` leaves over the sample: the fullest part is halved along its widest axis."""
    mean = sample.mean(0)
    spread, basis = np.linalg.eigh((sample - mean).T @ (sample - mean))
    spread, basis = np.maximum(spread[::-1], 0.0), basis[:, ::-1]
    leading = int(np.searchsorted(np.cumsum(spread) / max(float(spread.sum()), 1e-300), LEADING) + 1)
    y = (sample - mean) @ basis
    splits: list = []
    parts = [(np.arange(len(sample)), None)]  # rows, (node, side) that leads to them
    while len(parts) < leaves:
        i = max(range(len(parts)), key=lambda j: len(parts[j][0]))
        rows, via = parts[i]
        own = y[rows]
        axis = int(np.argmax(own.max(0) - own.min(0))) if len(rows) > 1 else 0
        value = float(np.median(own[:, axis]))
        low = own[:, axis] < value
        if not low.any() or low.all():
            break
        if via:
            splits[via[0]][via[1]] = len(splits)
        parts[i] = (rows[low], (len(splits), 2))
        parts.append((rows[~low], (len(splits), 3)))
        splits.append([axis, value, None, None])
    for leaf, (_, via) in enumerate(parts):
        if via:
            splits[via[0]][via[1]] = -1 - leaf
    centres = np.array([sample[rows].mean(0) for rows, _ in parts])
    return Tree(mean, basis, min(leading, sample.shape[1]), tuple(map(tuple, splits)), centres)


def block_top(q: np.ndarray, qid: np.ndarray, bound: np.ndarray, x: np.ndarray, xid: np.ndarray, tree: Tree, k: int,
              exclude_self: bool):
    """(query row, reference row, distance, pairs computed) of the k nearest rows of x to each query, up to its bound.

    ``pairs computed`` is the query's number of full distances, on its first row."""
    def turned(v):
        y = (v - tree.mean) @ tree.basis
        rest = np.sqrt((y[:, tree.leading :] ** 2).sum(1))
        return np.column_stack([y[:, : tree.leading], rest])  # the gap of the rests is what the other axes add at least

    def full(i, j):
        out = np.empty(len(i))
        for a in range(0, len(i), 1 << 15):
            d = q[i[a : a + (1 << 15)]] - x[j[a : a + (1 << 15)]]
            out[a : a + (1 << 15)] = np.sqrt(np.einsum("ij,ij->i", d, d))
        return out

    found = []
    y = turned(x)
    lengths = (y**2).sum(1)
    step = max(1, min(SLICE, CELLS // max(len(x), 1)))
    for a in range(0, len(q), step):
        z = turned(q[a : a + step])
        least = np.sqrt(np.maximum((z**2).sum(1)[:, None] - 2 * z @ y.T + lengths, 0.0))
        if exclude_self:
            least[qid[a : a + step][:, None] == xid[None, :]] = np.inf
        rows, limit = np.arange(len(z)), bound[a : a + step].copy()
        slack = _slack(z) + _slack(y)
        if len(x) > k:  # the k rows with the least bounds give a k-th distance that the others must beat
            near = np.argpartition(least, k - 1, axis=1)[:, :k]
            hopeful = np.nonzero(np.take_along_axis(least, near, 1).min(1) <= limit + slack)[0]
            d = full(a + np.repeat(hopeful, k), near[hopeful].ravel()).reshape(-1, k)
            d[np.isinf(np.take_along_axis(least, near, 1)[hopeful])] = np.inf
            limit[hopeful] = np.minimum(limit[hopeful], d.max(1))
        i, j = np.nonzero((least <= (limit + slack)[:, None]) & np.isfinite(least))
        d = full(a + i, j)
        order = np.lexsort((xid[j], d, i))
        i, j, d = i[order], j[order], d[order]
        start = np.searchsorted(i, rows)
        place = np.arange(len(i)) - start[i]
        computed = np.where(place == 0, np.bincount(i, minlength=len(z))[i], 0)
        kept = place < k
        found.append((a + i[kept], j[kept], d[kept], computed[kept]))
    return [np.concatenate(c) for c in zip(*found)]


def _vectors(column) -> np.ndarray:
    """A float64 matrix from an Arrow list column."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _place(tree: Tree):
    """Task function over (id, vector): adds the leaf and the distance to its centre."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column(1))
                leaf = tree.leaf_of(x)
                gap = np.sqrt(((x - tree.centres[leaf]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(gap)],
                                                 names=["_rid", "_rv", "_leaf", "_gap"])

    return run


def _visits(tree: Tree, k: int, further: bool):
    """Task function over (id, vector, bound): the leaves of the first visits, or those left within the bound."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x, bound = _vectors(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            lists = []
            for a in range(0, len(x), SLICE):
                reach = tree.balls(x[a : a + SLICE])
                to = ((x[a : a + SLICE, None, :] - tree.centres[None]) ** 2).sum(2) if len(tree.centres) <= 64 else (
                    -2 * x[a : a + SLICE] @ tree.centres.T + (tree.centres**2).sum(1))
                order = np.argsort(to, axis=1, kind="stable")
                held = np.cumsum(tree.members[order], axis=1)
                first = np.zeros(order.shape, bool)
                np.put_along_axis(first, order, (held - tree.members[order]) < FIRST_VISIT * k, 1)
                for i in range(len(reach)):
                    wanted = ~first[i] & (reach[i] <= bound[a + i]) if further else first[i]
                    lists.append(np.nonzero(wanted & (tree.members > 0))[0].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                                             names=["_qid", "_qv", "_bound", "_leaves"])

    return run


def _slabs(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First slab and number of slabs of each leaf: small leaves share one of up to SLAB rows, a large leaf has several."""
    first, count = np.zeros(len(members), np.int64), np.ones(len(members), np.int64)
    slab, held = 0, 0
    for leaf, rows in enumerate(members.tolist()):
        if held and held + rows > SLAB:
            slab, held = slab + 1, 0
        first[leaf], count[leaf] = slab, max(1, -(-rows // SLAB))
        held += rows
        if rows > SLAB:
            slab, held = slab + int(count[leaf]), 0
    return first, count


def _merge(best_d, best_id, rows, i, d, ids, k):
    """The k best of what the queries ``rows`` had and what they found: (i: place in rows, d, ids) in order of i and d."""
    place = np.arange(len(i)) - np.searchsorted(i, np.arange(len(rows)))[i]
    new_d, new_id = np.full((len(rows), k), np.inf), np.zeros((len(rows), k), best_id.dtype)
    new_d[i, place], new_id[i, place] = d, ids
    both_d, both_id = np.concatenate([best_d[rows], new_d], 1), np.concatenate([best_id[rows], new_id], 1)
    order = np.lexsort((both_id, both_d), axis=-1)[:, :k]
    best_d[rows], best_id[rows] = np.take_along_axis(both_d, order, 1), np.take_along_axis(both_id, order, 1)


def _searched(placed: DataFrame, visits: DataFrame, tree: Tree, k: int, exclude_self: bool) -> DataFrame:
    """(query id, reference id, distance, pairs computed): the k nearest rows of each slab that a query visits."""
    first, count = _slabs(tree.members)
    of_leaf = lambda numbers, leaf: F.get(F.array(*[F.lit(int(v)) for v in numbers]), leaf)
    slabs = F.array_distinct(F.flatten(F.transform("_leaves", lambda leaf: F.sequence(
        of_leaf(first, leaf), of_leaf(first + count - 1, leaf)))))
    visits = cut_lineage(visits.select("_qid", "_qv", "_bound", "_leaves", F.explode(slabs).alias("_slab")))
    chunks = np.zeros(int((first + count).max()), np.int64)
    for r in visits.groupBy("_slab").count().collect():  # one row a slab
        chunks[r["_slab"]] = -(-r["count"] // BLOCK)
    dealt = of_leaf(chunks, F.col("_slab"))
    left = visits.withColumn("_chunk", F.pmod(F.xxhash64("_qid"), dealt).cast("int"))
    right = placed.withColumn("_slab", of_leaf(first, F.col("_leaf")) + F.pmod(F.xxhash64("_rid"), of_leaf(count, F.col("_leaf"))).cast("int"))
    right = right.where(dealt > 0).select("_rid", "_rv", "_leaf", "_slab", F.explode(F.sequence(F.lit(0), (dealt - 1).cast("int"))).alias("_chunk"))
    id_type = visits.schema["_qid"].dataType.simpleString()

    def run(queries, rows):
        import pyarrow as pa

        out = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)]
        if queries.num_rows and rows.num_rows:
            qid, rid, leaf = (t.column(c).to_numpy() for t, c in ((queries, "_qid"), (rows, "_rid"), (rows, "_leaf")))
            q, x = _vectors(queries.column("_qv")), _vectors(rows.column("_rv"))
            bound, reach = queries.column("_bound").to_numpy().copy(), tree.balls(q)
            wanted = np.zeros((len(q), len(tree.centres)), bool)
            lists = queries.column("_leaves").combine_chunks()
            wanted[np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
            best_d, best_id = np.full((len(q), k), np.inf), np.zeros((len(q), k), qid.dtype)
            computed = np.zeros(len(q), np.int64)
            here = np.unique(leaf)
            for one in here[np.argsort(reach[:, here].mean(0), kind="stable")]:  # best partitions first, bounds run along
                own = np.nonzero(wanted[:, one] & (reach[:, one] <= bound))[0]
                if len(own):
                    at = np.nonzero(leaf == one)[0]
                    i, j, d, c = block_top(q[own], qid[own], bound[own], x[at], rid[at], tree, k, exclude_self)
                    computed += np.bincount(own[i], c, len(q)).astype(np.int64)
                    _merge(best_d, best_id, own, i, d, rid[at][j], k)
                    bound = np.minimum(bound, best_d[:, -1])
            i, place = np.nonzero(np.isfinite(best_d))
            out = [qid[i], best_id[i, place], best_d[i, place], np.where(place == 0, computed[i], 0)]
        return pa.table([pa.array(c) for c in out], names=["_qid", "_rid", "_dist", "_computed"])

    keys = ["_slab", "_chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, f"_qid {id_type}, _rid {id_type}, _dist double, _computed long")


def searched(reference: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec: str = "embedding",
             exclude_self: bool = False, leaf_rows: int = LEAF_ROWS) -> DataFrame | None:
    """Candidates (query id, reference id, distance, pairs computed) that hold the k nearest rows of every query; None
    without reference rows."""
    ref = reference.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("_rid"), F.col(vec).alias("_rv"))
    qry = queries.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("_qid"), F.col(vec).alias("_qv"),
                                                       F.lit(float("inf")).alias("_bound"))
    n = ref.count()
    if not n:
        return None
    sample = ref.orderBy(F.xxhash64("_rid"), "_rid").limit(SAMPLE).select("_rv").collect()
    tree = plant(np.array([r["_rv"] for r in sample], float), int(min(LEAVES, max(1, -(-n // leaf_rows)), len(sample))))
    placed = cut_lineage(ref.mapInArrow(_place(tree), T.StructType([*ref.schema.fields, T.StructField("_leaf", T.IntegerType()), T.StructField("_gap", T.DoubleType())])))
    radii, members = np.zeros(len(tree.centres)), np.zeros(len(tree.centres), np.int64)
    for r in placed.groupBy("_leaf").agg(F.max("_gap").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radii[r["_leaf"]], members[r["_leaf"]] = r["r"], r["n"]
    tree = Tree(tree.mean, tree.basis, tree.leading, tree.splits, tree.centres, radii, members)
    schema = T.StructType([*qry.schema.fields, T.StructField("_leaves", T.ArrayType(T.IntegerType()))])
    first = _searched(placed, qry.mapInArrow(_visits(tree, k, False), schema), tree, k, exclude_self)
    if len(tree.centres) == 1:
        return first
    first = cut_lineage(first)
    near = Window.partitionBy("_qid").orderBy("_dist", "_rid")  # k rows of each slab of the first leaves
    kth = first.withColumn("_r", F.row_number().over(near)).where(F.col("_r") == k).select("_qid", F.col("_dist").alias("_kth"))
    bounded = qry.drop("_bound").join(kth, "_qid", "left").select("_qid", "_qv", F.coalesce("_kth", F.lit(float("inf"))).alias("_bound"))
    rest = _searched(placed, bounded.mapInArrow(_visits(tree, k, True), schema), tree, k, exclude_self)
    return first.unionByName(rest)


def knn(reference: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec: str = "embedding",
        exclude_self: bool = False, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) for the k nearest reference rows of every query (exact; ties by id)."""
    found = searched(reference, queries, k, id_col, vec, exclude_self, leaf_rows)
    if found is None:
        return queries.where(F.lit(False)).select(
            F.col(id_col).alias("query_id"), F.lit(0).alias("rank"), F.col(id_col).alias("neighbour_id"),
            F.lit(None).cast("double").alias("distance"))
    near = Window.partitionBy("_qid").orderBy("_dist", "_rid")  # k rows of each slab that the query reaches
    top = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    return top.select(F.col("_qid").alias("query_id"), "rank", F.col("_rid").alias("neighbour_id"),
                      F.col("_dist").alias("distance"))


def split_reference(emb: DataFrame, share: float = 0.8, id_col: str = "vec_id") -> DataFrame:
    """Reference = the lower ``share`` of ids; target = label 0."""
    n = emb.agg(F.count(F.lit(1)).alias("_n"))
    t = emb.crossJoin(F.broadcast(n))
    return t.select("*", (F.col(id_col) < F.floor(F.col("_n") * share)).alias("is_reference"),
                    (F.col("label") == 0).cast("int").alias("target")).drop("_n")


def distance_scale(reference: DataFrame, k: int = K, id_col: str = "vec_id") -> DataFrame:
    """Median of the positive non-self k-NN distances among reference rows; 1.0 when there are none."""
    nn = knn(reference, reference, k, id_col, exclude_self=True)
    q = exact_quantiles(nn.where(F.col("distance") > 0).select("distance"), [], "distance", [0.5])
    one = reference.sparkSession.range(1)
    return one.join(q, how="left").select(F.coalesce(F.col("quantile"), F.lit(1.0)).alias("distance_scale"))


def nearest_cases(emb: DataFrame, k: int = K, id_col: str = "vec_id") -> DataFrame:
    """Top-k reference neighbours of each current row with similarity exp(-d / scale)."""
    s = split_reference(emb, id_col=id_col)
    ref, cur = s.where("is_reference"), s.where(~F.col("is_reference"))
    scale = F.broadcast(distance_scale(ref, k, id_col))
    nn = knn(ref, cur, k, id_col).crossJoin(scale)
    tgt = ref.select(F.col(id_col).alias("neighbour_id"), F.col("target").alias("neighbour_target"))
    # full precision: summaries average these; round where a table is emitted
    return nn.join(tgt, "neighbour_id").select(
        "query_id", "rank", "neighbour_id", "neighbour_target", "distance",
        F.exp(-F.col("distance") / F.col("distance_scale")).alias("similarity"), "distance_scale")


def wilson_interval(successes: Column, total: Column, z: float = WILSON_Z) -> tuple[Column, Column]:
    p = successes / total
    den = 1 + z * z / total
    centre = (p + z * z / (2 * total)) / den
    half = z * F.sqrt(p * (1 - p) / total + z * z / (4 * total * total)) / den
    ok = total > 0
    return (F.when(ok, F.greatest(centre - half, F.lit(0.0))), F.when(ok, F.least(centre + half, F.lit(1.0))))


def strength(mean_similarity: Column) -> Column:
    e = F.lit("Very Weak")
    for lo, name in reversed(STRENGTH):
        e = F.when(mean_similarity >= lo, name).otherwise(e)
    return e


def evidence_level(failed: Column, rate: Column, strength_label: Column) -> Column:
    strong = strength_label.isin("Very Strong", "Strong")
    return (F.when((failed >= 3) & (rate >= 0.3) & strong, "Strong Failure Evidence")
            .when((failed >= 2) & (rate >= 0.2), "Moderate Failure Evidence")
            .when(failed >= 1, "Limited Failure Evidence").otherwise("No Failure Evidence"))


def similarity_summary(cases: DataFrame, emb: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per query: failed/passed neighbour counts and mean similarities, similarity-weighted failure
    rate (plain mean when the weights vanish), Wilson interval, strength and evidence labels."""
    t = cases.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("neighbours"),
        F.count(F.when(F.col("neighbour_target") == 1, 1)).alias("failed_neighbours"),
        F.avg("similarity").alias("ms"), F.avg(F.when(F.col("neighbour_target") == 1, F.col("similarity"))).alias("mfs"),
        F.avg(F.when(F.col("neighbour_target") == 0, F.col("similarity"))).alias("mps"),
        F.sum(F.col("neighbour_target") * F.col("similarity")).alias("ts"), F.sum("similarity").alias("ss"),
        F.avg("neighbour_target").alias("mt"), F.avg("distance").alias("md"))
    rate = F.when(F.col("ss") > 1e-12, F.col("ts") / F.col("ss")).otherwise(F.col("mt"))
    lo, hi = wilson_interval(F.col("failed_neighbours"), F.col("neighbours"))
    lab = strength(F.col("ms"))
    q = emb.select(F.col(id_col).alias("query_id"), F.col("target").alias("query_target"))
    return t.join(q, "query_id", "left").select(
        "query_id", "query_target", "neighbours", "failed_neighbours",
        (F.col("neighbours") - F.col("failed_neighbours")).alias("passed_neighbours"),
        r6(F.col("ms")).alias("mean_similarity"), r6(F.col("mfs")).alias("mean_failed_similarity"),
        r6(F.col("mps")).alias("mean_passed_similarity"), r6(F.col("md")).alias("mean_distance"),
        r6(rate).alias("weighted_failure_rate"), r6(lo).alias("wilson_lower"), r6(hi).alias("wilson_upper"),
        lab.alias("similarity_strength"), evidence_level(F.col("failed_neighbours"), rate, lab).alias("historical_evidence"))


def similarity_groups(summary: DataFrame) -> DataFrame:
    """Means per query outcome and retrieval rate at >= 1, 2, 3, 5 failed neighbours."""
    aggs = [F.count(F.lit(1)).alias("queries"), r6(F.avg("mean_similarity")).alias("mean_similarity"),
            r6(F.avg("weighted_failure_rate")).alias("mean_weighted_failure_rate"),
            r6(F.avg("failed_neighbours")).alias("mean_failed_neighbours")]
    aggs += [r6(F.avg((F.col("failed_neighbours") >= m).cast("int"))).alias(f"retrieval_at_{m}") for m in RETRIEVAL_LEVELS]
    return summary.groupBy(F.when(F.col("query_target") == 1, "Failure").otherwise("Pass").alias("outcome")).agg(*aggs)


def check_unique_ids(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their multiplicity (empty when the key is unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def pca_embedding(emb: DataFrame, vec: str = "embedding", variance: float = 0.95, max_k: int = 100) -> DataFrame:
    """Fit MLlib PCA with the largest allowed k, keep the smallest k reaching the variance share
    (2 <= k <= min(100, n - 1, d)); returns (k, cumulative explained variance) and the projection."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = emb.select("*", array_to_vector(F.col(vec)).alias("_v"))
    d = len(v.select(vec).first()[0])
    n = v.count()
    kmax = max(2, min(max_k, n - 1, d))
    sc = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(v)
    vs = sc.transform(v)
    model = PCA(k=kmax, inputCol="_s", outputCol="_p").fit(vs)
    ev = list(model.explainedVariance.toArray())
    cum, k = 0.0, kmax
    for i, e in enumerate(ev):
        cum += e
        if cum >= variance:
            k = max(2, i + 1)
            break
    proj = model.transform(vs).select("*", F.slice(vector_to_array("_p"), 1, k).alias("components"))
    return proj.select("vec_id", "label", "components", F.lit(k).alias("n_components"),
                       F.lit(float(sum(ev[:k]))).alias("explained_variance"))
