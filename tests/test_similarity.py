"""Nearest cases through the partition tree must equal brute force exactly, and skip what can be skipped."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.operators import similarity as SM
from yieldlens.sources import fixtures as fx
from paths import SF_SMALL


def brute(R, Q, k, exclude_self=False):
    out = {}
    for q, v in Q.items():
        order = sorted((i for i in R if not (exclude_self and i == q)), key=lambda i: (float(np.sqrt(((R[i] - v) ** 2).sum())), i))
        out.update({(q, rank): rid for rank, rid in enumerate(order[:k], start=1)})
    return out


def vectors(df):
    return {r.vec_id: np.array(r.embedding, dtype=float) for r in df.select("vec_id", "embedding").collect()}


@pytest.mark.parametrize("leaf_rows", [SM.LEAF_ROWS, 16])
def test_knn_exact_against_brute_force(spark, leaf_rows):
    emb = SM.split_reference(fx.table(spark, SF_SMALL, "embeddings"))
    ref = emb.where("is_reference")
    cur = emb.where("not is_reference")
    got = {(r.query_id, r.rank): r.neighbour_id for r in SM.knn(ref, cur, 5, leaf_rows=leaf_rows).collect()}
    assert got == brute(vectors(ref), vectors(cur), 5)


def clustered(spark, n=3000, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, (60, 8))
    x = centres[rng.integers(0, 60, n)] + rng.normal(0, 0.3, (n, 8))
    x[5] = x[6] = x[7]  # equal vectors: ties go to the smaller id
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_balls_skip_most_partitions_of_clustered_rows(spark, monkeypatch):
    monkeypatch.setattr(SM, "BLOCK", 50)  # several blocks of queries to a slab,
    monkeypatch.setattr(SM, "SLAB", 120)  # few leaves to a slab, and slabs to a leaf
    emb = clustered(spark)
    found = SM.searched(emb, emb, 4, exclude_self=True, leaf_rows=50)
    assert found.agg(F.sum("_computed")).first()[0] < 0.05 * 3000 * 3000
    got = {(r.query_id, r.rank): r.neighbour_id for r in SM.knn(emb, emb, 4, exclude_self=True, leaf_rows=50).collect()}
    v = vectors(emb)
    some = {i: v[i] for i in [*range(0, 3000, 97), 5, 6, 7]}
    want = brute(v, some, 4, True)
    assert {key: got[key] for key in want} == want and len(got) == 4 * 3000


def test_few_pairs_are_computed_in_full_on_the_given_vectors(spark):
    emb = SM.split_reference(fx.table(spark, "/root/testdata/sf0.1", "embeddings"))
    ref, cur = emb.where("is_reference"), emb.where("not is_reference")
    computed = SM.searched(ref, cur, SM.K).agg(F.sum("_computed")).first()[0]
    assert computed < 0.2 * ref.count() * cur.count()


def test_fewer_rows_than_neighbours_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in SM.knn(rows, rows, 5, exclude_self=True).orderBy("query_id").collect()]
    assert got == [(1, 1, 2, 5.0), (2, 1, 1, 5.0)]
    assert SM.knn(rows.where("vec_id = 3"), rows, 5).count() == 0


def test_a_full_leaf_is_searched_in_bounded_memory():
    """512 queries against the 65,536 rows of a slab: the products were as large as the leaf times the queries."""
    import tracemalloc

    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(SM.SLAB, 16)), rng.normal(size=(SM.SLICE, 16))
    tree = SM.plant(x[:2000], 1)
    tracemalloc.start()
    i, j, d, _ = SM.block_top(q, np.arange(len(q)), np.full(len(q), np.inf), x, np.arange(len(x)), tree, 5, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    for row in (0, 511):
        want = np.sqrt(((x - q[row]) ** 2).sum(1))
        assert j[i == row].tolist() == np.argsort(want, kind="stable")[:5].tolist()
