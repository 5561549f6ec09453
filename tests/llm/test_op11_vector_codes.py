"""Product codes against a plain loop over Python integers, and the corners of the contract."""

import hashlib
import math
import random

import numpy as np
import pytest

from yieldlens.llm import op11_vector_codes as op

SCHEMA = "vec_id long, embedding array<double>, label int, codes string, error string, _q string"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{(vec_id, numbers): (code, error)} and the codebooks, with Python integers only."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v: [v[p * w : (p + 1) * w] for p in range(parts)]
    books = [[cut(v)[p] for _, v in kept[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((dist(v, e), k) for k, e in enumerate(books[p]))[::-1]
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            for p, part in enumerate(cut(v)):
                members.setdefault((p, nearest(part, p)[0]), []).append(part)
        for (p, k), m in members.items():
            books[p][k] = [sum(col) // len(m) for col in zip(*m)]
    out = []
    for i, v in kept:
        best = [nearest(part, p) for p, part in enumerate(cut(v))]
        out.append((i, "".join(f"{k:02x}" for k, _ in best), sum(d for _, d in best)))
    said = ",".join(str(x) for part in books for e in part for x in e)
    return out, hashlib.sha256(said.encode()).hexdigest()


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    got = op.compressed(df, "vec_id", "embedding", "label").collect()
    return got


def code(r):
    return None if r["codes"] is None else "".join(f"{k:02x}" for k in r["codes"])


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)], rng.choice([0, 1, None])) for i in range(300)]
    rows += [(7, rows[7][1], 1), (None, [rng.gauss(0, 0.3) for _ in range(16)], 0), (500, [0.0] * 16, 0), (501, [0.0] * 16, 0)]
    bad = [(900, None, 0), (901, [None] * 16, 0), (902, [float("nan")] + [0.0] * 15, 0), (903, [float("inf")] + [0.0] * 15, 0)]
    want, digest = brute(rows + bad)
    got = run(spark, rows + bad)
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    assert sorted(((r["vec_id"], code(r), r["error"]) for r in got), key=key) == sorted(want, key=key)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    by_label = {}
    label = {i: lab for i, _, lab in rows}
    for r in got:
        by_label.setdefault(label[r["vec_id"]] if r["vec_id"] != 7 else "seven", set()).add(r["group_error"])
    assert len(by_label[None]) == 1


def test_ties_go_to_the_lower_index_and_short_tables(spark):
    got = run(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 8, 0), (3, [-1.0] * 8, None)])
    assert [(r["vec_id"], code(r), r["error"]) for r in sorted(got, key=lambda r: r["vec_id"])] == [
        (1, "00" * 8, 0), (2, "00" * 8, 0), (3, "02" * 8, 0)]


def test_odd_lengths_huge_components_and_empty(spark):
    rows = [(1, [0.5] * 9, 0), (2, [0.25] * 9, 0), (3, [1.0] * 4, 0), (4, [], 0), (5, [1e300] + [0.0] * 8, 1), (6, [-1e7] + [0.0] * 8, 1)]
    got = {r["vec_id"]: r for r in run(spark, rows)}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert got[3]["codes"] is None and got[4]["error"] is None
    assert len(got[5]["codes"]) == 8 and got[5]["error"] == 0 and got[6]["error"] == 0
    assert run(spark, []) == [] and run(spark, [(1, None, 0)]) == []
    assert [code(r) for r in run(spark, [(1, [], 0)])] == ["00" * 8]


@pytest.mark.parametrize("size", [9, 1 << 12, 1 << 26, 1 << 28, 1 << 45])
def test_distances_are_exact(size):
    rng = np.random.default_rng(size)
    x, c = rng.integers(-size, size + 1, (40, 8)), rng.integers(-size, size + 1, (5, 8))
    d = op.distances(x, c)
    for i in range(40):
        for j in range(5):
            assert int(d[i, j]) == sum((int(a) - int(b)) ** 2 for a, b in zip(x[i], c[j]))


def test_limb_products_stay_exact():
    bits = op.limb_bits(8)
    assert 8 * ((1 << bits) - 1) ** 2 < 2**53
    x = np.array([[(1 << 40) - 1] * 8, [-(1 << 40)] * 8])
    back = sum(part.astype(np.int64) << (bits * k) for k, part in enumerate(op.limbs(x, bits)))
    assert (back == x).all() and all(np.abs(part).max() < 1 << bits for part in op.limbs(x, bits))


def test_decode_returns_entries(spark):
    df = spark.createDataFrame([(i, [float(i)] * 8) for i in range(4)], "i long, v array<double>")
    numbers = op.whole_numbers(df, "v").cache()
    books = op.fit(numbers, "i")
    back = op.decode(op.encode(numbers, books, ["i"]), books).collect()
    assert {r["i"]: r["vector"] for r in back} == {i: [float(i)] * 8 for i in range(4)}
    numbers.unpersist()
