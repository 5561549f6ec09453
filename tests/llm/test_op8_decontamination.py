import hashlib
import random
import re

from yieldlens.llm import op8_decontamination as op


def words(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items):
    windows = {}
    for item, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[s:s + 10]), set()).add(str(item))
    out = {}
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p:p + n])]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def data(seed):
    rng = random.Random(seed)
    text = lambda n: rng.choice([" ", "-", ", "]).join(rng.choice(["a", "B", "c", "é", "É", "d1", "zz"]) for _ in range(n))
    items = [(i, text(rng.randint(0, 30))) for i in range(25)] + [(100, None), (101, ""), (3, "b"), (102, "a b"), (103, "É"), (2, "q r s")]
    docs = [None, "", "a", "B", "x y z", "É é"]
    for _ in range(60):
        parts = [text(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 2)):
            w = words(rng.choice(items)[1])
            k = rng.randrange(len(w) + 1)
            parts += [" ".join(w[k:k + rng.randint(5, 30)]).upper().replace("É", "é"), text(rng.randint(0, 5))]
        docs.append(" ".join(parts))
    docs.append(" ".join(["a"] * 3000))
    return list(enumerate(docs)), items


def test_against_brute_force(make_docs, spark):
    docs, items = data(8)
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, term string")
    rows = op.rate(make_docs(docs + [docs[-5]]), bench).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
    assert len(rows) == len(docs) + 1
    assert got == brute(docs, items)


def test_proximity(make_docs, spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = make_docs([(1, "a b c d e f g h i j"), (2, "a x b c d e f g h i j"), (3, "a b c"), (4, "j i h g f e d c b a j a")])
    got = {(r["_id"], r["kind"]) for r in op.matches(docs, bench, slop=2).collect()}
    assert {k for k in got if k[1] == "exact"} == {(1, "exact")}
    assert (2, "near") in got and (3, "near") not in got


def test_empty_tables(make_docs, spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = make_docs([(1, "a b")])
    assert op.rate(docs.limit(0), bench).count() == 0
    assert not op.rate(docs, bench.limit(0)).first()["contaminated"]


def test_proximity_with_skewed_and_absent_terms(make_docs, spark):
    item = "r1 f2 f3 f4 f5 f6 f7 f8 f9 f10"
    bench = spark.createDataFrame([(1, item), (2, "q1 absent q3 q4 q5 q6 q7 q8 q9 q10")], "item_id long, text string")
    docs = [(1, "r1 new f2 f3 f4 f5 f6 f7 f8 f9 f10"), (2, "q1 other q3 q4 new q5 q6 q7 q8 q9 q10")]
    docs += [(10 + i, " ".join(f"f{k}" for k in range(2, 11))) for i in range(20)] + [(50, "q1"), (51, "r1 " + "x " * 9 + "f2")]
    got = {(r["_id"], r["item_id"], r["kind"]) for r in op.matches(make_docs(docs), bench, slop=2).collect()}
    assert got == {(1, 1, "near"), (2, 2, "near")}
