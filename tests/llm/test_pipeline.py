import collections
import random

import corpus_pipeline as p
import test_op2_token_ids as ids
import test_op8_decontamination as leak
import test_op9_neardup as near
from yieldlens.llm import op1_mixing, op5_quality


def write(spark, folder, docs, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def corpus():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(4)]
    rows = [(0, None, "a"), (1, "", "a"), (2, "too short", "b"), (3, "x y z " * 60, "b")]
    for g in range(30):
        base = [word() for _ in range(rng.randint(60, 200))]
        if g % 5 == 0:
            base[30:30] = items[g % 4][1].split()[:12]
        for _ in range(rng.randint(1, 4)):
            t = list(base)
            t[rng.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t), rng.choice("abc")))
    rows.append(rows[-1])
    return rows, items


def test_stages_against_brute_force(make_docs, spark, tmp_path):
    rows, items = corpus()
    docs = make_docs(rows)
    sf = write(spark, tmp_path, docs, items)
    out = {"docs": spark.read.parquet(f"{sf}/documents.parquet")}
    kept = []
    for name, stage in p.STAGES[:-1]:
        out["docs"] = p.cut_lineage(stage(spark, out["docs"], sf))
        assert out["docs"].columns == docs.columns
        kept.append([(r["doc_id"], r["text"]) for r in out["docs"].collect()])
    good = [(d, t) for d, t, _ in rows if not __import__("test_op5_quality").base(t)[-1]]
    assert collections.Counter(kept[0]) == collections.Counter(good)
    best = near.brute(list(dict(good).items()))
    one = {d: t for d, t in good if best[d][2]}
    assert sorted(kept[1]) == sorted(one.items())
    hit = leak.brute(list(one.items()), items)
    clean = {d: t for d, t in one.items() if not hit[d][4]}
    assert sorted(kept[2]) == sorted(clean.items()) and len(clean) < len(one)
    plan = {r["doc_id"]: r["taken"] for r in op1_mixing.take(make_docs([r for r in rows[:-1] if r[0] in clean])).collect()}
    words = collections.Counter()
    for d, t in kept[3]:
        assert clean[d].startswith(t)
        words[d] += len(t.split())
    assert words == {d: n for d, n in plan.items() if n}
    last = [(r["doc_id"], (r["start"], r["n_tokens"], r["ids_crc32"])) for r in p.token_ids(spark, out["docs"], sf).orderBy("start").collect()]
    assert [d for d, _ in last] == sorted(d for d, _ in kept[3])
    assert collections.Counter((d, n, c) for d, (_, n, c) in last) == collections.Counter(
        (d, *ids.brute([t])[0][1:]) for d, t in kept[3])
    assert p.run(spark, sf).count() == len(last)


def test_empty_table(make_docs, spark, tmp_path):
    sf = write(spark, tmp_path, make_docs([(1, "a", "s")]).limit(0), [(1, "a b")])
    assert p.run(spark, sf).count() == 0
    assert op5_quality.keep(make_docs([(1, "a", "s")])).count() == 0
