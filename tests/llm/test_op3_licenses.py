import random

from yieldlens.llm import op3_licenses as op


def brute(text):
    units = [(line, False) for line in (text or "").split("\n")] + [(text or "", True)]
    found = []
    for unit, whole in units:
        a = op.bigrams(unit)
        best = max(((2 * len(set(a) & set(b)) / (len(a) + len(b)), name) for name, b in
                    ((n, op.bigrams(t)) for n, t in op.TEMPLATES) if a), default=(0, ""))
        if best[0] >= op.THRESHOLD:
            found.append((best, whole))
    return (sum(not w for _, w in found), ",".join(sorted({b[1] for b, _ in found})),
            max((round(b[0], 9) for b, _ in found), default=None), any(w for _, w in found))


def test_against_brute_force(make_docs):
    rng = random.Random(2)
    texts = [None, "", "MIT", "all rights reserved", "All  RIGHTS reserved!", "\n\nReleased under the MIT license.\nx"]
    for _ in range(200):
        lines = []
        for _ in range(rng.randint(1, 4)):
            w = rng.choice(op.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(["x", "the", "License", "é", "under"])
            lines.append(" ".join(w) if rng.random() < 0.8 else "é prose " * rng.randint(1, 40))
        texts.append("\n".join(lines))
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_lines"], r["licenses"], None if r["best"] is None else round(r["best"], 9), r["whole"])
           for r in op.scan(make_docs(rows + [(0, None)])).collect()}
    assert got == {d: brute(t) for d, t in rows}


def test_empty_table(make_docs):
    assert op.scan(make_docs([(1, "a")]).limit(0)).count() == 0
