import hashlib
import random

import pytest

from yieldlens.llm import op6_suffix_dedup as op


def brute(rows, length=100):
    seen, out = {}, {}
    data = [(d, (t or "").encode()) for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    first = {}
    for d, b in data:
        for s in range(len(b) - length + 1):
            first.setdefault(b[s:s + length], (d, s))
    for d, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] != (d, s):
                gone[s:s + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [text(rng.randint(60, 400)) for _ in range(6)]
    docs = [None, "", "x" * 99, "x" * 100, "x" * 350, "ab" * 200, "ab" * 120, "abc" * 90, "y" * 5000]
    for _ in range(60):
        parts = [text(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += [p[a:] if rng.random() < 0.5 else p, text(rng.randint(0, 120))]
        docs.append("".join(parts))
    docs += [docs[20]] * 4 + [docs[30][:200] + "!" + docs[30][200:]] * 2
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [40_000, 7])
def test_against_brute_force(make_docs, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    rows = corpus(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in op.remove_repeats(make_docs(rows).repartition(5)).collect()}
    want = brute(rows)
    assert {d for d in want if got[d] != want[d]} == set()


def test_repeated_rows_and_empty_table(make_docs):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdef") for _ in range(300))
    got = op.remove_repeats(make_docs([(1, t), (1, t), (2, t), (3, None), (None, "z")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 300), (3, 0)]
    assert op.remove_repeats(make_docs([(1, "a")]).limit(0)).count() == 0
