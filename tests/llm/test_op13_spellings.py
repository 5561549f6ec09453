"""Forms and roots against a brute-force comparison of all pairs."""

import random
import re
import zlib

import numpy as np

from yieldlens.llm import op13_spellings as op


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    """{word: (form, root, n, n_near, form_n)}."""
    count = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1 :]
            count[low] = count.get(low, 0) + 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def rows_of(df):
    rows = df.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdéÿx") for _ in range(rng.choice([7, 7, 8, 9, 12, 15]))) for _ in range(40)]
    words = list(base)
    for w in base:
        for _ in range(6):
            i = rng.randrange(len(w))
            words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abÀ") + w[i:], w[:i] + "q" + w[i + 1 :]]))
    weights = [rng.choice([1, 2, 30, 400]) for _ in words]
    texts = [(i, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=120))) for i in range(n)]
    return texts + [(n, None), (n + 1, ""), (3, texts[3][1]), (None, texts[4][1]), (n + 2, "run " * 9)]


def test_equals_brute_force(spark, make_docs):
    rows = corpus(1)
    want = brute(rows)
    assert rows_of(op.group(make_docs(rows))) == want
    assert sum(w[0] is not None for w in want.values()) > 20


def test_short_lists_give_the_same(spark, make_docs):
    rows = corpus(2, 30)
    assert rows_of(op.group(make_docs(rows), limit=2)) == brute(rows)


def test_chains_ties_and_a_hot_list(spark, make_docs):
    hot = [f"zzzzzzz{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]  # one list of 100 words
    text = " ".join(["aaaaaaa"] * 300 + ["aaaaaab"] * 30 + ["aaaaabb"] * 3 + ["caaaaaa"] * 300 + hot * 2)
    rows = [(1, text), (2, "b" * 3000 + " " + "b" * 2999 + "c"), (3, "b" * 3000 + " " + "b" * 2999 + "c"), (4, "×÷" * 4 + " " + "×÷" * 4)]
    got = rows_of(op.group(make_docs(rows), limit=8))
    assert got == brute(rows)
    assert got["aaaaabb"][1] == "aaaaaaa"


def test_empty(spark, make_docs):
    assert rows_of(op.group(make_docs([]))) == {} and rows_of(op.group(make_docs([(1, None), (2, "short words only")]))) == {}


def test_sorted_scan_equals_all_pairs():
    rng = random.Random(5)
    words, lists = [], []
    for k in range(40):
        own = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([7, 8]))) for _ in range(rng.randrange(1, 60))})
        words += own
        lists += [k] * len(own)
    a, b, place = op.near_pairs(words, np.array(lists))
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if lists[i] == lists[j] and one_edit(words[i], words[j])}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)
    for i, j, p in zip(a, b, place):
        assert words[i][:p] == words[j][:p] and words[i][p : p + 1] != words[j][p : p + 1]
