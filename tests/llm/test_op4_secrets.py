import hashlib
import random
import re

from yieldlens.llm import op4_secrets as op

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def documents():
    rng = random.Random(4)
    pool = ["password", "PassWd", ": ", "=", '"', "'", "tOKEN", "secret", "api_key", "apikey", "AKIA", "ABCDEFGHIJ0123456789", "deadbeef0123",
            "deadbeef0123deadbeef0123", " ", "\n", "é", "😀", "abc", "x", "ſecret=abcdefgh", "AKIAAKIA"]
    return ["", None, "password=12345", "password=123456"] + [
        "".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(400)]


def test_base_spans_and_no_model(make_docs):
    texts = documents()
    got = {r["doc_id"]: r for r in op.find(make_docs(list(enumerate(texts))), rows=5).collect()}
    for i, t in enumerate(texts):
        spans = base(t)
        said = ",".join(f"{op.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest(), t
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert set(filter(None, said.split(","))) <= set(got[i]["spans"].split(","))


def test_held_out_accuracy_and_added_spans(make_docs, spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"{word(6)} {word(14)} token = \"{hexes(24 + i % 17)}\" {word(5)}") for i in range(300)]
    rows += [(1000 + i, f"{word(6)} mail{i % 9}.{word(8)}.com {word(15)} {word(4)}") for i in range(300)]
    docs = make_docs(rows + [(5000, f'{word(6)} {word(14)} token is "{hexes(23)}" {word(5)}'), (5001, "see mail3.example.com there")])
    nets = op.train(spark.createDataFrame([(1, op.window(t, t.index('"') + 1, t.rindex('"'))) for _, t in rows[:200]]
                                          + [(0, op.window(t, 7, 25)) for _, t in rows[300:500]], "label int, view string"))
    held = op.accepted(nets, [op.window(t, t.index('"') + 1, t.rindex('"')) for _, t in rows[200:300]])
    assert sum(held) >= 95
    assert sum(op.accepted(nets, [op.window(t, 7, 25) for _, t in rows[500:600]])) <= 5
    got = {r["doc_id"]: r for r in op.find(docs).collect()}
    assert got[5000]["n_model"] == 1 and got[5001]["spans"] == ""
    assert sum(got[1000 + i]["n_model"] for i in range(300)) <= 6


def test_empty_table(make_docs):
    assert op.find(make_docs([(1, "a")]).limit(0)).count() == 0


def test_windows_cover_the_whole_run():
    for n in (12, 40, 41, 59, 60, 61, 80, 81, 200, 1001):
        text = "before " + "".join(chr(0x4E00 + i) for i in range(n)) + " after"
        views = op.windows(text, 7, 7 + n)
        assert views[0] == op.window(text, 7, 7 + n) and all(len(v) == op.BEFORE + op.TOKEN + op.AFTER for v in views)
        seen = [v[op.BEFORE:op.BEFORE + op.TOKEN] for v in views]
        for a in range(n - min(n, 20) + 1):
            assert any(text[7 + a:7 + a + min(n, 20)] in s for s in seen)


def test_secret_after_the_fortieth_character_is_found(make_docs):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"{word(6)} {word(14)} token = \"{hexes(24 + i % 17)}\" {word(5)}") for i in range(300)]
    path = lambda: "/".join(word(9) for _ in range(4))
    rows += [(1000 + i, f"{word(6)} \"mail{i % 9}.{word(8)}.com/{path()}\" {word(4)}") for i in range(300)]
    rows += [(2000 + i, f"{word(6)} \"mail{i % 9}.{word(8)}.com/{path()}/{hexes(23)}\" {word(5)}") for i in range(5)]
    got = {r["doc_id"]: r["n_model"] for r in op.find(make_docs(rows)).collect()}
    assert sum(got[2000 + i] for i in range(5)) >= 4 and sum(got[1000 + i] for i in range(300)) <= 15


def test_recall_wins_over_the_floor():
    import numpy as np

    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 96, (600, op.BEFORE + op.TOKEN + op.AFTER)), np.arange(600) % 10 == 0
    net = op.CharNet().calibrate(x, y.astype(int))
    assert (net.chance(x)[y] >= net.threshold).mean() >= op.RECALL
