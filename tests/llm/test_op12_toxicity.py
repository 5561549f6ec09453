"""Held-out accuracy on the given labels, the risk's parts, and the corners."""

import random
import zlib

import numpy as np
import pytest

from yieldlens.llm import op12_toxicity as op
from yieldlens.llm.text import utf8

BAD = ["glurk", "snarf", "VRAK"]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def made(seed=1, n=600):
    rng = random.Random(seed)
    plain = ["w%s" % "".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = rng.choices(plain, k=rng.randrange(20, 200))
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(BAD)
        rows.append((i, " ".join(text)))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def scores(spark, docs, labels):
    lab = spark.createDataFrame([(*r, "clash") for r in labels], "doc_id long, quality int, toxic int, text string")
    return op.score(docs, lab).collect()


def test_finds_toxic_words_from_positive_and_unlabelled_rows(spark, make_docs):
    rows, labels = made()
    got = {r["doc_id"]: r["score"] for r in scores(spark, make_docs(rows), labels)}
    wrong = [i for i, s in got.items() if held(i) and (s >= 0.5) != (i % 5 == 0)]
    assert len(got) == 600 and not wrong


def test_corners(spark, make_docs):
    rows, labels = made(2, 300)
    long_text = "wabcd " * 300_000 + "vrak"
    rows += [(None, "glurk"), (None, None), (1000, ""), (1001, None), (1002, long_text), (1003, "a" * 3_000_000 + " snarf"), (0, rows[0][1])]
    labels += [(None, 1, 1), (1001, 1, None), (0, 1, 0), (0, 0, 1)]
    got = scores(spark, make_docs(rows), labels)
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        assert r["held_out"] == held(r["doc_id"])
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[1000] == by[1001] and by[1000][0] < 0.5
    assert by[1002][0] >= 0.5 and by[1003][0] >= 0.5 and len(set(by[0])) == 1 and max(by[None]) >= 0.5


def test_labels_of_held_out_rows_do_not_matter(spark, make_docs):
    rows, labels = made(3, 200)
    turned = [(i, q, 1 - y if held(i) else y) for i, q, y in labels]
    docs = make_docs(rows)
    order = lambda got: sorted((r["doc_id"], r["score"]) for r in got)
    assert order(scores(spark, docs, labels)) == order(scores(spark, docs.repartition(7), turned))


def test_nothing_to_learn_from(spark, make_docs):
    assert scores(spark, make_docs([]), [(1, 1, 1)]) == []
    for labels in ([], [(1, 1, 0)], [(1, 0, 1), (2, 0, 1)]):
        assert [r["score"] for r in scores(spark, make_docs([(1, "x"), (2, "y")]), labels)] == [0.0, 0.0]


def test_pieces_give_each_word_of_a_document_once():
    import pyarrow as pa

    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("aBé") for _ in range(rng.randrange(1, 4))) + rng.choice(["", ",", "1"])
                      for _ in range(rng.randrange(0, 60))) for _ in range(30)] + ["", "é" * 200, "x"]
    data, offsets = utf8(pa.array(texts))
    whole = {(int(d), int(k)) for doc, key in op.document_words(data, offsets, 1 << 30) for d, k in zip(doc, key)}
    for piece in (1, 7, 64):
        got = [(int(d), int(k)) for doc, key in op.document_words(data, offsets, piece) for d, k in zip(doc, key)]
        assert len(got) == len(set(got)) and set(got) == whole


def test_risk_is_corrected_and_kept_from_falling():
    p, u = np.array([2.0, 3.0]), np.array([2.0, -1.0, -2.0])
    first, second = op.risk(p, u, 0.4)
    soft = lambda z: np.log1p(np.exp(z)).mean()
    assert first == pytest.approx(0.4 * soft(-p)) and second == pytest.approx(soft(u) - 0.4 * soft(p))
    rng = np.random.default_rng(1)  # as many features as rows: without the correction the second part turns far negative
    x, y = rng.random((30, 200)) < 0.1, rng.random((60, 200)) < 0.1
    w = op.fit_linear(x.astype(float), y.astype(float), 0.3, 0.0)
    assert op.risk(x @ w[:-1] + w[-1], y @ w[:-1] + w[-1], 0.3)[1] > -0.05


@pytest.mark.parametrize("sf, recall", [("sf0.01", 0.6), ("sf0.1", 0.8)])
def test_held_out_accuracy(spark, sf, recall):
    d = f"/root/testdata/{sf}"
    got = op.op12_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    tp = sum(r["toxic"] == 1 and r["predicted"] == 1 for r in got)
    assert tp / sum(r["toxic"] == 1 for r in got) >= recall
    assert tp / max(1, sum(r["predicted"] for r in got)) >= 0.95
