import random
import zlib

import numpy as np

from yieldlens.llm import op2_token_ids as op

TEXTS = ["", None, "Hello  world", " lead and trail ", "a\n\n\n b \t c", "x<|endoftext|>y z", "don't we'll 'tis", "été über    x",
         "1234 56,7 !! ?\n", "word " * 3000, "one", "\n", "  ", "tab\tsep\r\nline \n next", "\u0085 a  b", "😀 😀😀  a"]


def brute(texts):
    tok = op.load_tokenizer(op.TOKENIZER)
    out, at = [], 0
    for t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [op.END_ID], "<u4")
        out.append((at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_against_whole_text_encoding(make_docs):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab  \n\tc.é'!1") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = list(enumerate(texts))
    got = op.read_ids(make_docs([]).sparkSession, op.write_ids(make_docs(random.Random(2).sample(rows, len(rows))).repartition(3)))
    got = [(r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.orderBy("doc_id").collect()]
    assert got == brute(texts)


def test_repeated_ids_and_empty_table(make_docs, spark):
    docs = make_docs([(7, "b b"), (7, "a"), (3, "c"), (None, "d"), (7, "a")])
    got = op.read_ids(spark, op.write_ids(docs)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 3, 7, 7, 7]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    assert op.read_ids(spark, op.write_ids(docs.limit(0))).count() == 0


def test_codes_round_trip():
    rng = np.random.default_rng(0)
    counts = [0, 1, 3, 4, 5, 1000, 0]
    v = (rng.integers(0, 2**32, sum(counts)) >> rng.integers(0, 32, sum(counts))).astype(np.uint32)
    control, codes = op.pack(v, counts)
    assert [len(c) for c in control] == [(n + 3) // 4 for n in counts] and (op.unpack(control, codes, counts) == v).all()
    assert (op.unpack(control[5:6], codes[5:6], [1000]) == v[13:]).all()
