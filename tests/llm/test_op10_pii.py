import hashlib
import random
import re

from yieldlens.llm import op10_pii as op

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return [("email", m.span()) for m in EMAIL.finditer(text)] + \
        [("ip", m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))] + \
        [("card", m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))] + \
        [("phone", m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def check(docs, texts):
    got = {r["doc_id"]: r for r in op.find(docs).collect()}
    for i, t in enumerate(texts):
        spans = base(t)
        said = ",".join(f"{k}:{a}:{b}" for k, (a, b) in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest(), (t, said, got[i]["spans"])
        assert tuple(got[i]["n_" + k] for k in op.KINDS[:4]) == tuple(sum(s[0] == k for s in spans) for k in op.KINDS[:4])
        assert got[i]["spans"].startswith(said)
    return got


def test_base_spans(make_docs):
    rng = random.Random(6)
    pool = ["a.b", "@", "mail", ".com", ".", "-", "1", "23", "255", "256", " ", "4539578763621486", "4539 5787 6362 1486", "+1", "(555)", "\n",
            "é", "😀", "555-1234", "+49 30 1234567", "0", "x%", "10.0.0.1", "a@b.c"]
    texts = ["", None, "a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "0001.02.3.255", "x@y@z.com", "9" * 20_000, "a" * 20_000 + "@", "+1((((((" * 500]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 16))) for _ in range(500)]
    check(make_docs(list(enumerate(texts))), texts)


def test_added_spans(make_docs):
    texts = [f"please call phone (555) 123-{1000 + i} now" for i in range(30)] + [f"see version 1.{i}.2 of page 12345 67" for i in range(30)]
    texts += [f"write to joe{i}@mail.example.com soon" for i in range(30)] + [f"call +1 (555) 321-{2000 + i}" for i in range(30)]
    got = check(make_docs(list(enumerate(texts))), texts)
    assert sum(got[i]["n_other"] for i in range(30)) >= 27
    assert sum(got[30 + i]["n_other"] for i in range(30)) == 0


def test_empty_table_and_no_candidates(make_docs):
    assert op.find(make_docs([(1, "a")]).limit(0)).count() == 0
    assert op.find(make_docs([(1, "a"), (2, None)])).count() == 2
