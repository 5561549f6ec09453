import collections
import random
import re

from yieldlens.llm import op5_quality as op

W = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    ws = W.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if W.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.defaultdict(list)
    for i in range(len(ws) - 2):
        grams[tuple(ws[i:i + 3])].append(i)
    hit = {i + k for p in grams.values() if len(p) > 1 for i in p for k in range(3)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(ws) < 50 or 100 * len(hit) > 50 * len(ws))


def test_base_figures(make_docs):
    rng = random.Random(3)
    texts = ["", None, " \n\t", "a b c a b c", "x\n\nx\n x\nx", "#*$%&|<>", "é😀 ñ z", "Orre " * 4000, "a a a a"]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "dd  ", "#\t", "é "]) for _ in range(rng.randint(1, 200))) for _ in range(150)]
    got = {r["doc_id"]: r for r in op.judge(make_docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(t), t


def test_depleted_documents_are_rejected_and_copies_kept(make_docs):
    def body(i, n):
        name = "".join(chr(97 + int(c)) for c in str(i))
        return " ".join(f"w{name}x{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n))

    common = " ".join(f"c{k}" for k in range(60))
    docs = [(i, common + "\n" + body(i, 3), "h") for i in range(30)]           # nothing of their own
    docs += [(100 + i, common + "\n" + body(100 + i, 60), "h") for i in range(30)]
    docs += [(200 + i, body(7, 80) + "\n" + body(8, 70), "h") for i in range(60)]  # exact copies of one document
    docs += [(300, common + "\n" + body(1, 3), None), (301, None, None)]
    got = {r["doc_id"]: r["kept"] for r in op.judge(make_docs(docs)).collect()}
    assert not any(got[i] for i in range(30))
    assert all(got[100 + i] for i in range(30)) and all(got[200 + i] for i in range(60))
    assert got[300] and not got[301]


def test_empty_table(make_docs):
    assert op.judge(make_docs([(1, "a")]).limit(0)).count() == 0


def test_kept_texts_lose_their_boilerplate_lines(make_docs):
    def body(i, n):
        name = "".join(chr(97 + int(c)) for c in str(i))
        return " ".join(f"w{name}x{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n))

    docs = [(i, f"Page {i}  of Site\n\n{body(i, 60)}\n\tpage {i + 1} OF site\nend", "h") for i in range(30)]
    docs += [(100, "Page 1 of Site\n" + body(100, 60), "other"), (101, "page 7 of site\n" + body(101, 60), None)]
    docs += [(None, "page 9 of site\n" + body(102, 70), "h"), (3, "page 8 of site\n" + body(103, 70), "h"), (104, "end", "h")]
    rows = op.keep(make_docs(docs)).select("doc_id", "text", "source", "h").collect()
    want = [(i, f"\n{body(i, 60)}", "h", "clash") for i in range(30)]
    want += [(d, t, h, "clash") for d, t, h in docs[30:32]] + [(None, body(102, 70), "h", "clash"), (3, body(103, 70), "h", "clash")]
    assert collections.Counter(tuple(r) for r in rows) == collections.Counter(want)
