import collections

from yieldlens.llm import op1_mixing as op


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_budgets_epochs_and_edge_cases(make_docs):
    docs = make_docs([(i, "w " * (i % 7), s) for s in ("a", "b", "c", None) for i in range(40)]
                     + [(900, None, "a"), (901, "", "b"), (902, "x " * 5000, "c"), (903, " \n", "empty"), (5, "w w", "a"), (5, "w w", "a")])
    got = rows_of(op.take(docs))
    assert len(got) == 166
    by = collections.defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = by[r["source"]]
        s[0] += r["size"]
        s[1] += r["taken"]
        s[2] = r["target"]
        assert r["target"] <= 3 * r["source_size"]
    total = sum(s[0] for s in by.values())
    assert abs(sum(s[2] for s in by.values()) - total) < 1e-6
    for s in by.values():
        assert abs(s[1] - s[2]) <= 0.5
    order = ["a", "b", "c", "empty", None]
    weight = dict(zip(order, (5, 2, 1, 5, 2)))
    free = [k for k in order if by[k][2] < 3 * by[k][0]]
    levels = {round(by[k][2] / weight[k], 6) for k in free}
    assert len(levels) == 1 and all(3 * by[k][0] / weight[k] <= max(levels) + 1e-6 for k in order if k not in free)
    assert sorted(map(str, got)) == sorted(map(str, rows_of(op.take(docs))))


def test_rows_of_the_mix(make_docs):
    docs = make_docs([(i, f"a  b\n c{i} d ", "x") for i in range(9)] + [(100 + i, "é " * 50, "y") for i in range(20)] + [(200, None, "x")])
    plan = {r["doc_id"]: r for r in rows_of(op.take(docs))}
    words = collections.Counter()
    for r in op.apply_mix(docs).collect():
        assert set(docs.columns) == set(r.asDict())
        words[r["doc_id"]] += len(r["text"].split())
    assert words == {k: r["taken"] for k, r in plan.items() if r["taken"]}


def test_empty_table(make_docs):
    docs = make_docs([(1, "a", "s")]).limit(0)
    assert op.take(docs).count() == 0
    assert op.apply_mix(docs).count() == 0
