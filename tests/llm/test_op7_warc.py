import hashlib
import random

from yieldlens.llm import op7_warc as op


def test_round_trip(spark):
    rng = random.Random(5)
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 30_000
    texts = ["", None, "short", "short", big, big, "x" * 999, "x" * 999, "y" * 1000, "y" * 1000, "y" * 1000]
    texts += ["".join(rng.choice("ab\r\né") for _ in range(rng.randint(0, 3000))) for _ in range(40)]
    rows = [(i, None if i % 3 else f"http://a/\r\n{i}é", t, "clash") for i, t in enumerate(texts)]
    rows += [(4, "u", big, "clash"), (None, None, "y" * 1000, "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string").repartition(3)
    _, index = op.write_archives(pages)
    chunks = op.read_chunks(spark, index).collect()
    records = {}
    for c in sorted(chunks, key=lambda c: c["chunk_no"]):
        assert len(c["chunk"]) <= op.CHUNK
        records.setdefault((c["record_id"], c["record_type"]), []).append(c)
    top = {}
    for i, _, t, _ in rows:
        if i is not None and len((t or "").encode()) >= 1000:
            top[t] = max(top.get(t, -1), i)
    assert index.count() == len(rows)
    for i, _, t, _ in rows:
        data = (t or "").encode()
        rid = f"<urn:page:{'' if i is None else i}>"
        if len(data) >= 1000 and top[t] != i:
            got = records[rid, "revisit"][-1]
            assert got["refers_to"] == f"<urn:page:{top[t]}>" and got["stated_bytes"] == len(data)
        else:
            got = records[rid, "response"]
            assert b"".join(c["chunk"] for c in got) == data and [c["chunk_no"] for c in got] == list(range(len(got)))
            got = got[-1]
            assert got["last"] and got["payload_bytes"] == len(data) and got["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert got["stated_digest"] == hashlib.sha1(data).hexdigest()


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    _, index = op.write_archives(pages)
    assert op.read_chunks(spark, index).count() == 0


def test_records_state_the_mandatory_fields(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 2000), (2, "http://b/", "x" * 2000), (3, None, None)],
                                  "page_id long, url string, html string")
    _, index = op.write_archives(pages, date="2026-01-31T12:00:00Z")
    kinds = set()
    for name in {r["archive"] for r in index.collect()}:
        store, path = op.open_store(name)
        with store.open_input_stream(path, compression=None) as stream:
            for fields, *_ in op.records(stream):
                kinds.add(fields["warc-type"])
                assert fields["warc-date"] == "2026-01-31T12:00:00Z"
                assert {"warc-record-id", "warc-type", "content-length"} <= set(fields)
    assert kinds == {"response", "revisit"}
