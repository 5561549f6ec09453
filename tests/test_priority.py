"""Percentile ranks within records, against a plain computation; records that span batches; tasks that stay of one size."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldlens.operators import priority as PR

ROWS = [("r1", "a", 3.0), ("r1", "b", None), ("r1", "c", 3.0), ("r1", "d", -1.0), ("r2", "a", 2.0), ("r2", "b", 2.0),
        (None, "a", 1.0), (None, "b", 5.0), ("r3", "a", 0.0)]


def _plain(rows):
    out = {}
    for rid in {r[0] for r in rows}:
        own = [(f, 0.0 if v is None else v) for r, f, v in rows if r == rid]
        for f, v in own:
            below, same = sum(x < v for _, x in own), sum(x == v for _, x in own)
            out[rid, f] = 0.5 if same == len(own) else (below + (same + 1) / 2) / len(own)
    return out


def _ranks(spark, rows):
    df = spark.createDataFrame(rows, "record_id string, feature string, value double")
    return PR.percentile_ranks(df, {"p": F.col("value")}, "record_id", len(rows))


def test_percentile_ranks(spark):
    got = {(r["record_id"], r["feature"]): r["p"] for r in _ranks(spark, ROWS).collect()}
    assert got == _plain(ROWS)


def test_records_that_span_batches(spark):
    rows = [(f"r{i // 7}", f"f{i % 7}", float((i * 37) % 11)) for i in range(210)] + [("big", f"g{i:03d}", float(i % 13)) for i in range(100)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "16")
    try:
        got = {(r["record_id"], r["feature"]): r["p"] for r in _ranks(spark, rows).collect()}
    finally:
        spark.conf.set(size, before)
    assert got == _plain(rows)


def test_one_sort_and_more_tasks_for_more_rows(spark):
    df = spark.createDataFrame(ROWS, "record_id string, feature string, value double")
    signals = {"p": F.col("value"), "q": F.abs("value")}
    out = PR.percentile_ranks(df, signals, "record_id", 40 * PR.ROWS_IN_TASK, "feature", 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "Window" not in plan
    assert "hashpartitioning(record_id" in plan and ", 40)" in plan
    got = {r["record_id"]: (r["feature"], r["_place"]) for r in out.collect()}
    assert got == {"r1": ("a", 1), "r2": ("a", 1), None: ("b", 1), "r3": ("a", 1)}
