"""Fold models read stored rows: no plan of a result joins or scans the records once a fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldlens.operators import models as MO

COLS = ["a", "b"]


def _wide(spark, n=200):
    rows = [(f"r{i}", i, int(i % 3 == 0), "current" if i % 5 == 0 else "reference", float((i * 7) % 13) + 3 * (i % 3 == 0),
             None if i % 11 == 0 else float(i % 4)) for i in range(n)]
    return spark.createDataFrame([*rows, rows[0]], "record_id string, o_orderkey long, target int, side string, a double, b double")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fold_spread_scores_all_folds_in_one_pass(spark):
    out = MO.fold_spread(_wide(spark), COLS, 3)
    plan = _plan(out)
    assert plan.count("Relation [") == 1 and "Union" not in plan and "Join" not in plan
    got = {r["record_id"]: r for r in out.collect()}
    assert len(got) == 40 and all(0 < r["fold_mean"] < 1 and r["fold_std"] >= 0 for r in got.values())  # r0, twice there, is one row


def test_out_of_fold_scores_read_stored_rows(spark):
    wide = _wide(spark)
    out = MO.out_of_fold_scores(wide, COLS, "logistic", 3)
    plan = _plan(out)
    assert "Join" not in plan and "LogicalRDD" not in plan and plan.count("Relation [") == 3
    assert out.count() == 160 and out.select("fold").distinct().count() == 3
    folds = {r["record_id"]: r["fold"] for r in MO.stratified_folds(wide.where(F.col("side") == "reference"), 3).collect()}
    assert {r["record_id"]: r["fold"] for r in out.collect()} == folds
