"""Row statistics: right values on odd rows, fitted statistics read once, no row expression that grows with the square of the sensors."""

from __future__ import annotations

import math

from yieldlens.operators import features as FE

COLS = ["a", "b", "c"]
ROWS = [(1, 3.0, None, -1.0), (2, None, None, None), (3, float("nan"), 2.0, float("inf")), (4, 0.0, 5.0, 1.0)]


class CountedReads:
    """A table of statistics that counts how often it is read."""

    def __init__(self, df):
        self.df, self.reads = df, 0

    def select(self, *cols):
        self.reads += 1
        return self.df.select(*cols)


def _frame(spark):
    return spark.createDataFrame(ROWS, "record_id long, a double, b double, c double")


def _stats(spark):
    return spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 0.0), ("c", None, None)], "feature string, median double, iqr double")


def test_row_statistics(spark):
    out = {r["record_id"]: r for r in FE.aggregate_features(_frame(spark), COLS).collect()}
    assert (out[1]["row_mean"], out[1]["row_median"], out[1]["row_missing_count"], out[1]["negative_count"]) == (1.0, 1.0, 1, 1)
    assert out[1]["row_std"] == round(math.sqrt(8), 6) and out[1]["row_abs_mean"] == 2.0 and out[1]["positive_rate"] == 0.5
    assert out[2]["row_mean"] is None and out[2]["row_range"] is None and out[2]["row_missing_count"] == 3 and out[2]["zero_rate"] is None
    assert out[3]["row_mean"] == 2.0 and out[3]["row_std"] is None and out[3]["row_missing_count"] == 2
    assert (out[4]["row_median"], out[4]["row_range"], out[4]["zero_count"]) == (1.0, 5.0, 1)


def test_row_statistics_are_not_nested_lambdas(spark):
    assert "lambda" not in FE.aggregate_features(_frame(spark), COLS)._jdf.queryExecution().optimizedPlan().toString()


def test_deviations_against_fitted_statistics_read_once(spark):
    stats = CountedReads(_stats(spark))
    out = {r["record_id"]: r for r in FE.robust_deviation_features(_frame(spark), COLS, stats).collect()}
    assert stats.reads == 1
    assert (out[1]["z_mean"], out[1]["abs_z_ge_1"], out[1]["z_std"]) == (1.0, 1, None)
    assert out[2]["z_rms"] is None and out[2]["abs_z_ge_1"] == 0
    assert (out[4]["z_mean"], out[4]["high_extremes"], out[4]["z_abs_max"]) == (1.25, 1, 3.0)


def test_zones_read_the_fitted_statistics_once(spark):
    stats = CountedReads(_stats(spark))
    out = {r["record_id"]: r for r in FE.zone_features(_frame(spark), COLS, stats).collect()}
    assert stats.reads == 1
    assert (out[1]["zone1_mean"], out[1]["zone1_mean_abs_z"], out[1]["zone1_mild_count"], out[1]["zone1_extreme_rate"]) == (3.0, 1.0, 1, 0.0)
    assert (out[4]["zone2_extreme_count"], out[4]["zone2_extreme_rate"], out[4]["zone3_mean_abs_z"]) == (1, 1.0, None)
    assert (out[2]["zone1_missing"], out[2]["zone1_missing_rate"], out[2]["zone1_max"]) == (1, 1.0, None)
