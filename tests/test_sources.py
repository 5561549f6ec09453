"""Positional text sources over several part files."""

import pytest
from pyspark.sql import functions as F

from yieldlens.sources import readers as R


def test_order_over_part_files(spark, tmp_path):
    df = spark.range(500).select("id", F.col("id").cast("double").alias("s")).repartition(7)
    path = R.write_sensor_text(df, ["s"], str(tmp_path / "m"), "id")
    back = R.read_sensor_matrix(spark, path, 1).orderBy("position").collect()
    assert [r["position"] for r in back] == list(range(500)) and [r["sensor_001"] for r in back] == [float(i) for i in range(500)]


def test_unequal_counts_are_refused(spark, tmp_path):
    sensors = spark.createDataFrame([(i, 1.0) for i in range(4)], "position long, sensor_001 double")
    labels = spark.createDataFrame([(i, 1, 1, "Fail", None) for i in range(3)],
                                   "position long, original_label int, target int, status string, timestamp timestamp")
    with pytest.raises(Exception, match="no partner for line 4"):
        R.build_master(sensors, labels).collect()


def test_faulty_lines_are_listed(spark, tmp_path):
    (tmp_path / "m.txt").write_text("1 2\n3 x\nNaN 4\n5\n")
    got = [tuple(r) for r in R.sensor_matrix_problems(spark, str(tmp_path / "m.txt"), 2).orderBy("position").collect()]
    assert got == [(1, 2, ["x"]), (3, 1, [])]


def test_json_column_named_like_an_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "data": [{"x": 1}]}, {"id": 2, "data": [{"x": 2}]}]')
    (tmp_path / "b.json").write_text('{"rows": [{"id": 1}, {"id": 2}]}')
    assert R.load_tabular(spark, str(tmp_path / "a.json")).columns == ["data", "id"]
    assert R.load_tabular(spark, str(tmp_path / "b.json")).count() == 2
