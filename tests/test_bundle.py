"""Bundles are seen whole or not at all, and their listing tells when files changed."""

import pytest
from pyspark.sql import functions as F

from yieldlens.operators import bundle as B


def test_readers_see_all_tables_or_none(spark, tmp_path):
    folder = str(tmp_path / "bundle")
    good = spark.range(10).select("id", F.lit("x").alias("word"))
    broken = spark.range(5).select(F.raise_error(F.lit("no such row")).alias("id"))
    with pytest.raises(Exception, match="no such row"):
        B.publish({"a": good, "b": broken}, folder)
    with pytest.raises(FileNotFoundError):
        B.listing(spark, folder)
    assert B.publish({"a": good, "b": good.limit(3)}, folder) == 1
    with pytest.raises(Exception, match="no such row"):
        B.publish({"a": good.limit(1), "b": broken}, folder)
    seen = {r["table_name"]: (r["version"], r["row_count"]) for r in B.listing(spark, folder).collect()}
    assert seen == {"a": (1, 10), "b": (1, 3)} and B.read(spark, folder, "a").count() == 10
    assert B.publish({"a": good.limit(2)}, folder) == 2
    assert B.read(spark, folder, "a").count() == 2 and B.read(spark, folder, "a", version=1).count() == 10
    with pytest.raises(KeyError):
        B.read(spark, folder, "b")


def test_of_two_writers_of_a_version_one_takes_the_next(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "bundle")
    B.publish({"a": spark.range(1)}, folder)
    monkeypatch.setattr(B, "versions", lambda spark, folder: [])  # a writer that has not seen version 1
    assert B.publish({"a": spark.range(2)}, folder) == 2
    monkeypatch.undo()
    assert B.versions(spark, folder) == [1, 2] and B.read(spark, folder, "a", 1).count() == 1


def test_digest_follows_rows_not_order(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b", None), (2, "a", "b|c"), (2, "a", "b|c"), (None, "", "\\N")], "id long, s string, t string")
    one = B.digest(df).first()
    assert one == B.digest(df.orderBy(F.desc("id")).repartition(3)).first() and one["row_count"] == 4
    assert one["digest"] != B.digest(df.distinct()).first()["digest"] != B.digest(df.withColumn("s", F.lit("a"))).first()["digest"]
    folder = str(tmp_path / "bundle")
    B.publish({"t": df, "none": df.limit(0)}, folder)
    assert [r["intact"] for r in B.verified(spark, folder).collect()] == [True, True]
    df.limit(1).write.mode("append").parquet(B.manifest(spark, folder)[0]["path"])
    assert {r["table_name"]: r["intact"] for r in B.verified(spark, folder).collect()} == {"t": False, "none": True}
    with pytest.raises(ValueError):
        B.publish({}, folder)
