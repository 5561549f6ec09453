"""Registered source / sink queries.  Raw formats are produced from the given tables by Spark itself
(written to the shared scratch folder) and read back, so every query grows with the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ROLE_ALIASES
from ..operators import profile as P
from ..sources import fixtures as fx
from ..sources import readers as R

SENS = fx.SENSORS


def _raw(spark, sf):
    w = fx.wide_records(spark, sf)
    sp = R.write_sensor_text(w, SENS, R.scratch_path(spark, "sensors"), "record_id")
    lp = R.write_label_text(w, R.scratch_path(spark, "labels"), "record_id")
    return w, sp, lp


def _master(spark, sf):
    w, sp, lp = _raw(spark, sf)
    sens = R.read_sensor_matrix(spark, sp, len(SENS))
    labels, _ = R.read_labels(spark, lp)
    return R.build_master(sens, labels)


def q_read_sensor_matrix(spark, sf):
    w, sp, lp = _raw(spark, sf)
    return R.read_sensor_matrix(spark, sp, len(SENS))


def q_read_labels(spark, sf):
    w, sp, lp = _raw(spark, sf)
    return R.read_labels(spark, lp)[0]


def q_build_master(spark, sf):
    return _master(spark, sf)


def q_dataset_summary_print(spark, sf):
    return R.dataset_summary(_master(spark, sf))


def q_load_master(spark, sf):
    path = R.scratch_path(spark, "master")
    _master(spark, sf).write.mode("overwrite").parquet(path)
    return R.validate_master(R.load_tabular(spark, path, "parquet"))


def q_load_splits(spark, sf):
    w = fx.wide_records(spark, sf).withColumn("_hash", F.expr("(o_orderkey * 2654435761) % 4294967296"))
    split = P.stratified_split(w, "_hash")
    path = R.scratch_path(spark, "splits")
    split.write.mode("overwrite").partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    dev = back.where(F.col("split").isin("train", "validation")).unionByName(back.where(F.col("split") == "test"))
    return dev.groupBy(F.when(F.col("split") == "test", "test").otherwise("development").alias("dataset")).agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("target") == 1, 1)).alias("failures"))


def q_load_tabular(spark, sf):
    path = R.scratch_path(spark, "scores") + ".csv"
    fx.scores(spark, sf).select("record_id", "target", "probability", "confidence").write.mode("overwrite").option(
        "header", True).csv(path)
    return R.load_tabular(spark, path, "csv")


def q_coerce_types(spark, sf):
    w = fx.wide_records(spark, sf)
    return R.coerce_types(w, SENS, "ts", "record_id")[1]


def q_write_tables(spark, sf):
    w = fx.wide_records(spark, sf)
    fs = P.feature_stats(P.profile_base(w, SENS))
    manifest = P.feature_manifest(fs)
    base = R.scratch_path(spark, "stage_outputs")
    manifest.write.mode("overwrite").parquet(f"{base}/feature_manifest.parquet")
    manifest.write.mode("overwrite").option("header", True).csv(f"{base}/feature_manifest.csv")
    w.write.mode("overwrite").partitionBy("side").parquet(f"{base}/records.parquet")
    rows = [("feature_manifest", "parquet", spark.read.parquet(f"{base}/feature_manifest.parquet")),
            ("feature_manifest", "csv", spark.read.option("header", True).csv(f"{base}/feature_manifest.csv")),
            ("records", "parquet", spark.read.parquet(f"{base}/records.parquet"))]
    out = None
    for name, fmt, df in rows:
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), F.lit(fmt).alias("format"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def q_import_auth_log(spark, sf):
    ev = fx.audit_events(spark, sf).where(F.col("category") == "authentication")
    line = F.to_json(F.struct(F.col("event_type"), F.col("user_email").alias("user"),
                              F.when(F.col("outcome") == "success", "true").otherwise("false").alias("success"),
                              F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss").alias("ts")))
    path = R.scratch_path(spark, "auth_log")
    ev.orderBy("timestamp_utc", "event_id").select(line.alias("value")).write.mode("overwrite").text(path)
    first = R.import_auth_log(spark, path)
    already = first.where(F.substring("fingerprint", 1, 1) < "8")  # a previous import of part of the log, by hash
    return R.import_auth_log(spark, path, existing=already)


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

_POS = "row_number() OVER (ORDER BY record_id) - 1"
SQL = {
    "read_sensor_matrix": fx.sql_with("wide_records") + f"SELECT {', '.join(SENS)}, {_POS} AS position FROM wide_records",
    "read_labels": fx.sql_with("wide_records") + f"""SELECT {_POS} AS position, CASE WHEN target = 1 THEN 1 ELSE -1 END AS original_label,
        target, CASE WHEN target = 1 THEN 'Fail' ELSE 'Pass' END AS status, date_trunc('second', ts) AS timestamp FROM wide_records""",
    "build_master": fx.sql_with("wide_records") + f""", m AS (SELECT *, {_POS} AS position, date_trunc('second', ts) AS t2 FROM wide_records)
      SELECT 'WF-' || lpad(CAST(position + 1 AS VARCHAR), 6, '0') AS wafer_id, t2 AS timestamp,
        CASE WHEN target = 1 THEN 1 ELSE -1 END AS original_label, target, CASE WHEN target = 1 THEN 'Fail' ELSE 'Pass' END AS status,
        strftime(t2, '%Y-%m-%d') AS production_date, hour(t2) AS production_hour, dayname(t2) AS production_day,
        CASE WHEN hour(t2) > -1 AND hour(t2) <= 7 THEN 'Night' WHEN hour(t2) > 7 AND hour(t2) <= 15 THEN 'Morning'
             WHEN hour(t2) > 15 AND hour(t2) <= 23 THEN 'Evening' END AS shift,
        {' + '.join(f'CASE WHEN {s} IS NULL THEN 1 ELSE 0 END' for s in SENS)} AS missing_sensor_count, {', '.join(SENS)} FROM m""",
    "dataset_summary_print": fx.sql_with("wide_records") + f"""SELECT count(*) AS rows, {len(SENS)} AS sensors,
        CAST(sum({' + '.join(f'CASE WHEN {s} IS NULL THEN 1 ELSE 0 END' for s in SENS)}) AS BIGINT) AS missing_cells,
        {' + '.join(f'CASE WHEN count(DISTINCT {s}) <= 1 THEN 1 ELSE 0 END' for s in SENS)} AS constant_sensors,
        count(*) FILTER (WHERE target = 0) AS pass_count, count(*) FILTER (WHERE target = 1) AS fail_count,
        round(100.0 * count(*) FILTER (WHERE target = 1) / count(*), 4) AS fail_percent,
        strftime(min(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS start_time,
        strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS end_time FROM wide_records""",
    "load_master": fx.sql_with("wide_records") + f"""SELECT count(*) AS rows, '' AS missing_required, {len(SENS)} AS sensor_columns,
        count(*) FILTER (WHERE target NOT IN (0, 1)) = 0 AS target_valid, count(*) FILTER (WHERE target NOT IN (0, 1)) = 0 AS valid
      FROM wide_records""",
    "load_splits": fx.sql_with("wide_records") + """, rk AS (SELECT record_id, target, row_number() OVER (PARTITION BY target
        ORDER BY (o_orderkey * 2654435761) % 4294967296, record_id) AS r, count(*) OVER (PARTITION BY target) AS n FROM wide_records)
      SELECT CASE WHEN r <= round(n * 0.2) THEN 'test' ELSE 'development' END AS dataset, count(*) AS records,
        count(*) FILTER (WHERE target = 1) AS failures FROM rk GROUP BY 1""",
    "load_tabular": fx.sql_with("wide_records", "scores") + "SELECT record_id, target, probability, confidence FROM scores",
    "coerce_types": fx.sql_with("wide_records") + f"""SELECT count(*) AS rows, 27 AS columns,
        CAST(coalesce((SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM wide_records GROUP BY ALL_COLS)), 0) AS BIGINT) AS duplicate_rows,
        CAST(count(*) - count(DISTINCT record_id) AS BIGINT) AS duplicate_ids,
        CAST(sum({' + '.join(f'CASE WHEN {s} IS NULL THEN 1 ELSE 0 END' for s in SENS)}) AS BIGINT) AS missing_cells,
        {len(SENS)} AS numeric_columns, 7 AS categorical_columns FROM wide_records""".replace(
        "GROUP BY ALL_COLS", "GROUP BY record_id, o_orderkey, o_custkey, ts, target, status, side, " + ", ".join(SENS)),
}
