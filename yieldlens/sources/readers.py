"""Sources and sinks: the raw sensor-matrix / label text formats, tabular files, role discovery.

Positional files (one record per line, no key) get their line position from
a distributed rank over (file, row id in the scan), never from a driver-side
loop; every other step is a projection or a join on that position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import cumulative
from ..session import shared_path

LABEL_PATTERN = r'^\s*(-?1)\s+"([^"]*)"\s*$'
LABEL_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
SHIFT_EDGES = [-1, 7, 15, 23]
SHIFTS = ["Night", "Morning", "Evening"]
ENVELOPE_KEYS = ["items", "records", "data", "rows"]


def scratch_path(spark: SparkSession, name: str) -> str:
    return shared_path(spark, f"files/{name}")


def with_line_position(lines: DataFrame) -> DataFrame:
    """0-based line position in file order: distributed rank over (file name, scan row id)."""
    t = lines.select("*", F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_i"),
                     F.lit(1).alias("_one"))
    r = cumulative(t, [], ["_f", "_i"], ["_one"])
    return r.select(*lines.columns, (F.col("cum__one") - 1).alias("position"))


def read_sensor_matrix(spark: SparkSession, path: str, n_columns: int | None = None) -> DataFrame:
    """Whitespace-separated numbers without header; the token NaN is missing; columns sensor_001...
    (``n_columns`` fixes the width; otherwise it is taken from the first line).  Other tokens that are no numbers, and
    lines of another width, are listed by ``sensor_matrix_problems``; here they are missing values."""
    lines = spark.read.text(path)
    if n_columns is None:
        first = lines.first()
        n_columns = len(first[0].split()) if first else 0
    tok = F.split(F.trim(F.col("value")), r"\s+")
    cols = []
    for i in range(n_columns):
        t = F.element_at(tok, i + 1)
        v = t.try_cast("double")
        cols.append(F.when(F.lower(t) == "nan", F.lit(None).cast("double")).otherwise(v).alias(f"sensor_{i + 1:03d}"))
    return with_line_position(lines.select(*cols))


def sensor_matrix_problems(spark: SparkSession, path: str, n_columns: int) -> DataFrame:
    """Quarantine of a sensor matrix: position, tokens (how many the line has) and bad_tokens of every faulty line."""
    tok = F.split(F.trim(F.col("value")), r"\s+")
    bad = F.filter(tok, lambda t: t.try_cast("double").isNull() & (F.lower(t) != "nan"))
    t = with_line_position(spark.read.text(path).select(F.size(tok).alias("tokens"), bad.alias("bad_tokens")))
    return t.where((F.col("tokens") != n_columns) | (F.size("bad_tokens") > 0)).select("position", "tokens", "bad_tokens")


def read_labels(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Lines ``-1|1 "dd/MM/yyyy HH:mm:ss"`` -> (labels, quarantine).  -1 -> 0/Pass, 1 -> 1/Fail; a malformed
    line raises in strict mode and goes to the quarantine frame otherwise."""
    lines = with_line_position(spark.read.text(path))
    lab = F.regexp_extract("value", LABEL_PATTERN, 1)
    ts = F.try_to_timestamp(F.regexp_extract("value", LABEL_PATTERN, 2), F.lit(LABEL_TIME_FORMAT))
    ok = (lab != "") & ts.isNotNull()
    if strict:
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed label line "),
                                                                     (F.col("position") + 1).cast("string"))))
    t = lines.select("position", "value", ok.alias("_ok"), lab.alias("_lab"), ts.alias("timestamp"))
    good = t.where("_ok").select("position", F.col("_lab").cast("int").alias("original_label"),
                                 F.when(F.col("_lab") == "1", 1).otherwise(0).alias("target"),
                                 F.when(F.col("_lab") == "1", "Fail").otherwise("Pass").alias("status"), "timestamp")
    bad = t.where(~F.col("_ok")).select("position", F.col("value").alias("line"))
    return good, bad


def build_master(sensors: DataFrame, labels: DataFrame, id_prefix: str = "WF-") -> DataFrame:
    """Positional 1:1 join of sensor rows and labels; id, calendar columns, shift, per-row missing count.

    A position that only one side has is an error: the two files then do not describe the same records."""
    sens = [c for c in sensors.columns if c.startswith("sensor_")]
    j = labels.withColumn("_label", F.lit(True)).join(sensors.withColumn("_row", F.lit(True)), "position", "full")
    alone = F.col("_label").isNull() | F.col("_row").isNull()
    alone_error = F.raise_error(F.concat(F.lit("no partner for line "), (F.col("position") + 1).cast("string"),
                                         F.lit(": sensor rows and labels differ in number")))
    hour = F.hour("timestamp")
    shift = F.when((hour > -1) & (hour <= 7), SHIFTS[0]).when((hour > 7) & (hour <= 15), SHIFTS[1]).when(
        (hour > 15) & (hour <= 23), SHIFTS[2])
    miss = sum(F.col(c).isNull().cast("int") for c in sens) if sens else F.lit(0)
    return j.select(
        F.when(alone, alone_error).otherwise(
            F.concat(F.lit(id_prefix), F.lpad((F.col("position") + 1).cast("string"), 6, "0"))).alias("wafer_id"),
        "timestamp", "original_label", "target", "status",
        F.date_format("timestamp", "yyyy-MM-dd").alias("production_date"),
        hour.alias("production_hour"), F.date_format("timestamp", "EEEE").alias("production_day"), shift.alias("shift"),
        miss.alias("missing_sensor_count"), *sens)


def write_sensor_text(df: DataFrame, features: Sequence[str], path: str, order: str) -> str:
    """Sink in the raw matrix format (NaN for missing): numbered part files that follow each other in ``order``."""
    txt = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in features])
    df.orderBy(order).select(txt.alias("value")).write.mode("overwrite").text(path)
    return path


def write_label_text(df: DataFrame, path: str, order: str, ts: str = "ts") -> str:
    line = F.concat(F.when(F.col("target") == 1, "1").otherwise("-1"), F.lit(' "'),
                    F.date_format(ts, LABEL_TIME_FORMAT), F.lit('"'))
    df.orderBy(order).select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def load_tabular(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Format by suffix (csv, parquet/pq, json); a file that is one JSON object may wrap its rows as an array of objects
    under items/records/data/rows (a column of that name in a table of several rows stays a column)."""
    f = (fmt or path.rsplit(".", 1)[-1]).lower()
    if f in ("parquet", "pq"):
        return spark.read.parquet(path)
    if f == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if f == "json":
        raw = spark.read.option("multiLine", True).json(path)
        for k in ENVELOPE_KEYS:
            kind = raw.schema[k].dataType if k in raw.columns else None
            if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and raw.limit(2).count() == 1:
                return raw.select(F.explode(k).alias("_r")).select("_r.*")
        return raw
    raise ValueError(f"unsupported format: {f}")


def dataset_summary(master: DataFrame, id_col: str = "wafer_id", ts_col: str = "timestamp") -> DataFrame:
    sens = [c for c in master.columns if c.startswith("sensor_")]
    miss = sum(F.col(c).isNull().cast("int") for c in sens)
    a = master.agg(F.count(F.lit(1)).alias("rows"), F.sum(miss).alias("missing_cells"),
                   F.count(F.when(F.col("target") == 0, 1)).alias("pass_count"),
                   F.count(F.when(F.col("target") == 1, 1)).alias("fail_count"),
                   *[F.coalesce(F.min(c) == F.max(c), F.lit(True)).cast("int").alias(f"_k_{c}") for c in sens],
                   F.min(ts_col).alias("start_time"), F.max(ts_col).alias("end_time"))
    return a.select("rows", F.lit(len(sens)).alias("sensors"), F.col("missing_cells").cast("bigint").alias("missing_cells"),
                    sum(F.col(f"_k_{c}") for c in sens).alias("constant_sensors"), "pass_count", "fail_count",
                    F.round(100.0 * F.col("fail_count") / F.col("rows"), 4).alias("fail_percent"),
                    F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
                    F.date_format("end_time", "yyyy-MM-dd HH:mm:ss").alias("end_time"))


def validate_master(master: DataFrame, required: Sequence[str] = ("wafer_id", "timestamp", "target")) -> DataFrame:
    """Required columns, sensors present, target within {0, 1} (one aggregate)."""
    missing = [c for c in required if c not in master.columns]
    sens = [c for c in master.columns if c.startswith("sensor_")]
    a = master.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(~F.col("target").isin(0, 1), 1)).alias("bad_targets"))
    return a.select("rows", F.lit(",".join(missing)).alias("missing_required"), F.lit(len(sens)).alias("sensor_columns"),
                    (F.col("bad_targets") == 0).alias("target_valid"),
                    ((F.col("bad_targets") == 0) & F.lit(not missing) & F.lit(bool(sens))).alias("valid"))


def coerce_types(df: DataFrame, numeric: Sequence[str], ts_col: str | None = None, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """try_cast numerics (non-finite -> NULL), timestamps; descriptor row: rows, columns, duplicate rows, duplicate
    ids, missing cells."""
    out = df.select(*[(F.when(F.abs(F.col(c).try_cast("double")) == float("inf"), F.lit(None))
                       .otherwise(F.col(c).try_cast("double"))).alias(c) if c in numeric else F.col(c) for c in df.columns])
    if ts_col:
        out = out.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    miss = sum(F.col(c).isNull().cast("int") for c in out.columns)
    others = out.columns
    dups = out.groupBy(*others).count().agg(F.sum(F.col("count") - 1).alias("duplicate_rows"))
    a = out.agg(F.count(F.lit(1)).alias("rows"), F.sum(miss).alias("missing_cells"),
                (F.count(F.lit(1)) - F.countDistinct(id_col)).alias("duplicate_ids") if id_col else F.lit(0).alias(
                    "duplicate_ids"))
    desc = a.crossJoin(dups).select("rows", F.lit(len(out.columns)).alias("columns"),
                                    F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows"),
                                    F.col("duplicate_ids").cast("bigint").alias("duplicate_ids"),
                                    F.col("missing_cells").cast("bigint").alias("missing_cells"),
                                    F.lit(len(numeric)).alias("numeric_columns"),
                                    F.lit(len(out.columns) - len(numeric)).alias("categorical_columns"))
    return out, desc


def import_auth_log(spark: SparkSession, path: str, existing: DataFrame | None = None) -> DataFrame:
    """JSON-lines log -> audit events; fingerprint = sha256(line number | line); blank/invalid lines
    skipped; fingerprints already imported are skipped (anti join); success true/false/other ->
    success/failure/information; category 'session' when the event type mentions a session."""
    lines = with_line_position(spark.read.text(path))
    schema = "event_type string, user string, success string, ts string"
    parsed = lines.select("position", "value", F.from_json("value", schema).alias("j"),
                          F.sha2(F.concat_ws("|", (F.col("position") + 1).cast("string"), F.col("value")), 256).alias(
                              "fingerprint"))
    good = parsed.where((F.trim("value") != "") & F.col("j").isNotNull() & F.col("j.event_type").isNotNull())
    out = good.select(
        "fingerprint", F.col("j.event_type").alias("event_type"), F.lower(F.trim("j.user")).alias("user_email"),
        F.when(F.lower("j.success") == "true", "success").when(F.lower("j.success") == "false", "failure")
        .otherwise("information").alias("outcome"),
        F.when(F.lower("j.event_type").contains("session"), "session").otherwise("authentication").alias("category"),
        F.col("j.ts").alias("timestamp_utc"))
    if existing is not None:
        out = out.join(existing.select("fingerprint"), "fingerprint", "left_anti")
    return out
