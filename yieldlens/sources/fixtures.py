"""Record-table views derived from the driver's synthetic tables.

The reference works on one wide sensor table (id, time, 0/1 target, many
numeric measurements).  The synthetic TPC-H-ish tables are turned into that
shape by Spark itself (joins and grouping over ``lineitem``/``orders``), so
every query grows with the given data.  ``sql_with`` renders the same views
as DuckDB CTE text for the oracle twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_SENSORS = 20
SENSORS = [f"sensor_{i:03d}" for i in range(1, N_SENSORS + 1)]
SPLIT_TS = "2000-04-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_sensors(lineitem: DataFrame) -> DataFrame:
    even = F.col("l_linenumber") % 2 == 0
    odd = F.col("l_linenumber") % 2 == 1
    ln = F.col("l_linenumber")

    def mx(cond, col):
        return F.max(F.when(cond, F.col(col)))

    aggs = [
        mx(even, "l_quantity"), mx(even, "l_extendedprice"), mx(even, "l_discount"), mx(even, "l_tax"),
        mx(odd, "l_quantity"), mx(odd, "l_extendedprice"), mx(odd, "l_discount"), mx(odd, "l_tax"),
    ]
    aggs += [mx(ln == k, "l_extendedprice") for k in range(1, 8)]
    aggs.append(mx((ln == 1) & (F.col("l_returnflag") == "R"), "l_quantity"))
    return lineitem.groupBy("l_orderkey").agg(*[a.alias(SENSORS[i]) for i, a in enumerate(aggs)])


def _order_columns() -> list:
    """The columns of a record that come from its order alone."""
    fail = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return [
        F.concat(F.lit("R-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("record_id"),
        "o_orderkey",
        "o_custkey",
        F.expr("o_orderdate + make_interval(0, 0, 0, 0, CAST(o_orderkey % 24 AS INT), 0, 0)").alias("ts"),
        F.when(fail, 1).otherwise(0).alias("target"),
        F.when(fail, "Fail").otherwise("Pass").alias("status"),
        F.when(F.col("o_orderdate") < F.lit(SPLIT_TS).cast("timestamp_ntz"), "reference")
        .otherwise("current")
        .alias("side"),
    ]


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``wide_records`` without the sensors: ``lineitem`` adds at most one row to an order, so it is not read."""
    return table(spark, sf_dir, "orders").select(*_order_columns())


def wide_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, 20 sensors, a 0/1 target and a reference/current side."""
    orders = table(spark, sf_dir, "orders")
    line = _line_sensors(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
        )
    )
    j = orders.join(line, orders.o_orderkey == line.l_orderkey, "left")
    return j.select(
        *_order_columns(),
        *SENSORS[:16],
        F.col("o_totalprice").alias("sensor_017"),
        F.lit(1.0).cast("double").alias("sensor_018"),
        (2 * F.col("o_totalprice") + 1).alias("sensor_019"),
        (F.col("o_custkey") % 97).cast("double").alias("sensor_020"),
    )


def scores(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> DataFrame:
    """A fixed failure probability (plus confidence, OOD and neighbour signals) per record."""
    w = wide if wide is not None else order_records(spark, sf_dir)
    return w.select(
        "record_id", "target", "side", "ts",
        (((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729) % 10007 + 4000 * F.col("target")).cast("double")
         / 14006).alias("probability"),
        (((F.col("o_orderkey") * 31 + 7) % 1009).cast("double") / 1008).alias("confidence"),
        (((F.col("o_orderkey") * 17 + F.col("o_custkey")) % 997).cast("double") / 996).alias("ood_percentile"),
        ((F.col("o_orderkey") * 13 + 5) % 11).cast("int").alias("failed_neighbour_count"),
    )


def members(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> DataFrame:
    """Five ensemble-member probabilities per record (long form)."""
    w = wide if wide is not None else order_records(spark, sf_dir)
    m = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("member")
    return w.select("record_id", "o_orderkey", "o_custkey", m).select(
        "record_id", "member",
        (((F.col("o_orderkey") * (7919 + 26 * F.col("member")) + F.col("o_custkey") * 101) % 10007).cast("double")
         / 10006).alias("p"),
    )


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit-event rows derived from ``events``."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.concat(F.lit("E-"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("ts").alias("timestamp_utc"),
        "event_type",
        F.when(et == "signup", "authentication").when(et == "error", "authentication")
        .when(et == "view", "wafer_access").when(et == "purchase", "export").otherwise("search").alias("category"),
        F.when(et == "error", "failure").otherwise("success").alias("outcome"),
        F.when(F.col("user_id") % 25 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))).alias("user_email"),
        F.concat(F.lit("R-"), F.lpad((F.col("event_id") % 500).cast("string"), 9, "0")).alias("resource_id"),
        F.col("value").alias("duration_ms"),
        F.col("props").alias("details_json"),
    )


# ---------------------------------------------------------------------------
# DuckDB twins of the views (CTE text), for oracle_sql()
# ---------------------------------------------------------------------------

_SQL_LINE = """line AS (
  SELECT l_orderkey,
    max(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END) AS sensor_001,
    max(CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END) AS sensor_002,
    max(CASE WHEN l_linenumber % 2 = 0 THEN l_discount END) AS sensor_003,
    max(CASE WHEN l_linenumber % 2 = 0 THEN l_tax END) AS sensor_004,
    max(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity END) AS sensor_005,
    max(CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice END) AS sensor_006,
    max(CASE WHEN l_linenumber % 2 = 1 THEN l_discount END) AS sensor_007,
    max(CASE WHEN l_linenumber % 2 = 1 THEN l_tax END) AS sensor_008,
    max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS sensor_009,
    max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS sensor_010,
    max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS sensor_011,
    max(CASE WHEN l_linenumber = 4 THEN l_extendedprice END) AS sensor_012,
    max(CASE WHEN l_linenumber = 5 THEN l_extendedprice END) AS sensor_013,
    max(CASE WHEN l_linenumber = 6 THEN l_extendedprice END) AS sensor_014,
    max(CASE WHEN l_linenumber = 7 THEN l_extendedprice END) AS sensor_015,
    max(CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN l_quantity END) AS sensor_016
  FROM lineitem GROUP BY l_orderkey)"""

_SQL_WIDE = """wide_records AS (
  SELECT concat('R-', lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) AS record_id,
       o_orderkey, o_custkey,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS ts,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS target,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Fail' ELSE 'Pass' END AS status,
       CASE WHEN o_orderdate < TIMESTAMP '2000-04-01 00:00:00' THEN 'reference' ELSE 'current' END AS side,
       sensor_001, sensor_002, sensor_003, sensor_004, sensor_005, sensor_006, sensor_007, sensor_008,
       sensor_009, sensor_010, sensor_011, sensor_012, sensor_013, sensor_014, sensor_015, sensor_016,
       o_totalprice AS sensor_017,
       CAST(1.0 AS DOUBLE) AS sensor_018,
       2 * o_totalprice + 1 AS sensor_019,
       CAST(o_custkey % 97 AS DOUBLE) AS sensor_020
  FROM orders LEFT JOIN line ON o_orderkey = l_orderkey)"""

_SQL_SCORES = """scores AS (
  SELECT record_id, target, side, ts,
       CAST((o_orderkey * 7919 + o_custkey * 104729) % 10007 + 4000 * target AS DOUBLE) / 14006 AS probability,
       CAST((o_orderkey * 31 + 7) % 1009 AS DOUBLE) / 1008 AS confidence,
       CAST((o_orderkey * 17 + o_custkey) % 997 AS DOUBLE) / 996 AS ood_percentile,
       CAST((o_orderkey * 13 + 5) % 11 AS INT) AS failed_neighbour_count
  FROM wide_records)"""

_SQL_MEMBERS = """members AS (
  SELECT record_id, m AS member,
       CAST((o_orderkey * (7919 + 26 * m) + o_custkey * 101) % 10007 AS DOUBLE) / 10006 AS p
  FROM wide_records CROSS JOIN (SELECT 0 AS m UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) AS t)"""

_SQL_AUDIT = """audit_events AS (
  SELECT concat('E-', CAST(event_id AS VARCHAR)) AS event_id, ts AS timestamp_utc, event_type,
       CASE event_type WHEN 'signup' THEN 'authentication' WHEN 'error' THEN 'authentication'
                       WHEN 'view' THEN 'wafer_access' WHEN 'purchase' THEN 'export' ELSE 'search' END AS category,
       CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome,
       CASE WHEN user_id % 25 = 0 THEN NULL ELSE concat('user', CAST(user_id AS VARCHAR), '@example.com') END AS user_email,
       concat('R-', lpad(CAST(event_id % 500 AS VARCHAR), 9, '0')) AS resource_id,
       value AS duration_ms, props AS details_json
  FROM events)"""

# long form of the wide view: one row per (record, sensor)
_SQL_LONG = "long_records AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT record_id, ts, target, side, '{s}' AS feature, {s} AS value FROM wide_records" for s in SENSORS
) + ")"

_ORDER = ["line", "wide_records", "scores", "members", "long_records", "audit_events"]
_TEXT = {
    "line": _SQL_LINE,
    "wide_records": _SQL_WIDE,
    "scores": _SQL_SCORES,
    "members": _SQL_MEMBERS,
    "long_records": _SQL_LONG,
    "audit_events": _SQL_AUDIT,
}
_DEPS = {
    "line": [],
    "wide_records": ["line"],
    "scores": ["wide_records"],
    "members": ["wide_records"],
    "long_records": ["wide_records"],
    "audit_events": [],
}


def sql_with(*views: str, extra: list[str] | None = None) -> str:
    """``WITH`` prefix defining the named fixture views (and their dependencies) plus extra CTEs."""
    need: set[str] = set()

    def add(v):
        if v in need:
            return
        for d in _DEPS[v]:
            add(d)
        need.add(v)

    for v in views:
        add(v)
    parts = [_TEXT[v] for v in _ORDER if v in need] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
