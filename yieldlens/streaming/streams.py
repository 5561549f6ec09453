"""Structured Streaming versions of the continuous behaviours.

Every stream reads a file source (the given Parquet tables), runs with
``trigger(availableNow=True)`` so a replay is bounded, keeps its checkpoint
and its sink under the shared checkpoint folder, and returns the sink as a
DataFrame.  Stateful operators use event-time watermarks so state is bounded:
rows later than the watermark are dropped.  Sinks are written through
``foreachBatch``, one folder for each batch, and readers keep the last version of every
key, so a restarted micro-batch (executor loss) rewrites its folder and never duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import r6
from ..session import cut_lineage, shared_path

WATERMARK = "2 hours"
SESSION_GAP = "30 minutes"
LOCKOUT_FAILURES = 5
LOCKOUT_MINUTES = 15


def _dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    base = shared_path(spark, f"streams/{name}")
    return f"{base}/checkpoint", f"{base}/sink"


def _status(spark: SparkSession, path: str):
    """(exists, is a folder) of a path in any store Spark reads."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (True, fs.getFileStatus(jpath).isDirectory()) if fs.exists(jpath) else (False, False)


def source(spark: SparkSession, sf_dir: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """A streaming file source over one of the given Parquet tables, a folder of part files or a single file
    (schema taken from the batch read); by default one trigger takes all files there are."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    if _status(spark, path)[1]:
        return stream.parquet(path)
    # a file stream watches a folder: watch the data folder, admit only this table's file
    return stream.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def batch_sink(spark: SparkSession, sink: str):
    """A ``foreachBatch`` writer: each micro-batch has a folder of its own, so a retried batch overwrites its rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return write


def read_sink(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """All batches of a sink with their ``batch`` id; a replay without batches has no rows, any other failure raises."""
    if not _status(spark, sink)[0]:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
    return spark.read.parquet(sink)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, keys: list[str] | None = None,
                 mode: str = "update") -> DataFrame:
    """Run ``stream`` to completion over the available input; return what it wrote.

    With ``keys`` the reader keeps the row of the latest batch per key (update-mode upsert semantics)."""
    ckpt, sink = _dirs(spark, name)
    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", ckpt).foreachBatch(batch_sink(spark, sink))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = read_sink(spark, sink, stream.schema)
    if keys:
        rest = [c for c in out.columns if c not in (*keys, "batch")]
        out = out.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("_last")).select(
            *keys, *[F.col(f"_last.{c}").alias(c) for c in rest])
        return out.select(*stream.columns)
    return out.drop("batch")


def _events(spark, sf_dir):
    e = source(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def window_profile(spark: SparkSession, sf_dir: str, width: str = "1 hour") -> DataFrame:
    """Tumbling-window count / mean / std / missing rate of the event value, with a watermark."""
    e = _events(spark, sf_dir).withWatermark("ts", WATERMARK)
    agg = e.groupBy(F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.avg("value").alias("mean_value"), F.stddev_samp("value").alias("std_value"),
        F.avg(F.col("value").isNull().cast("int")).alias("missing_rate"))
    out = run_to_table(spark, agg.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "events",
                                         "mean_value", "std_value", "missing_rate"), "window_profile", ["window_start"])
    return out.select("window_start", "events", r6(F.col("mean_value")).alias("mean_value"),
                      r6(F.col("std_value")).alias("std_value"), r6(F.col("missing_rate")).alias("missing_rate"))


def sliding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-day windows sliding every 6 hours: events, failures (error events) and failure rate."""
    e = _events(spark, sf_dir).withWatermark("ts", "1 day")
    agg = e.groupBy(F.window("ts", "1 day", "6 hours").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("event_type") == "error", 1)).alias("failures"))
    out = run_to_table(spark, agg.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "events",
                                         "failures"), "sliding_rate", ["window_start"])
    return out.select("window_start", "events", "failures", r6(F.col("failures") / F.col("events")).alias("failure_rate"))


def sessions(spark: SparkSession, sf_dir: str, close_open: bool = True) -> DataFrame:
    """Session windows per user with a 30-minute gap (gaps and islands in event time).

    Append mode emits a session once the watermark passes its end.  At the end of a replay, ``close_open`` adds the
    sessions still in state, read from the static table."""
    def rows(e):
        agg = e.groupBy("user_id", F.session_window("ts", SESSION_GAP).alias("s")).agg(F.count(F.lit(1)).alias("events"))
        return agg.select("user_id", F.date_format("s.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"),
                          F.date_format("s.end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_end"), "events")

    out = run_to_table(spark, rows(_events(spark, sf_dir).withWatermark("ts", WATERMARK)), "sessions",
                       ["user_id", "session_start"], mode="append")
    if not close_open:
        return out
    static = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # written first: the optimizer would move the anti join below the session aggregate, before sessions are merged
    closing = cut_lineage(rows(static)).join(out.select("user_id", "session_start"), ["user_id", "session_start"], "left_anti")
    return out.unionByName(closing)


def decide(spark: SparkSession, sf_dir: str, lower: float = 0.035, upper: float = 0.08) -> DataFrame:
    """Stateless scoring of the order stream into three-way decisions (thresholds as literals)."""
    from ..operators.policy import assign_decision

    o = source(spark, sf_dir, "orders")
    fail = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    t = o.select(F.concat(F.lit("R-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("record_id"),
                 F.when(fail, 1).otherwise(0).alias("target"), "o_orderkey", "o_custkey")
    p = (((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729) % 10007 + 4000 * F.col("target")).cast("double") / 14006)
    s = t.select("record_id", "target", p.alias("probability"))
    d = s.select("record_id", "target", r6(F.col("probability")).alias("calibrated_failure_probability"),
                 assign_decision(F.col("probability"), lower, upper).alias("operational_decision"))
    return run_to_table(spark, d, "decide", mode="append")


def alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per (user, event type, day): ids are sha256-derived and deduplicated within the watermark."""
    e = _events(spark, sf_dir).where(F.col("event_type") == "error").withWatermark("ts", "1 day")
    day = F.date_format("ts", "yyyy-MM-dd")
    a = e.select(F.substring(F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), "event_type", day), 256), 1, 20)
                 .alias("alert_id"), "user_id", "event_type", day.alias("alert_day"), "ts")
    d = a.dropDuplicatesWithinWatermark(["alert_id"]).select("alert_id", "user_id", "event_type", "alert_day")
    return run_to_table(spark, d, "alert_dedupe", ["alert_id"], mode="append")


def drift(spark: SparkSession, sf_dir: str, bins: int = 10, eps: float = 1e-8, width: str = "1 day",
          files_per_trigger: int | None = None) -> DataFrame:
    """PSI of the event value in each event-time window against fixed reference edges (the first half of the period).

    The state is a count for each (window, bin), merged over micro-batches, so the rows depend on the events and not on
    how files or triggers cut them.  No watermark: a replay may bring any window's events late, and the state is only
    ``bins`` numbers a window.  Reference edges and counts (``bins`` numbers) come once from the static table."""
    from ..functions.ranking import exact_quantiles

    path = f"{sf_dir.rstrip('/')}/events.parquet"
    static = spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    mid = static.agg(((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2).alias("m")).first()["m"]
    ref = static.where((F.unix_micros("ts") < mid) & F.col("value").isNotNull())
    q = exact_quantiles(ref.select("value"), [], "value", [j / bins for j in range(bins + 1)])
    inner = sorted({float(r["quantile"]) for r in q.collect()})[1:-1]
    edges = F.array(*[F.lit(x) for x in inner]) if inner else F.array().cast("array<double>")
    at = F.size(F.filter(edges, lambda e: e <= F.col("value"))).alias("bin")
    ref_counts = [0] * (len(inner) + 1)
    for r in ref.select(at).groupBy("bin").count().collect():
        ref_counts[r["bin"]] = r["count"]
    share = [max(c / (sum(ref_counts) or 1), eps) for c in ref_counts]
    share = [x / sum(share) for x in share]

    events = source(spark, sf_dir, "events", files_per_trigger).withColumn("ts", F.col("ts").cast("timestamp")).where(F.col("value").isNotNull())
    counts = events.groupBy(F.window("ts", width).alias("w"), at).agg(F.count(F.lit(1)).alias("n"))
    held = run_to_table(spark, counts.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "bin", "n"),
                        "stream_drift", ["window_start", "bin"])
    wide = held.groupBy("window_start").agg(F.sum("n").alias("events"), *[
        F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(share))])
    current = [F.greatest(F.col(f"n{i}") / F.col("events"), F.lit(eps)) for i in range(len(share))]
    total = sum(current[1:], current[0])
    parts = [(c / total - F.lit(r)) * F.log(c / total / F.lit(r)) for r, c in zip(share, current)]
    return wide.select("window_start", "events", r6(F.greatest(sum(parts[1:], parts[0]), F.lit(0.0))).alias("psi"))


STATE_DAYS = 1  # an idle user's state is dropped so long after the watermark


def lock_step(key, rows, failures: int, until, lock=None):
    """Locks of one user from (ts, is_error) rows in time order, and the state after them; ``lock`` is what a lock adds to a ts."""
    import datetime

    lock = datetime.timedelta(minutes=LOCKOUT_MINUTES) if lock is None else lock
    out = []
    for ts, error in rows:
        if until is not None and ts < until:
            continue
        failures = failures + 1 if error else 0
        if failures >= LOCKOUT_FAILURES:
            until = ts + lock
            out.append((key, ts, until, failures))
            failures = 0
    return out, failures, until


WALKED = "user_id long, locked_at long, locked_until long, failures int, seen long, state boolean"


def walk_locks(batches):
    """Locks and one state row for each user from rows sorted by user and time (user_id, at, error, failures, until), one Arrow batch
    at a time: only the current user's state is kept.  A user's first row may be the state before (``error`` is null)."""
    from itertools import groupby

    import pyarrow as pa

    schema = pa.schema([("user_id", pa.int64()), ("locked_at", pa.int64()), ("locked_until", pa.int64()), ("failures", pa.int32()),
                        ("seen", pa.int64()), ("state", pa.bool_())])
    minutes = LOCKOUT_MINUTES * 60_000_000
    user, failures, until, seen = None, 0, None, None  # seen is null until the first row

    def emitted(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        users, at, error, had, locked = (c.to_pylist() for c in batch.columns)
        out = []
        for key, span in groupby(range(len(users)), key=users.__getitem__):
            span = list(span)
            if seen is not None and key != user:
                out.append((user, None, until, failures, seen, True))
                failures, until, seen = 0, None, None
            user = key
            if error[span[0]] is None:
                failures, until = had[span[0]], locked[span[0]]
            locks, failures, until = lock_step(key, ((at[i], error[i]) for i in span if error[i] is not None), failures, until, minutes)
            out += [(*row, None, False) for row in locks]
            seen = at[span[-1]] if seen is None else max(seen, at[span[-1]])  # a batch may bring older events
        if out:
            yield emitted(out)
    if seen is not None:
        yield emitted([(user, None, until, failures, seen, True)])


def lockout(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """N consecutive failed logins lock a user for M minutes.

    Failed login = an ``error`` event; any other event resets the count; failures while locked are ignored; events without a
    time are left out.  Spark sorts each micro-batch by user and time, behind the users' states of the batch before, and tasks walk
    the sorted rows by Arrow batches, so a user with most of the events needs no more memory than any other.  Locks and states
    are written together, in a folder for each batch, which a retried batch overwrites.  State without news for a
    day of event time past the watermark is dropped."""
    ckpt, sink = _dirs(spark, "lockout")
    idle = 1_000_000 * (STATE_DAYS * 86_400 + int(WATERMARK.split()[0]) * 3_600)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where("ts IS NOT NULL").select(
            F.col("user_id").cast("long").alias("user_id"), F.unix_micros("ts").alias("at"),
            F.coalesce(F.col("event_type") == "error", F.lit(False)).alias("error"),
            F.lit(None).cast("int").alias("failures"), F.lit(None).cast("long").alias("until"), "event_id", F.lit(1).alias("turn"))
        if batch_id:
            before = batch.sparkSession.read.parquet(f"{sink}/batch={batch_id - 1}").where("state")
            newest = before.agg(F.max("seen")).first()[0] or 0
            rows = rows.unionByName(before.where(F.col("seen") >= newest - idle).select(
                "user_id", F.col("seen").alias("at"), F.lit(None).cast("boolean").alias("error"), "failures",
                F.col("locked_until").alias("until"), F.lit(0).alias("turn")), allowMissingColumns=True)
        rows = rows.repartition("user_id").sortWithinPartitions("user_id", "turn", "at", "event_id")
        walked = rows.select("user_id", "at", "error", "failures", "until").mapInArrow(walk_locks, WALKED)
        walked.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    events = source(spark, sf_dir, "events", files_per_trigger).withColumn("ts", F.col("ts").cast("timestamp"))
    q = (events.select("user_id", "ts", "event_id", "event_type").writeStream.option("checkpointLocation", ckpt).foreachBatch(step)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    locks = read_sink(spark, sink, T._parse_datatype_string(WALKED)).where("not state")
    return locks.select("user_id", F.timestamp_micros("locked_at").alias("locked_at"),
                        F.timestamp_micros("locked_until").alias("locked_until"), "failures")


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_window_profile": window_profile,
    "stream_sliding_rate": sliding_rate,
    "stream_sessions": sessions,
    "stream_drift": drift,
    "stream_decide": decide,
    "stream_alert_dedupe": alert_dedupe,
    "stream_lockout": lockout,
}
