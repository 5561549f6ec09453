"""Audit-event analytics over an event table.

Events: event_id, timestamp_utc, event_type, category, outcome, user_email,
resource_id, duration_ms, details_json.  Everything is a filter, projection
or grouped aggregate except the tamper-evident hash chain, which is serial by
definition and is therefore cut into linked segments of a fixed number of
events, chained in parallel by ``applyInPandas``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import r6
from ..functions.ranking import cumulative, previous_in_order
from ..functions.vectors import text_udf

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
ALLOWED_CATEGORIES = ["authentication", "session", "wafer_access", "search", "filter", "export", "navigation",
                      "governance", "system"]
ALLOWED_OUTCOMES = ["success", "failure", "denied", "warning", "information"]
SENSITIVE_KEYS = ["password", "password_hash", "token", "access_token", "refresh_token", "api_key", "secret",
                  "client_secret", "authorization"]
REDACTED = "[REDACTED]"
SESSION_TIMEOUT_MINUTES = 30
FAILED_OUTCOMES = ["failure", "denied"]
UNKNOWN_USER = "Unknown user"
GENESIS = "0" * 64
CHAIN_SEGMENT = 1000


def _clean(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when((t == "") | t.isNull(), F.lit(None).cast("string")).otherwise(t)


def normalise_events(ev: DataFrame) -> DataFrame:
    """Lower/trim category, outcome and e-mail, empty -> NULL, validity flag and rejection reason."""
    cat, out, mail = _clean(F.col("category")), _clean(F.col("outcome")), _clean(F.col("user_email"))
    ok_cat = cat.isin(*ALLOWED_CATEGORIES)
    ok_out = out.isin(*ALLOWED_OUTCOMES)
    reason = F.concat_ws("; ", F.when(~F.coalesce(ok_cat, F.lit(False)), F.lit("category not allowed")),
                         F.when(~F.coalesce(ok_out, F.lit(False)), F.lit("outcome not allowed")))
    return ev.select(
        "event_id", "timestamp_utc", F.trim(F.col("event_type")).alias("event_type"), cat.alias("category"),
        out.alias("outcome"), mail.alias("user_email"), "resource_id", "duration_ms", "details_json",
        (F.coalesce(ok_cat, F.lit(False)) & F.coalesce(ok_out, F.lit(False))).alias("is_valid"),
        F.when(reason == "", F.lit(None).cast("string")).otherwise(reason).alias("rejection_reason"),
    )


_KEY = '"(' + "|".join(SENSITIVE_KEYS) + ')"\\s*:\\s*'
SENSITIVE_PATTERN = "(?i)" + _KEY + '("(?:[^"\\\\]|\\\\.)*"|-?[0-9.eE+-]+|true|false|null)'
NESTED_PATTERN = "(?i)" + _KEY + "[\\[{]"


def redact_nested(text: str) -> str:
    """``text`` with the object or array behind every sensitive key replaced; a value that does not end takes the rest."""
    import json
    import re

    out, at = [], 0
    for m in re.finditer(NESTED_PATTERN, text):
        if m.start() < at:
            continue
        try:
            end = json.JSONDecoder().raw_decode(text, m.end() - 1)[1]
        except ValueError:
            end = len(text)
        out.append(f'{text[at:m.start()]}"{m[1]}": "{REDACTED}"')
        at = end
    return "".join(out) + text[at:]


def redact_details(ev: DataFrame, col: str = "details_json") -> DataFrame:
    """Replace the value of every sensitive key (any case, any nesting depth, any kind of value) by a fixed marker.

    Scalar values are replaced by one pattern in the JVM; only texts with an object or array behind a sensitive key are
    handed to Python, which knows where such a value ends."""

    hard = F.col(col).rlike(NESTED_PATTERN)
    plain = F.when(hard, text_udf(redact_nested)(F.when(hard, F.col(col)))).otherwise(F.col(col))
    red = F.regexp_replace(plain, SENSITIVE_PATTERN, f'"$1": "{REDACTED}"')
    return ev.select("event_id", red.alias(col), (red != F.col(col)).alias("was_redacted"))


def canonical_event(ev: DataFrame) -> Column:
    """Canonical text of an event: a JSON object of all fields in fixed order, nulls written (two events never share it)."""
    fields = ["event_id", "timestamp_utc", "event_type", "category", "outcome", "user_email", "resource_id",
              "duration_ms", "details_json"]
    return F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})


def hash_chain(ev: DataFrame, segment: int = CHAIN_SEGMENT) -> DataFrame:
    """event_hash = sha256(previous_hash || canonical event) along the log ordered by (time, id).

    The log is cut into segments of ``segment`` events, which are chained in parallel.  A segment starts from the digest of
    the event before it, so segments are linked although none waits for another; the first starts from the genesis hash.
    Positions come from the distributed running count, so no task holds more than a segment."""
    text = canonical_event(ev)
    base = ev.select(F.to_date("timestamp_utc").alias("chain_day"), "event_id", "timestamp_utc", text.alias("canonical"),
                     F.lit(1).cast("long").alias("_one"))
    placed = cumulative(base, [], ["timestamp_utc", "event_id"], ["_one"]).withColumn("position", F.col("cum__one") - 1)
    placed = placed.withColumn("segment", F.floor(F.col("position") / segment))
    heads = placed.where(F.col("position") % segment == segment - 1).select(
        (F.col("segment") + 1).alias("_next"), F.sha2("canonical", 256).alias("link"))
    rows = placed.join(heads, F.col("segment") == F.col("_next"), "left").select(
        "chain_day", "event_id", "timestamp_utc", "canonical", "position", "segment", "link")

    def chain(pdf):
        import hashlib

        pdf = pdf.sort_values("position")
        link = pdf["link"].iloc[0]
        prev = hashlib.sha256((GENESIS + link).encode("utf-8")).hexdigest() if isinstance(link, str) else GENESIS
        prevs, hashes = [], []
        for text in pdf["canonical"]:
            prevs.append(prev)
            prev = hashlib.sha256((prev + text).encode("utf-8")).hexdigest()
            hashes.append(prev)
        pdf["previous_event_hash"] = prevs
        pdf["event_hash"] = hashes
        return pdf[["chain_day", "event_id", "timestamp_utc", "position", "previous_event_hash", "event_hash"]]

    return rows.groupBy("segment").applyInPandas(
        chain, "chain_day date, event_id string, timestamp_utc timestamp_ntz, position long, previous_event_hash string, "
               "event_hash string")


def verify_chain(ev: DataFrame, chained: DataFrame, segment: int = CHAIN_SEGMENT, expected_events: int | None = None) -> DataFrame:
    """One row per chain day with the number of broken events and the first one; row-parallel given the stored hashes.

    An event is broken if either table lacks it, if its text does not give its hash, if its previous hash is not that of the
    event before (for the first of a segment: not made from that event's digest), or if positions have a gap before
    it, as when a day was removed.  A removed tail leaves no trace in the rows: with ``expected_events``, the stored number
    of events, the last event is broken if the number differs."""
    now = ev.select(F.col("event_id").alias("_id"), F.col("timestamp_utc").alias("_ts"), canonical_event(ev).alias("canonical"))
    both = chained.join(now, F.col("event_id") == F.col("_id"), "full")
    gone = both.where(F.col("position").isNull()).select(
        F.to_date("_ts").alias("chain_day"), F.col("_ts").alias("timestamp_utc"), F.col("_id").alias("event_id"), F.lit(True).alias("bad"))
    held = both.where(F.col("position").isNotNull()).withColumn("digest", F.sha2("canonical", 256))
    held = previous_in_order(held.drop("_id", "_ts"), [], ["position"], ["position", "event_hash", "digest"])
    first = F.col("position") % segment == 0
    before = (F.when(F.col("position") == 0, F.lit(GENESIS))
              .when(first, F.sha2(F.concat(F.lit(GENESIS), F.col("prev_digest")), 256)).otherwise(F.col("prev_event_hash")))
    good = ((F.col("previous_event_hash") == before)
            & (F.sha2(F.concat(F.col("previous_event_hash"), F.col("canonical")), 256) == F.col("event_hash"))
            & ((F.col("position") == 0) | (F.col("prev_position") == F.col("position") - 1)))
    if expected_events is not None:
        total, last = chained.agg(F.count(F.lit(1)), F.max("position")).first()
        good = good & (F.lit(total == expected_events) | (F.col("position") != F.lit(last)))
    held = held.select("chain_day", "timestamp_utc", "event_id", (~F.coalesce(good, F.lit(False))).alias("bad"))
    return held.unionByName(gone).groupBy("chain_day").agg(
        F.count(F.lit(1)).alias("events"),
        F.count(F.when(F.col("bad"), 1)).alias("broken_events"),
        F.min(F.when(F.col("bad"), F.struct("timestamp_utc", "event_id"))).getField("event_id").alias("first_broken_event"),
    ).select("*", (F.col("broken_events") == 0).alias("chain_valid"))


def filter_events(ev: DataFrame, start=None, end=None, user_email=None, category=None, event_type=None,
                  outcome=None, resource_id=None, limit: int | None = 500) -> DataFrame:
    """Optional predicates (pushed to the scan), newest first, optional row limit (the feature's page size)."""
    cond = F.lit(True)
    for col, val in (("user_email", user_email), ("category", category), ("event_type", event_type),
                     ("outcome", outcome), ("resource_id", resource_id)):
        if val is not None:
            cond = cond & (F.col(col) == val)
    if start is not None:
        cond = cond & (F.col("timestamp_utc") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (F.col("timestamp_utc") <= F.lit(end).cast("timestamp_ntz"))
    out = ev.where(cond).orderBy(F.desc("timestamp_utc"), F.desc("event_id"))
    return out.limit(limit) if limit else out


def _us(col: str) -> Column:
    """Microseconds since the epoch of a (zone-less, UTC) timestamp column."""
    return F.unix_micros(F.col(col).cast("timestamp"))


def sessions(ev: DataFrame, timeout_minutes: int = SESSION_TIMEOUT_MINUTES) -> DataFrame:
    """Fold each user's events into sessions split by gaps longer than the timeout (gaps and islands).

    The previous event per user comes from the distributed ordered lag and the session number from the
    distributed prefix sum, so a user with a third of all events is still spread over many tasks."""
    from ..functions.ranking import cumulative, previous_in_order

    u = ev.where(F.col("user_email").isNotNull()).select("user_email", "event_id", "timestamp_utc",
                                                         _us("timestamp_utc").alias("_t"))
    p = previous_in_order(u, ["user_email"], ["_t", "event_id"], ["_t"])
    starts = p.select("user_email", "event_id", "timestamp_utc", "_t",
                      F.when(F.col("prev__t").isNull() | ((F.col("_t") - F.col("prev__t")) > timeout_minutes * 60 * 1_000_000),
                             1).otherwise(0).alias("_start"))
    numbered = cumulative(starts, ["user_email"], ["_t", "event_id"], ["_start"], bounded_keys=False)
    return numbered.groupBy("user_email", F.col("cum__start").alias("session_no")).agg(
        F.min("timestamp_utc").alias("started_utc"), F.max("timestamp_utc").alias("last_activity_utc"),
        F.count(F.lit(1)).alias("events"),
    ).select(
        F.concat_ws("#", "user_email", F.col("session_no").cast("string")).alias("session_id"),
        "user_email", "started_utc", "last_activity_utc", "events",
        ((_us("last_activity_utc") - _us("started_utc")) / 1e6).alias("duration_seconds"),
    )


def session_analytics(ev: DataFrame, timeout_minutes: int = SESSION_TIMEOUT_MINUTES) -> DataFrame:
    s = sessions(ev, timeout_minutes)
    as_of = ev.agg(F.max("timestamp_utc").alias("_now"))
    t = s.crossJoin(F.broadcast(as_of))  # one-row table
    active = (_us("_now") - _us("last_activity_utc")) <= timeout_minutes * 60 * 1_000_000
    return t.select("session_id", "user_email", "started_utc", "last_activity_utc", "events", "duration_seconds",
                    r6(F.col("duration_seconds") / 60.0).alias("duration_minutes"),
                    F.when(active, "Active").otherwise("Ended").alias("status")).drop("_now")


def event_summary(ev: DataFrame, days: int = 30, timeout_minutes: int = SESSION_TIMEOUT_MINUTES) -> DataFrame:
    """Totals over the last ``days`` days before the latest event."""
    now = ev.agg(F.max("timestamp_utc").alias("_now"))
    recent = ev.crossJoin(F.broadcast(now)).where(
        F.col("timestamp_utc") >= F.col("_now") - F.expr(f"INTERVAL {int(days)} DAYS")).drop("_now")
    s = sessions(recent, timeout_minutes).agg(F.count(F.lit(1)).alias("sessions"),
                                              F.avg("duration_seconds").alias("_dur"))
    a = recent.agg(
        F.count(F.lit(1)).alias("total_events"), F.countDistinct("user_email").alias("unique_users"),
        F.count(F.when(F.col("outcome").isin(*FAILED_OUTCOMES), 1)).alias("failed_events"),
        F.count(F.when(F.col("category") == "wafer_access", 1)).alias("wafer_views"),
        F.count(F.when(F.col("category") == "export", 1)).alias("exports"),
        F.count(F.when(F.col("category") == "search", 1)).alias("searches"),
    )
    return a.crossJoin(s).select(F.lit(days).alias("period_days"), "total_events", "unique_users", "failed_events",
                                 "wafer_views", "exports", "searches", "sessions",
                                 r6(F.col("_dur") / 60.0).alias("mean_session_minutes"))


def retention(ev: DataFrame, retention_days: int = 365) -> DataFrame:
    """Events kept by the retention rule (younger than N days before the latest event)."""
    now = ev.agg(F.max("timestamp_utc").alias("_now"))
    return ev.crossJoin(F.broadcast(now)).where(
        F.col("timestamp_utc") >= F.col("_now") - F.expr(f"INTERVAL {int(retention_days)} DAYS")).drop("_now")


def login_timeline(ev: DataFrame) -> DataFrame:
    """Per day: successful vs failed/denied authentication events, zero-filled over the day range."""
    auth = ev.where(F.col("category") == "authentication").select(
        F.to_date("timestamp_utc").alias("day"), "outcome")
    c = auth.groupBy("day").agg(
        F.count(F.when(F.col("outcome") == "success", 1)).alias("successful_logins"),
        F.count(F.when(F.col("outcome").isin(*FAILED_OUTCOMES), 1)).alias("failed_logins"),
    )
    rng = ev.agg(F.to_date(F.min("timestamp_utc")).alias("d0"), F.to_date(F.max("timestamp_utc")).alias("d1"))
    days = rng.select(F.explode(F.sequence("d0", "d1")).alias("day"))
    t = days.join(c, "day", "left")
    return t.select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                    F.coalesce("successful_logins", F.lit(0)).cast("bigint").alias("successful_logins"),
                    F.coalesce("failed_logins", F.lit(0)).cast("bigint").alias("failed_logins"))


def failed_logins(ev: DataFrame) -> DataFrame:
    return ev.where((F.col("category") == "authentication") & F.col("outcome").isin(*FAILED_OUTCOMES)).select(
        "event_id", "timestamp_utc", F.coalesce("user_email", F.lit(UNKNOWN_USER)).alias("user_email"),
        "event_type", "outcome", "resource_id")


def export_history(ev: DataFrame) -> DataFrame:
    """Export events with format, record count and file name from the JSON details, with defaults."""
    d = F.col("details_json")
    j = lambda p: F.get_json_object(d, p)
    return ev.where(F.col("category") == "export").select(
        "event_id", "timestamp_utc", F.coalesce("user_email", F.lit(UNKNOWN_USER)).alias("user_email"),
        "resource_id",
        F.coalesce(j("$.format"), j("$.export_format"), F.lit("unknown")).alias("export_format"),
        F.coalesce(j("$.record_count").cast("bigint"), j("$.rows").cast("bigint"), F.lit(0).cast("bigint")).alias(
            "record_count"),
        F.coalesce(j("$.file_name"), j("$.filename"), F.lit("unknown")).alias("file_name"),
    )


def resource_access(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("category") == "wafer_access").groupBy("resource_id").agg(
        F.count(F.lit(1)).alias("views"), F.countDistinct("user_email").alias("distinct_users"),
        F.max("timestamp_utc").alias("last_access_utc"),
    )


def user_activity(ev: DataFrame, categories: Sequence[str] = tuple(ALLOWED_CATEGORIES)) -> DataFrame:
    u = F.coalesce("user_email", F.lit(UNKNOWN_USER))
    aggs = [F.count(F.lit(1)).alias("total_events")]
    aggs += [F.count(F.when(F.col("category") == c, 1)).alias(f"{c}_events") for c in categories]
    aggs += [F.count(F.when(F.col("outcome") == o, 1)).alias(f"{o}_events") for o in ALLOWED_OUTCOMES]
    aggs += [F.min("timestamp_utc").alias("first_event_utc"), F.max("timestamp_utc").alias("last_event_utc")]
    return ev.groupBy(u.alias("user_email")).agg(*aggs)
