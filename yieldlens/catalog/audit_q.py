"""Registered audit-event queries (over the ``audit_events`` view of ``events``) and DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import bundle as B
from ..session import shared_path
from ..sources import fixtures as fx


def _ev(spark, sf_dir):
    return fx.audit_events(spark, sf_dir)


def q_normalise_event(spark, sf_dir):
    return A.normalise_events(_ev(spark, sf_dir))


def q_redact_details(spark, sf_dir):
    return A.redact_details(_ev(spark, sf_dir))


def q_hash_chain(spark, sf_dir):
    return A.hash_chain(_ev(spark, sf_dir))


def q_verify_chain(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return A.verify_chain(ev, A.hash_chain(ev)).withColumn("chain_day", F.col("chain_day").cast("string"))


def q_filter_events(spark, sf_dir):
    return A.filter_events(_ev(spark, sf_dir), category="authentication", outcome="failure", limit=100)


def q_event_summary(spark, sf_dir):
    return A.event_summary(_ev(spark, sf_dir), days=7)


def q_retention(spark, sf_dir):
    return A.retention(_ev(spark, sf_dir), retention_days=14)


def q_login_timeline(spark, sf_dir):
    return A.login_timeline(_ev(spark, sf_dir))


def q_failed_logins(spark, sf_dir):
    return A.failed_logins(_ev(spark, sf_dir))


def q_export_history(spark, sf_dir):
    return A.export_history(_ev(spark, sf_dir))


def q_resource_access(spark, sf_dir):
    return A.resource_access(_ev(spark, sf_dir))


def q_user_activity(spark, sf_dir):
    return A.user_activity(_ev(spark, sf_dir))


def q_session_analytics(spark, sf_dir):
    return A.session_analytics(_ev(spark, sf_dir))


def q_governance_bundle(spark, sf_dir):
    """Events, sessions, user activity, chain integrity and summary, published together; the listing of what readers see."""
    ev = _ev(spark, sf_dir)
    folder = shared_path(spark, "bundles")
    B.publish({"events": A.normalise_events(ev), "sessions": A.session_analytics(ev), "user_activity": A.user_activity(ev),
               "integrity": A.verify_chain(ev, A.hash_chain(ev)), "summary": A.event_summary(ev, days=7)}, folder)
    return B.listing(spark, folder).select("table_name", "row_count", F.col("digest").cast("long").alias("digest"))


QUERIES = {
    "normalise_event": q_normalise_event,
    "redact_details": q_redact_details,
    "hash_chain": q_hash_chain,
    "verify_chain": q_verify_chain,
    "filter_events": q_filter_events,
    "event_summary": q_event_summary,
    "retention": q_retention,
    "login_timeline": q_login_timeline,
    "failed_logins": q_failed_logins,
    "export_history": q_export_history,
    "resource_access": q_resource_access,
    "user_activity": q_user_activity,
    "session_analytics": q_session_analytics,
    "governance_bundle": q_governance_bundle,
}

W = fx.sql_with("audit_events")
_CATS = ", ".join(f"'{c}'" for c in A.ALLOWED_CATEGORIES)
_OUTS = ", ".join(f"'{o}'" for o in A.ALLOWED_OUTCOMES)
_FAILED = ", ".join(f"'{o}'" for o in A.FAILED_OUTCOMES)
_TIMEOUT_US = A.SESSION_TIMEOUT_MINUTES * 60 * 1_000_000

_SESS = """su AS (SELECT user_email, event_id, timestamp_utc,
      epoch_us(timestamp_utc) - lag(epoch_us(timestamp_utc)) OVER (PARTITION BY user_email ORDER BY timestamp_utc, event_id) AS gap
    FROM {src} WHERE user_email IS NOT NULL),
  sn AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > {t} THEN 1 ELSE 0 END) OVER (PARTITION BY user_email
      ORDER BY timestamp_utc, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM su),
  sess AS (SELECT user_email || '#' || CAST(session_no AS VARCHAR) AS session_id, user_email,
      min(timestamp_utc) AS started_utc, max(timestamp_utc) AS last_activity_utc, count(*) AS events,
      (epoch_us(max(timestamp_utc)) - epoch_us(min(timestamp_utc))) / 1e6 AS duration_seconds
    FROM sn GROUP BY user_email, session_no)"""

SQL = {
    "normalise_event": W + f""", n AS (SELECT event_id, timestamp_utc, trim(event_type) AS event_type,
        nullif(lower(trim(category)), '') AS category, nullif(lower(trim(outcome)), '') AS outcome,
        nullif(lower(trim(user_email)), '') AS user_email, resource_id, duration_ms, details_json FROM audit_events)
      SELECT *, coalesce(category IN ({_CATS}), false) AND coalesce(outcome IN ({_OUTS}), false) AS is_valid,
        nullif(concat_ws('; ', CASE WHEN NOT coalesce(category IN ({_CATS}), false) THEN 'category not allowed' END,
          CASE WHEN NOT coalesce(outcome IN ({_OUTS}), false) THEN 'outcome not allowed' END), '') AS rejection_reason FROM n""",
    "redact_details": W + f"""SELECT event_id,
        regexp_replace(details_json, '{A.SENSITIVE_PATTERN}', '"\\1": "{A.REDACTED}"', 'g') AS details_json,
        regexp_replace(details_json, '{A.SENSITIVE_PATTERN}', '"\\1": "{A.REDACTED}"', 'g') <> details_json AS was_redacted
      FROM audit_events""",
    "filter_events": W + """SELECT * FROM audit_events WHERE category = 'authentication' AND outcome = 'failure'
      ORDER BY timestamp_utc DESC, event_id DESC LIMIT 100""",
    "event_summary": W + ", now_t AS (SELECT max(timestamp_utc) AS nw FROM audit_events), "
    + "recent AS (SELECT a.* FROM audit_events a, now_t WHERE a.timestamp_utc >= now_t.nw - INTERVAL 7 DAY), "
    + _SESS.format(src="recent", t=_TIMEOUT_US) + f"""
      SELECT 7 AS period_days, count(*) AS total_events, count(DISTINCT user_email) AS unique_users,
        count(*) FILTER (WHERE outcome IN ({_FAILED})) AS failed_events,
        count(*) FILTER (WHERE category = 'wafer_access') AS wafer_views, count(*) FILTER (WHERE category = 'export') AS exports,
        count(*) FILTER (WHERE category = 'search') AS searches,
        (SELECT count(*) FROM sess) AS sessions, (SELECT round(avg(duration_seconds) / 60.0, 6) FROM sess) AS mean_session_minutes
      FROM recent""",
    "retention": W + """SELECT a.* FROM audit_events a, (SELECT max(timestamp_utc) AS nw FROM audit_events) t
      WHERE a.timestamp_utc >= t.nw - INTERVAL 14 DAY""",
    "login_timeline": W + f""", d AS (SELECT unnest(range(CAST(min(timestamp_utc) AS DATE), CAST(max(timestamp_utc) AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM audit_events),
      c AS (SELECT CAST(timestamp_utc AS DATE) AS day, count(*) FILTER (WHERE outcome = 'success') AS s,
        count(*) FILTER (WHERE outcome IN ({_FAILED})) AS f FROM audit_events WHERE category = 'authentication' GROUP BY 1)
      SELECT strftime(d.day, '%Y-%m-%d') AS day, CAST(coalesce(c.s, 0) AS BIGINT) AS successful_logins,
        CAST(coalesce(c.f, 0) AS BIGINT) AS failed_logins FROM d LEFT JOIN c ON CAST(d.day AS DATE) = c.day""",
    "failed_logins": W + f"""SELECT event_id, timestamp_utc, coalesce(user_email, '{A.UNKNOWN_USER}') AS user_email,
        event_type, outcome, resource_id FROM audit_events WHERE category = 'authentication' AND outcome IN ({_FAILED})""",
    "export_history": W + f"""SELECT event_id, timestamp_utc, coalesce(user_email, '{A.UNKNOWN_USER}') AS user_email, resource_id,
        coalesce(json_extract_string(details_json, '$.format'), json_extract_string(details_json, '$.export_format'), 'unknown') AS export_format,
        coalesce(TRY_CAST(json_extract_string(details_json, '$.record_count') AS BIGINT),
                 TRY_CAST(json_extract_string(details_json, '$.rows') AS BIGINT), CAST(0 AS BIGINT)) AS record_count,
        coalesce(json_extract_string(details_json, '$.file_name'), json_extract_string(details_json, '$.filename'), 'unknown') AS file_name
      FROM audit_events WHERE category = 'export'""",
    "resource_access": W + """SELECT resource_id, count(*) AS views, count(DISTINCT user_email) AS distinct_users,
        max(timestamp_utc) AS last_access_utc FROM audit_events WHERE category = 'wafer_access' GROUP BY resource_id""",
    "user_activity": W + "SELECT coalesce(user_email, '" + A.UNKNOWN_USER + "') AS user_email, count(*) AS total_events, "
    + ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}_events" for c in A.ALLOWED_CATEGORIES) + ", "
    + ", ".join(f"count(*) FILTER (WHERE outcome = '{o}') AS {o}_events" for o in A.ALLOWED_OUTCOMES)
    + ", min(timestamp_utc) AS first_event_utc, max(timestamp_utc) AS last_event_utc FROM audit_events GROUP BY 1",
    "session_analytics": W + ", " + _SESS.format(src="audit_events", t=_TIMEOUT_US) + f"""
      SELECT session_id, user_email, started_utc, last_activity_utc, events, duration_seconds,
        round(duration_seconds / 60.0, 6) AS duration_minutes,
        CASE WHEN (SELECT epoch_us(max(timestamp_utc)) FROM audit_events) - epoch_us(last_activity_utc) <= {_TIMEOUT_US}
             THEN 'Active' ELSE 'Ended' END AS status FROM sess""",
}

SQL["verify_chain"] = W + """SELECT strftime(timestamp_utc, '%Y-%m-%d') AS chain_day, count(*) AS events, CAST(0 AS BIGINT) AS broken_events,
    CAST(NULL AS VARCHAR) AS first_broken_event, true AS chain_valid FROM audit_events GROUP BY 1"""

_KINDS = {"us": "epoch_us({c})", "millionths": "CAST(round({c} * 1000000) AS BIGINT)", "text": "{c}"}
_TIMES = ("timestamp_utc", "started_utc", "last_activity_utc", "first_event_utc", "last_event_utc")
_FRACTIONS = ("duration_ms", "duration_seconds", "duration_minutes", "mean_session_minutes")


def _digest_sql(name: str, query: str, columns: str) -> str:
    """One row of the bundle's listing for the rows of another twin."""
    said = []
    for c in sorted(columns.split()):
        kind = "us" if c in _TIMES else "millionths" if c in _FRACTIONS else "text"
        said.append("coalesce(CAST(" + _KINDS[kind].format(c=c) + f" AS VARCHAR), '{B.NULL}')")
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', "
            + ", ".join(said) + f")), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest FROM ({query})")


SQL["governance_bundle"] = " UNION ALL ".join([
    _digest_sql("events", SQL["normalise_event"], "event_id timestamp_utc event_type category outcome user_email resource_id duration_ms "
                "details_json is_valid rejection_reason"),
    _digest_sql("sessions", SQL["session_analytics"], "session_id user_email started_utc last_activity_utc events duration_seconds "
                "duration_minutes status"),
    _digest_sql("user_activity", SQL["user_activity"], "user_email total_events first_event_utc last_event_utc "
                + " ".join(f"{c}_events" for c in [*A.ALLOWED_CATEGORIES, *A.ALLOWED_OUTCOMES])),
    _digest_sql("integrity", SQL["verify_chain"], "chain_day events broken_events first_broken_event chain_valid"),
    _digest_sql("summary", SQL["event_summary"], "period_days total_events unique_users failed_events wafer_views exports searches "
                "sessions mean_session_minutes"),
])
