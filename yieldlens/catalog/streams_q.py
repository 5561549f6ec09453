"""Registered streaming queries (bounded availableNow replays) and DuckDB twins of their results."""

from __future__ import annotations

from ..streaming import streams as ST

QUERIES = dict(ST.STREAMS)

_GAP_US = 30 * 60 * 1_000_000
_LOCK_AFTER, _LOCK_MINUTES = ST.LOCKOUT_FAILURES, ST.LOCKOUT_MINUTES

SQL = {
    "stream_window_profile": """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        count(*) AS events, round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS std_value,
        round(avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END), 6) AS missing_rate FROM events GROUP BY 1""",
    "stream_sliding_rate": """WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS ws, event_type
        FROM events, (SELECT unnest(range(0, 4)) AS k))
      SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS events,
        count(*) FILTER (WHERE event_type = 'error') AS failures,
        round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS failure_rate FROM w GROUP BY ws""",
    "stream_sessions": f"""WITH g AS (SELECT user_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap
        FROM events),
      n AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= {_GAP_US} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM g)
      SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
        strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS events
      FROM n GROUP BY user_id, sn""",
    # one step of the recursion is one event of each user, in time order
    "stream_lockout": f"""WITH RECURSIVE e AS (SELECT user_id, ts, event_type = 'error' AS err,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
      s AS (SELECT user_id, ts, rn, CASE WHEN err THEN 1 ELSE 0 END AS streak, CAST(NULL AS TIMESTAMP) AS until, false AS locks
        FROM e WHERE rn = 1
        UNION ALL
        SELECT user_id, ts, rn, CASE WHEN locks THEN 0 ELSE streak END AS streak, until, locks FROM (
          SELECT user_id, ts, rn, streak, CASE WHEN streak >= {_LOCK_AFTER} THEN ts + INTERVAL {_LOCK_MINUTES} MINUTE ELSE until END AS until,
            streak >= {_LOCK_AFTER} AS locks FROM (
            SELECT e.user_id, e.ts, e.rn, s.until, CASE WHEN s.until IS NOT NULL AND e.ts < s.until THEN s.streak
              WHEN e.err THEN s.streak + 1 ELSE 0 END AS streak
            FROM s JOIN e ON e.user_id IS NOT DISTINCT FROM s.user_id AND e.rn = s.rn + 1)))
      SELECT user_id, ts AS locked_at, until AS locked_until, CAST({_LOCK_AFTER} AS INTEGER) AS failures FROM s WHERE locks""",
    "stream_decide": """WITH t AS (SELECT 'R-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS record_id,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS target, o_orderkey, o_custkey FROM orders),
      s AS (SELECT record_id, target, CAST((o_orderkey * 7919 + o_custkey * 104729) % 10007 + 4000 * target AS DOUBLE) / 14006 AS p FROM t)
      SELECT record_id, target, round(p, 6) AS calibrated_failure_probability,
        CASE WHEN p < 0.035 THEN 'Low Risk' WHEN p >= 0.08 THEN 'High Risk' ELSE 'Engineering Review' END AS operational_decision FROM s""",
    "stream_alert_dedupe": """SELECT DISTINCT substr(sha256(concat_ws('|', CAST(user_id AS VARCHAR), event_type, strftime(ts, '%Y-%m-%d'))), 1, 20) AS alert_id,
        user_id, event_type, strftime(ts, '%Y-%m-%d') AS alert_day FROM events WHERE event_type = 'error'""",
    "stream_drift": """WITH m AS (SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) / 2 AS mid FROM events),
      r AS (SELECT value FROM events, m WHERE epoch_us(ts) < mid AND value IS NOT NULL),
      e AS (SELECT list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS a FROM r),
      i AS (SELECT list_slice(a, 2, len(a) - 1) AS a FROM e),
      b AS (SELECT unnest(range(len(a) + 1)) AS b FROM i),
      x AS (SELECT len([y for y in a if y <= value]) AS b, count(*) AS n FROM r, i GROUP BY 1),
      z AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS w, len([y for y in a if y <= value]) AS b, count(*) AS n
        FROM events, i WHERE value IS NOT NULL GROUP BY 1, 2),
      t AS (SELECT w, sum(n) AS total FROM z GROUP BY w),
      p AS (SELECT t.w, t.total, greatest(coalesce(x.n, 0) / (SELECT sum(n) FROM x), 1e-8) AS pr,
        greatest(coalesce(z.n, 0) / t.total, 1e-8) AS pc FROM t CROSS JOIN b LEFT JOIN x USING (b) LEFT JOIN z ON z.w = t.w AND z.b = b.b),
      q AS (SELECT w, total, pr / sum(pr) OVER (PARTITION BY w) AS pr, pc / sum(pc) OVER (PARTITION BY w) AS pc FROM p)
      SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(max(total) AS BIGINT) AS events,
        round(greatest(0.0, sum((pc - pr) * ln(pc / pr))), 6) AS psi FROM q GROUP BY w""",
}
