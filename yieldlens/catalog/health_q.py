"""Registered monitoring queries: output/category drift, data quality, alerts, health; DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DriftConfig, HEALTH_BANDS, BAND_SEVERITY, SEVERITY_SCORE
from ..operators import drift as D
from ..operators import health as H
from ..operators import policy as PO
from ..sources import fixtures as fx
from . import drift_q as DQ
from . import sqlbits as S

CFG = DriftConfig()
RUN_ID = "monitoring-run"
LOWER, UPPER = 0.035, 0.08
OUT_METRICS = ["probability", "confidence", "uncertainty", "data_confidence"]


def _scored(spark, sf_dir):
    w = fx.wide_records(spark, sf_dir)
    s = fx.scores(spark, sf_dir).select("record_id", "probability", "confidence")
    return w.join(s, "record_id").withColumn("uncertainty", 1 - F.col("confidence")).withColumn(
        "decision", PO.assign_decision(F.col("probability"), LOWER, UPPER))


def _run(spark, sf_dir):
    from ..plans.monitoring_run import MonitoringRun
    from ..session import cut_lineage
    # one snapshot of the scored records per run, read by every stage
    return MonitoringRun(cut_lineage(_scored(spark, sf_dir)), fx.SENSORS, RUN_ID, OUT_METRICS, "decision", CFG)


def _parts(spark, sf_dir):
    r = _run(spark, sf_dir)
    return (r.records, r.feature_drift, r.feature_summary, r.output_drift, r.category_drift, r.data_quality,
            r.data_quality_summary)


def q_output_drift(spark, sf_dir):
    return H.output_drift(_scored(spark, sf_dir), OUT_METRICS, CFG)


def q_category_shares(spark, sf_dir):
    return H.category_shares(_scored(spark, sf_dir), "decision")


def q_category_drift(spark, sf_dir):
    return H.category_drift(_scored(spark, sf_dir), "decision", CFG)


def q_data_quality(spark, sf_dir):
    return H.data_quality(_scored(spark, sf_dir), fx.SENSORS)


def q_data_quality_summary(spark, sf_dir):
    return H.data_quality_summary(H.data_quality(_scored(spark, sf_dir), fx.SENSORS))


def q_prediction_summary(spark, sf_dir):
    sc = _scored(spark, sf_dir)
    return H.prediction_summary(H.output_drift(sc, OUT_METRICS, CFG), H.category_drift(sc, "decision", CFG))


def q_moment_shift(spark, sf_dir):
    fd = D.feature_drift(fx.wide_records(spark, sf_dir), fx.SENSORS, CFG)
    return fd.select("feature", "reference_mean", "current_mean", "absolute_mean_shift", "standardised_mean_shift",
                     "reference_std", "current_std", "standard_deviation_ratio", "reference_median", "current_median",
                     "absolute_median_shift")


def q_constant_change(spark, sf_dir):
    fd = D.feature_drift(fx.wide_records(spark, sf_dir), fx.SENSORS, CFG)
    return fd.select("feature", "reference_constant", "current_constant", "constant_sensor_change_severity")


def q_severity(spark, sf_dir):
    fd = D.feature_drift(fx.wide_records(spark, sf_dir), fx.SENSORS, CFG)
    return fd.select("feature", "psi_severity", "ks_statistic_severity", "standardised_mean_shift_severity",
                     "missing_rate_difference_severity", "constant_sensor_change_severity",
                     "measurement_availability_severity", "overall_severity", "feature_health_score", "severity_rank")


def q_align_features(spark, sf_dir):
    w = fx.wide_records(spark, sf_dir)
    long = D.side_long(w, fx.SENSORS).where(F.col("value").isNotNull())
    present = long.groupBy("side", "feature").agg(F.count(F.lit(1)).alias("n"))
    ref = present.where(F.col("side") == D.REF).select("feature")
    cur = present.where(F.col("side") == D.CUR).select("feature")
    return H.align_features(ref, cur)


def q_alerts(spark, sf_dir):
    sc, fd, fsum, od, cat, dq, dqs = _parts(spark, sf_dir)
    return H.alerts(RUN_ID, fd, od, cat, dq)


def q_alert_ids(spark, sf_dir):
    return q_alerts(spark, sf_dir).select("alert_id", "run_id", "category", "alert_type", "resource_id", "metric_name")


def q_retraining_policy(spark, sf_dir):
    return _run(spark, sf_dir).assessment.select(
        "run_id", "recommendation", "overall_health_score", "critical_alerts", "warning_alerts", "critical_feature_rate")


def q_health_components(spark, sf_dir):
    sc, fd, fsum, od, cat, dq, dqs = _parts(spark, sf_dir)
    return H.health_components(fsum, od, cat, dqs, CFG)


def q_health_assessment(spark, sf_dir):
    return _run(spark, sf_dir).assessment


def _quarter_runs(df):
    q = F.concat(F.year("ts").cast("string"), F.lit("-Q"), F.quarter("ts").cast("string"))
    k = len(fx.SENSORS)
    from ..functions.columns import row_array
    miss = F.size(F.filter(row_array(fx.SENSORS), lambda x: x.isNull()))
    return df.groupBy(q.alias("run_id")).agg(
        F.max("ts").alias("generated_utc"), F.count(F.lit(1)).alias("records"),
        F.round(F.sum(miss) / (F.count(F.lit(1)) * k), 6).alias("missing_rate"),
        F.round(F.avg("target"), 6).alias("failure_rate"))


def q_run_history(spark, sf_dir):
    w = fx.wide_records(spark, sf_dir)
    return H.run_history(_quarter_runs(w), _quarter_runs(w.where(F.col("side") == D.CUR)))


QUERIES = {
    "alert_ids": q_alert_ids,
    "retraining_policy": q_retraining_policy,
    "output_drift": q_output_drift,
    "category_shares": q_category_shares,
    "category_drift": q_category_drift,
    "data_quality": q_data_quality,
    "data_quality_summary": q_data_quality_summary,
    "prediction_summary": q_prediction_summary,
    "moment_shift": q_moment_shift,
    "constant_change": q_constant_change,
    "severity": q_severity,
    "align_features": q_align_features,
    "alerts": q_alerts,
    "health_components": q_health_components,
    "health_assessment": q_health_assessment,
    "run_history": q_run_history,
}

# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_SCORED = f"""sc AS (SELECT w.*, s.probability, s.confidence, 1 - s.confidence AS uncertainty,
    CASE WHEN s.probability < {LOWER!r} THEN 'Low Risk' WHEN s.probability >= {UPPER!r} THEN 'High Risk'
         ELSE 'Engineering Review' END AS decision
  FROM wide_records w JOIN scores s USING (record_id))"""

_OUT_LONG = """long_records AS (SELECT record_id, side, 'probability' AS feature, probability AS value FROM sc
  UNION ALL SELECT record_id, side, 'confidence', confidence FROM sc
  UNION ALL SELECT record_id, side, 'uncertainty', uncertainty FROM sc)"""

_PT = CFG.prediction_thresholds
_OSEV = {
    "mean_shift": "(CASE metric_name WHEN 'probability' THEN " + S.sev("shift", _PT["probability_mean_shift"])
    + " WHEN 'confidence' THEN " + S.sev("shift", _PT["confidence_mean_shift"])
    + " WHEN 'uncertainty' THEN " + S.sev("shift", _PT["uncertainty_mean_shift"]) + " ELSE 'Normal' END)",
    "psi": S.sev("psi", CFG.feature_thresholds["psi"]),
    "ks_statistic": S.sev("ks_statistic", CFG.feature_thresholds["ks_statistic"]),
    "availability": "(CASE WHEN cur_n = 0 THEN 'Critical' WHEN ref_n = 0 THEN 'Warning' ELSE 'Normal' END)",
}
_OD = [
    """od0 AS (SELECT feature AS metric_name, coalesce(ref_n, 0) AS ref_n, coalesce(cur_n, 0) AS cur_n, ref_mean, cur_mean,
      abs(cur_mean - ref_mean) AS shift, ref_std, cur_std, psi, ks_statistic, ks_p_value, wasserstein_distance
    FROM fw LEFT JOIN psi_t USING (feature) LEFT JOIN ks_t USING (feature) LEFT JOIN wd_t USING (feature))""",
    f"""od AS (SELECT metric_name, CAST(ref_n AS BIGINT) AS reference_count, CAST(cur_n AS BIGINT) AS current_count,
      round(ref_mean, 6) AS reference_mean, round(cur_mean, 6) AS current_mean, round(shift, 6) AS absolute_mean_shift,
      round(ref_std, 6) AS reference_std, round(cur_std, 6) AS current_std, round(psi, 6) AS psi,
      round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value,
      round(wasserstein_distance, 6) AS wasserstein_distance, {S.max_sev(*_OSEV.values())} AS severity,
      {S.health(_OSEV, H.OUTPUT_WEIGHTS)} AS health_score, true AS available FROM od0
    UNION ALL SELECT 'data_confidence', 0, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Warning',
      {H.UNAVAILABLE_HEALTH!r}, false)""",
    f"""odr AS (SELECT *, {S.sev_rank('severity')} AS severity_rank FROM od)""",
]

_CAT = [
    f"""cs0 AS (SELECT CASE WHEN trim(decision) IS NULL OR lower(trim(decision)) IN ('', 'nan', 'none', 'null')
        THEN '{H.MISSING_CATEGORY}' ELSE trim(decision) END AS category,
      count(*) FILTER (WHERE side = 'reference') AS reference_count, count(*) FILTER (WHERE side = 'current') AS current_count
    FROM sc GROUP BY 1)""",
    """cshare AS (SELECT category, reference_count, current_count,
      round(CASE WHEN sum(reference_count) OVER () > 0 THEN reference_count / sum(reference_count) OVER () ELSE 0.0 END, 6) AS reference_share,
      round(CASE WHEN sum(current_count) OVER () > 0 THEN current_count / sum(current_count) OVER () ELSE 0.0 END, 6) AS current_share
    FROM cs0)""",
    """cshares AS (SELECT *, round(current_share - reference_share, 6) AS share_shift FROM cshare)""",
    f"""cat AS (SELECT 'decision' AS metric_name, round(0.5 * sum(abs(current_share - reference_share)), 6) AS total_variation_distance,
      arg_max(category, struct_pack(a := abs(share_shift), c := category)) AS largest_shift_category,
      round(max(abs(share_shift)), 6) AS largest_shift,
      coalesce(string_agg(CASE WHEN reference_count = 0 THEN category END, ',' ORDER BY category), '') AS unseen_categories,
      coalesce(string_agg(CASE WHEN current_count = 0 THEN category END, ',' ORDER BY category), '') AS absent_categories,
      count(*) AS categories,
      {S.sev('0.5 * sum(abs(current_share - reference_share))', _PT['decision_total_variation'])} AS severity
    FROM cshares)""",
    f"""catr AS (SELECT *, {S.health({'tv': 'severity'}, {'tv': 1.0})} AS health_score FROM cat)""",
]

_K = len(fx.SENSORS)
_ROWMISS = "(" + " + ".join(f"CASE WHEN {s} IS NULL THEN 1 ELSE 0 END" for s in fx.SENSORS) + ")"
_QT = CFG.quality_thresholds


def _vsev(v):
    lo, mid, hi = H.VALIDATION_LIMITS
    return (f"(CASE WHEN {v} IS NULL THEN 'Normal' WHEN {v} >= {hi!r} THEN 'Critical' WHEN {v} >= {mid!r} THEN 'Warning' "
            f"WHEN {v} > {lo!r} THEN 'Watch' ELSE 'Normal' END)")


_DQSEV = "(CASE metric " + " ".join(
    f"WHEN '{n}' THEN {S.sev('value', _QT[n]) if n in _QT else _vsev('value')}" for n in H.QUALITY_WEIGHTS) + " END)"
_DQ = [
    f"""dqb AS (SELECT side, count(*) AS rows, sum({_ROWMISS}) AS missing_cells, count(DISTINCT record_id) AS ids,
      count(*) FILTER (WHERE probability IS NULL OR probability < 0 OR probability > 1) AS bad_prob,
      count(*) FILTER (WHERE confidence IS NULL OR confidence < 0 OR confidence > 1) AS bad_conf,
      count(*) FILTER (WHERE uncertainty IS NULL OR uncertainty < 0 OR uncertainty > 1) AS bad_unc,
      ({' + '.join(f'CASE WHEN count(DISTINCT {s}) <= 1 THEN 1 ELSE 0 END' for s in fx.SENSORS)}) / {_K} AS constant_feature_rate
    FROM sc GROUP BY side)""",
    f"""dqd AS (SELECT side, sum(c - 1) AS dup_rows FROM (SELECT side, count(*) AS c FROM sc GROUP BY side, {', '.join(fx.SENSORS)}) GROUP BY side)""",
    f"""dqm AS (SELECT b.side, missing_cells / (rows * {_K}) AS missing_rate, coalesce(dup_rows, 0) / rows AS duplicate_rate,
      constant_feature_rate, 0.0 AS unmatched_feature_rate, bad_prob / rows AS invalid_probability_rate,
      bad_conf / rows AS invalid_confidence_rate, bad_unc / rows AS invalid_uncertainty_rate,
      (rows - ids) / rows AS id_duplicate_rate FROM dqb b LEFT JOIN dqd USING (side))""",
    "dql AS (" + " UNION ALL ".join(f"SELECT side, '{n}' AS metric, CAST({n} AS DOUBLE) AS value FROM dqm"
                                    for n in H.QUALITY_WEIGHTS) + ")",
    """dqp AS (SELECT metric, max(CASE WHEN side = 'current' THEN value END) AS value,
      max(CASE WHEN side = 'reference' THEN value END) AS reference_value FROM dql GROUP BY metric)""",
    f"""dq AS (SELECT metric, round(value, 6) AS value, round(reference_value, 6) AS reference_value, {_DQSEV} AS severity,
      (CASE metric {' '.join(f"WHEN '{n}' THEN {w!r}" for n, w in H.QUALITY_WEIGHTS.items())} END) AS weight FROM dqp)""",
    f"""dqr AS (SELECT *, {S.sev_rank('severity')} AS severity_rank FROM dq)""",
    f"""dqs AS (SELECT round(sum({S.sev_score('severity')} * weight) / sum(weight), 2) AS health_score,
      {S.rank_sev('max(severity_rank)')} AS severity, count(*) FILTER (WHERE severity <> 'Normal') AS flagged_metrics FROM dqr)""",
]


def _with_out(*extra):
    return fx.sql_with("wide_records", "scores", extra=[_SCORED, _OUT_LONG] + DQ._BASE + _OD + list(extra))


def _with_all(*extra):
    """Feature drift over the wide records plus output/category drift and data quality, in one text."""
    feat_long = "long_records AS (\n" + "\n  UNION ALL\n".join(
        f"  SELECT record_id, ts, target, side, '{s}' AS feature, {s} AS value FROM wide_records" for s in fx.SENSORS) + ")"
    # feature drift CTEs renamed with an f_ prefix so they do not clash with the output-drift ones
    import re
    names = ["lf", "mom", "fw", "edges", "ed", "binned", "dom", "fullb", "props", "clipped", "normed", "psi_t", "kv",
             "kc", "ksd", "kss", "ks_t", "gap", "wd_t", "fd0", "fd1", "fd", "fdr",
             "long_records"]
    pat = re.compile(r"\b(" + "|".join(names) + r")\b")
    feat = [pat.sub(lambda m: "f_" + m.group(1), x) for x in [feat_long] + DQ._BASE + list(DQ._FD)]
    return fx.sql_with("wide_records", "scores", extra=[_SCORED] + feat + [_OUT_LONG] + DQ._BASE + _OD + _CAT + _DQ
                       + list(extra))


_FSUM = f"""fsum AS (SELECT count(*) AS monitored_features, count(*) FILTER (WHERE overall_severity = 'Critical') AS critical_features,
    round(coalesce(avg(feature_health_score), 100.0), 2) AS mean_feature_health_score,
    coalesce(['Normal', 'Watch', 'Warning', 'Critical'][max(severity_rank) + 1], 'Normal') AS dominant_severity FROM f_fdr)"""

_FD_METRIC = """CASE WHEN psi_severity = overall_severity THEN 'psi' WHEN ks_statistic_severity = overall_severity THEN 'ks_statistic'
    WHEN standardised_mean_shift_severity = overall_severity THEN 'standardised_mean_shift'
    WHEN missing_rate_difference_severity = overall_severity THEN 'missing_rate_difference'
    WHEN constant_sensor_change_severity = overall_severity THEN 'constant_sensor_change' ELSE 'measurement_availability' END"""

_TH_NAME = ("CASE WHEN metric_name = 'total_variation_distance' THEN 'decision_total_variation' WHEN category = 'prediction_drift' THEN "
            "(CASE resource_id " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in H.OUTPUT_METRICS.items()) + " END) ELSE metric_name END")
_TH = (f"CASE {_TH_NAME} " + " ".join(
    f"WHEN '{k}' THEN (CASE severity WHEN 'Watch' THEN {a!r} WHEN 'Warning' THEN {b!r} WHEN 'Critical' THEN {c!r} END)"
    for k, (a, b, c) in H.threshold_levels(CFG).items()) + " END")

_ALERTS = [
    f"""fda AS (SELECT *, {_FD_METRIC} AS m FROM f_fdr WHERE overall_severity <> 'Normal')""",
    """al0 AS (
    SELECT 'feature_drift' AS category, 'sensor_drift' AS alert_type, overall_severity AS severity, feature AS resource_id, m AS metric_name,
      round(CASE m WHEN 'psi' THEN psi WHEN 'ks_statistic' THEN ks_statistic WHEN 'standardised_mean_shift' THEN standardised_mean_shift
        WHEN 'missing_rate_difference' THEN missing_rate_difference END, 6) AS observed_value FROM fda
    UNION ALL SELECT 'prediction_drift', 'output_distribution', severity, metric_name, 'absolute_mean_shift', round(absolute_mean_shift, 6)
      FROM odr WHERE severity <> 'Normal'
    UNION ALL SELECT 'prediction_drift', 'decision_mix', severity, metric_name, 'total_variation_distance', round(total_variation_distance, 6)
      FROM catr WHERE severity <> 'Normal'
    UNION ALL SELECT 'data_quality', 'data_quality', severity, metric, metric, round(value, 6) FROM dqr WHERE severity <> 'Normal')""",
    f"""alerts AS (SELECT substr(sha256(concat_ws('|', '{RUN_ID}', category, alert_type, resource_id, metric_name)), 1, 20) AS alert_id,
      '{RUN_ID}' AS run_id, category, alert_type, severity, resource_id, metric_name, observed_value,
      ({_TH}) AS threshold_value,
      coalesce(printf('%s %s on %s (%s)', severity, alert_type, resource_id, metric_name), '') AS message,
      CASE WHEN severity = 'Critical' THEN 'Investigate now and assess retraining'
           WHEN severity = 'Warning' THEN 'Review at the next monitoring meeting' ELSE 'Keep watching' END AS recommended_action,
      to_json(struct_pack(resource_id := resource_id, metric_name := metric_name, severity := severity)) AS evidence_json,
      {S.sev_rank('severity')} AS severity_rank FROM al0)""",
]

_W = CFG.health_weights
_WT = sum(_W.values())
_COMP = [
    """predrows AS (SELECT metric_name, severity, health_score FROM odr UNION ALL SELECT metric_name, severity, health_score FROM catr)""",
    f"""comp0 AS (
    SELECT 'data_quality' AS component_name, health_score AS raw_score, severity FROM dqs
    UNION ALL SELECT 'feature_drift', mean_feature_health_score, dominant_severity FROM fsum
    UNION ALL SELECT 'prediction_drift', round(avg(health_score), 2), {S.rank_sev(f"max({S.sev_rank('severity')})")} FROM predrows
    UNION ALL SELECT 'confidence_and_uncertainty', round(avg(health_score), 2), {S.rank_sev(f"max({S.sev_rank('severity')})")}
      FROM odr WHERE metric_name IN ('confidence', 'uncertainty', 'data_confidence'))""",
    f"""comp AS (SELECT component_name, (CASE component_name {' '.join(f"WHEN '{k}' THEN {v / _WT!r}" for k, v in _W.items())} END) AS weight,
      raw_score, round(raw_score * (CASE component_name {' '.join(f"WHEN '{k}' THEN {v / _WT!r}" for k, v in _W.items())} END), 4) AS weighted_score,
      severity FROM comp0)""",
]


def _band(x):
    parts = " ".join(f"WHEN {x} >= {lo!r} THEN '{name}'" for lo, name in HEALTH_BANDS[:-1])
    return f"(CASE {parts} ELSE '{HEALTH_BANDS[-1][1]}' END)"


_BANDSEV = "(CASE band " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BAND_SEVERITY.items()) + " END)"
_R = H.RETRAIN
_ASSESS = f"""ha0 AS (SELECT round(sum(weighted_score) / sum(weight), 2) AS overall_health_score,
      max({S.sev_rank('severity')}) AS comp_rank,
      arg_min(struct_pack(n := component_name, r := raw_score, s := severity),
              struct_pack(r := raw_score, neg := -{S.sev_rank('severity')}, n := component_name, s := severity)) AS worst FROM comp),
  ha1 AS (SELECT ha0.*, {_band('overall_health_score')} AS band,
      (SELECT count(*) FROM alerts) AS total_alerts, (SELECT count(*) FROM alerts WHERE severity = 'Critical') AS critical_alerts,
      (SELECT count(*) FROM alerts WHERE severity = 'Warning') AS warning_alerts,
      (SELECT count(*) FROM alerts WHERE severity = 'Watch') AS watch_alerts,
      (SELECT critical_features / monitored_features FROM fsum) AS critical_feature_rate,
      (SELECT severity FROM dqs) AS dq_severity,
      (SELECT count(*) FROM sc WHERE side = 'current') AS current_rows FROM ha0)
  SELECT '{RUN_ID}' AS run_id, overall_health_score, band AS health_band,
    {S.rank_sev(f"greatest({S.sev_rank(_BANDSEV)}, comp_rank)")} AS severity,
    CASE WHEN current_rows < {CFG.minimum_current_rows} THEN '{_R[2]}'
         WHEN critical_alerts >= 3 OR critical_feature_rate >= 0.15 OR (overall_health_score < 60.0 AND dq_severity <> 'Critical') THEN '{_R[0]}'
         WHEN overall_health_score < 65.0 OR critical_alerts > 0 THEN '{_R[1]}'
         WHEN overall_health_score < 80.0 OR warning_alerts >= 5 THEN '{_R[1]}'
         WHEN overall_health_score < 90.0 OR warning_alerts > 0 THEN '{_R[2]}' ELSE '{_R[3]}' END AS recommendation,
    total_alerts, critical_alerts, warning_alerts, watch_alerts, round(critical_feature_rate, 6) AS critical_feature_rate,
    printf('%s (%.2f/100, %s)', CASE worst.n WHEN 'data_quality' THEN 'Data Quality' WHEN 'feature_drift' THEN 'Feature Drift'
      WHEN 'prediction_drift' THEN 'Prediction Drift' ELSE 'Confidence And Uncertainty' END, worst.r, worst.s) AS primary_risk_driver,
    current_rows FROM ha1"""

_QRUNS = f"""SELECT CAST(year(ts) AS VARCHAR) || '-Q' || CAST(quarter(ts) AS VARCHAR) AS run_id, max(ts) AS generated_utc,
    count(*) AS records, round(sum({_ROWMISS}) / (count(*) * {_K}), 6) AS missing_rate, round(avg(target), 6) AS failure_rate
  FROM wide_records {{where}} GROUP BY 1"""

SQL = {
    "output_drift": _with_out() + "SELECT * FROM odr",
    "category_shares": fx.sql_with("wide_records", "scores", extra=[_SCORED] + _CAT) + "SELECT * FROM cshares",
    "category_drift": fx.sql_with("wide_records", "scores", extra=[_SCORED] + _CAT) + "SELECT * FROM catr",
    "data_quality": fx.sql_with("wide_records", "scores", extra=[_SCORED] + _DQ) + "SELECT * FROM dqr",
    "data_quality_summary": fx.sql_with("wide_records", "scores", extra=[_SCORED] + _DQ) + "SELECT * FROM dqs",
    "prediction_summary": _with_out(*_CAT) + f"""SELECT {S.rank_sev(f"max({S.sev_rank('severity')})")} AS dominant_severity,
        round(avg(health_score), 2) AS mean_health_score, count(*) FILTER (WHERE severity <> 'Normal') AS flagged_metrics
      FROM (SELECT severity, health_score FROM odr UNION ALL SELECT severity, health_score FROM catr)""",
    "moment_shift": DQ.SQL["feature_drift"].replace("SELECT * FROM fdr", """SELECT feature, reference_mean, current_mean,
        absolute_mean_shift, standardised_mean_shift, reference_std, current_std, standard_deviation_ratio, reference_median,
        current_median, absolute_median_shift FROM fdr"""),
    "constant_change": DQ.SQL["feature_drift"].replace(
        "SELECT * FROM fdr", "SELECT feature, reference_constant, current_constant, constant_sensor_change_severity FROM fdr"),
    "severity": DQ.SQL["feature_drift"].replace("SELECT * FROM fdr", """SELECT feature, psi_severity, ks_statistic_severity,
        standardised_mean_shift_severity, missing_rate_difference_severity, constant_sensor_change_severity,
        measurement_availability_severity, overall_severity, feature_health_score, severity_rank FROM fdr"""),
    "align_features": fx.sql_with("wide_records", "long_records") + """, p AS (SELECT DISTINCT side, feature FROM long_records WHERE value IS NOT NULL),
      r AS (SELECT feature, true AS in_ref FROM p WHERE side = 'reference'), c AS (SELECT feature, true AS in_cur FROM p WHERE side = 'current')
      SELECT coalesce(r.feature, c.feature) AS feature, coalesce(in_ref, false) AS in_reference, coalesce(in_cur, false) AS in_current,
        CASE WHEN coalesce(in_ref, false) AND coalesce(in_cur, false) THEN 'shared' WHEN coalesce(in_ref, false) THEN 'reference_only' ELSE 'current_only' END AS status,
        CASE WHEN coalesce(in_ref, false) AND coalesce(in_cur, false) THEN 'Normal' WHEN coalesce(in_ref, false) THEN 'Critical' ELSE 'Warning' END AS severity
      FROM r FULL OUTER JOIN c ON r.feature = c.feature""",
    "alerts": _with_all(*_ALERTS) + "SELECT * FROM alerts",
    "alert_ids": _with_all(*_ALERTS) + "SELECT alert_id, run_id, category, alert_type, resource_id, metric_name FROM alerts",
    "retraining_policy": "SELECT run_id, recommendation, overall_health_score, critical_alerts, warning_alerts, critical_feature_rate FROM ("
                         + _with_all(_FSUM, *_ALERTS, *_COMP) + ", " + _ASSESS + ")",
    "health_components": _with_all(_FSUM, *_COMP) + "SELECT * FROM comp",
    "health_assessment": _with_all(_FSUM, *_ALERTS, *_COMP) + ", " + _ASSESS,
    "run_history": fx.sql_with("wide_records") + f""", h AS ({_QRUNS.format(where='')}),
      n AS ({_QRUNS.format(where="WHERE side = 'current'")}),
      m AS (SELECT * FROM h WHERE run_id NOT IN (SELECT run_id FROM n) UNION ALL SELECT * FROM n)
      SELECT *, row_number() OVER (ORDER BY generated_utc, run_id) AS history_rank FROM m""",
}
