"""Registered evidence, validation and report queries with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import r6
from ..operators import evidence as EV
from ..operators import explain as X
from ..operators import policy as PO
from ..operators import priority as PR
from ..operators import uncertainty as U
from ..sources import fixtures as fx
from . import decisions_q as DQ

LOWER, UPPER = 0.035, 0.08
SENS = fx.SENSORS


def _plan(spark, sf):
    from ..plans.decision_report import DecisionReport
    from ..session import cut_lineage
    w = cut_lineage(fx.wide_records(spark, sf))  # one record snapshot per run
    return DecisionReport(w, fx.scores(spark, sf, w), fx.members(spark, sf, w), SENS, LOWER, UPPER)


def _parts(spark, sf):
    p = _plan(spark, sf)
    return p.wide, p.scores, p.attributions, p.evidence


def _prio(w, att):
    return PR.sensor_priority(att, w, SENS, X.global_importance(att), X.failure_features(att, None))


def q_evidence_labels(spark, sf):
    rep = _parts(spark, sf)[3]
    return rep.select("record_id", "model_evidence_strength", "prediction_reliability",
                      r6(F.col("data_familiarity_score")).alias("data_familiarity_score"), "data_familiarity_band",
                      "historical_evidence")


def q_evidence_agreement(spark, sf):
    return _parts(spark, sf)[3].select("record_id", "evidence_agreement", "evidence_conflict", "recommended_action")


def q_evidence_report(spark, sf):
    return U.rounded(_parts(spark, sf)[3])


def q_agreement_summary(spark, sf):
    return EV.agreement_summary(_parts(spark, sf)[3])


def q_offline_evaluation(spark, sf):
    return EV.offline_evaluation(_parts(spark, sf)[3])


def q_conflict_cases(spark, sf):
    return EV.conflict_cases(_parts(spark, sf)[3]).select(
        "record_id", "target", "uncertainty_adjusted_decision", "evidence_agreement", "historical_evidence",
        r6(F.col("calibrated_failure_probability")).alias("calibrated_failure_probability"))


def _table_checks(spark, sf, w, s, att):
    ev = fx.audit_events(spark, sf)
    li = fx.table(spark, sf, "lineitem")
    return (EV.validate_table("wide_records", w, ["record_id"], ["record_id", "ts", "target"])
            .unionByName(EV.validate_table("scores", s, ["record_id"], ["record_id", "probability"]))
            .unionByName(EV.validate_table("attributions", att, ["record_id", "feature"], ["record_id", "feature", "contribution"]))
            .unionByName(EV.validate_table("audit_events", ev, ["event_id"], ["event_id", "timestamp_utc"]))
            .unionByName(EV.validate_table("lineitem", li, ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber"])))


def _all_checks(spark, sf):
    w, s, att, rep = _parts(spark, sf)
    expected = w.where(F.col("side") == "current")
    return (_table_checks(spark, sf, w, s, att).unionByName(EV.check_record_sets(expected, rep, "record_sets"))
            .unionByName(EV.check_governance(rep)))


def q_validate_table(spark, sf):
    w = fx.wide_records(spark, sf)
    s = fx.scores(spark, sf, w)
    return _table_checks(spark, sf, w, s, X.attributions(w, SENS))


def q_check_record_sets(spark, sf):
    w, s, att, rep = _parts(spark, sf)
    return EV.check_record_sets(w.where(F.col("side") == "current"), rep, "record_sets")


def q_check_governance(spark, sf):
    return EV.check_governance(_parts(spark, sf)[3])


def q_readiness(spark, sf):
    return EV.readiness(_all_checks(spark, sf)).select("total_checks", "passed", "failed", "critical_failures",
                                                       "deployment_ready")


def q_weighted_readiness(spark, sf):
    return EV.readiness(_all_checks(spark, sf)).select("total_checks", "passed", "warnings", "failed",
                                                       "critical_failures", "weighted_score", "production_ready")


def _index(spark, sf):
    return _plan(spark, sf).index


def q_report_index(spark, sf):
    return _index(spark, sf)


def q_query_index(spark, sf):
    return EV.query_index(_index(spark, sf), decision=PO.REVIEW, min_probability=0.04, sort_by="queue", page=2,
                          page_size=20)


def q_decision_mix(spark, sf):
    return EV.decision_mix(_parts(spark, sf)[3])


def q_queue_score(spark, sf):
    return _index(spark, sf).select("record_id", "queue_score")


def _docs(spark, sf):
    return _plan(spark, sf).documents


def q_report_document(spark, sf):
    return _docs(spark, sf)


def q_report_document_counts(spark, sf):
    return _docs(spark, sf).select("record_id", "decision", "contribution_count", "priority_count")


def q_report_flatten(spark, sf):
    return EV.report_flatten(_docs(spark, sf))


def q_record_details(spark, sf):
    w, s, att, rep = _parts(spark, sf)
    idx = EV.report_index(rep, PR.record_priority_summary(_prio(w, att)))
    ids = idx.orderBy(F.desc("queue_score"), "record_id").limit(5).select("record_id").unionByName(
        spark.createDataFrame([("R-999999999",)], "record_id string"))
    return EV.record_details(ids, rep, X.local_top_k(att), _prio(w, att))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

# ---------------------------------------------------------------------------
# DuckDB twins (reuse the uncertainty / attribution / priority CTEs)
# ---------------------------------------------------------------------------

_REP = [
    """rb AS (SELECT u.record_id, u.target, u.calibrated_failure_probability AS p, u.prediction_confidence AS conf,
      u.combined_uncertainty AS unc, u.uncertainty_adjusted_decision AS dec,
      least(greatest(1 - u.ood_percentile, 0.0), 1.0) AS fam, coalesce(s.failed_neighbour_count, 0) AS failed,
      ls.top_risk_features FROM ur u LEFT JOIN ls USING (record_id) LEFT JOIN scores s USING (record_id) WHERE u.side = 'current')""",
    f"""rl AS (SELECT *, failed / {float(EV.NEIGHBOURS)!r} AS rate,
      CASE WHEN p >= {max(UPPER * 2.0, UPPER + 0.05)!r} THEN 'Very Strong Risk Signal' WHEN p >= {UPPER!r} THEN 'Strong Risk Signal'
           WHEN p >= {LOWER!r} THEN 'Intermediate Risk Signal' WHEN p < {LOWER / 2.0!r} THEN 'Strong Low-Risk Signal'
           ELSE 'Moderate Low-Risk Signal' END AS me,
      CASE WHEN conf <= {EV.LOW_CONFIDENCE!r} OR unc >= {EV.HIGH_UNCERTAINTY!r} THEN 'Low Reliability'
           WHEN conf <= {EV.MODERATE_CONFIDENCE!r} OR unc >= {EV.MODERATE_UNCERTAINTY!r} THEN 'Moderate Reliability'
           ELSE 'High Reliability' END AS rel,
      CASE WHEN fam >= {EV.HIGH_FAMILIARITY!r} THEN 'Very Familiar' WHEN fam >= {EV.MODERATE_FAMILIARITY!r} THEN 'Familiar'
           WHEN fam >= {EV.UNUSUAL_FAMILIARITY!r} THEN 'Unusual' ELSE 'Outside Typical Historical Experience' END AS fb FROM rb)""",
    f"""rh AS (SELECT *, CASE WHEN failed >= {EV.STRONG_FAILED_NEIGHBOURS} AND rate >= {EV.STRONG_HISTORICAL_RATE!r} THEN 'Strong Historical Failure Evidence'
           WHEN failed >= {EV.MODERATE_FAILED_NEIGHBOURS} AND rate >= {EV.MODERATE_HISTORICAL_RATE!r} THEN 'Moderate Historical Failure Evidence'
           WHEN failed >= 1 THEN 'Limited Historical Failure Evidence' ELSE 'No Retrieved Historical Failure Evidence' END AS hist FROM rl)""",
    """ra AS (SELECT *, CASE
        WHEN dec = 'Insufficient Evidence' THEN 'Insufficient Evidence'
        WHEN dec = 'High Risk' AND hist IN ('Strong Historical Failure Evidence', 'Moderate Historical Failure Evidence') AND rel <> 'Low Reliability' THEN 'Convergent Risk Evidence'
        WHEN dec = 'High Risk' AND (fb IN ('Unusual', 'Outside Typical Historical Experience') OR rel = 'Low Reliability') THEN 'High Risk with Reliability Caution'
        WHEN dec = 'High Risk' THEN 'Model-Led Risk Evidence'
        WHEN dec = 'Engineering Review' AND hist IN ('Strong Historical Failure Evidence', 'Moderate Historical Failure Evidence') THEN 'Review with Supporting Historical Risk'
        WHEN dec = 'Engineering Review' AND (fb IN ('Unusual', 'Outside Typical Historical Experience') OR rel = 'Low Reliability') THEN 'Review Driven by Reliability Concern'
        WHEN dec = 'Engineering Review' THEN 'Mixed or Intermediate Evidence'
        WHEN dec = 'Low Risk' AND hist = 'No Retrieved Historical Failure Evidence' AND rel <> 'Low Reliability' AND fb NOT IN ('Unusual', 'Outside Typical Historical Experience') THEN 'Convergent Low-Risk Evidence'
        WHEN dec = 'Low Risk' AND hist IN ('Strong Historical Failure Evidence', 'Moderate Historical Failure Evidence') THEN 'Low-Risk Decision with Historical Conflict'
        WHEN dec = 'Low Risk' AND (fb IN ('Unusual', 'Outside Typical Historical Experience') OR rel = 'Low Reliability') THEN 'Low-Risk Decision with Reliability Caution'
        WHEN dec = 'Low Risk' THEN 'Low-Risk Decision with Limited Support' ELSE 'Unclassified Evidence Pattern' END AS agree FROM rh)""",
    """rc AS (SELECT *, agree IN ('Low-Risk Decision with Historical Conflict', 'Low-Risk Decision with Reliability Caution',
      'High Risk with Reliability Caution') OR dec = 'Insufficient Evidence' AS conflict FROM ra)""",
    """rep AS (SELECT record_id, target, p AS calibrated_failure_probability, conf AS prediction_confidence, unc AS combined_uncertainty,
      dec AS uncertainty_adjusted_decision, me AS model_evidence_strength, rel AS prediction_reliability, fam AS data_familiarity_score,
      fb AS data_familiarity_band, CAST(failed AS INTEGER) AS failed_neighbour_count, rate AS historical_failure_rate, hist AS historical_evidence,
      agree AS evidence_agreement, conflict AS evidence_conflict,
      CASE WHEN dec = 'Low Risk' AND agree IN ('Low-Risk Decision with Historical Conflict', 'Low-Risk Decision with Reliability Caution')
             THEN 'Verify the flagged evidence before release'
           WHEN dec = 'Low Risk' THEN 'Release under standard monitoring'
           WHEN dec = 'Engineering Review' THEN 'Engineering assessment of the ranked sensors and similar cases'
           WHEN dec = 'High Risk' THEN 'Hold and inspect before further processing' ELSE 'Collect more evidence before deciding' END AS recommended_action,
      coalesce(top_risk_features, '') AS top_risk_features, printf('%s: %s, %s, %s; %s.', dec, me, rel, fb, hist) AS evidence_narrative,
      dec <> 'Low Risk' OR conflict AS human_review_required, dec = 'Low Risk' AND NOT conflict AS automatic_release_allowed FROM rc)""",
]


def _w(*extra):
    return fx.sql_with("wide_records", "scores", "members", "long_records", "audit_events",
                       extra=DQ._UNC + DQ._ATT + DQ._PRIO + _REP + list(extra))


def _vt(name, src, keys, required_ok=True):
    kd = ", ".join(keys)
    null_cond = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT '{name}' AS category, item, status, severity, details FROM (
      SELECT count(*) AS rows, count(DISTINCT row({kd})) AS dk, count(*) FILTER (WHERE {null_cond}) AS nk FROM {src}) a,
      LATERAL (VALUES
        ('non_empty', CASE WHEN a.rows > 0 THEN 'PASS' ELSE 'FAIL' END, 'Critical', printf('%d rows', a.rows)),
        ('required_columns', '{'PASS' if required_ok else 'FAIL'}', 'Critical', 'all present'),
        ('unique_keys', CASE WHEN a.dk = a.rows THEN 'PASS' ELSE 'FAIL' END, 'Critical', printf('%d duplicate keys', a.rows - a.dk)),
        ('no_null_keys', CASE WHEN a.nk = 0 THEN 'PASS' ELSE 'FAIL' END, 'Warning', printf('%d null keys', a.nk))) v(item, status, severity, details)"""


_TABLE_CHECKS = " UNION ALL ".join([
    _vt("wide_records", "wide_records", ["record_id"]), _vt("scores", "scores", ["record_id"]),
    _vt("attributions", "att", ["record_id", "feature"]), _vt("audit_events", "audit_events", ["event_id"]),
    _vt("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])])

_RECORD_SETS = """SELECT 'record_sets' AS category, 'expected_records' AS item, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS status,
    'Critical' AS severity, printf('%d expected', n) AS details FROM (SELECT count(DISTINCT record_id) AS n FROM wide_records WHERE side = 'current')
  UNION ALL SELECT 'record_sets', 'missing_records', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, 'Critical', printf('%d missing', n)
    FROM (SELECT count(*) AS n FROM (SELECT DISTINCT record_id FROM wide_records WHERE side = 'current') e WHERE record_id NOT IN (SELECT record_id FROM rep))
  UNION ALL SELECT 'record_sets', 'extra_records', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, 'Critical', printf('%d unexpected', n)
    FROM (SELECT count(*) AS n FROM (SELECT DISTINCT record_id FROM rep) p WHERE record_id NOT IN (SELECT record_id FROM wide_records WHERE side = 'current'))"""

_GOV = f"""SELECT 'governance' AS category, 'allowed_decisions' AS item, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'Critical' AS severity,
    printf('%d outside the allowed set', bad) AS details FROM g0
  UNION ALL SELECT 'governance', 'flag_consistency', CASE WHEN clash = 0 THEN 'PASS' ELSE 'FAIL' END, 'Critical', printf('%d contradictory rows', clash) FROM g0
  UNION ALL SELECT 'governance', 'safe_failure_routing', CASE WHEN safe >= {EV.SAFE_ROUTING_MINIMUM!r} THEN 'PASS' ELSE 'FAIL' END, 'Critical',
    printf('%.4f of failures held for review', round(safe, 4)) FROM g0"""
_G0 = """g0 AS (SELECT count(*) FILTER (WHERE uncertainty_adjusted_decision NOT IN ('Low Risk', 'Engineering Review', 'High Risk', 'Insufficient Evidence')) AS bad,
    count(*) FILTER (WHERE human_review_required = automatic_release_allowed) AS clash,
    CASE WHEN count(*) FILTER (WHERE target = 1) > 0 THEN count(*) FILTER (WHERE target = 1 AND NOT automatic_release_allowed)
      / count(*) FILTER (WHERE target = 1) ELSE 1.0 END AS safe FROM rep)"""
_READY = f"""ck AS ({_TABLE_CHECKS} UNION ALL {_RECORD_SETS} UNION ALL {_GOV}),
  rd AS (SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
    count(*) FILTER (WHERE status = 'WARN') AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failed,
    count(*) FILTER (WHERE status = 'FAIL' AND severity = 'Critical') AS critical_failures,
    round(100 * sum((CASE WHEN severity = 'Critical' THEN 2.0 ELSE 1.0 END) * (CASE WHEN status = 'PASS' THEN 1.0 WHEN status = 'WARN' THEN 0.5 ELSE 0.0 END))
      / sum(CASE WHEN severity = 'Critical' THEN 2.0 ELSE 1.0 END), 2) AS weighted_score FROM ck)"""

_PSUM = """psum AS (SELECT record_id, max(CASE WHEN priority_rank = 1 THEN feature END) AS top_sensor FROM prio GROUP BY record_id)"""
_QS = f"""(0.55 * coalesce(CASE uncertainty_adjusted_decision {' '.join(f"WHEN '{d}' THEN {float(v)!r}" for d, v in EV.DECISION_SCORE.items())} END, 0.0)
    + 0.20 * coalesce(calibrated_failure_probability, 0.0) + 0.20 * coalesce(combined_uncertainty, 0.0) + 0.05 * (1.0 - coalesce(prediction_confidence, 0.0)))"""
_IDX = f"""idx AS (SELECT record_id, target, round(calibrated_failure_probability, 6) AS calibrated_failure_probability, uncertainty_adjusted_decision,
    round(prediction_confidence, 6) AS prediction_confidence, round(combined_uncertainty, 6) AS combined_uncertainty, evidence_agreement,
    evidence_conflict, top_sensor, round({_QS}, 6) AS queue_score FROM rep LEFT JOIN psum USING (record_id))"""
_TOPK = """topk AS (SELECT * FROM (SELECT record_id, feature, contribution, row_number() OVER (PARTITION BY record_id ORDER BY abs(contribution) DESC, feature) AS rank FROM att) WHERE rank <= 10)"""
_DOCS = """docs AS (SELECT r.record_id, r.uncertainty_adjusted_decision AS decision,
    (SELECT count(*) FROM topk t WHERE t.record_id = r.record_id) AS contribution_count,
    (SELECT count(*) FROM prio p WHERE p.record_id = r.record_id) AS priority_count,
    round(r.calibrated_failure_probability, 6) AS probability, round(r.prediction_confidence, 6) AS confidence,
    coalesce((SELECT feature FROM prio p WHERE p.record_id = r.record_id AND p.priority_rank = 1), 'none') AS top_sensor,
    coalesce((SELECT feature FROM topk t WHERE t.record_id = r.record_id AND t.rank = 1), 'none') AS top_contributor,
    r.evidence_conflict FROM rep r)"""

SQL = {
    "evidence_labels": _w() + """SELECT record_id, model_evidence_strength, prediction_reliability, round(data_familiarity_score, 6) AS data_familiarity_score,
        data_familiarity_band, historical_evidence FROM rep""",
    "evidence_agreement": _w() + "SELECT record_id, evidence_agreement, evidence_conflict, recommended_action FROM rep",
    "evidence_report": _w() + """SELECT * REPLACE (round(calibrated_failure_probability, 6) AS calibrated_failure_probability,
        round(prediction_confidence, 6) AS prediction_confidence, round(combined_uncertainty, 6) AS combined_uncertainty,
        round(data_familiarity_score, 6) AS data_familiarity_score, round(historical_failure_rate, 6) AS historical_failure_rate) FROM rep""",
    "agreement_summary": _w() + """SELECT evidence_agreement, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        round(avg(target), 6) AS failure_rate, count(*) FILTER (WHERE evidence_conflict) AS conflicts,
        round(avg(calibrated_failure_probability), 6) AS mean_probability,
        round(avg(CASE WHEN data_familiarity_band IN ('Very Familiar', 'Familiar') THEN 1 ELSE 0 END), 6) AS familiar_share
      FROM rep GROUP BY evidence_agreement""",
    "offline_evaluation": _w() + ", lo AS (" + " UNION ALL ".join(
        f"SELECT target, '{c}' AS label_column, {c} AS label_value FROM rep" for c in EV.OFFLINE_COLUMNS) + """)
      SELECT label_column, label_value, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        round(avg(target), 6) AS failure_rate FROM lo GROUP BY label_column, label_value""",
    "conflict_cases": _w() + """SELECT record_id, target, uncertainty_adjusted_decision, evidence_agreement, historical_evidence,
        round(calibrated_failure_probability, 6) AS calibrated_failure_probability FROM rep WHERE evidence_conflict""",
    "validate_table": _w() + _TABLE_CHECKS,
    "check_record_sets": _w() + _RECORD_SETS,
    "check_governance": _w(_G0) + _GOV,
    "readiness": _w(_G0) + ", " + _READY + """ SELECT total_checks, passed, failed, critical_failures,
        critical_failures = 0 AS deployment_ready FROM rd""",
    "weighted_readiness": _w(_G0) + ", " + _READY + f""" SELECT total_checks, passed, warnings, failed, critical_failures, weighted_score,
        critical_failures = 0 AND weighted_score >= {EV.READY_SCORE!r} AS production_ready FROM rd""",
    "report_index": _w(_PSUM, _IDX) + "SELECT * FROM idx",
    "query_index": _w(_PSUM, _IDX) + """, f AS (SELECT * FROM idx WHERE uncertainty_adjusted_decision = 'Engineering Review'
        AND calibrated_failure_probability >= 0.04)
      SELECT f.*, (SELECT count(*) FROM f) AS total_matches FROM f ORDER BY queue_score DESC, record_id LIMIT 20 OFFSET 20""",
    "decision_mix": _w() + """SELECT CASE uncertainty_adjusted_decision WHEN 'High Risk' THEN 0 WHEN 'Insufficient Evidence' THEN 1
        WHEN 'Engineering Review' THEN 2 WHEN 'Low Risk' THEN 3 END AS risk_order, uncertainty_adjusted_decision, count(*) AS records,
        round(count(*) / sum(count(*)) OVER (), 6) AS share, round(avg(calibrated_failure_probability), 6) AS mean_probability,
        round(avg(prediction_confidence), 6) AS mean_confidence, round(avg(combined_uncertainty), 6) AS mean_uncertainty
      FROM rep GROUP BY uncertainty_adjusted_decision""",
    "queue_score": _w(_PSUM, _IDX) + "SELECT record_id, queue_score FROM idx",
    "report_document_counts": _w(_TOPK, _DOCS) + "SELECT record_id, decision, contribution_count, priority_count FROM docs",
    "report_flatten": _w(_TOPK, _DOCS) + """, j AS (SELECT record_id, json_object('prediction', json_object('decision', decision,
        'probability', probability), 'reliability', json_object('confidence', confidence), 'priorities',
        CASE WHEN top_sensor = 'none' THEN json('[]') ELSE json_array(json_object('feature', top_sensor)) END,
        'contributions', CASE WHEN top_contributor = 'none' THEN json('[]') ELSE json_array(json_object('feature', top_contributor)) END,
        'evidence', json_object('evidence_conflict', evidence_conflict)) AS doc FROM docs)
      SELECT record_id, coalesce(json_extract_string(doc, '$.prediction.decision'), 'Unknown') AS decision,
        CAST(json_extract_string(doc, '$.prediction.probability') AS DOUBLE) AS probability,
        CAST(json_extract_string(doc, '$.reliability.confidence') AS DOUBLE) AS confidence,
        coalesce(json_extract_string(doc, '$.priorities[0].feature'), 'none') AS top_sensor,
        coalesce(json_extract_string(doc, '$.contributions[0].feature'), 'none') AS top_contributor,
        coalesce(CAST(json_extract_string(doc, '$.evidence.evidence_conflict') AS BOOLEAN), false) AS evidence_conflict FROM j""",
    "record_details": _w(_PSUM, _IDX, _TOPK) + """, ids AS (SELECT record_id FROM (SELECT record_id FROM idx ORDER BY queue_score DESC, record_id LIMIT 5)
        UNION ALL SELECT 'R-999999999')
      SELECT record_id, 'prediction' AS section, 0 AS rank, uncertainty_adjusted_decision AS name,
        round(calibrated_failure_probability, 6) AS value FROM rep WHERE record_id IN (SELECT record_id FROM ids)
      UNION ALL SELECT record_id, 'contribution', rank, feature, round(contribution, 6) FROM topk WHERE record_id IN (SELECT record_id FROM ids)
      UNION ALL SELECT record_id, 'priority', priority_rank, feature, priority_score FROM prio WHERE record_id IN (SELECT record_id FROM ids)
      UNION ALL SELECT record_id, 'unknown_id', 0, NULL, NULL FROM ids WHERE record_id NOT IN (SELECT record_id FROM rep)""",
}
