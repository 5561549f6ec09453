"""Registered error-analysis, uncertainty, explanation and priority queries with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contributions as CO
from ..operators import errors as E
from ..operators import explain as X
from ..operators import policy as PO
from ..operators import priority as PR
from ..operators import uncertainty as U
from ..functions.expressions import r6
from ..session import cut_lineage
from ..sources import fixtures as fx

SENS = fx.SENSORS
THRESHOLD = 0.385
LOWER, UPPER = 0.035, 0.08


def _w(spark, sf):
    return fx.wide_records(spark, sf)


def _snap(spark, sf):
    return cut_lineage(_w(spark, sf))  # one record snapshot for multi-stage queries


def _em(spark, sf):
    w = _snap(spark, sf)
    return w, E.error_master(w, fx.scores(spark, sf, w), SENS, THRESHOLD)


def q_error_master(spark, sf):
    return _em(spark, sf)[1]


def q_segment_metrics(spark, sf):
    return E.segment_metrics(_em(spark, sf)[1], "shift")


def q_error_type_summary(spark, sf):
    return E.error_type_summary(_em(spark, sf)[1])


def q_error_rankings(spark, sf):
    return E.error_rankings(_em(spark, sf)[1])


def q_error_groups(spark, sf):
    return _em(spark, sf)[1].select("record_id", "target", "predicted_target", "error_group")


def q_mann_whitney(spark, sf):
    w, em = _em(spark, sf)
    return E.mann_whitney(w, em, SENS, *E.COMPARISONS[0])


def q_error_diagnostics(spark, sf):
    w, em = _em(spark, sf)
    return E.error_diagnostics(w, em, SENS)


def _cc(spark, sf):
    w = _snap(spark, sf)
    return U.confidence_components(w, fx.scores(spark, sf, w), fx.members(spark, sf, w), SENS, LOWER, UPPER)


def q_ensemble_spread(spark, sf):
    return U.ensemble_spread(fx.members(spark, sf))


def q_percentile_normalise(spark, sf):
    s = fx.scores(spark, sf)
    t = U.percentile_normalise(s, "failed_neighbour_count", F.col("side") == "reference", "neighbour_percentile")
    return t.select("record_id", "failed_neighbour_count", r6(F.col("neighbour_percentile")).alias("neighbour_percentile"))


def q_upper_reference_normalise(spark, sf):
    w = _w(spark, sf)
    sp = cut_lineage(U.ensemble_spread(fx.members(spark, sf, w)).join(w.select("record_id", "side"), "record_id"))
    q = U.reference_quantiles(sp, {"member_std": [U.UPPER_QUANTILE]}, F.col("side") == "reference")
    t = sp.crossJoin(F.broadcast(q))
    return t.select("record_id", "member_std",
                    r6(U.upper_reference_normalise(F.col("member_std"), F.col("member_std_q950"))).alias("normalised_spread"))


def q_decision_margin(spark, sf):
    s = fx.scores(spark, sf)
    return s.select("record_id", r6(U.decision_margin(F.col("probability"), LOWER, UPPER)).alias("decision_margin"))


def q_confidence_components(spark, sf):
    return U.rounded(_cc(spark, sf)).select("record_id", "completeness", "ood_percentile", "neighbour_percentile", "model_agreement",
                                 "prediction_stability", "data_confidence", "decision_margin", "prediction_confidence",
                                 "combined_uncertainty")


def q_uncertainty_bands(spark, sf):
    return _cc(spark, sf).select("record_id", "uncertainty_band", "confidence_band")


def q_abstention(spark, sf):
    return _cc(spark, sf).select("record_id", "original_decision", "uncertainty_adjusted_decision", "abstention_reason")


def q_uncertainty_output(spark, sf):
    return U.rounded(_cc(spark, sf))


def q_uncertainty_decision_summary(spark, sf):
    return PO.decision_summary(_cc(spark, sf), "uncertainty_adjusted_decision", score="calibrated_failure_probability",
                               decisions=[PO.LOW, PO.REVIEW, PO.HIGH, PO.ABSTAIN])


def q_band_performance(spark, sf):
    return U.band_performance(_cc(spark, sf), "uncertainty_band")


def _att(spark, sf):
    return X.attributions(_w(spark, sf), SENS)


def _decisions(spark, sf):
    s = fx.scores(spark, sf)
    return s.select("record_id", "target", PO.assign_decision(F.col("probability"), LOWER, UPPER).alias("decision"))


def q_attributions(spark, sf):
    return _att(spark, sf).select("record_id", "target", "feature", r6(F.col("value")).alias("value"),
                                  r6(F.col("contribution")).alias("contribution"))


def q_global_importance(spark, sf):
    return X.global_importance(_att(spark, sf))


def q_local_top_k(spark, sf):
    return X.local_top_k(_att(spark, sf))


def q_local_summary(spark, sf):
    return X.local_summary(_att(spark, sf))


def q_explanation_text(spark, sf):
    return X.explanation_text(X.local_summary(_att(spark, sf)), fx.scores(spark, sf), LOWER, UPPER)


def q_group_top_features(spark, sf):
    return X.group_top_features(_att(spark, sf), _decisions(spark, sf), "decision")


def q_failure_features(spark, sf):
    return X.failure_features(_att(spark, sf))


def _tree_att(spark, sf):
    return CO.forest_attributions(_w(spark, sf), SENS, F.col("side") == "reference", F.col("side") == "current")


def q_tree_attributions(spark, sf):
    return _tree_att(spark, sf).select("record_id", "target", "feature", *[r6(F.col(c)).alias(c) for c in (
        "value", "contribution", "base_value", "score")])


def q_tree_importance(spark, sf):
    return X.global_importance(cut_lineage(_tree_att(spark, sf)))


def q_review_queue(spark, sf):
    s = fx.scores(spark, sf)
    u = s.select("record_id", "target", "probability", (1 - F.col("confidence")).alias("uncertainty"),
                 PO.assign_decision(F.col("probability"), LOWER, UPPER).alias("decision"))
    return X.review_queue(u)


def _prio(spark, sf):
    w = _snap(spark, sf)
    att = X.attributions(w, SENS)
    return PR.sensor_priority(att, w, SENS, X.global_importance(att), X.failure_features(att, None))


def q_importance_reference(spark, sf):
    gi = X.global_importance(_att(spark, sf))
    return PR.importance_reference(gi, "mean_absolute_contribution", "importance_normalized").select(
        "feature", r6(F.col("importance_normalized")).alias("importance_normalized"))


def q_percentile_rank(spark, sf):
    w = _snap(spark, sf)
    t = PR.percentile_ranks(X.attributions(w, SENS).select("record_id", "feature", "contribution"),
                            {"contribution_percentile": F.abs(F.col("contribution"))}, "record_id", w.count() * len(SENS))
    return t.select("record_id", "feature", r6(F.col("contribution_percentile")).alias("contribution_percentile"))


def q_sensor_priority(spark, sf):
    return _prio(spark, sf)


def q_priority_levels(spark, sf):
    return _prio(spark, sf).select("record_id", "feature", "priority_score", "priority_level", "deviation_level")


def q_record_priority_summary(spark, sf):
    return PR.record_priority_summary(_prio(spark, sf))


def q_sensor_priority_rollups(spark, sf):
    return PR.sensor_priority_rollups(_prio(spark, sf), _decisions(spark, sf))


def q_tree_sensor_priority(spark, sf):
    w = _snap(spark, sf)
    att = cut_lineage(CO.forest_attributions(w, SENS, F.col("side") == "reference", F.col("side") == "current"))
    return PR.sensor_priority(att, w, SENS, X.global_importance(att), X.failure_features(att, None))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

K = len(SENS)
_ROWMISS = "(" + " + ".join(f"CASE WHEN {s} IS NULL THEN 1 ELSE 0 END" for s in SENS) + ")"


def _cut(expr, edges, labels):
    return "(CASE " + " ".join(f"WHEN {expr} > {edges[i]!r} AND {expr} <= {edges[i + 1]!r} THEN '{labels[i]}'"
                               for i in range(len(labels))) + " END)"


_EG = """(CASE WHEN target = 1 AND pred = 1 THEN 'Detected Failure' WHEN target = 1 AND pred = 0 THEN 'Missed Failure'
   WHEN target = 0 AND pred = 1 THEN 'False Alarm' ELSE 'Correct Pass' END)"""

_EM = [
    f"""em0 AS (SELECT s.record_id, w.ts, s.target, s.probability AS p, s.ood_percentile AS anomaly,
      1 - {_ROWMISS.replace('CASE WHEN ', 'CASE WHEN w.')} / {K} AS quality,
      CASE WHEN s.probability >= {THRESHOLD!r} THEN 1 ELSE 0 END AS pred
    FROM scores s LEFT JOIN wide_records w USING (record_id))""",
    f"""em1 AS (SELECT record_id, ts, target, round(p, 6) AS probability, pred AS predicted_target, {_EG} AS error_group,
      CASE WHEN target = 1 AND pred = 0 THEN 'Missed Failure' WHEN target = 0 AND pred = 1 THEN 'False Alarm' ELSE 'Correct' END AS error_type,
      round(p - {THRESHOLD!r}, 6) AS margin_to_threshold,
      round(CASE WHEN pred = 1 THEN p ELSE 1 - p END, 6) AS prediction_confidence,
      {_cut('p', E.PROBABILITY_EDGES, E.PROBABILITY_BANDS)} AS probability_band,
      {_cut('(CASE WHEN pred = 1 THEN p ELSE 1 - p END)', E.CONFIDENCE_EDGES, E.CONFIDENCE_BANDS)} AS confidence_band,
      round(quality, 6) AS quality_score, round(anomaly, 6) AS anomaly_score, strftime(ts, '%Y-%m-%d') AS production_date,
      hour(ts) AS production_hour, dayname(ts) AS production_day, {_cut('hour(ts)', E.SHIFT_EDGES, E.SHIFTS)} AS shift FROM em0)""",
    """qe AS (SELECT list_sort(list_distinct(quantile_cont(quality_score, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS e FROM em1)""",
    """em AS (SELECT em1.*, CASE WHEN quality_score IS NULL THEN NULL ELSE 'Q' || CAST(len(list_filter(
        list_slice(qe.e, 2, len(qe.e) - 1), lambda x: quality_score > x)) + 1 AS VARCHAR) END AS quality_quartile FROM em1, qe)""",
]


def _with(*extra, views=("wide_records", "scores")):
    return fx.sql_with(*views, extra=list(extra))


_AUCSEG = """rs AS (SELECT segment, probability AS score, count(*) FILTER (WHERE target = 1) AS pos,
    count(*) FILTER (WHERE target = 0) AS neg FROM seg GROUP BY segment, probability),
  rk AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY segment) AS tot_pos,
    sum(neg) OVER (PARTITION BY segment) AS tot_neg FROM rs
    WINDOW w AS (PARTITION BY segment ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  auc AS (SELECT segment, CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN
      sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (max(tot_pos) * max(tot_neg)) END AS roc_auc,
    CASE WHEN max(tot_pos) > 0 THEN sum(CASE WHEN pos > 0 THEN (pos / tot_pos) * ((tot_pos - (cum_pos - pos)) /
      ((tot_pos - (cum_pos - pos)) + (tot_neg - (cum_neg - neg)))) ELSE 0.0 END) END AS average_precision FROM rk GROUP BY segment)"""

# erfc polynomial, same constants as the Spark expression
_C = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223,
      0.17087277]


def _erfc(x):
    t = f"(1.0 / (1.0 + 0.5 * abs({x})))"
    poly = f"{_C[-1]!r}"
    for c in reversed(_C[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    ans = f"({t} * exp(-abs({x}) * abs({x}) + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


_LONG_ALL = "lg AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT record_id, '{s}' AS feature, {s} AS value FROM wide_records" for s in SENS) + ")"


def _mw(comparison, ga, gb):
    n = comparison
    return [
        f"""{n}_v AS (SELECT lg.feature, lg.value, em.error_group FROM lg JOIN em USING (record_id)
          WHERE em.error_group IN ('{ga}', '{gb}') AND lg.value IS NOT NULL)""",
        f"""{n}_c AS (SELECT feature, value, count(*) FILTER (WHERE error_group = '{ga}') AS ca,
          count(*) FILTER (WHERE error_group = '{gb}') AS cb, count(*) AS ct FROM {n}_v GROUP BY feature, value)""",
        f"""{n}_r AS (SELECT *, sum(ct) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM {n}_c)""",
        f"""{n}_s AS (SELECT feature, sum(ca * ((cum - ct) + (ct + 1) / 2.0)) AS ra, sum(ca) AS n, sum(cb) AS m,
          sum(power(ct, 3) - ct) AS ties FROM {n}_r GROUP BY feature)""",
        f"""{n}_med AS (SELECT feature, quantile_cont(value, 0.5) FILTER (WHERE error_group = '{ga}') AS med_a,
          quantile_cont(value, 0.5) FILTER (WHERE error_group = '{gb}') AS med_b FROM {n}_v GROUP BY feature)""",
        f"""{n}_z AS (SELECT f.feature, s.n, s.m, s.ra - s.n * (s.n + 1) / 2.0 AS u,
          sqrt(s.n * s.m / 12.0 * ((s.n + s.m + 1) - s.ties / ((s.n + s.m) * (s.n + s.m - 1)))) AS sigma, med_a, med_b
          FROM (SELECT unnest([{', '.join(repr(x) for x in SENS)}]) AS feature) f LEFT JOIN {n}_s s USING (feature)
          LEFT JOIN {n}_med USING (feature))""",
        f"""{n} AS (SELECT '{comparison}' AS comparison, feature, '{ga}' AS group_a, '{gb}' AS group_b,
          CAST(coalesce(n, 0) AS BIGINT) AS group_a_count, CAST(coalesce(m, 0) AS BIGINT) AS group_b_count,
          round(CASE WHEN n >= 3 AND m >= 3 THEN med_a END, 6) AS group_a_median,
          round(CASE WHEN n >= 3 AND m >= 3 THEN med_b END, 6) AS group_b_median,
          round(CASE WHEN n >= 3 AND m >= 3 THEN med_a - med_b END, 6) AS median_difference,
          round(CASE WHEN n >= 3 AND m >= 3 THEN 2.0 * u / (n * m) - 1.0 END, 6) AS rank_biserial_effect,
          round(CASE WHEN n >= 3 AND m >= 3 THEN abs(2.0 * u / (n * m) - 1.0) END, 6) AS absolute_effect,
          round(CASE WHEN n >= 3 AND m >= 3 AND sigma > 0 THEN least(1.0,
            {_erfc('greatest((abs(u - n * m / 2.0) - 0.5) / sigma, 0.0) / sqrt(2.0)')}) END, 6) AS mann_whitney_p_value
          FROM {n}_z)""",
    ]


_MW_ALL = _mw(*E.COMPARISONS[0]) + _mw(*E.COMPARISONS[1])

# uncertainty -----------------------------------------------------------------
_SPREAD = """spread AS (SELECT record_id, count(*) AS members, round(avg(p), 6) AS member_mean, round(stddev_samp(p), 6) AS member_std,
    round(quantile_cont(p, 0.05), 6) AS interval_lower, round(quantile_cont(p, 0.95), 6) AS interval_upper,
    round(max(p) - min(p), 6) AS member_range, round(quantile_cont(p, 0.95) - quantile_cont(p, 0.05), 6) AS interval_width
  FROM members GROUP BY record_id)"""


def _urn(v, s):
    return f"(CASE WHEN {s} > 1e-12 THEN least(greatest({v} / {s}, 0.0), 1.0) ELSE 0.0 END)"


_MARGIN = f"least(greatest(least(abs(probability - {LOWER!r}), abs(probability - {UPPER!r})) / {max(LOWER, 1.0 - UPPER, UPPER - LOWER, 1e-8)!r}, 0.0), 1.0)"
_DW, _CW = U.DATA_WEIGHTS, U.CONFIDENCE_WEIGHTS
_UNC = [
    _SPREAD,
    f"""ub0 AS (SELECT s.record_id, s.target, s.side, s.probability, s.ood_percentile, s.failed_neighbour_count,
      1 - {_ROWMISS.replace('CASE WHEN ', 'CASE WHEN w.')} / {K} AS completeness, sp.* EXCLUDE (record_id)
    FROM scores s JOIN wide_records w USING (record_id) JOIN spread sp USING (record_id))""",
    """nref AS (SELECT failed_neighbour_count AS v FROM ub0 WHERE side = 'reference')""",
    """ub AS (SELECT ub0.*, (SELECT count(*) FROM nref WHERE nref.v <= ub0.failed_neighbour_count) / (SELECT count(*) FROM nref)
      AS neighbour_percentile FROM ub0)""",
    """q1 AS (SELECT quantile_cont(member_std, 0.95) AS qs, quantile_cont(member_range, 0.95) AS qr,
      quantile_cont(ood_percentile, 0.975) AS qo FROM ub WHERE side = 'reference')""",
    f"""uc0 AS (SELECT ub.*, q1.qo, 1 - {_urn('member_std', 'qs')} AS model_agreement, 1 - {_urn('member_range', 'qr')} AS prediction_stability,
      {_DW['completeness']!r} * completeness + {_DW['ood']!r} * (1 - ood_percentile) + {_DW['neighbour']!r} * (1 - neighbour_percentile) AS data_confidence,
      {_MARGIN} AS decision_margin FROM ub, q1)""",
    f"""uc1 AS (SELECT *, {_CW['agreement']!r} * model_agreement + {_CW['stability']!r} * prediction_stability
      + {_CW['data']!r} * data_confidence + {_CW['margin']!r} * decision_margin AS prediction_confidence FROM uc0)""",
    """uc2 AS (SELECT *, 1 - prediction_confidence AS combined_uncertainty FROM uc1)""",
    """q2 AS (SELECT quantile_cont(combined_uncertainty, 0.5) AS u50, quantile_cont(combined_uncertainty, 0.95) AS u95,
      quantile_cont(prediction_confidence, 0.1) AS c10 FROM uc2 WHERE side = 'reference')""",
    f"""uc3 AS (SELECT uc2.*, q2.*, CASE WHEN probability < {LOWER!r} THEN 'Low Risk' WHEN probability >= {UPPER!r} THEN 'High Risk'
      ELSE 'Engineering Review' END AS original_decision FROM uc2, q2)""",
    f"""uc AS (SELECT *, original_decision IN ('Low Risk', 'High Risk') AND (ood_percentile >= qo OR (prediction_confidence < c10
      AND combined_uncertainty >= u95)) AS abstain FROM uc3)""",
    f"""ur AS (SELECT record_id, target, side, probability AS calibrated_failure_probability, members, member_mean,
      member_std, interval_lower, interval_upper, interval_width, completeness, ood_percentile, neighbour_percentile,
      model_agreement, prediction_stability, data_confidence, decision_margin, prediction_confidence, combined_uncertainty,
      CASE WHEN combined_uncertainty < u50 THEN 'Low' WHEN combined_uncertainty < u95 THEN 'Moderate' ELSE 'High' END AS uncertainty_band,
      CASE WHEN prediction_confidence >= 0.8 THEN 'Very High' WHEN prediction_confidence >= 0.6 THEN 'High'
           WHEN prediction_confidence >= 0.4 THEN 'Moderate' ELSE 'Low' END AS confidence_band,
      original_decision, CASE WHEN abstain THEN 'Insufficient Evidence' ELSE original_decision END AS uncertainty_adjusted_decision,
      CASE WHEN abstain AND ood_percentile >= qo THEN '{U.REASONS['ood']}' WHEN abstain THEN '{U.REASONS['conflict']}' END AS abstention_reason
    FROM uc)""",
    """uo AS (SELECT record_id, target, side, round(calibrated_failure_probability, 6) AS calibrated_failure_probability,
      members, round(member_mean, 6) AS member_mean, round(member_std, 6) AS member_std, round(interval_lower, 6) AS interval_lower,
      round(interval_upper, 6) AS interval_upper, round(interval_width, 6) AS interval_width, round(completeness, 6) AS completeness,
      round(ood_percentile, 6) AS ood_percentile, round(neighbour_percentile, 6) AS neighbour_percentile,
      round(model_agreement, 6) AS model_agreement, round(prediction_stability, 6) AS prediction_stability,
      round(data_confidence, 6) AS data_confidence, round(decision_margin, 6) AS decision_margin,
      round(prediction_confidence, 6) AS prediction_confidence, round(combined_uncertainty, 6) AS combined_uncertainty,
      uncertainty_band, confidence_band, original_decision, uncertainty_adjusted_decision, abstention_reason FROM ur)""",
]

# explanations -----------------------------------------------------------------
_COEF = X.coefficients(SENS)
_ATT = [
    """st AS (SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM long_records WHERE side = 'reference' GROUP BY feature)""",
    "coef AS (SELECT * FROM (VALUES " + ", ".join(f"('{f}', {c!r})" for f, c in _COEF.items()) + ") t(feature, c))",
    """att AS (SELECT l.record_id, l.target, l.feature, l.value,
      coef.c * CASE WHEN st.s IS NULL OR st.s = 0 OR l.value IS NULL THEN 0.0 ELSE (l.value - st.m) / st.s END AS contribution
    FROM long_records l JOIN st USING (feature) JOIN coef USING (feature) WHERE l.side = 'current')""",
    """gi AS (SELECT feature, avg(abs(contribution)) AS mean_abs, avg(contribution) AS mean_c,
      avg(CASE WHEN contribution > 0 THEN 1 ELSE 0 END) AS share_pos FROM att GROUP BY feature)""",
    """gi1 AS (SELECT *, mean_abs / sum(mean_abs) OVER () AS rel FROM gi)""",
    """gi2 AS (SELECT feature, round(mean_abs, 6) AS mean_absolute_contribution, round(mean_c, 6) AS mean_contribution,
      round(share_pos, 6) AS share_positive, round(rel, 6) AS relative_importance,
      round(sum(rel) OVER (ORDER BY rel DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cumulative_importance,
      row_number() OVER (ORDER BY rel DESC, feature) AS importance_rank FROM gi1)""",
    """ls AS (SELECT record_id, round(sum(CASE WHEN contribution > 0 THEN contribution ELSE 0.0 END), 6) AS positive_total,
      round(sum(CASE WHEN contribution < 0 THEN contribution ELSE 0.0 END), 6) AS negative_total,
      coalesce(array_to_string(list_slice(list(feature ORDER BY contribution DESC, feature) FILTER (WHERE contribution > 0), 1, 5), ','), '') AS top_risk_features,
      coalesce(array_to_string(list_slice(list(feature ORDER BY contribution ASC, feature) FILTER (WHERE contribution < 0), 1, 5), ','), '') AS top_protective_features
    FROM att GROUP BY record_id)""",
    """ff AS (SELECT feature, count(*) AS failures, round(avg(abs(contribution)), 6) AS mean_absolute_contribution,
      round(avg(CASE WHEN contribution > 0 THEN 1 ELSE 0 END), 6) AS share_positive,
      row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS feature_rank FROM att WHERE target = 1 GROUP BY feature)""",
    f"""dec AS (SELECT record_id, target, CASE WHEN probability < {LOWER!r} THEN 'Low Risk' WHEN probability >= {UPPER!r}
      THEN 'High Risk' ELSE 'Engineering Review' END AS decision FROM scores)""",
]

# priority -----------------------------------------------------------------------


def _pr(v):
    return (f"(CASE WHEN min(coalesce({v}, 0.0)) OVER (PARTITION BY record_id) = max(coalesce({v}, 0.0)) OVER (PARTITION BY record_id)"
            f" THEN 0.5 ELSE (rank() OVER (PARTITION BY record_id ORDER BY coalesce({v}, 0.0))"
            f" + (count(*) OVER (PARTITION BY record_id, coalesce({v}, 0.0)) - 1) / 2.0)"
            f" / count(*) OVER (PARTITION BY record_id) END)")


_PRIO = [
    """pq AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
      FROM long_records WHERE side = 'reference' AND value IS NOT NULL GROUP BY feature)""",
    """impn AS (SELECT feature, mean_absolute_contribution / max(mean_absolute_contribution) OVER () AS importance_normalized FROM gi2)""",
    """recn AS (SELECT feature, mean_absolute_contribution / max(mean_absolute_contribution) OVER () AS recurrence_normalized
      FROM ff)""",
    """pt AS (SELECT a.record_id, a.feature, a.value, a.contribution,
      (a.value - pq.med) / CASE WHEN abs(pq.q3 - pq.q1) < 1e-12 THEN 1.0 ELSE pq.q3 - pq.q1 END AS robust_z,
      a.value IS NULL AS is_missing, coalesce(importance_normalized, 0.0) AS importance_normalized,
      coalesce(recurrence_normalized, 0.0) AS recurrence_normalized
    FROM att a LEFT JOIN pq USING (feature) LEFT JOIN impn USING (feature) LEFT JOIN recn USING (feature))""",
    f"""ps AS (SELECT *, ({_pr('greatest(contribution, 0.0)')} + {_pr('abs(robust_z)')} + {_pr('importance_normalized')}
      + {_pr('recurrence_normalized')}) / 4.0 AS priority_score FROM pt)""",
    """pl AS (SELECT record_id, feature, round(value, 6) AS value, round(contribution, 6) AS contribution, round(robust_z, 6) AS robust_z, is_missing,
      round(importance_normalized, 6) AS importance_normalized, round(recurrence_normalized, 6) AS recurrence_normalized,
      round(priority_score, 6) AS priority_score,
      CASE WHEN is_missing THEN 'Data Verification' WHEN priority_score >= 0.8 AND contribution > 0 THEN 'Very High'
           WHEN priority_score >= 0.65 AND contribution > 0 THEN 'High' WHEN priority_score >= 0.45 THEN 'Moderate' ELSE 'Low' END AS priority_level,
      CASE WHEN is_missing THEN 'Missing Measurement' WHEN abs(robust_z) >= 3.0 THEN 'Extreme Deviation'
           WHEN abs(robust_z) >= 1.5 THEN 'Moderate Deviation' WHEN abs(robust_z) >= 1.0 THEN 'Mild Deviation' ELSE 'Within Typical Range' END AS deviation_level,
      coalesce(nullif(concat_ws('; ', CASE WHEN is_missing THEN 'measurement missing' END,
        CASE WHEN contribution > 0 THEN 'raises the failure score' END,
        CASE WHEN abs(robust_z) >= 1.5 THEN 'far from the reference median' END,
        CASE WHEN importance_normalized >= 0.5 THEN 'globally important' END,
        CASE WHEN recurrence_normalized >= 0.5 THEN 'recurs in failures' END), ''), 'no notable signal') AS reason,
      row_number() OVER (PARTITION BY record_id ORDER BY priority_score DESC, feature) AS priority_rank FROM ps)""",
    """prio AS (SELECT * FROM pl WHERE priority_rank <= 10)""",
]


def _wx(*extra):
    return fx.sql_with("wide_records", "scores", "long_records", extra=_ATT + list(extra))


_ROLL = """SELECT {scope} AS scope, feature, count(*) AS times_in_top_ten, count(*) FILTER (WHERE priority_rank = 1) AS times_first,
    (2 * sum(CAST(round(priority_score * 1000000) AS BIGINT)) + count(*)) // (2 * count(*)) / 1000000 AS mean_priority_score, count(*) FILTER (WHERE priority_level = 'Very High') AS very_high_count
  FROM prio JOIN dec USING (record_id) {where} GROUP BY {group}"""

SQL = {
    "error_master": _with(*_EM) + "SELECT * FROM em",
    "segment_metrics": _with(*_EM, "seg AS (SELECT coalesce(CAST(shift AS VARCHAR), 'Unknown') AS segment, * FROM em)", _AUCSEG)
    + """, a AS (SELECT segment, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        count(*) FILTER (WHERE target = 1 AND predicted_target = 1) AS tp, count(*) FILTER (WHERE target = 0 AND predicted_target = 1) AS fp,
        count(*) FILTER (WHERE target = 1 AND predicted_target = 0) AS fn, count(*) FILTER (WHERE target = 0 AND predicted_target = 0) AS tn,
        avg(probability) AS mp, avg(quality_score) AS mq, avg(anomaly_score) AS ma FROM seg GROUP BY segment)
      SELECT 'shift' AS segment_column, segment, records, failures, tp, fp, fn, tn, round(failures / records, 6) AS failure_rate,
        round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
        round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
        round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END, 6) AS false_alarm_rate,
        round(mp, 6) AS mean_probability, round(mq, 6) AS mean_quality, round(ma, 6) AS mean_anomaly,
        round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM a LEFT JOIN auc USING (segment)""",
    "error_type_summary": _with(*_EM) + """SELECT error_type, count(*) AS records, round(avg(probability), 6) AS mean_probability,
        round(quantile_cont(probability, 0.5), 6) AS median_probability, round(avg(quality_score), 6) AS mean_quality,
        round(avg(anomaly_score), 6) AS mean_anomaly, round(avg(prediction_confidence), 6) AS mean_confidence FROM em GROUP BY error_type""",
    "error_rankings": _with(*_EM) + """SELECT error_type, CAST(row_number() OVER (PARTITION BY error_type ORDER BY
        CASE WHEN error_type = 'Missed Failure' THEN probability ELSE -probability END, record_id) AS BIGINT) AS error_rank,
        record_id, probability, prediction_confidence, quality_score, anomaly_score FROM em
      WHERE error_type IN ('Missed Failure', 'False Alarm')""",
    "error_groups": _with(*_EM) + "SELECT record_id, target, predicted_target, error_group FROM em",
    "mann_whitney": _with(*_EM, _LONG_ALL, *_mw(*E.COMPARISONS[0])) + f"SELECT * FROM {E.COMPARISONS[0][0]}",
    "error_diagnostics": _with(*_EM, _LONG_ALL, *_MW_ALL) + f""", d AS (SELECT * FROM {E.COMPARISONS[0][0]}
        UNION ALL SELECT * FROM {E.COMPARISONS[1][0]})
      SELECT *, coalesce(mann_whitney_p_value < {E.SIGNIFICANCE / K!r}, false) AS adjusted_significance_flag,
        row_number() OVER (ORDER BY absolute_effect DESC NULLS LAST, comparison, feature) AS diagnostic_rank FROM d""",
    "ensemble_spread": fx.sql_with("wide_records", "members", extra=[_SPREAD]) + "SELECT * FROM spread",
    "percentile_normalise": fx.sql_with("wide_records", "scores") + """, r AS (SELECT failed_neighbour_count AS v FROM scores WHERE side = 'reference')
      SELECT record_id, failed_neighbour_count, round((SELECT count(*) FROM r WHERE r.v <= s.failed_neighbour_count) /
        (SELECT count(*) FROM r), 6) AS neighbour_percentile FROM scores s""",
    "upper_reference_normalise": fx.sql_with("wide_records", "members", extra=[_SPREAD]) + f""", sp AS (SELECT spread.*, w.side FROM spread
        JOIN wide_records w USING (record_id)), q AS (SELECT quantile_cont(member_std, 0.95) AS qs FROM sp WHERE side = 'reference')
      SELECT record_id, member_std, round({_urn('member_std', 'qs')}, 6) AS normalised_spread FROM sp, q""",
    "decision_margin": fx.sql_with("wide_records", "scores") + f"SELECT record_id, round({_MARGIN}, 6) AS decision_margin FROM scores",
    "confidence_components": fx.sql_with("wide_records", "scores", "members", extra=_UNC) + """SELECT record_id, completeness,
        ood_percentile, neighbour_percentile, model_agreement, prediction_stability, data_confidence, decision_margin,
        prediction_confidence, combined_uncertainty FROM uo""",
    "uncertainty_bands": fx.sql_with("wide_records", "scores", "members", extra=_UNC)
    + "SELECT record_id, uncertainty_band, confidence_band FROM uo",
    "abstention": fx.sql_with("wide_records", "scores", "members", extra=_UNC)
    + "SELECT record_id, original_decision, uncertainty_adjusted_decision, abstention_reason FROM uo",
    "uncertainty_output": fx.sql_with("wide_records", "scores", "members", extra=_UNC) + "SELECT * FROM uo",
    "uncertainty_decision_summary": fx.sql_with("wide_records", "scores", "members", extra=_UNC) + """,
      dom AS (SELECT * FROM (VALUES (0, 'Low Risk'), (1, 'Engineering Review'), (2, 'High Risk'), (3, 'Insufficient Evidence')) t(decision_order, decision)),
      agg AS (SELECT uncertainty_adjusted_decision AS decision, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        count(*) FILTER (WHERE target = 0) AS passes, avg(calibrated_failure_probability) AS mp FROM ur GROUP BY 1)
      SELECT decision_order, decision, CAST(coalesce(records, 0) AS BIGINT) AS records,
        round(CASE WHEN sum(coalesce(records, 0)) OVER () > 0 THEN coalesce(records, 0) / sum(coalesce(records, 0)) OVER () ELSE 0.0 END, 6) AS share,
        CAST(coalesce(failures, 0) AS BIGINT) AS failures, CAST(coalesce(passes, 0) AS BIGINT) AS passes,
        round(CASE WHEN coalesce(records, 0) > 0 THEN failures / records END, 6) AS observed_failure_rate,
        round(mp, 6) AS mean_probability FROM dom LEFT JOIN agg USING (decision)""",
    "band_performance": fx.sql_with("wide_records", "scores", "members", extra=_UNC) + """SELECT 'uncertainty_band' AS band_column,
        uncertainty_band AS band, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        count(*) FILTER (WHERE target = 1 AND uncertainty_adjusted_decision = 'Low Risk') AS unsafe_low_risk,
        count(*) FILTER (WHERE target = 1 AND uncertainty_adjusted_decision = 'High Risk') AS high_risk_failures,
        count(*) FILTER (WHERE target = 1 AND uncertainty_adjusted_decision IN ('Engineering Review', 'Insufficient Evidence')) AS review_or_abstain_failures,
        round(avg(calibrated_failure_probability), 6) AS mean_probability, round(avg(prediction_confidence), 6) AS mean_confidence,
        round(avg(combined_uncertainty), 6) AS mean_uncertainty FROM ur GROUP BY uncertainty_band""",
    "attributions": _wx() + "SELECT record_id, target, feature, round(value, 6) AS value, round(contribution, 6) AS contribution FROM att",
    "global_importance": _wx() + "SELECT * FROM gi2",
    "local_top_k": _wx() + """, r AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY abs(contribution) DESC, feature) AS rank FROM att)
      SELECT record_id, rank, feature, round(value, 6) AS value, round(contribution, 6) AS contribution, CASE WHEN contribution > 0 THEN 'increases risk'
        WHEN contribution < 0 THEN 'decreases risk' ELSE 'neutral' END AS direction FROM r WHERE rank <= 10""",
    "local_summary": _wx() + "SELECT * FROM ls",
    "explanation_text": _wx() + f""", t AS (SELECT ls.*, s.probability, s.confidence,
        CASE WHEN s.probability < {LOWER!r} THEN 'Low Risk' WHEN s.probability >= {UPPER!r} THEN 'High Risk' ELSE 'Engineering Review' END AS decision,
        array_to_string(list_slice(string_split(top_risk_features, ','), 1, 3), ',') AS top3 FROM ls JOIN scores s USING (record_id))
      SELECT record_id, decision, printf('%s: failure probability %.3f, confidence %.2f; main risk drivers: %s', decision,
        round(probability, 3), round(confidence, 2), CASE WHEN top3 = '' THEN 'none' ELSE top3 END) AS explanation_text FROM t""",
    "group_top_features": _wx() + """, g AS (SELECT decision, feature, avg(abs(contribution)) AS m, avg(contribution) AS mc
        FROM att JOIN dec USING (record_id) GROUP BY decision, feature),
      r AS (SELECT decision, feature, round(m, 6) AS mean_absolute_contribution, round(mc, 6) AS mean_contribution,
        row_number() OVER (PARTITION BY decision ORDER BY m DESC, feature) AS feature_rank FROM g)
      SELECT * FROM r WHERE feature_rank <= 20""",
    "failure_features": _wx() + "SELECT * FROM ff WHERE feature_rank <= 20",
    "review_queue": fx.sql_with("wide_records", "scores") + f""", u AS (SELECT record_id, target, probability, 1 - confidence AS uncertainty,
        CASE WHEN probability < {LOWER!r} THEN 'Low Risk' WHEN probability >= {UPPER!r} THEN 'High Risk' ELSE 'Engineering Review' END AS decision FROM scores)
      SELECT record_id, target, decision, probability, uncertainty, CASE decision WHEN 'High Risk' THEN 0 WHEN 'Insufficient Evidence' THEN 1
        WHEN 'Engineering Review' THEN 2 ELSE 3 END AS decision_priority FROM u
      ORDER BY target DESC, decision_priority, probability DESC, uncertainty DESC, record_id LIMIT 25""",
    "importance_reference": _wx() + """SELECT feature, round(mean_absolute_contribution / max(mean_absolute_contribution) OVER (), 6)
        AS importance_normalized FROM gi2""",
    "percentile_rank": _wx() + f"SELECT record_id, feature, round({_pr('abs(contribution)')}, 6) AS contribution_percentile FROM att",
    "sensor_priority": _wx(*_PRIO) + "SELECT * FROM prio",
    "priority_levels": _wx(*_PRIO) + "SELECT record_id, feature, priority_score, priority_level, deviation_level FROM prio",
    "record_priority_summary": _wx(*_PRIO) + """, r AS (SELECT record_id, max(CASE WHEN priority_rank = 1 THEN feature END) AS top_sensor,
        array_to_string(list(feature ORDER BY priority_rank) FILTER (WHERE priority_rank <= 5), ',') AS top_five_sensors,
        count(*) FILTER (WHERE priority_level = 'Very High') AS very_high_count, count(*) FILTER (WHERE priority_level = 'High') AS high_count,
        count(*) FILTER (WHERE is_missing) AS missing_count FROM prio GROUP BY record_id)
      SELECT *, printf('Start with %s; %d very high and %d high priority sensors in the top ten', top_sensor, very_high_count, high_count)
        AS summary_text FROM r""",
    "sensor_priority_rollups": _wx(*_PRIO) + ", u AS (" + _ROLL.format(scope="'all'", where="", group="feature")
    + " UNION ALL " + _ROLL.format(scope="'failures'", where="WHERE target = 1", group="feature")
    + " UNION ALL " + _ROLL.format(scope="'decision:' || decision", where="", group="decision, feature") + """),
      r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY times_in_top_ten DESC, mean_priority_score DESC, feature) AS rollup_rank FROM u)
      SELECT * FROM r WHERE rollup_rank <= 30""",
}
