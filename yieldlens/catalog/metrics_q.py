"""Registered evaluation / threshold / policy queries and their DuckDB twins.

Inputs: ``scores`` (one fixed probability per record) and the five ensemble
``members`` used as five competing models ("member_0" .. "member_4").
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import policy as PO
from ..sources import fixtures as fx

LOWER, UPPER = 0.035, 0.08
THRESHOLD = 0.5


def _scores(spark, sf_dir):
    return fx.scores(spark, sf_dir)


def model_scores(spark, sf_dir):
    w = fx.wide_records(spark, sf_dir)
    m = fx.members(spark, sf_dir, w)
    t = w.select("record_id", "target")
    return m.join(t, "record_id").select(
        F.concat(F.lit("member_"), F.col("member").cast("string")).alias("model"), "record_id", "target",
        F.col("p").alias("probability"))


def q_confusion_metrics(spark, sf_dir):
    return M.confusion_metrics(model_scores(spark, sf_dir), ["model"], THRESHOLD)


def q_roc_auc(spark, sf_dir):
    from ..functions.expressions import r6
    r = M.ranked_scores(model_scores(spark, sf_dir), ["model"])
    return M.roc_auc(r, ["model"]).select("model", r6(F.col("roc_auc")).alias("roc_auc"))


def q_average_precision(spark, sf_dir):
    from ..functions.expressions import r6
    r = M.ranked_scores(model_scores(spark, sf_dir), ["model"])
    return M.average_precision(r, ["model"]).select("model", r6(F.col("average_precision")).alias("average_precision"))


def q_brier_log_loss(spark, sf_dir):
    return M.brier_log_loss(model_scores(spark, sf_dir), ["model"])


def q_curve_points(spark, sf_dir):
    return M.curve_points(M.ranked_scores(_scores(spark, sf_dir), []), [])


def q_best_f1_threshold(spark, sf_dir):
    return M.best_f1_threshold(M.ranked_scores(model_scores(spark, sf_dir), ["model"]), ["model"])


def q_threshold_sweep(spark, sf_dir):
    return M.threshold_sweep(_scores(spark, sf_dir))


def q_cost_sweep(spark, sf_dir):
    return M.cost_sweep(model_scores(spark, sf_dir), ["model"])


def q_select_threshold_precision(spark, sf_dir):
    return M.select_threshold_precision(M.threshold_sweep(model_scores(spark, sf_dir), ["model"]), ["model"])


def q_select_threshold_cost(spark, sf_dir):
    return M.select_threshold_cost(M.cost_sweep(model_scores(spark, sf_dir), ["model"]), ["model"])


def q_select_model(spark, sf_dir):
    return M.select_model(M.model_comparison(model_scores(spark, sf_dir)))


def q_prediction_table(spark, sf_dir):
    return M.prediction_table(_scores(spark, sf_dir), THRESHOLD, extra=["ts"])


def q_calibration_bins(spark, sf_dir):
    return M.calibration_bins(model_scores(spark, sf_dir), ["model"])


def q_calibration_error(spark, sf_dir):
    return M.calibration_error(model_scores(spark, sf_dir), ["model"])


def q_rank_calibrators(spark, sf_dir):
    ms = model_scores(spark, sf_dir)
    e = M.calibration_error(ms, ["model"])
    b = M.brier_log_loss(ms, ["model"])
    from pyspark.sql import Window
    t = e.join(b, "model").select("model", "ece", "mce", "brier_score",
                                  F.round(F.col("brier_score") + F.col("ece") + 0.25 * F.col("mce"), 6).alias(
                                      "calibration_score"))
    return t.withColumn("calibration_rank", F.row_number().over(
        Window.partitionBy().orderBy("calibration_score", "model")))  # one row per calibrator


def q_assign_decision(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("record_id", "target", PO.assign_decision(F.col("probability"), LOWER, UPPER).alias("decision"))


def q_policy_metrics(spark, sf_dir):
    return PO.policy_metrics(_scores(spark, sf_dir), [], LOWER, UPPER)


def q_policy_grid(spark, sf_dir):
    return PO.policy_grid(_scores(spark, sf_dir))


def q_select_policy(spark, sf_dir):
    return PO.select_policy(PO.policy_grid(model_scores(spark, sf_dir), ["model"]), ["model"])


def q_decision_summary(spark, sf_dir):
    s = _scores(spark, sf_dir).withColumn("decision", PO.assign_decision(F.col("probability"), LOWER, UPPER))
    return PO.decision_summary(s, "decision")


def q_decide_batch(spark, sf_dir):
    return PO.decide_batch(_scores(spark, sf_dir), LOWER, UPPER)


QUERIES = {
    "confusion_metrics": q_confusion_metrics,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "brier_log_loss": q_brier_log_loss,
    "curve_points": q_curve_points,
    "best_f1_threshold": q_best_f1_threshold,
    "threshold_sweep": q_threshold_sweep,
    "cost_sweep": q_cost_sweep,
    "select_threshold_precision": q_select_threshold_precision,
    "select_threshold_cost": q_select_threshold_cost,
    "select_model": q_select_model,
    "prediction_table": q_prediction_table,
    "calibration_bins": q_calibration_bins,
    "calibration_error": q_calibration_error,
    "rank_calibrators": q_rank_calibrators,
    "assign_decision": q_assign_decision,
    "policy_metrics": q_policy_metrics,
    "policy_grid": q_policy_grid,
    "select_policy": q_select_policy,
    "decision_summary": q_decision_summary,
    "decide_batch": q_decide_batch,
}

# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_MS = """ms AS (SELECT 'member_' || CAST(m.member AS VARCHAR) AS model, m.record_id, w.target, m.p AS probability
  FROM members m JOIN wide_records w USING (record_id))"""


def _w(*extra, scores=False):
    views = ("wide_records", "members") if not scores else ("wide_records", "scores")
    return fx.sql_with(*views, extra=([_MS] if not scores else []) + list(extra))


def _div(a, b, d="0.0"):
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE {d} END)"


_P = _div("tp", "tp + fp")
_R = _div("tp", "tp + fn")
_F1 = _div(f"2 * {_P} * {_R}", f"{_P} + {_R}")
_BA = f"(({_R} + {_div('tn', 'tn + fp')}) / 2)"


def _grid(src, steps, k_from, k_to, keys=""):
    kc = f"{keys}, " if keys else ""
    return f"""gc AS (SELECT {kc}g.k, g.k / {float(steps)!r} AS threshold,
        count(*) FILTER (WHERE s.target = 1 AND s.probability >= g.k / {float(steps)!r}) AS tp,
        count(*) FILTER (WHERE s.target = 0 AND s.probability >= g.k / {float(steps)!r}) AS fp,
        count(*) FILTER (WHERE s.target = 1 AND s.probability < g.k / {float(steps)!r}) AS fn,
        count(*) FILTER (WHERE s.target = 0 AND s.probability < g.k / {float(steps)!r}) AS tn
      FROM {src} s, (SELECT CAST(range AS INTEGER) AS k FROM range({k_from}, {k_to + 1})) g GROUP BY {kc}g.k)"""


_RANKED = """rs AS (SELECT {keys} probability AS score, count(*) FILTER (WHERE target = 1) AS pos,
    count(*) FILTER (WHERE target = 0) AS neg FROM {src} GROUP BY {keys} probability),
  rk AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
    sum(pos) OVER (PARTITION BY {part}) AS tot_pos, sum(neg) OVER (PARTITION BY {part}) AS tot_neg FROM rs
    WINDOW w AS (PARTITION BY {part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _ranked(src="ms", keys="model"):
    return _RANKED.format(keys=f"{keys}," if keys else "", src=src, part=keys if keys else "1")


_TP = "(tot_pos - (cum_pos - pos))"
_FP = "(tot_neg - (cum_neg - neg))"

_SWEEP_COLS = f"""round(threshold, 6) AS threshold, round({_P}, 6) AS precision_fail, round({_R}, 6) AS recall_fail,
    round({_F1}, 6) AS f1_fail, round({_BA}, 6) AS balanced_accuracy, tn AS true_negative, fp AS false_positive,
    fn AS false_negative, tp AS true_positive"""
_COST_COLS = _SWEEP_COLS + f""", tp + fp AS alert_count, round((tp + fp) / (tp + fp + fn + tn), 6) AS alert_rate,
    round(CASE WHEN tp > 0 THEN fp / tp END, 6) AS false_alarms_per_detected_failure,
    round({M.MISSED_FAILURE_COST!r} * fn + {M.FALSE_ALARM_COST!r} * fp, 6) AS operational_cost"""


def _bin(p="probability", bins=M.CALIBRATION_BINS):
    return f"CAST(greatest(0, least(ceil({p} * {bins}) - 1, {bins - 1})) AS INTEGER)"


def _pick_sql(table, keys, elig, order_e, order_f, reasons, cols):
    kp = f"PARTITION BY {keys}" if keys else ""
    ords = ", ".join(f"CASE WHEN tier = 0 THEN {e} ELSE {f} END" for e, f in zip(order_e, order_f))
    return f"""t1 AS (SELECT *, max(CAST({elig} AS INTEGER)) OVER ({kp}) AS has FROM {table}),
  t2 AS (SELECT *, CASE WHEN has = 1 THEN CASE WHEN {elig} THEN 0 ELSE 2 END ELSE 1 END AS tier FROM t1),
  t3 AS (SELECT *, row_number() OVER ({kp} ORDER BY tier, {ords}) AS rn FROM t2)
  SELECT {cols}, CASE WHEN tier = 0 THEN '{reasons[0]}' ELSE '{reasons[1]}' END AS selection_reason FROM t3 WHERE rn = 1"""


_COSTSEL = _pick_sql(
    "cs", "model", f"recall_fail >= {M.MINIMUM_FAILURE_RECALL!r}",
    ["operational_cost", "false_positive", "-precision_fail", "-balanced_accuracy", "-threshold"],
    ["-recall_fail", "operational_cost", "false_positive", "-precision_fail", "-threshold"],
    ("lowest cost with failure recall >= 0.75", "recall target missed: highest recall"),
    "model, threshold, recall_fail, precision_fail, f1_fail, balanced_accuracy, true_negative, false_positive, "
    "false_negative, true_positive, alert_count, alert_rate, false_alarms_per_detected_failure, operational_cost",
)

# policy metric columns from the six zone x class counts lf lp rf rp hf hp
_POL = f"""CAST(lf + lp AS BIGINT) AS low_risk_records, CAST(rf + rp AS BIGINT) AS review_records,
    CAST(hf + hp AS BIGINT) AS high_risk_records, CAST(lf AS BIGINT) AS low_risk_failures, CAST(lp AS BIGINT) AS low_risk_passes,
    CAST(rf AS BIGINT) AS review_failures, CAST(rp AS BIGINT) AS review_passes, CAST(hf AS BIGINT) AS high_risk_failures,
    CAST(hp AS BIGINT) AS high_risk_passes,
    round({_div('lp', 'lf + lp', 'NULL')}, 6) AS low_risk_npv,
    round({_div('hf', 'hf + hp')}, 6) AS high_risk_precision,
    round({_div('lf', 'lf + rf + hf')}, 6) AS low_risk_failure_leakage,
    round({_div('hf', 'lf + rf + hf')}, 6) AS high_risk_failure_capture,
    round({_div('rf', 'lf + rf + hf')}, 6) AS review_failure_capture,
    round({_div('rf + hf', 'lf + rf + hf')}, 6) AS review_plus_high_failure_capture,
    round({_div('rf + rp', 'lf + lp + rf + rp + hf + hp')}, 6) AS review_rate,
    round({_div('lf + lp + hf + hp', 'lf + lp + rf + rp + hf + hp')}, 6) AS automation_coverage,
    round({_div('hp', 'lp + rp + hp')}, 6) AS high_risk_false_alarm_rate,
    round({PO.COST['low_failure']!r} * lf + {PO.COST['low_pass']!r} * lp + {PO.COST['review_failure']!r} * rf
      + {PO.COST['review_pass']!r} * rp + {PO.COST['high_failure']!r} * hf + {PO.COST['high_pass']!r} * hp, 6) AS operational_cost"""


def _policy_grid_sql(src, keys=""):
    kc = f"{keys}, " if keys else ""
    kj = f"l.{keys} = u.{keys} AND " if keys else ""
    return [
        f"""bc AS (SELECT {kc}g.k,
            count(*) FILTER (WHERE s.target = 1 AND s.probability < g.k / 200.0) AS fb,
            count(*) FILTER (WHERE s.target = 0 AND s.probability < g.k / 200.0) AS pb,
            count(*) FILTER (WHERE s.target = 1) AS P, count(*) FILTER (WHERE s.target = 0) AS N
          FROM {src} s, (SELECT CAST(range AS INTEGER) AS k FROM range(0, 201)) g GROUP BY {kc}g.k)""",
        f"""pairs AS (SELECT {'l.' + keys + ', ' if keys else ''}l.k AS kl, u.k AS ku, l.fb AS lf, l.pb AS lp,
            l.P - u.fb AS hf, l.N - u.pb AS hp, u.fb - l.fb AS rf, u.pb - l.pb AS rp
          FROM bc l JOIN bc u ON {kj}u.k > l.k
          WHERE l.k BETWEEN {PO.LOWER_K[0]} AND {PO.LOWER_K[1]} AND u.k BETWEEN {PO.UPPER_K[0]} AND {PO.UPPER_K[1]})""",
        f"""pg AS (SELECT {kc}round(kl / 200.0, 6) AS lower_threshold, round(ku / 200.0, 6) AS upper_threshold, {_POL} FROM pairs)""",
    ]


_STRICT = f"""(low_risk_failure_leakage <= {PO.MAX_LOW_RISK_LEAKAGE!r} AND low_risk_npv IS NOT NULL
    AND low_risk_npv >= {PO.MIN_LOW_RISK_NPV!r} AND review_rate <= {PO.MAX_REVIEW_RATE!r}
    AND automation_coverage >= {PO.MIN_AUTOMATION_COVERAGE!r} AND high_risk_failure_capture >= {PO.MIN_HIGH_RISK_CAPTURE!r}
    AND review_plus_high_failure_capture >= {PO.MIN_REVIEW_PLUS_HIGH_CAPTURE!r})"""
_SAFE = f"""(low_risk_failure_leakage <= {PO.MAX_LOW_RISK_LEAKAGE!r}
    AND review_plus_high_failure_capture >= {PO.MIN_REVIEW_PLUS_HIGH_CAPTURE!r})"""

_SELPOL = f"""sp1 AS (SELECT *, max(CAST(coalesce({_STRICT}, false) AS INTEGER)) OVER (PARTITION BY model) AS s_any,
    max(CAST(coalesce({_SAFE}, false) AS INTEGER)) OVER (PARTITION BY model) AS f_any FROM pg),
  sp2 AS (SELECT *, CASE WHEN s_any = 1 THEN CASE WHEN coalesce({_STRICT}, false) THEN 0 ELSE 9 END
                         WHEN f_any = 1 THEN CASE WHEN coalesce({_SAFE}, false) THEN 1 ELSE 9 END ELSE 2 END AS tier FROM sp1),
  sp3 AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY tier,
      CASE WHEN tier = 0 THEN operational_cost WHEN tier = 1 THEN review_rate ELSE low_risk_failure_leakage END,
      CASE WHEN tier = 0 THEN review_rate WHEN tier = 1 THEN operational_cost ELSE -review_plus_high_failure_capture END,
      CASE WHEN tier = 0 THEN -high_risk_precision WHEN tier = 1 THEN -high_risk_failure_capture ELSE operational_cost END,
      CASE WHEN tier = 0 THEN -automation_coverage WHEN tier = 1 THEN -high_risk_precision ELSE review_rate END,
      lower_threshold, upper_threshold) AS rn FROM sp2)"""

SQL = {
    "confusion_metrics": _w() + f"""SELECT model, tn AS true_negative, fp AS false_positive, fn AS false_negative,
        tp AS true_positive, round({_R}, 6) AS recall, round({_P}, 6) AS precision, round({_F1}, 6) AS f1,
        round({_BA}, 6) AS balanced_accuracy, tp + fp AS predicted_failures
      FROM (SELECT model, count(*) FILTER (WHERE probability >= {THRESHOLD!r} AND target = 1) AS tp,
          count(*) FILTER (WHERE probability >= {THRESHOLD!r} AND target = 0) AS fp,
          count(*) FILTER (WHERE probability < {THRESHOLD!r} AND target = 1) AS fn,
          count(*) FILTER (WHERE probability < {THRESHOLD!r} AND target = 0) AS tn FROM ms GROUP BY model)""",
    "roc_auc": _w(_ranked()) + """SELECT model, round(CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN
        sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (max(tot_pos) * max(tot_neg)) END, 6) AS roc_auc FROM rk GROUP BY model""",
    "average_precision": _w(_ranked()) + f"""SELECT model, round(CASE WHEN max(tot_pos) > 0 THEN
        sum(CASE WHEN pos > 0 THEN (pos / tot_pos) * ({_TP} / ({_TP} + {_FP})) ELSE 0.0 END) END, 6) AS average_precision
      FROM rk GROUP BY model""",
    "brier_log_loss": _w() + f"""SELECT model, round(avg(power(probability - target, 2)), 6) AS brier_score,
        round(-avg(target * ln(least(greatest(probability, {M.LOG_LOSS_CLIP!r}), {1 - M.LOG_LOSS_CLIP!r}))
          + (1 - target) * ln(1 - least(greatest(probability, {M.LOG_LOSS_CLIP!r}), {1 - M.LOG_LOSS_CLIP!r}))), 6) AS log_loss
      FROM ms GROUP BY model""",
    "curve_points": _w(_ranked("scores", ""), scores=True) + f"""SELECT round(score, 6) AS threshold,
        CAST({_TP} AS BIGINT) AS true_positive, CAST({_FP} AS BIGINT) AS false_positive,
        round({_div(_TP, 'tot_pos')}, 6) AS tpr, round({_div(_FP, 'tot_neg')}, 6) AS fpr,
        round({_div(_TP, f'{_TP} + {_FP}')}, 6) AS precision, round({_div(_TP, 'tot_pos')}, 6) AS recall FROM rk""",
    "best_f1_threshold": _w(_ranked(), f"""f AS (SELECT model, score, {_div(_TP, f'{_TP} + {_FP}')} AS p,
        {_div(_TP, 'tot_pos')} AS r FROM rk)""", f"""f2 AS (SELECT *, {_div('2 * p * r', 'p + r')} AS f1,
        row_number() OVER (PARTITION BY model ORDER BY {_div('2 * p * r', 'p + r')} DESC, score ASC) AS rn FROM f)""")
    + "SELECT model, round(score, 6) AS threshold, round(f1, 6) AS f1, round(p, 6) AS precision, round(r, 6) AS recall FROM f2 WHERE rn = 1",
    "threshold_sweep": _w(_grid("scores", M.SWEEP_STEPS, 1, M.SWEEP_STEPS - 1), scores=True)
    + f"SELECT {_SWEEP_COLS}, tp + fp AS predicted_failures FROM gc",
    "cost_sweep": _w(_grid("ms", M.COST_STEPS, 1, M.COST_STEPS - 1, "model")) + f"SELECT model, {_COST_COLS} FROM gc",
    "select_threshold_precision": _w(
        _grid("ms", M.SWEEP_STEPS, 1, M.SWEEP_STEPS - 1, "model"),
        f"sw AS (SELECT model, {_SWEEP_COLS} FROM gc)",
    ) + ", " + _pick_sql(
        "sw", "model", f"recall_fail >= {M.MINIMUM_FAILURE_RECALL!r}",
        ["-precision_fail", "-f1_fail", "-threshold"], ["-recall_fail", "-precision_fail", "-f1_fail"],
        ("highest precision with failure recall >= 0.75", "recall target missed: highest recall"),
        "model, threshold, precision_fail, recall_fail, f1_fail, balanced_accuracy"),
    "select_threshold_cost": _w(
        _grid("ms", M.COST_STEPS, 1, M.COST_STEPS - 1, "model"), f"cs AS (SELECT model, {_COST_COLS} FROM gc)",
    ) + ", " + _COSTSEL,
    "prediction_table": _w(scores=True) + f"""SELECT record_id, ts, target, round(probability, 6) AS fail_probability,
        CASE WHEN probability >= {THRESHOLD!r} THEN 1 ELSE 0 END AS predicted_target,
        CASE WHEN probability >= {THRESHOLD!r} THEN 'Fail' ELSE 'Pass' END AS predicted_status,
        round({THRESHOLD!r}, 6) AS decision_threshold,
        (CASE WHEN probability >= {THRESHOLD!r} THEN 1 ELSE 0 END) = target AS prediction_correct,
        CASE WHEN target = 1 AND probability < {THRESHOLD!r} THEN 'Missed Failure'
             WHEN target = 0 AND probability >= {THRESHOLD!r} THEN 'False Alarm' ELSE 'Correct' END AS error_type FROM scores""",
    "calibration_bins": _w() + f"""SELECT model, {_bin()} AS bin, count(*) AS records, round(avg(probability), 6) AS mean_probability,
        round(avg(target), 6) AS observed_rate, round(abs(avg(probability) - avg(target)), 6) AS gap FROM ms GROUP BY model, 2""",
    "calibration_error": _w(f"""cb AS (SELECT model, {_bin()} AS bin, count(*) AS n, avg(probability) AS mp,
        avg(target) AS orate FROM ms GROUP BY model, 2)""") + """SELECT model,
        round(sum(n * abs(mp - orate)) / sum(n), 6) AS ece, round(max(abs(mp - orate)), 6) AS mce FROM cb GROUP BY model""",
    "assign_decision": _w(scores=True) + f"""SELECT record_id, target, CASE WHEN probability < {LOWER!r} THEN 'Low Risk'
        WHEN probability >= {UPPER!r} THEN 'High Risk' ELSE 'Engineering Review' END AS decision FROM scores""",
    "policy_metrics": _w(f"""z AS (SELECT
        count(*) FILTER (WHERE probability < {LOWER!r} AND target = 1) AS lf,
        count(*) FILTER (WHERE probability < {LOWER!r} AND target = 0) AS lp,
        count(*) FILTER (WHERE probability >= {LOWER!r} AND probability < {UPPER!r} AND target = 1) AS rf,
        count(*) FILTER (WHERE probability >= {LOWER!r} AND probability < {UPPER!r} AND target = 0) AS rp,
        count(*) FILTER (WHERE probability >= {UPPER!r} AND target = 1) AS hf,
        count(*) FILTER (WHERE probability >= {UPPER!r} AND target = 0) AS hp FROM scores)""", scores=True)
    + f"SELECT {LOWER!r} AS lower_threshold, {UPPER!r} AS upper_threshold, {_POL} FROM z",
    "policy_grid": _w(*_policy_grid_sql("scores"), scores=True) + "SELECT * FROM pg",
    "select_policy": _w(*_policy_grid_sql("ms", "model"), _SELPOL) + """SELECT * EXCLUDE (s_any, f_any, rn),
        CASE WHEN tier = 0 THEN 'meets every operational constraint at the lowest weighted cost'
             WHEN tier = 1 THEN 'fallback: keeps failure routing safe with the least review load'
             ELSE 'emergency fallback: least unsafe low-risk leakage' END AS selection_reason FROM sp3 WHERE rn = 1""",
    "decision_summary": _w(f"""dd AS (SELECT CASE WHEN probability < {LOWER!r} THEN 'Low Risk' WHEN probability >= {UPPER!r}
        THEN 'High Risk' ELSE 'Engineering Review' END AS decision, target, probability FROM scores)""", scores=True)
    + """, dom AS (SELECT * FROM (VALUES (0, 'Low Risk'), (1, 'Engineering Review'), (2, 'High Risk')) t(decision_order, decision)),
      agg AS (SELECT decision, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        count(*) FILTER (WHERE target = 0) AS passes, avg(probability) AS mp FROM dd GROUP BY decision)
      SELECT decision_order, decision, CAST(coalesce(records, 0) AS BIGINT) AS records,
        round(CASE WHEN sum(coalesce(records, 0)) OVER () > 0 THEN coalesce(records, 0) / sum(coalesce(records, 0)) OVER () ELSE 0.0 END, 6) AS share,
        CAST(coalesce(failures, 0) AS BIGINT) AS failures, CAST(coalesce(passes, 0) AS BIGINT) AS passes,
        round(CASE WHEN coalesce(records, 0) > 0 THEN failures / records END, 6) AS observed_failure_rate,
        round(mp, 6) AS mean_probability FROM dom LEFT JOIN agg USING (decision)""",
    "decide_batch": _w(scores=True) + f"""SELECT record_id, target, round(probability, 6) AS calibrated_failure_probability,
        CASE WHEN probability < {LOWER!r} THEN 'Low Risk' WHEN probability >= {UPPER!r} THEN 'High Risk'
             ELSE 'Engineering Review' END AS operational_decision,
        CASE WHEN probability < {LOWER!r} THEN '{PO.ACTIONS[PO.LOW]}' WHEN probability >= {UPPER!r} THEN '{PO.ACTIONS[PO.HIGH]}'
             ELSE '{PO.ACTIONS[PO.REVIEW]}' END AS recommended_action,
        {LOWER!r} AS lower_threshold, {UPPER!r} AS upper_threshold FROM scores""",
    "rank_calibrators": _w(f"""cb AS (SELECT model, {_bin()} AS bin, count(*) AS n, avg(probability) AS mp,
        avg(target) AS orate FROM ms GROUP BY model, 2)""",
        """ce AS (SELECT model, round(sum(n * abs(mp - orate)) / sum(n), 6) AS ece, round(max(abs(mp - orate)), 6) AS mce FROM cb GROUP BY model)""",
        """br AS (SELECT model, round(avg(power(probability - target, 2)), 6) AS brier_score FROM ms GROUP BY model)""")
    + """SELECT model, ece, mce, brier_score, round(brier_score + ece + 0.25 * mce, 6) AS calibration_score,
        row_number() OVER (ORDER BY round(brier_score + ece + 0.25 * mce, 6), model) AS calibration_rank FROM ce JOIN br USING (model)""",
}

SQL["select_model"] = _w(
    _grid("ms", M.COST_STEPS, 1, M.COST_STEPS - 1, "model"), f"cs AS (SELECT model, {_COST_COLS} FROM gc)",
    _ranked(),
) + ", sel AS (WITH " + _COSTSEL.replace("\n  SELECT ", "\n  SELECT ", 1) + """),
  auc AS (SELECT model, round(sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (max(tot_pos) * max(tot_neg)), 6) AS roc_auc FROM rk GROUP BY model),
  ap AS (SELECT model, round(sum(CASE WHEN pos > 0 THEN (pos / tot_pos) * ((tot_pos - (cum_pos - pos)) /
      ((tot_pos - (cum_pos - pos)) + (tot_neg - (cum_neg - neg)))) ELSE 0.0 END), 6) AS pr_auc FROM rk GROUP BY model),
  br AS (SELECT model, round(avg(power(probability - target, 2)), 6) AS brier_score FROM ms GROUP BY model),
  cmp AS (SELECT * FROM sel JOIN auc USING (model) JOIN ap USING (model) JOIN br USING (model)),
  e AS (SELECT *, CASE WHEN max(CAST(recall_fail >= 0.75 AS INTEGER)) OVER () = 1 THEN recall_fail >= 0.75 ELSE true END AS eligible FROM cmp)
  SELECT *, row_number() OVER (ORDER BY eligible DESC, operational_cost, false_positive, precision_fail DESC,
      balanced_accuracy DESC, pr_auc DESC, model) AS model_rank FROM e"""
SQL["select_model"] = SQL["select_model"].replace(
    "AS model_rank FROM e", "AS model_rank, row_number() OVER (ORDER BY eligible DESC, operational_cost, false_positive, "
    "precision_fail DESC, balanced_accuracy DESC, pr_auc DESC, model) = 1 AS selected FROM e")
