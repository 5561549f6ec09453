"""Registered model, cross-fitting, calibration and resampling queries.

Fitted models are checked by row count and their own tests (no SQL twin);
folds and the CV benchmark on fixed member scores have DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import imputation as IM
from ..operators import models as MO
from ..operators import resampling as RS
from ..operators import trees as TR
from ..sources import fixtures as fx
from .metrics_q import model_scores

SENS = fx.SENSORS


def _w(spark, sf):
    return fx.wide_records(spark, sf)


def _sides():
    """Fitted on the reference side, scored on the current one."""
    return F.col("side") == "reference", F.col("side") == "current"


def q_stratified_folds(spark, sf):
    return MO.stratified_folds(_w(spark, sf))


def q_logistic_model(spark, sf):
    return MO.fit_score(_w(spark, sf), SENS, "logistic")


def q_forest_model(spark, sf):
    return MO.fit_score(_w(spark, sf), SENS, "forest")


def q_boosted_trees(spark, sf):
    return TR.boosted_trees(_w(spark, sf), SENS, *_sides())


def q_balanced_forest(spark, sf):
    return TR.balanced_forest(_w(spark, sf), SENS, *_sides())


def q_easy_ensemble(spark, sf):
    return TR.easy_ensemble(_w(spark, sf), SENS, *_sides())


def q_fit_score(spark, sf):
    return MO.fit_score(_w(spark, sf), SENS, "forest", balanced=True)


def q_out_of_fold_scores(spark, sf):
    return MO.out_of_fold_scores(_w(spark, sf), SENS, "logistic")


def q_fold_spread(spark, sf):
    """Per-row spread of the k fold models' scores on the current side."""
    return MO.fold_spread(_w(spark, sf), SENS)


def q_cv_benchmark(spark, sf):
    ms = model_scores(spark, sf)
    folds = MO.stratified_folds(_w(spark, sf))
    return MO.cv_benchmark(ms.join(folds.select("record_id", "fold"), "record_id"))


def q_isolation_anomaly(spark, sf):
    return MO.isolation_scores(_w(spark, sf), SENS)


def q_permutation_importance(spark, sf):
    return MO.permutation_importance(_w(spark, sf), SENS)


def q_bootstrap_ci(spark, sf):
    return RS.bootstrap_ci(fx.scores(spark, sf).where(F.col("side") == "current"))


def _oof(spark, sf):
    return fx.scores(spark, sf).where(F.col("side") == "reference").select("record_id", "target", "probability")


def q_sigmoid_calibrator(spark, sf):
    return MO.calibrate(_oof(spark, sf), "sigmoid")


def q_beta_calibrator(spark, sf):
    return MO.calibrate(_oof(spark, sf), "beta")


def q_isotonic_calibrator(spark, sf):
    return MO.calibrate(_oof(spark, sf), "isotonic")


def q_cross_fit_calibration(spark, sf):
    from ..operators import metrics as M
    o = _oof(spark, sf)
    allm = None
    for m in ("uncalibrated", "sigmoid", "beta", "isotonic"):
        c = MO.calibrate(o, m)
        allm = c if allm is None else allm.unionByName(c)
    e = M.calibration_error(allm, ["method"], score="calibrated_probability")
    b = M.brier_log_loss(allm, ["method"], score="calibrated_probability")
    return e.join(b, "method").select("*", F.round(F.col("brier_score") + F.col("ece") + 0.25 * F.col("mce"), 6).alias(
        "calibration_score"))


def q_chained_impute(spark, sf):
    return IM.chained_impute(_w(spark, sf), SENS, _sides()[0])


def q_imputation_ranking(spark, sf):
    return MO.imputation_ranking(_w(spark, sf), SENS)


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

_FOLDS = """fo AS (SELECT record_id, target, CAST((row_number() OVER (PARTITION BY target ORDER BY (o_orderkey * 2654435761 + 42) % 4294967296,
    record_id) - 1) % 5 AS INTEGER) AS fold FROM wide_records)"""
_MS = """ms AS (SELECT 'member_' || CAST(m.member AS VARCHAR) AS model, m.record_id, w.target, m.p AS probability
  FROM members m JOIN wide_records w USING (record_id))"""

SQL = {
    "stratified_folds": fx.sql_with("wide_records", extra=[_FOLDS]) + "SELECT * FROM fo",
    "cv_benchmark": fx.sql_with("wide_records", "members", extra=[_FOLDS, _MS]) + """,
      s AS (SELECT ms.*, fo.fold FROM ms JOIN fo USING (record_id)),
      rs AS (SELECT model, fold, probability AS score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg
        FROM s GROUP BY model, fold, probability),
      rk AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY model, fold) AS tot_pos,
        sum(neg) OVER (PARTITION BY model, fold) AS tot_neg FROM rs
        WINDOW w AS (PARTITION BY model, fold ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
      ra AS (SELECT model, fold, sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (max(tot_pos) * max(tot_neg)) AS roc_auc,
        sum(CASE WHEN pos > 0 THEN (pos / tot_pos) * ((tot_pos - (cum_pos - pos)) / ((tot_pos - (cum_pos - pos)) + (tot_neg - (cum_neg - neg)))) ELSE 0.0 END) AS average_precision
        FROM rk GROUP BY model, fold),
      c AS (SELECT model, fold, avg(power(probability - target, 2)) AS brier_score,
        count(*) FILTER (WHERE target = 1 AND probability >= 0.5) AS tp, count(*) FILTER (WHERE target = 0 AND probability >= 0.5) AS fp,
        count(*) FILTER (WHERE target = 1 AND probability < 0.5) AS fn FROM s GROUP BY model, fold),
      per AS (SELECT c.model, c.fold, roc_auc, average_precision, brier_score,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision
        FROM c JOIN ra USING (model, fold)),
      per2 AS (SELECT *, CASE WHEN recall + precision > 0 THEN 2 * recall * precision / (recall + precision) ELSE 0.0 END AS f1 FROM per),
      lg AS (""" + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM per2" for m in
                                     ["roc_auc", "average_precision", "brier_score", "recall", "precision", "f1"]) + """)
      SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, count(*) AS folds
      FROM lg GROUP BY model, metric""",
}
