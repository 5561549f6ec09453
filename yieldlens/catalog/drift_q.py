"""Registered drift queries (Spark) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DriftConfig
from ..functions.expressions import r6
from ..operators import drift as D
from ..sources import fixtures as fx
from . import sqlbits as S

CFG = DriftConfig()
EPS = CFG.epsilon


def _base(spark, sf_dir):
    return D.DriftBase(fx.wide_records(spark, sf_dir), fx.SENSORS, EPS)


def q_feature_drift(spark, sf_dir):
    return D.feature_drift(fx.wide_records(spark, sf_dir), fx.SENSORS, CFG)


def q_feature_drift_summary(spark, sf_dir):
    return D.feature_drift_summary(q_feature_drift(spark, sf_dir))


def q_psi(spark, sf_dir):
    return D.psi(_base(spark, sf_dir), CFG.number_of_bins).select("feature", r6(F.col("psi")).alias("psi"))


def q_ks_two_sample(spark, sf_dir):
    return D.ks_two_sample(_base(spark, sf_dir)).select(
        "feature", r6(F.col("ks_statistic")).alias("ks_statistic"), r6(F.col("ks_p_value")).alias("ks_p_value")
    )


def q_wasserstein_quantile(spark, sf_dir):
    return D.wasserstein(_base(spark, sf_dir)).select(
        "feature", r6(F.col("wasserstein_distance")).alias("wasserstein_distance")
    )


QUERIES = {
    "feature_drift": q_feature_drift,
    "feature_drift_summary": q_feature_drift_summary,
    "psi": q_psi,
    "ks_two_sample": q_ks_two_sample,
    "wasserstein_quantile": q_wasserstein_quantile,
}

# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_PROBS = "[" + ", ".join(repr(j / CFG.number_of_bins) for j in range(CFG.number_of_bins + 1)) + "]"

_BASE = [
    "lf AS (SELECT record_id, side, feature, CASE WHEN isnan(value) OR isinf(value) THEN NULL ELSE value END AS value FROM long_records)",
    f"""mom AS (SELECT feature, side, count(*) AS rows, count(value) AS n, avg(value) AS mean,
        stddev_samp(value) AS std, min(value) AS vmin, max(value) AS vmax, quantile_cont(value, 0.5) AS median,
        1 - count(value) / count(*) AS missing_rate,
        CASE WHEN count(value) = 0 THEN false WHEN count(value) = 1 THEN true
             ELSE abs(max(value) - min(value)) <= {EPS!r} END AS constant
      FROM lf GROUP BY feature, side)""",
    """fw AS (SELECT feature,
        max(CASE WHEN side = 'reference' THEN n END) AS ref_n, max(CASE WHEN side = 'current' THEN n END) AS cur_n,
        max(CASE WHEN side = 'reference' THEN mean END) AS ref_mean, max(CASE WHEN side = 'current' THEN mean END) AS cur_mean,
        max(CASE WHEN side = 'reference' THEN std END) AS ref_std, max(CASE WHEN side = 'current' THEN std END) AS cur_std,
        max(CASE WHEN side = 'reference' THEN median END) AS ref_median, max(CASE WHEN side = 'current' THEN median END) AS cur_median,
        max(CASE WHEN side = 'reference' THEN missing_rate END) AS ref_missing_rate,
        max(CASE WHEN side = 'current' THEN missing_rate END) AS cur_missing_rate,
        bool_or(CASE WHEN side = 'reference' THEN constant END) AS ref_constant,
        bool_or(CASE WHEN side = 'current' THEN constant END) AS cur_constant,
        max(CASE WHEN side = 'reference' THEN vmin END) AS ref_vmin, max(CASE WHEN side = 'reference' THEN vmax END) AS ref_vmax
      FROM mom GROUP BY feature)""",
    f"""edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_PROBS}))) AS e
      FROM lf WHERE side = 'reference' AND value IS NOT NULL GROUP BY feature)""",
    f"""ed AS (SELECT fw.feature,
        CASE WHEN coalesce(ref_n, 0) = 0 OR abs(ref_vmax - ref_vmin) <= {EPS!r} OR e IS NULL OR len(e) < 2
             THEN CAST([] AS DOUBLE[]) ELSE list_slice(e, 2, len(e) - 1) END AS inner_edges
      FROM fw LEFT JOIN edges USING (feature))""",
    """binned AS (SELECT lf.feature, side, len(list_filter(inner_edges, lambda x: x <= value)) AS bin, count(*) AS cnt
      FROM lf JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY ALL)""",
    """dom AS (SELECT feature, s.side, b.bin FROM ed,
        LATERAL (SELECT unnest(range(len(inner_edges) + 1)) AS bin) b,
        (VALUES ('reference'), ('current')) s(side))""",
    """fullb AS (SELECT d.feature, d.side, d.bin, coalesce(b.cnt, 0) AS cnt FROM dom d LEFT JOIN binned b USING (feature, side, bin))""",
    """props AS (SELECT feature, side, bin,
        CASE WHEN sum(cnt) OVER w > 0 THEN cnt / sum(cnt) OVER w ELSE 1.0 / count(*) OVER w END AS p
      FROM fullb WINDOW w AS (PARTITION BY feature, side))""",
    f"""clipped AS (SELECT feature, side, bin, greatest(p, {EPS!r}) AS p FROM props)""",
    """normed AS (SELECT feature, side, bin, p / sum(p) OVER (PARTITION BY feature, side) AS p FROM clipped)""",
    """psi_t AS (SELECT x.feature, CASE WHEN least(fw.ref_n, fw.cur_n) > 0 THEN greatest(sum((pc - pr) * ln(pc / pr)), 0.0) END AS psi
      FROM (SELECT feature, bin, max(CASE WHEN side = 'reference' THEN p END) AS pr,
                   max(CASE WHEN side = 'current' THEN p END) AS pc FROM normed GROUP BY feature, bin) x
      JOIN fw USING (feature) GROUP BY x.feature, fw.ref_n, fw.cur_n)""",
    """kv AS (SELECT feature, value, count(*) FILTER (WHERE side = 'reference') AS c_ref,
        count(*) FILTER (WHERE side = 'current') AS c_cur FROM lf WHERE value IS NOT NULL GROUP BY feature, value)""",
    """kc AS (SELECT feature, sum(c_ref) OVER w AS cr, sum(c_cur) OVER w AS cc FROM kv
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    """ksd AS (SELECT fw.feature, fw.ref_n, fw.cur_n, max(abs(cr / fw.ref_n - cc / fw.cur_n)) AS d
      FROM fw LEFT JOIN kc USING (feature) GROUP BY fw.feature, fw.ref_n, fw.cur_n)""",
    """kss AS (SELECT feature, ref_n, cur_n, d,
        (sqrt(ref_n * cur_n / (ref_n + cur_n)) + 0.12 + 0.11 / sqrt(ref_n * cur_n / (ref_n + cur_n))) * d AS sc FROM ksd)""",
    """ks_t AS (SELECT feature,
        CASE WHEN ref_n > 0 AND cur_n > 0 THEN d END AS ks_statistic,
        CASE WHEN ref_n > 0 AND cur_n > 0 THEN
          CASE WHEN sc <= 0 THEN 1.0 ELSE least(greatest(2.0 * list_reduce(
            list_transform(range(1, 101), lambda k: power(-1.0, k - 1) * exp(-2.0 * k * k * sc * sc)),
            lambda a, b: a + b, 0.0), 0.0), 1.0) END END AS ks_p_value
      FROM kss)""",
    """gap AS (SELECT feature, abs(cr / ref_n - cc / cur_n) * (lead(kv.value) OVER (PARTITION BY kv.feature ORDER BY kv.value) - kv.value) AS s
      FROM (SELECT feature, value, sum(c_ref) OVER w AS cr, sum(c_cur) OVER w AS cc FROM kv
        WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) kv
      JOIN fw USING (feature))""",
    """wd_t AS (SELECT fw.feature, CASE WHEN ref_n > 0 AND cur_n > 0 THEN coalesce(sum(s), 0.0) END AS wasserstein_distance
      FROM fw LEFT JOIN gap USING (feature) GROUP BY fw.feature, fw.ref_n, fw.cur_n)""",
]


def _with(extra=None):
    return fx.sql_with("wide_records", "long_records", extra=_BASE + list(extra or []))


_SHIFT = (
    f"CASE WHEN ref_mean IS NULL OR cur_mean IS NULL THEN NULL "
    f"WHEN ref_std IS NULL OR ref_std < {EPS!r} THEN CASE WHEN abs(cur_mean - ref_mean) < {EPS!r} THEN 0.0 END "
    f"ELSE abs(cur_mean - ref_mean) / ref_std END"
)
_RATIO = (
    f"CASE WHEN ref_std IS NULL OR cur_std IS NULL THEN NULL "
    f"WHEN abs(ref_std) < {EPS!r} THEN CASE WHEN abs(cur_std) < {EPS!r} THEN 1.0 END ELSE cur_std / ref_std END"
)
_TH = CFG.feature_thresholds
_SEVS = {
    "psi": S.sev("psi", _TH["psi"]),
    "ks_statistic": S.sev("ks_statistic", _TH["ks_statistic"]),
    "standardised_mean_shift": S.sev("shift", _TH["standardised_mean_shift"]),
    "missing_rate_difference": S.sev("miss_delta", _TH["missing_rate_difference"]),
    "constant_sensor_change": "(CASE WHEN NOT ref_const AND cur_const AND cur_n > 1 THEN 'Critical' "
    "WHEN ref_const <> cur_const THEN 'Warning' ELSE 'Normal' END)",
    "measurement_availability": "(CASE WHEN ref_n = 0 OR cur_n = 0 THEN 'Critical' ELSE 'Normal' END)",
}
_NOTES = """concat_ws('; ',
    CASE WHEN ref_n = 0 THEN 'reference side has no finite values' END,
    CASE WHEN cur_n = 0 THEN 'current side has no finite values' END,
    CASE WHEN ref_const THEN 'constant on reference side' END,
    CASE WHEN cur_const THEN 'constant on current side' END,
    CASE WHEN ref_const AND NOT cur_const THEN 'started to vary' END,
    CASE WHEN NOT ref_const AND cur_const THEN 'stopped varying' END,
    CASE WHEN shift IS NULL AND ref_n > 0 AND cur_n > 0 THEN 'mean shift undefined: reference spread too small' END,
    CASE WHEN psi IS NULL THEN 'psi undefined' END,
    CASE WHEN miss_signed > 0 THEN 'more missing values on current side' END)"""

_FD = f"""fd0 AS (SELECT fw.feature, coalesce(ref_n, 0) AS ref_n, coalesce(cur_n, 0) AS cur_n, ref_missing_rate, cur_missing_rate,
      abs(cur_missing_rate - ref_missing_rate) AS miss_delta, cur_missing_rate - ref_missing_rate AS miss_signed,
      ref_mean, cur_mean, ref_std, cur_std, ref_median, cur_median,
      {_SHIFT} AS shift, {_RATIO} AS ratio, psi, ks_statistic, ks_p_value, wasserstein_distance,
      coalesce(ref_constant, false) AS ref_const, coalesce(cur_constant, false) AS cur_const
    FROM fw LEFT JOIN psi_t USING (feature) LEFT JOIN ks_t USING (feature) LEFT JOIN wd_t USING (feature))""", \
    f"""fd1 AS (SELECT *, {S.max_sev(*_SEVS.values())} AS overall FROM fd0)""", \
    f"""fd AS (SELECT feature,
      CAST(ref_n AS BIGINT) AS reference_count, CAST(cur_n AS BIGINT) AS current_count,
      {S.r6('ref_missing_rate')} AS reference_missing_rate, {S.r6('cur_missing_rate')} AS current_missing_rate,
      {S.r6('miss_delta')} AS missing_rate_difference,
      {S.r6('ref_mean')} AS reference_mean, {S.r6('cur_mean')} AS current_mean,
      {S.r6('abs(cur_mean - ref_mean)')} AS absolute_mean_shift, {S.r6('shift')} AS standardised_mean_shift,
      {S.r6('ref_std')} AS reference_std, {S.r6('cur_std')} AS current_std, {S.r6('ratio')} AS standard_deviation_ratio,
      {S.r6('ref_median')} AS reference_median, {S.r6('cur_median')} AS current_median,
      {S.r6('abs(cur_median - ref_median)')} AS absolute_median_shift,
      {S.r6('psi')} AS psi, {S.r6('ks_statistic')} AS ks_statistic, {S.r6('ks_p_value')} AS ks_p_value,
      {S.r6('wasserstein_distance')} AS wasserstein_distance,
      ref_const AS reference_constant, cur_const AS current_constant,
      {', '.join(f'{v} AS {k}_severity' for k, v in _SEVS.items())},
      overall AS overall_severity,
      {S.health(_SEVS, CFG.feature_weights)} AS feature_health_score,
      overall <> 'Normal' AS drift_detected,
      coalesce(nullif({_NOTES}, ''), 'none') AS notes,
      {S.sev_rank('overall')} AS severity_rank
    FROM fd1)""", \
    """fdr AS (SELECT *, row_number() OVER (ORDER BY severity_rank DESC, feature_health_score ASC,
      psi DESC NULLS LAST, ks_statistic DESC NULLS LAST, feature ASC) AS monitoring_rank FROM fd)"""

SQL = {
    "feature_drift": _with(_FD) + "SELECT * FROM fdr",
    "feature_drift_summary": _with(_FD) + """SELECT count(*) AS monitored_features,
      count(*) FILTER (WHERE overall_severity = 'Normal') AS normal_features,
      count(*) FILTER (WHERE overall_severity = 'Watch') AS watch_features,
      count(*) FILTER (WHERE overall_severity = 'Warning') AS warning_features,
      count(*) FILTER (WHERE overall_severity = 'Critical') AS critical_features,
      count(*) FILTER (WHERE overall_severity <> 'Normal') AS drifted_features,
      round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE overall_severity <> 'Normal') / count(*) ELSE 0.0 END, 6) AS drift_rate,
      round(coalesce(avg(feature_health_score), 100.0), 2) AS mean_feature_health_score,
      max(psi) AS maximum_psi, max(ks_statistic) AS maximum_ks_statistic,
      max(standardised_mean_shift) AS maximum_standardised_mean_shift,
      max(missing_rate_difference) AS maximum_missing_rate_difference,
      coalesce(['Normal', 'Watch', 'Warning', 'Critical'][max(severity_rank) + 1], 'Normal') AS dominant_severity
    FROM fdr""",
    "psi": _with() + f"SELECT feature, {S.r6('psi')} AS psi FROM psi_t",
    "ks_two_sample": _with() + f"SELECT feature, {S.r6('ks_statistic')} AS ks_statistic, {S.r6('ks_p_value')} AS ks_p_value FROM ks_t",
    "wasserstein_quantile": _with() + f"SELECT feature, {S.r6('wasserstein_distance')} AS wasserstein_distance FROM wd_t",
}
