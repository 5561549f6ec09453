"""Registered data-audit / profiling queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources import fixtures as fx
from . import sqlbits as S

SENS = fx.SENSORS
HASH = "(o_orderkey * 2654435761) % 4294967296"


def _wide(spark, sf_dir):
    return fx.wide_records(spark, sf_dir)


def _fs(spark, sf_dir):
    w = _wide(spark, sf_dir)
    b = P.profile_base(w, SENS)
    return w, b, P.feature_stats(b)


def q_basic_summary(spark, sf_dir):
    return P.basic_summary(_wide(spark, sf_dir), SENS)


def q_feature_manifest(spark, sf_dir):
    return P.feature_manifest(_fs(spark, sf_dir)[2])


def q_constant_features(spark, sf_dir):
    return P.constant_features(_fs(spark, sf_dir)[2])


def q_near_constant_features(spark, sf_dir):
    return P.near_constant_features(_fs(spark, sf_dir)[2])


def q_missingness_report(spark, sf_dir):
    return P.missingness_report(_fs(spark, sf_dir)[2])


def q_outlier_report(spark, sf_dir):
    w, b, fs = _fs(spark, sf_dir)
    return P.outlier_report(b, fs, P.excluded_features(fs))


def q_sensor_reliability(spark, sf_dir):
    w, b, fs = _fs(spark, sf_dir)
    return P.sensor_reliability(b, fs)


def q_record_quality(spark, sf_dir):
    w, b, fs = _fs(spark, sf_dir)
    return P.record_quality(w, SENS, P.sensor_reliability(b, fs))


def q_row_quality(spark, sf_dir):
    return P.row_quality(_wide(spark, sf_dir), SENS)


def q_daily_trend(spark, sf_dir):
    return P.daily_trend(_wide(spark, sf_dir))


def q_class_distribution(spark, sf_dir):
    return P.class_distribution(_wide(spark, sf_dir))


def q_missingness_association(spark, sf_dir):
    return P.missingness_association(_wide(spark, sf_dir), SENS)


def q_row_missingness_bands(spark, sf_dir):
    return P.row_missingness_bands(_wide(spark, sf_dir), SENS)


def q_correlated_pairs(spark, sf_dir):
    w, b, fs = _fs(spark, sf_dir)
    excl = [r["feature"] for r in P.excluded_features(fs).collect()]
    return P.correlated_pairs(w, fs, SENS, excluded=excl)


def q_audited_dataset(spark, sf_dir):
    w, b, fs = _fs(spark, sf_dir)
    return P.audited_dataset(w, fs, SENS)


def _split(spark, sf_dir):
    w = _wide(spark, sf_dir).withColumn("_hash", F.expr(HASH))
    return P.stratified_split(w, "_hash")


def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir)


def q_split_summary(spark, sf_dir):
    return P.split_summary(_split(spark, sf_dir))


def q_audit_summary(spark, sf_dir):
    w, b, fs = _fs(spark, sf_dir)
    const = P.constant_features(fs).agg(
        F.count(F.lit(1)).alias("constant_features"),
        F.concat_ws(",", F.array_sort(F.collect_list("feature"))).alias("constant_list"))
    near = P.near_constant_features(fs).agg(F.count(F.lit(1)).alias("near_constant_features"))
    high = fs.where((1 - F.col("n") / F.col("rows")) > P.HIGH_MISSING).agg(
        F.count(F.lit(1)).alias("high_missing_features"),
        F.concat_ws(",", F.array_sort(F.collect_list("feature"))).alias("high_missing_list"))
    dropped = fs.where((F.col("distinct") <= 1) | ((1 - F.col("n") / F.col("rows")) > P.HIGH_MISSING)).agg(
        F.count(F.lit(1)).alias("dropped_features"),
        F.concat_ws(",", F.array_sort(F.collect_list("feature"))).alias("dropped_list"))
    basic = P.basic_summary(w, SENS).select("total_rows", "sensor_columns", "fail_count", "failure_rate",
                                            "missing_rate")
    return basic.crossJoin(const).crossJoin(near).crossJoin(high).crossJoin(dropped).select(
        "*", (F.col("sensor_columns") - F.col("dropped_features")).alias("retained_sensors"))


QUERIES = {
    "basic_summary": q_basic_summary,
    "feature_manifest": q_feature_manifest,
    "constant_features": q_constant_features,
    "near_constant_features": q_near_constant_features,
    "missingness_report": q_missingness_report,
    "outlier_report": q_outlier_report,
    "sensor_reliability": q_sensor_reliability,
    "record_quality": q_record_quality,
    "row_quality": q_row_quality,
    "daily_trend": q_daily_trend,
    "class_distribution": q_class_distribution,
    "missingness_association": q_missingness_association,
    "row_missingness_bands": q_row_missingness_bands,
    "correlated_pairs": q_correlated_pairs,
    "audited_dataset": q_audited_dataset,
    "stratified_split": q_stratified_split,
    "split_summary": q_split_summary,
    "audit_summary": q_audit_summary,
}

# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_PF = [
    """pf AS (SELECT feature, count(*) AS rows, count(value) AS n, count(DISTINCT value) AS distinct_n,
        avg(value) AS mean, avg(abs(value)) AS mean_abs, var_samp(value) AS var, stddev_samp(value) AS std,
        var_pop(value) * count(value) AS ss, min(value) AS minimum, max(value) AS maximum,
        quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM long_records GROUP BY feature)""",
    """nearc AS (SELECT l.feature, var_pop(coalesce(l.value, pf.median)) AS filled_variance
      FROM long_records l JOIN pf USING (feature) WHERE pf.distinct_n > 1 AND pf.n > 1 GROUP BY l.feature)""",
    f"""excl AS (SELECT feature FROM pf WHERE distinct_n <= 1
      UNION ALL SELECT feature FROM nearc WHERE filled_variance <= {P.NEAR_CONSTANT_VARIANCE!r})""",
    """fences AS (SELECT feature, n, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM pf)""",
    """outl AS (SELECT f.feature, f.n, f.q1, f.q3, f.iqr, f.lower, f.upper,
        count(*) FILTER (WHERE l.value < f.lower OR l.value > f.upper) AS outliers
      FROM fences f LEFT JOIN long_records l USING (feature) GROUP BY ALL)""",
    f"""rel AS (SELECT pf.feature AS sensor, pf.n, 1 - pf.n / pf.rows AS miss,
        round(CASE WHEN pf.n > 0 THEN o.outliers / pf.n ELSE 0.0 END, 6) AS orate,
        pf.std / (pf.mean_abs + 1e-8) AS rv FROM pf JOIN outl o USING (feature))""",
    """relf AS (SELECT sensor, n, miss, orate, rv, 1 - miss AS comp, greatest(0.0, 1 - orate) AS osc, 1.0 / (1.0 + rv) AS stab FROM rel)""",
    """relo AS (SELECT sensor,
        round(CASE WHEN n = 0 THEN 1.0 ELSE miss END, 6) AS missing_rate,
        round(CASE WHEN n = 0 THEN 1.0 ELSE orate END, 6) AS outlier_rate,
        round(CASE WHEN n = 0 THEN NULL ELSE rv END, 6) AS relative_variability,
        round(CASE WHEN n = 0 THEN 0.0 ELSE stab END, 6) AS stability_score,
        round(CASE WHEN n = 0 THEN 0.0 ELSE comp END, 6) AS completeness_score,
        round(CASE WHEN n = 0 THEN 0.0 ELSE osc END, 6) AS outlier_score,
        round(CASE WHEN n = 0 THEN 0.0 ELSE least(greatest(0.5 * comp + 0.25 * osc + 0.25 * stab, 0.0), 1.0) END, 6)
          AS sensor_reliability_score
      FROM relf)""",
]


def _with(*extra):
    return fx.sql_with("wide_records", "long_records", extra=_PF + list(extra))


def _cut(expr, edges, labels):
    parts = " ".join(
        f"WHEN {expr} > {edges[i]!r} AND {expr} <= {edges[i + 1]!r} THEN '{labels[i]}'" for i in range(len(labels))
    )
    return f"(CASE {parts} END)"


_ROWMISS = "(" + " + ".join(f"CASE WHEN {s} IS NULL THEN 1 ELSE 0 END" for s in SENS) + ")"
K = len(SENS)

_RATE = "(rows - n) / rows"
SQL = {
    "basic_summary": fx.sql_with("wide_records") + f"""SELECT b.total_rows, CAST({len(['record_id', 'o_orderkey', 'o_custkey', 'ts', 'target', 'status', 'side']) + K} AS BIGINT) AS total_columns,
        CAST({K} AS BIGINT) AS sensor_columns, b.pass_count, b.fail_count, round(b.fail_count / b.total_rows, 6) AS failure_rate,
        CAST(coalesce(d1.dups, 0) AS BIGINT) AS duplicate_rows, CAST(coalesce(d2.dups, 0) AS BIGINT) AS duplicate_sensor_rows,
        CAST(b.missing_cells AS BIGINT) AS missing_cells, round(b.missing_cells / (b.total_rows * {K}), 6) AS missing_rate,
        b.start_time, b.end_time
      FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE target = 0) AS pass_count,
                   count(*) FILTER (WHERE target = 1) AS fail_count, sum({_ROWMISS}) AS missing_cells,
                   min(ts) AS start_time, max(ts) AS end_time FROM wide_records) b,
           (SELECT sum(c - 1) AS dups FROM (SELECT count(*) AS c FROM wide_records
              GROUP BY o_orderkey, o_custkey, ts, target, status, side, {', '.join(SENS)})) d1,
           (SELECT sum(c - 1) AS dups FROM (SELECT count(*) AS c FROM wide_records GROUP BY {', '.join(SENS)})) d2""",
    "feature_manifest": _with() + f"""SELECT feature, 'double' AS dtype, CAST(n AS BIGINT) AS non_missing_count,
        CAST(rows - n AS BIGINT) AS missing_count, round({_RATE}, 6) AS missing_rate, CAST(distinct_n AS BIGINT) AS unique_count,
        distinct_n <= 1 AS is_constant, {S.sig('var')} AS variance, round(minimum, 6) AS minimum, round(maximum, 6) AS maximum,
        round(mean, 6) AS mean, round(median, 6) AS median, round(std, 6) AS standard_deviation,
        {_cut(_RATE, P.MISSINGNESS_CATEGORY_EDGES, P.MISSINGNESS_CATEGORIES)} AS missingness_category,
        row_number() OVER (ORDER BY round({_RATE}, 6) DESC, {S.sig('var')} ASC NULLS LAST, feature ASC) AS manifest_rank
      FROM pf""",
    "constant_features": _with() + "SELECT feature, CAST(distinct_n AS BIGINT) AS unique_count FROM pf WHERE distinct_n <= 1",
    "near_constant_features": _with() + f"SELECT feature, {S.sig('filled_variance')} AS filled_variance FROM nearc "
    f"WHERE filled_variance <= {P.NEAR_CONSTANT_VARIANCE!r}",
    "missingness_report": _with() + f"""SELECT feature, CAST(rows - n AS BIGINT) AS missing_count, round({_RATE}, 6) AS missing_rate,
        CASE WHEN {_RATE} > {P.HIGH_MISSING!r} THEN '{P.MISSING_ACTIONS[0]}' WHEN {_RATE} > {P.MODERATE_MISSING!r} THEN '{P.MISSING_ACTIONS[1]}'
             WHEN {_RATE} > 0 THEN '{P.MISSING_ACTIONS[2]}' ELSE '{P.MISSING_ACTIONS[3]}' END AS recommended_action FROM pf""",
    "outlier_report": _with() + """SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
        round(lower, 6) AS lower_bound, round(upper, 6) AS upper_bound, CAST(outliers AS BIGINT) AS outlier_count,
        round(CASE WHEN n > 0 THEN outliers / n ELSE 0.0 END, 6) AS outlier_rate
      FROM outl WHERE feature NOT IN (SELECT feature FROM excl)""",
    "sensor_reliability": _with() + "SELECT * FROM relo",
    "record_quality": _with(
        "rmap AS (SELECT map_from_entries(list(struct_pack(k := sensor, v := sensor_reliability_score))) AS m FROM relo)",
        "rq AS (SELECT record_id, ts, target, status, "
        + " + ".join(f"CASE WHEN {s} IS NULL THEN 0 ELSE 1 END" for s in SENS) + " AS n_obs, "
        + "(0.0 + " + " + ".join(f"CASE WHEN {s} IS NULL THEN 0.0 ELSE rmap.m['{s}'] END" for s in SENS) + ") AS rsum "
        + "FROM wide_records, rmap)",
    ) + f"""SELECT record_id, ts, target, status, CAST({K} - n_obs AS BIGINT) AS missing_sensor_count,
        round(1 - n_obs / {K}, 6) AS missing_sensor_rate, CAST(n_obs AS BIGINT) AS observed_sensor_count,
        round(rsum / greatest(n_obs, 1), 6) AS mean_observed_sensor_reliability, round(n_obs / {K}, 6) AS completeness_score,
        round(least(greatest(0.6 * (n_obs / {K}) + 0.4 * (rsum / greatest(n_obs, 1)), 0.0), 1.0), 6) AS data_quality_score,
        {_cut(f'least(greatest(0.6 * (n_obs / {K}) + 0.4 * (rsum / greatest(n_obs, 1)), 0.0), 1.0)', P.RECORD_QUALITY_EDGES, P.RECORD_QUALITY_BANDS)} AS data_quality_band
      FROM rq""",
    "row_quality": fx.sql_with("wide_records") + f"""SELECT record_id, target, CAST({_ROWMISS} AS BIGINT) AS missing_count,
        round({_ROWMISS} / {K}, 6) AS missing_rate, CAST({K} - {_ROWMISS} AS BIGINT) AS available_count,
        {_cut(f'{_ROWMISS} / {K}', P.ROW_QUALITY_EDGES, P.ROW_QUALITY_FLAGS)} AS quality_flag FROM wide_records""",
    "daily_trend": fx.sql_with("wide_records") + """SELECT CAST(ts AS DATE) AS day, count(*) AS records,
        count(*) FILTER (WHERE target = 1) AS failures, round(count(*) FILTER (WHERE target = 1) / count(*), 6) AS failure_rate
      FROM wide_records GROUP BY 1""",
    "class_distribution": fx.sql_with("wide_records") + """SELECT target, status, count(*) AS records,
        round(count(*) / sum(count(*)) OVER (), 6) AS share FROM wide_records GROUP BY target, status""",
    "missingness_association": fx.sql_with("wide_records", "long_records", extra=[
        """ma AS (SELECT feature, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS m,
            count(*) FILTER (WHERE value IS NULL AND target = 1) AS m1,
            count(*) FILTER (WHERE value IS NOT NULL AND target = 1) AS o1 FROM long_records GROUP BY feature)""",
        """mb AS (SELECT feature, n, m, m1, o1, n - m AS o, m - m1 AS m0, (n - m) - o1 AS o0, m1 + o1 AS y1, (m - m1) + ((n - m) - o1) AS y0 FROM ma)""",
    ]) + """SELECT feature, CAST(m AS BIGINT) AS missing_count, round(m / n, 6) AS missing_rate,
        round(CASE WHEN m > 0 THEN m1 / m END, 6) AS failure_rate_when_missing,
        round(CASE WHEN o > 0 THEN o1 / o END, 6) AS failure_rate_when_observed,
        round(CASE WHEN m > 0 THEN m1 / m END - CASE WHEN o > 0 THEN o1 / o END, 6) AS failure_rate_difference,
        round(CASE WHEN m = 0 THEN 0.0 ELSE
          (CASE WHEN m1 > 0 THEN (m1 / n) * ln((m1 * n) / (m * y1)) ELSE 0.0 END)
        + (CASE WHEN m0 > 0 THEN (m0 / n) * ln((m0 * n) / (m * y0)) ELSE 0.0 END)
        + (CASE WHEN o1 > 0 THEN (o1 / n) * ln((o1 * n) / (o * y1)) ELSE 0.0 END)
        + (CASE WHEN o0 > 0 THEN (o0 / n) * ln((o0 * n) / (o * y0)) ELSE 0.0 END) END, 6) AS mutual_information
      FROM mb""",
    "row_missingness_bands": fx.sql_with("wide_records") + f"""SELECT d.band_order, d.band,
        CAST(coalesce(c.records, 0) AS BIGINT) AS records, CAST(coalesce(c.failures, 0) AS BIGINT) AS failures,
        round(CASE WHEN coalesce(c.records, 0) > 0 THEN c.failures / c.records END, 6) AS failure_rate
      FROM (VALUES {', '.join(f"({i}, '{b}')" for i, b in enumerate(P.ROW_MISSING_BANDS))}) d(band_order, band)
      LEFT JOIN (SELECT {_cut(f'{_ROWMISS} / {K}', P.ROW_MISSING_BAND_EDGES, P.ROW_MISSING_BANDS)} AS band,
                        count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures FROM wide_records GROUP BY 1) c
      USING (band)""",
    "split_summary": fx.sql_with("wide_records", extra=[
        f"""rk AS (SELECT record_id, target, row_number() OVER (PARTITION BY target ORDER BY {HASH}, record_id) AS r,
            count(*) OVER (PARTITION BY target) AS n FROM wide_records)""",
        """sp AS (SELECT record_id, target, CASE WHEN r <= round(n * 0.2) THEN 'test'
            WHEN r <= round(n * 0.2) + round(n * 0.16) THEN 'validation' ELSE 'train' END AS split FROM rk)""",
    ]) + """SELECT split, count(*) AS records, count(*) FILTER (WHERE target = 1) AS failures,
        round(count(*) FILTER (WHERE target = 1) / count(*), 6) AS failure_rate,
        round(count(*) / sum(count(*)) OVER (), 6) AS share FROM sp GROUP BY split""",
}
SQL["stratified_split"] = SQL["split_summary"].split("SELECT split, count(*)")[0] + "SELECT record_id, target, split FROM sp"

# correlated pairs: the median-filled Pearson r of every unordered pair of kept sensors
_PAIRS = []
for i, a in enumerate(SENS):
    for b in SENS[i + 1:]:
        _PAIRS.append(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(coalesce({a}, (SELECT median FROM pf WHERE feature = '{a}')), "
            f"coalesce({b}, (SELECT median FROM pf WHERE feature = '{b}'))) AS r FROM wide_records"
        )
SQL["correlated_pairs"] = _with("pairs AS (" + "\nUNION ALL\n".join(_PAIRS) + ")") + f"""SELECT feature_a, feature_b,
    round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation FROM pairs
  WHERE feature_a NOT IN (SELECT feature FROM excl) AND feature_b NOT IN (SELECT feature FROM excl)
    AND NOT isnan(r) AND abs(r) >= {P.CORRELATION_THRESHOLD!r}"""

SQL["audit_summary"] = _with() + f"""SELECT b.total_rows, CAST({K} AS BIGINT) AS sensor_columns, b.fail_count,
    round(b.fail_count / b.total_rows, 6) AS failure_rate, round(b.missing_cells / (b.total_rows * {K}), 6) AS missing_rate,
    c.constant_features, c.constant_list, nc.near_constant_features, h.high_missing_features, h.high_missing_list,
    d.dropped_features, d.dropped_list, {K} - d.dropped_features AS retained_sensors
  FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE target = 1) AS fail_count, sum({_ROWMISS}) AS missing_cells FROM wide_records) b,
       (SELECT count(*) AS constant_features, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS constant_list FROM pf WHERE distinct_n <= 1) c,
       (SELECT count(*) AS near_constant_features FROM nearc WHERE filled_variance <= {P.NEAR_CONSTANT_VARIANCE!r}) nc,
       (SELECT count(*) AS high_missing_features, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS high_missing_list
          FROM pf WHERE {_RATE} > {P.HIGH_MISSING!r}) h,
       (SELECT count(*) AS dropped_features, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS dropped_list
          FROM pf WHERE distinct_n <= 1 OR {_RATE} > {P.HIGH_MISSING!r}) d"""

# the audited table drops the constant sensor and the sensor above the 60 % missing rule of this fixture
SQL["audited_dataset"] = fx.sql_with("wide_records") + "SELECT * EXCLUDE (sensor_016, sensor_018) FROM wide_records"
SQL["daily_trend"] = SQL["daily_trend"].replace("CAST(ts AS DATE) AS day", "strftime(ts, '%Y-%m-%d') AS day")
