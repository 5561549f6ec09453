"""Registered preparation / feature-engineering queries and DuckDB twins (fit side = reference)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import row_array, to_long
from ..functions.expressions import r6
from ..operators import explain as X
from ..operators import features as FE
from ..operators import metrics as M
from ..session import cut_lineage
from ..sources import fixtures as fx
from . import sqlbits as S

SENS = fx.SENSORS
K = len(SENS)


def _ref():
    return F.col("side") == "reference"

INJECT_RATE = 0.2


def _w(spark, sf):
    return fx.wide_records(spark, sf)


def _snap(spark, sf):
    return cut_lineage(_w(spark, sf))  # read by the fit and by the transform


def _stats(w):
    return FE.development_stats(w, SENS, fit=_ref())


def q_development_stats(spark, sf):
    st = _stats(_w(spark, sf))
    return st.select("feature", *[r6(F.col(c)).alias(c) for c in ("median", "q1", "q3", "iqr", "mean", "std", "missing_rate")],
                     "observed_count")


def q_median_impute(spark, sf):
    w = _w(spark, sf)
    t = FE.median_impute(w, SENS, _stats(w))
    return t.select(*[r6(F.col(c)).alias(c) if c in SENS else F.col(c) for c in t.columns])


def q_robust_scale(spark, sf):
    w = _w(spark, sf)
    return FE.robust_scale(w, SENS, _stats(w))


def q_class_weights(spark, sf):
    return FE.class_weights(_w(spark, sf).where(_ref()))


def q_missingness_features(spark, sf):
    return FE.missingness_features(_w(spark, sf), SENS)


def q_inject_missingness(spark, sf):
    return FE.inject_missingness(_w(spark, sf), SENS, INJECT_RATE)


def q_min_max_normalise(spark, sf):
    return FE.min_max_normalise(fx.scores(spark, sf), "ood_percentile")


def _quality(w):
    comp = 1 - F.size(F.filter(row_array(SENS), lambda x: x.isNull())) / F.lit(K)
    return w.select("record_id", comp.alias("quality_score"))


def q_merge_context(spark, sf):
    w = _w(spark, sf)
    an = fx.scores(spark, sf, w).select("record_id", F.col("ood_percentile").alias("anomaly_score"))
    t = FE.merge_context(w, _quality(w), an, "current")
    return t.select("record_id", "target", r6(F.col("quality_score")).alias("quality_score"),
                    r6(F.col("anomaly_score")).alias("anomaly_score"), "matched", "unmatched_records")


def q_aggregate_features(spark, sf):
    return FE.aggregate_features(_w(spark, sf), SENS)


def q_robust_deviation_features(spark, sf):
    w = _snap(spark, sf)
    return FE.robust_deviation_features(w, SENS, _stats(w))


def q_zone_features(spark, sf):
    w = _snap(spark, sf)
    return FE.zone_features(w, SENS, _stats(w))


def q_interaction_features(spark, sf):
    w = _w(spark, sf)
    ag = FE.aggregate_features(w, SENS).select("record_id", F.col("row_range").alias("range"), F.col("row_std").alias("std"),
                                               (F.col("row_missing_count") / K).alias("missing_rate"))
    dv = FE.robust_deviation_features(w, SENS, _stats(w)).select("record_id", F.col("abs_z_ge_3").alias("extremes"))
    q = _quality(w).select("record_id", F.col("quality_score").alias("quality"), F.col("quality_score").alias("completeness"))
    an = fx.scores(spark, sf, w).select("record_id", F.col("ood_percentile").alias("anomaly"))
    base = an.join(q, "record_id").join(ag, "record_id").join(dv, "record_id")
    return FE.interaction_features(base)


def q_missingness_stress(spark, sf):
    """Re-score under extra missingness r: linear attribution score (missing -> mean), AUC/AP per r."""
    w = _snap(spark, sf)
    coefs = X.coefficients(SENS)
    ref_long = to_long(w.where(_ref()), ["record_id"], SENS)
    st = ref_long.groupBy("feature").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s")).collect()  # one row per feature
    rates = spark.createDataFrame([(r,) for r in FE.STRESS_RATES], "rate double")
    cur = w.where(~_ref())

    def cells(r):
        """A record's score and its number of missing cells under the rate."""
        injected = FE.injected(SENS, r)
        z = [coefs[x["feature"]] * F.coalesce((injected[x["feature"]] - x["_m"]) / x["_s"], F.lit(0.0)) for x in st if x["_s"]]
        gone = [injected[x["feature"]].isNull().cast("int") for x in st]
        return F.struct(F.lit(r).alias("rate"), sum(z, F.lit(0.0)).alias("p"), sum(gone, F.lit(0)).alias("m"))

    each = cur.select("record_id", *[cells(r).alias(f"_{i}") for i, r in enumerate(FE.STRESS_RATES)])
    each = each.where(F.lit(bool(st))).groupBy("record_id").agg(*[F.struct(
        F.lit(r).alias("rate"), F.sum(f"_{i}.p").alias("probability"), (F.sum(f"_{i}.m") / (F.count(F.lit(1)) * max(len(st), 1))).alias("_miss")
    ).alias(f"_{i}") for i, r in enumerate(FE.STRESS_RATES)])
    tgt = w.select("record_id", "target")
    sc = each.join(tgt, "record_id").select("record_id", "target", F.explode(F.array(*[f"_{i}" for i in range(len(FE.STRESS_RATES))])).alias("_x"))
    sc = cut_lineage(sc.select("target", "_x.*"))
    ranked = M.ranked_scores(sc.select("rate", "probability", "target"), ["rate"])
    auc = M.roc_auc(ranked, ["rate"])
    ap = M.average_precision(ranked, ["rate"])
    mr = sc.groupBy("rate").agg(F.avg("_miss").alias("missing_cell_rate"))
    return rates.join(auc, "rate", "left").join(ap, "rate", "left").join(mr, "rate", "left").select(
        "rate", r6(F.col("roc_auc")).alias("roc_auc"), r6(F.col("average_precision")).alias("average_precision"),
        r6(F.col("missing_cell_rate")).alias("missing_cell_rate"))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_DS = [
    """ds AS (SELECT feature, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS q1,
      quantile_cont(value, 0.75) AS q3, coalesce(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 0.0) AS iqr,
      avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std, 1 - count(value) / count(*) AS missing_rate,
      count(value) AS observed_count FROM long_records WHERE side = 'reference' GROUP BY feature)""",
    "dsw AS (SELECT " + ", ".join(
        f"max(median) FILTER (WHERE feature = '{s}') AS med_{s}, max(iqr) FILTER (WHERE feature = '{s}') AS iqr_{s}"
        for s in SENS) + " FROM ds)",
]


def _ws(*extra):
    return fx.sql_with("wide_records", "long_records", "scores", extra=_DS + list(extra))


_ARR = "[" + ", ".join(SENS) + "]"
_OBS = f"list_filter({_ARR}, lambda x: x IS NOT NULL)"
_N = f"len({_OBS})"


def _median(obs):
    s = f"list_sort({obs})"
    n = f"len({obs})"
    return (f"(CASE WHEN {n} = 0 THEN NULL ELSE ({s}[CAST(floor(({n} - 1) / 2) AS INTEGER) + 1]"
            f" + {s}[CAST(ceil(({n} - 1) / 2) AS INTEGER) + 1]) / 2.0 END)")


def _mean(obs):
    return f"(CASE WHEN len({obs}) > 0 THEN list_sum({obs}) / len({obs}) END)"


def _std(obs):
    m = _mean(obs)
    return (f"(CASE WHEN len({obs}) > 1 THEN sqrt(list_reduce(list_transform({obs}, lambda x: (x - {m}) * (x - {m})),"
            f" lambda a, b: a + b, 0.0) / (len({obs}) - 1)) END)")


_ABS_OBS = f"list_transform({_OBS}, lambda x: abs(x))"
_ZARR = "[" + ", ".join(f"({s} - med_{s}) / CASE WHEN abs(coalesce(iqr_{s}, 0.0)) > 1e-12 THEN iqr_{s} ELSE 1.0 END"
                        for s in SENS) + "]"
_ZOBS = f"list_filter({_ZARR}, lambda x: x IS NOT NULL)"


def _zone_cols():
    cols = []
    for zi, zf in enumerate(FE.zones(SENS), start=1):
        arr = "[" + ", ".join(zf) + "]"
        obs = f"list_filter({arr}, lambda x: x IS NOT NULL)"
        cols += [f"round({_mean(obs)}, 6) AS zone{zi}_mean", f"round({_std(obs)}, 6) AS zone{zi}_std",
                 f"round(list_min({obs}), 6) AS zone{zi}_min", f"round(list_max({obs}), 6) AS zone{zi}_max",
                 f"round(list_max({obs}) - list_min({obs}), 6) AS zone{zi}_range",
                 f"{len(zf)} - len({obs}) AS zone{zi}_missing",
                 f"round({_mean(f'list_transform({obs}, lambda x: abs(x))')}, 6) AS zone{zi}_abs_mean",
                 f"round({_median(obs)}, 6) AS zone{zi}_median", f"len({obs}) AS zone{zi}_observed",
                 f"round(({len(zf)} - len({obs})) / {len(zf)}, 6) AS zone{zi}_missing_rate"]
        zarr = "[" + ", ".join(f"abs({s} - med_{s}) / CASE WHEN abs(coalesce(iqr_{s}, 0.0)) > 1e-12 THEN iqr_{s} ELSE 1.0 END"
                               for s in zf) + "]"
        az = f"list_filter({zarr}, lambda x: x IS NOT NULL)"
        over = [f"len(list_filter({zarr}, lambda x: x >= {t}))" for t in FE.DEVIATION_LEVELS]
        cols += [f"round({_mean(az)}, 6) AS zone{zi}_mean_abs_z", f"round({_median(az)}, 6) AS zone{zi}_median_abs_z",
                 f"round(list_max({az}), 6) AS zone{zi}_max_abs_z", f"{over[0]} AS zone{zi}_mild_count",
                 f"{over[1]} AS zone{zi}_moderate_count", f"{over[2]} AS zone{zi}_extreme_count",
                 f"round({over[2]} / greatest(len({obs}), 1), 6) AS zone{zi}_extreme_rate"]
    return ", ".join(cols)


_AGG = f"""agg AS (SELECT record_id, round({_mean(_OBS)}, 6) AS row_mean, round({_median(_OBS)}, 6) AS row_median,
    round({_std(_OBS)}, 6) AS row_std, round(list_min({_OBS}), 6) AS row_min, round(list_max({_OBS}), 6) AS row_max,
    round(list_max({_OBS}) - list_min({_OBS}), 6) AS row_range, round({_mean(_ABS_OBS)}, 6) AS row_abs_mean,
    round({_median(_ABS_OBS)}, 6) AS row_abs_median, {K} - {_N} AS row_missing_count,
    len(list_filter({_OBS}, lambda x: x > 0)) AS positive_count, len(list_filter({_OBS}, lambda x: x < 0)) AS negative_count,
    len(list_filter({_OBS}, lambda x: x = 0)) AS zero_count,
    round(CASE WHEN {_N} > 0 THEN len(list_filter({_OBS}, lambda x: x > 0)) / {_N} END, 6) AS positive_rate,
    round(CASE WHEN {_N} > 0 THEN len(list_filter({_OBS}, lambda x: x < 0)) / {_N} END, 6) AS negative_rate,
    round(CASE WHEN {_N} > 0 THEN len(list_filter({_OBS}, lambda x: x = 0)) / {_N} END, 6) AS zero_rate FROM wide_records)"""

_ZN = f"len({_ZOBS})"
_DEV = f"""dev AS (SELECT record_id, len(list_filter({_ZOBS}, lambda x: abs(x) >= 1.0)) AS abs_z_ge_1,
    len(list_filter({_ZOBS}, lambda x: abs(x) >= 1.5)) AS abs_z_ge_1_5, len(list_filter({_ZOBS}, lambda x: abs(x) >= 3.0)) AS abs_z_ge_3,
    len(list_filter({_ZOBS}, lambda x: x >= 3.0)) AS high_extremes, len(list_filter({_ZOBS}, lambda x: x <= -3.0)) AS low_extremes,
    len(list_filter({_ZOBS}, lambda x: x >= 3.0)) - len(list_filter({_ZOBS}, lambda x: x <= -3.0)) AS extreme_balance,
    round(CASE WHEN {_ZN} > 0 THEN len(list_filter({_ZOBS}, lambda x: abs(x) >= 1.0)) / {_ZN} END, 6) AS abs_z_ge_1_rate,
    round(CASE WHEN {_ZN} > 0 THEN len(list_filter({_ZOBS}, lambda x: abs(x) >= 1.5)) / {_ZN} END, 6) AS abs_z_ge_1_5_rate,
    round(CASE WHEN {_ZN} > 0 THEN len(list_filter({_ZOBS}, lambda x: abs(x) >= 3.0)) / {_ZN} END, 6) AS abs_z_ge_3_rate,
    round({_mean(_ZOBS)}, 6) AS z_mean,
    round(CASE WHEN {_ZN} > 0 THEN sqrt(list_reduce(list_transform({_ZOBS}, lambda x: x * x), lambda a, b: a + b, 0.0) / {_ZN}) END, 6) AS z_rms,
    round(list_max(list_transform({_ZOBS}, lambda x: abs(x))), 6) AS z_abs_max, round({_median(_ZOBS)}, 6) AS z_median,
    round({_std(_ZOBS)}, 6) AS z_std FROM wide_records, dsw)"""

_QUAL = f"qual AS (SELECT record_id, 1 - ({' + '.join(f'CASE WHEN {s} IS NULL THEN 1 ELSE 0 END' for s in SENS)}) / {K} AS quality_score FROM wide_records)"
_FLAGGED = SENS[:16]  # sensors with missing values on the reference side of this fixture
_COEF = X.coefficients(SENS)


def _inject(rate):
    seed = int(42 + 1000 * rate)
    return ", ".join(
        f"CASE WHEN CAST('0x' || substr(md5(o_orderkey || '|{s}|{seed}'), 1, 8) AS BIGINT) / 4294967296.0 < {rate!r} THEN NULL ELSE {s} END AS {s}"
        for i, s in enumerate(SENS))


_STRESS = [
    "st AS (SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM long_records WHERE side = 'reference' GROUP BY feature)",
    "coef AS (SELECT * FROM (VALUES " + ", ".join(f"('{f}', {c!r})" for f, c in _COEF.items()) + ") t(feature, c))",
    "inj AS (" + " UNION ALL ".join(
        f"SELECT record_id, target, {r!r} AS rate, {_inject(r)} FROM wide_records WHERE side = 'current'" for r in FE.STRESS_RATES) + ")",
    "il AS (" + " UNION ALL ".join(f"SELECT record_id, target, rate, '{s}' AS feature, {s} AS value FROM inj" for s in SENS) + ")",
    """isc AS (SELECT rate, record_id, any_value(target) AS target,
      sum(c * CASE WHEN s IS NULL OR s = 0 OR value IS NULL THEN 0.0 ELSE (value - m) / s END) AS probability,
      avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS miss FROM il JOIN st USING (feature) JOIN coef USING (feature) GROUP BY rate, record_id)""",
    """rs AS (SELECT rate, probability AS score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg
      FROM isc GROUP BY rate, probability)""",
    """rk AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY rate) AS tot_pos,
      sum(neg) OVER (PARTITION BY rate) AS tot_neg FROM rs WINDOW w AS (PARTITION BY rate ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
]

SQL = {
    "development_stats": _ws() + """SELECT feature, round(median, 6) AS median, round(q1, 6) AS q1, round(q3, 6) AS q3,
        round(iqr, 6) AS iqr, round(mean, 6) AS mean, round(std, 6) AS std, round(missing_rate, 6) AS missing_rate,
        observed_count FROM ds""",
    "median_impute": _ws() + "SELECT record_id, " + ", ".join(f"round(coalesce({s}, med_{s}), 6) AS {s}" for s in SENS) + ", "
    + ", ".join(f"CAST({s} IS NULL AS INTEGER) AS {s}_missing" for s in _FLAGGED) + " FROM wide_records, dsw",
    "robust_scale": _ws() + "SELECT record_id, " + ", ".join(
        f"round(({s} - med_{s}) / CASE WHEN abs(coalesce(iqr_{s}, 0.0)) > 0 THEN iqr_{s} ELSE 1.0 END, 6) AS {s}" for s in SENS)
    + " FROM wide_records, dsw",
    "class_weights": fx.sql_with("wide_records") + """, r AS (SELECT * FROM wide_records WHERE side = 'reference')
      SELECT target, count(*) AS records, round((SELECT count(*) FROM r) / (2.0 * count(*)), 6) AS balanced_weight,
        round((SELECT count(*) FILTER (WHERE target = 0) FROM r) / nullif((SELECT count(*) FILTER (WHERE target = 1) FROM r), 0), 6) AS scale_pos_weight
      FROM r GROUP BY target""",
    "missingness_features": fx.sql_with("wide_records") + f"""SELECT record_id, {K} - {_N} AS row_missing_count,
        round(({K} - {_N}) / {K}, 6) AS row_missing_rate, {_N} AS row_observed_count, """
    + ", ".join(f"CAST({s} IS NULL AS INTEGER) AS {s}_missing" for s in SENS) + " FROM wide_records",
    "inject_missingness": fx.sql_with("wide_records") + f"SELECT record_id, o_orderkey, {_inject(INJECT_RATE)} FROM wide_records",
    "min_max_normalise": fx.sql_with("wide_records", "scores") + """SELECT record_id, ood_percentile,
        round(CASE WHEN mx - mn < 1e-12 THEN 0.0 ELSE (ood_percentile - mn) / (mx - mn) END, 6) AS ood_percentile_normalised
      FROM scores, (SELECT min(ood_percentile) AS mn, max(ood_percentile) AS mx FROM scores)""",
    "merge_context": fx.sql_with("wide_records", "scores", extra=[_QUAL]) + """, t AS (SELECT w.record_id, w.target, q.quality_score,
        s.ood_percentile AS anomaly_score, q.quality_score IS NOT NULL AND s.ood_percentile IS NOT NULL AS matched
        FROM wide_records w LEFT JOIN qual q USING (record_id) LEFT JOIN scores s USING (record_id) WHERE w.side = 'current')
      SELECT record_id, target, round(quality_score, 6) AS quality_score, round(anomaly_score, 6) AS anomaly_score, matched,
        (SELECT count(*) FILTER (WHERE NOT matched) FROM t) AS unmatched_records FROM t""",
    "aggregate_features": fx.sql_with("wide_records", extra=[_AGG]) + "SELECT * FROM agg",
    "robust_deviation_features": _ws(_DEV) + "SELECT * FROM dev",
    "zone_features": _ws() + f"SELECT record_id, {_zone_cols()} FROM wide_records, dsw",
    "interaction_features": _ws(_AGG, _DEV, _QUAL) + """, b AS (SELECT s.record_id, s.ood_percentile AS anomaly, q.quality_score AS quality,
        q.quality_score AS completeness, a.row_missing_count / """ + str(K) + """ AS missing_rate, d.abs_z_ge_3 AS extremes,
        a.row_range AS range, a.row_std AS std FROM scores s JOIN qual q USING (record_id) JOIN agg a USING (record_id) JOIN dev d USING (record_id))
      SELECT record_id, """ + ", ".join(
        f"{S.sig(f'CASE WHEN isnan({a} * {b}) OR isinf({a} * {b}) THEN NULL ELSE {a} * {b} END')} AS {a}_x_{b}"
        for a, b in FE.INTERACTIONS) + " FROM b",
    "missingness_stress": _ws(*_STRESS) + """, auc AS (SELECT rate, round(sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (max(tot_pos) * max(tot_neg)), 6) AS roc_auc,
        round(sum(CASE WHEN pos > 0 THEN (pos / tot_pos) * ((tot_pos - (cum_pos - pos)) / ((tot_pos - (cum_pos - pos)) + (tot_neg - (cum_neg - neg)))) ELSE 0.0 END), 6) AS average_precision
        FROM rk GROUP BY rate), mr AS (SELECT rate, round(avg(miss), 6) AS missing_cell_rate FROM isc GROUP BY rate)
      SELECT rate, roc_auc, average_precision, missing_cell_rate FROM auc JOIN mr USING (rate)""",
}
