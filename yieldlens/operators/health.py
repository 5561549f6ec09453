"""Output drift, category drift, data quality, alerts and deployment health.

All inputs are the record table split by a ``side`` column.  Output drift
reuses the feature-drift base on the score columns; everything after the
per-feature tables is a few hundred rows (alerts, components, one health
row), so those steps are plain small aggregates and windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DriftConfig
from ..functions.columns import row_array
from ..functions.expressions import max_severity, r6, rank_to_severity, severity, severity_rank, weighted_health
from . import drift as D

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
OUTPUT_METRICS = {  # output column -> threshold key
    "probability": "probability_mean_shift",
    "confidence": "confidence_mean_shift",
    "uncertainty": "uncertainty_mean_shift",
    "data_confidence": "confidence_mean_shift",
}
OUTPUT_WEIGHTS = {"mean_shift": 0.35, "psi": 0.30, "ks_statistic": 0.25, "availability": 0.10}
UNAVAILABLE_HEALTH = 70.0
QUALITY_WEIGHTS = {
    "missing_rate": 0.30, "duplicate_rate": 0.15, "constant_feature_rate": 0.20, "unmatched_feature_rate": 0.15,
    "invalid_probability_rate": 0.05, "invalid_confidence_rate": 0.05, "invalid_uncertainty_rate": 0.05,
    "id_duplicate_rate": 0.05,
}
VALIDATION_LIMITS = (0.0, 0.03, 0.10)  # > 0 Watch, >= .03 Warning, >= .10 Critical
MISSING_LABELS = ["", "nan", "none", "null"]
MISSING_CATEGORY = "Missing"
RETRAIN = ["Immediate Retraining", "Retrain Soon", "Increase Monitoring", "Continue Monitoring"]


def output_drift(df: DataFrame, metrics: Sequence[str], cfg: DriftConfig | None = None,
                 id_col: str = "record_id") -> DataFrame:
    """Distribution drift of model outputs; metrics absent from ``df`` score Warning / 70."""
    cfg = cfg or DriftConfig()
    present = [m for m in metrics if m in df.columns]
    b = D.DriftBase(df, present, cfg.epsilon, id_col, "side")
    t = b.stats.join(D.psi(b, cfg.number_of_bins), "feature", "left").join(D.ks_two_sample(b), "feature", "left").join(
        D.wasserstein(b, cfg.number_of_bins), "feature", "left")
    shift = F.abs(F.col("mean_cur") - F.col("mean_ref"))
    th = cfg.prediction_thresholds
    key_map = F.create_map(*[x for m in present for x in (F.lit(m), F.lit(OUTPUT_METRICS.get(m, m)))])
    mean_sev = F.lit("Normal")
    for key, vals in th.items():
        mean_sev = F.when(key_map[F.col("feature")] == key, severity(shift, vals)).otherwise(mean_sev)
    ft = cfg.feature_thresholds
    sev = {
        "mean_shift": mean_sev,
        "psi": severity(F.col("psi"), ft["psi"]),
        "ks_statistic": severity(F.col("ks_statistic"), ft["ks_statistic"]),
        "availability": F.when(F.col("n_cur") == 0, "Critical").when(F.col("n_ref") == 0, "Warning").otherwise("Normal"),
    }
    overall = max_severity(*sev.values())
    out = t.select(
        F.col("feature").alias("metric_name"),
        F.col("n_ref").cast("bigint").alias("reference_count"), F.col("n_cur").cast("bigint").alias("current_count"),
        r6(F.col("mean_ref")).alias("reference_mean"), r6(F.col("mean_cur")).alias("current_mean"),
        r6(shift).alias("absolute_mean_shift"), r6(F.col("std_ref")).alias("reference_std"),
        r6(F.col("std_cur")).alias("current_std"), r6(F.col("psi")).alias("psi"),
        r6(F.col("ks_statistic")).alias("ks_statistic"), r6(F.col("ks_p_value")).alias("ks_p_value"),
        r6(F.col("wasserstein_distance")).alias("wasserstein_distance"),
        overall.alias("severity"), weighted_health(sev, OUTPUT_WEIGHTS).alias("health_score"),
        F.lit(True).alias("available"),
    )
    missing = [m for m in metrics if m not in df.columns]
    if missing:
        spark = df.sparkSession
        miss = spark.createDataFrame([(m,) for m in missing], "metric_name string").select(
            "metric_name", *[F.lit(0).cast("bigint").alias(c) for c in ("reference_count", "current_count")],
            *[F.lit(None).cast("double").alias(c) for c in (
                "reference_mean", "current_mean", "absolute_mean_shift", "reference_std", "current_std", "psi",
                "ks_statistic", "ks_p_value", "wasserstein_distance")],
            F.lit("Warning").alias("severity"), F.lit(UNAVAILABLE_HEALTH).alias("health_score"),
            F.lit(False).alias("available"))
        out = out.unionByName(miss)
    return out.withColumn("severity_rank", severity_rank(F.col("severity")))


def normalise_category(c: Column) -> Column:
    t = F.trim(c.cast("string"))
    return F.when(t.isNull() | F.lower(t).isin(*MISSING_LABELS), MISSING_CATEGORY).otherwise(t)


def category_shares(df: DataFrame, col: str) -> DataFrame:
    """Per category: counts and shares on each side (full outer union of both sides' categories)."""
    c = df.groupBy(normalise_category(F.col(col)).alias("category")).agg(
        F.count(F.when(F.col("side") == D.REF, 1)).alias("reference_count"),
        F.count(F.when(F.col("side") == D.CUR, 1)).alias("current_count"),
    )
    w = Window.partitionBy()  # one row per category: bounded by the domain
    rs = F.sum("reference_count").over(w)
    cs = F.sum("current_count").over(w)
    return c.select(
        "category", "reference_count", "current_count",
        r6(F.when(rs > 0, F.col("reference_count") / rs).otherwise(0.0)).alias("reference_share"),
        r6(F.when(cs > 0, F.col("current_count") / cs).otherwise(0.0)).alias("current_share"),
    ).select("*", r6(F.col("current_share") - F.col("reference_share")).alias("share_shift"))


def category_drift(df: DataFrame, col: str, cfg: DriftConfig | None = None, metric: str = "decision") -> DataFrame:
    """Total-variation distance of category shares, largest shift, unseen and vanished categories."""
    cfg = cfg or DriftConfig()
    s = category_shares(df, col)
    a = s.agg(
        (0.5 * F.sum(F.abs(F.col("current_share") - F.col("reference_share")))).alias("tv"),
        F.max(F.struct(F.abs(F.col("share_shift")), F.col("category"))).getField("category").alias("largest_shift_category"),
        F.max(F.abs(F.col("share_shift"))).alias("largest_shift"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when((F.col("reference_count") == 0), F.col("category"))))).alias(
            "unseen_categories"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when((F.col("current_count") == 0), F.col("category"))))).alias(
            "absent_categories"),
        F.count(F.lit(1)).alias("categories"),
    )
    sev = severity(F.col("tv"), cfg.prediction_thresholds["decision_total_variation"])
    return a.select(F.lit(metric).alias("metric_name"), r6(F.col("tv")).alias("total_variation_distance"),
                    "largest_shift_category", r6(F.col("largest_shift")).alias("largest_shift"), "unseen_categories",
                    "absent_categories", "categories", sev.alias("severity"),
                    weighted_health({"tv": sev}, {"tv": 1.0}).alias("health_score"))


def _validation_severity(v: Column) -> Column:
    lo, mid, hi = VALIDATION_LIMITS
    return F.when(v.isNull(), "Normal").when(v >= hi, "Critical").when(v >= mid, "Warning").when(v > lo, "Watch").otherwise(
        "Normal")


def data_quality(df: DataFrame, features: Sequence[str], id_col: str = "record_id", probability: str | None = "probability",
                 confidence: str | None = "confidence", uncertainty: str | None = "uncertainty",
                 reference_features: Sequence[str] | None = None, cfg: DriftConfig | None = None) -> DataFrame:
    """Eight quality metrics per side (current drives severity), one row per metric, plus weighted health."""
    cfg = cfg or DriftConfig()
    k = len(features)
    miss = F.size(F.filter(row_array(features), lambda x: x.isNull()))
    invalid = lambda c: (F.col(c).isNull() | (F.col(c) < 0) | (F.col(c) > 1)) if c and c in df.columns else None  # noqa
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(miss).alias("missing_cells"), F.countDistinct(id_col).alias("ids")]
    for name, c in (("prob", probability), ("conf", confidence), ("unc", uncertainty)):
        e = invalid(c)
        aggs.append((F.count(F.when(e, 1)) if e is not None else F.lit(None).cast("bigint")).alias(f"bad_{name}"))
    base = df.groupBy("side").agg(*aggs)
    dups = df.groupBy("side", *features).count().groupBy("side").agg(F.sum(F.col("count") - 1).alias("dup_rows"))
    const = df.select("side", *features)
    const_rows = const.groupBy("side").agg(*[
        F.coalesce(F.min(f) == F.max(f), F.lit(True)).cast("int").alias(f) for f in features])
    const_rate = const_rows.select("side", (sum(F.col(f) for f in features) / k).alias("constant_feature_rate"))
    unmatched = 0.0
    if reference_features is not None:
        shared = set(features) & set(reference_features)
        union = set(features) | set(reference_features)
        unmatched = (len(union) - len(shared)) / len(union) if union else 0.0
    m = base.join(dups, "side", "left").join(const_rate, "side", "left").select(
        "side",
        (F.col("missing_cells") / (F.col("rows") * k)).alias("missing_rate"),
        (F.coalesce("dup_rows", F.lit(0)) / F.col("rows")).alias("duplicate_rate"),
        F.col("constant_feature_rate"),
        F.lit(unmatched).alias("unmatched_feature_rate"),
        (F.col("bad_prob") / F.col("rows")).alias("invalid_probability_rate"),
        (F.col("bad_conf") / F.col("rows")).alias("invalid_confidence_rate"),
        (F.col("bad_unc") / F.col("rows")).alias("invalid_uncertainty_rate"),
        ((F.col("rows") - F.col("ids")) / F.col("rows")).alias("id_duplicate_rate"),
    )
    names = list(QUALITY_WEIGHTS)
    long = m.unpivot(["side"], names, "metric", "value")
    piv = long.groupBy("metric").agg(
        F.max(F.when(F.col("side") == D.CUR, F.col("value"))).alias("value"),
        F.max(F.when(F.col("side") == D.REF, F.col("value"))).alias("reference_value"),
    )
    th = cfg.quality_thresholds
    sev = F.lit("Normal")
    for name in names:
        s = severity(F.col("value"), th[name]) if name in th else _validation_severity(F.col("value"))
        sev = F.when(F.col("metric") == name, s).otherwise(sev)
    weight = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(QUALITY_WEIGHTS[n]))])
    return piv.select("metric", r6(F.col("value")).alias("value"), r6(F.col("reference_value")).alias("reference_value"),
                      sev.alias("severity"), weight[F.col("metric")].alias("weight")).withColumn(
        "severity_rank", severity_rank(F.col("severity")))


def data_quality_summary(dq: DataFrame) -> DataFrame:
    from ..config import SEVERITY_SCORE
    score = F.lit(100.0)
    for k, v in SEVERITY_SCORE.items():
        score = F.when(F.col("severity") == k, v).otherwise(score)
    return dq.agg(
        F.round(F.sum(score * F.col("weight")) / F.sum("weight"), 2).alias("health_score"),
        rank_to_severity(F.max("severity_rank")).alias("severity"),
        F.count(F.when(F.col("severity") != "Normal", 1)).alias("flagged_metrics"),
    )


def prediction_summary(out_drift: DataFrame, cat: DataFrame) -> DataFrame:
    """Dominant severity and mean health over output metrics plus the decision metric."""
    rows = out_drift.select("metric_name", "severity", "health_score").unionByName(
        cat.select("metric_name", "severity", "health_score"))
    return rows.agg(rank_to_severity(F.max(severity_rank(F.col("severity")))).alias("dominant_severity"),
                    F.round(F.avg("health_score"), 2).alias("mean_health_score"),
                    F.count(F.when(F.col("severity") != "Normal", 1)).alias("flagged_metrics"))


def alert_id(run_id: Column, category: Column, alert_type: Column, resource: Column, metric: Column) -> Column:
    """First 20 hex digits of sha256(run|category|type|resource|metric)."""
    return F.substring(F.sha2(F.concat_ws("|", run_id, category, alert_type, resource, metric), 256), 1, 20)


def threshold_levels(cfg: DriftConfig | None = None) -> dict[str, tuple[float, float, float]]:
    """Watch, Warning and Critical limits by threshold name, of all four alert sources."""
    cfg = cfg or DriftConfig()
    return {**cfg.feature_thresholds, **cfg.prediction_thresholds, **cfg.quality_thresholds}


def threshold_reached(name: Column, sev: Column, cfg: DriftConfig | None = None) -> Column:
    """The limit that a severity stands for; NULL for metrics without limits (constant change, availability, ...)."""
    levels = F.create_map(*[x for k, v in threshold_levels(cfg).items() for x in (F.lit(k), F.array(*[F.lit(float(y)) for y in v]))])
    return F.get(levels[name], severity_rank(sev) - 1)


def alerts(run_id: str, feature_drift: DataFrame, out_drift: DataFrame, cat: DataFrame, dq: DataFrame) -> DataFrame:
    """One row per non-Normal finding from four sources, with id, message, action and JSON evidence."""
    def sel(df, category, alert_type, resource, metric, value, threshold, extra):
        return df.where(F.col("severity") != "Normal").select(
            F.lit(category).alias("category"), F.lit(alert_type).alias("alert_type"), F.col("severity"),
            resource.alias("resource_id"), metric.alias("metric_name"), r6(value).alias("observed_value"),
            threshold.alias("threshold_value"),
            F.to_json(F.struct(resource.alias("resource_id"), metric.alias("metric_name"), F.col("severity"))).alias(
                "evidence_json"))

    fd = feature_drift.withColumnRenamed("overall_severity", "severity")
    fd_metric = (F.when(F.col("psi_severity") == F.col("severity"), "psi")
                 .when(F.col("ks_statistic_severity") == F.col("severity"), "ks_statistic")
                 .when(F.col("standardised_mean_shift_severity") == F.col("severity"), "standardised_mean_shift")
                 .when(F.col("missing_rate_difference_severity") == F.col("severity"), "missing_rate_difference")
                 .when(F.col("constant_sensor_change_severity") == F.col("severity"), "constant_sensor_change")
                 .otherwise("measurement_availability"))
    fd_value = (F.when(fd_metric == "psi", F.col("psi")).when(fd_metric == "ks_statistic", F.col("ks_statistic"))
                .when(fd_metric == "standardised_mean_shift", F.col("standardised_mean_shift"))
                .when(fd_metric == "missing_rate_difference", F.col("missing_rate_difference")))
    reached = lambda name: threshold_reached(name, F.col("severity"))
    outputs = F.create_map(*[F.lit(x) for kv in OUTPUT_METRICS.items() for x in kv])
    a1 = sel(fd, "feature_drift", "sensor_drift", F.col("feature"), fd_metric, fd_value, reached(fd_metric),
             F.struct("psi", "ks_statistic", "standardised_mean_shift", "missing_rate_difference"))
    a2 = sel(out_drift, "prediction_drift", "output_distribution", F.col("metric_name"), F.lit("absolute_mean_shift"),
             F.col("absolute_mean_shift"), reached(outputs[F.col("metric_name")]), F.struct("absolute_mean_shift", "psi", "ks_statistic"))
    a3 = sel(cat, "prediction_drift", "decision_mix", F.col("metric_name"), F.lit("total_variation_distance"),
             F.col("total_variation_distance"), reached(F.lit("decision_total_variation")),
             F.struct("total_variation_distance", "largest_shift_category"))
    a4 = sel(dq, "data_quality", "data_quality", F.col("metric"), F.col("metric"), F.col("value"),
             reached(F.col("metric")), F.struct("value", "reference_value"))
    allr = a1.unionByName(a2).unionByName(a3).unionByName(a4)
    rid = F.lit(run_id)
    msg = F.format_string("%s %s on %s (%s)", F.col("severity"), F.col("alert_type"), F.col("resource_id"),
                          F.col("metric_name"))
    action = (F.when(F.col("severity") == "Critical", "Investigate now and assess retraining")
              .when(F.col("severity") == "Warning", "Review at the next monitoring meeting")
              .otherwise("Keep watching"))
    return allr.select(
        alert_id(rid, F.col("category"), F.col("alert_type"), F.col("resource_id"), F.col("metric_name")).alias("alert_id"),
        rid.alias("run_id"), "category", "alert_type", "severity", "resource_id", "metric_name", "observed_value",
        "threshold_value", F.coalesce(msg, F.lit("")).alias("message"), action.alias("recommended_action"),
        "evidence_json", severity_rank(F.col("severity")).alias("severity_rank"))


def health_components(feature_summary: DataFrame, out_drift: DataFrame, cat: DataFrame, dq_summary: DataFrame,
                      cfg: DriftConfig | None = None) -> DataFrame:
    """Four weighted components: data quality, feature drift, prediction drift, confidence/uncertainty."""
    cfg = cfg or DriftConfig()
    w = cfg.health_weights
    pred = out_drift.select("metric_name", "severity", "health_score").unionByName(
        cat.select("metric_name", "severity", "health_score"))
    conf = out_drift.where(F.col("metric_name").isin("confidence", "uncertainty", "data_confidence"))
    parts = [
        dq_summary.select(F.lit("data_quality").alias("component_name"), F.col("health_score").alias("raw_score"),
                          F.col("severity")),
        feature_summary.select(F.lit("feature_drift").alias("component_name"),
                               F.col("mean_feature_health_score").alias("raw_score"),
                               F.col("dominant_severity").alias("severity")),
        pred.agg(F.lit("prediction_drift").alias("component_name"), F.round(F.avg("health_score"), 2).alias("raw_score"),
                 rank_to_severity(F.max(severity_rank(F.col("severity")))).alias("severity")),
        conf.agg(F.lit("confidence_and_uncertainty").alias("component_name"),
                 F.round(F.avg("health_score"), 2).alias("raw_score"),
                 rank_to_severity(F.max(severity_rank(F.col("severity")))).alias("severity")),
    ]
    t = parts[0]
    for p in parts[1:]:
        t = t.unionByName(p)
    total = sum(w.values())
    wmap = F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(v / total))])
    return t.select("component_name", wmap[F.col("component_name")].alias("weight"), "raw_score",
                    F.round(F.col("raw_score") * wmap[F.col("component_name")], 4).alias("weighted_score"), "severity")


def health_band(score: Column) -> Column:
    from ..config import HEALTH_BANDS
    expr = F.lit(HEALTH_BANDS[-1][1])
    for lo, name in reversed(HEALTH_BANDS[:-1]):
        expr = F.when(score >= lo, name).otherwise(expr)
    return expr


def retraining_policy(score: Column, critical_alerts: Column, warning_alerts: Column, critical_feature_rate: Column,
                      dq_severity: Column, current_rows: Column, minimum_current_rows: int) -> Column:
    """Ordered rules: first match wins (the too-few-rows rule is evaluated, not raised)."""
    return (
        F.when(current_rows < minimum_current_rows, RETRAIN[2])
        .when((critical_alerts >= 3) | (critical_feature_rate >= 0.15) | ((score < 60.0) & (dq_severity != "Critical")),
              RETRAIN[0])
        .when((score < 65.0) | (critical_alerts > 0), RETRAIN[1])
        .when((score < 80.0) | (warning_alerts >= 5), RETRAIN[1])
        .when((score < 90.0) | (warning_alerts > 0), RETRAIN[2])
        .otherwise(RETRAIN[3])
    )


def health_assessment(run_id: str, components: DataFrame, alerts_df: DataFrame, feature_summary: DataFrame,
                      dq_summary: DataFrame, current_rows: DataFrame, cfg: DriftConfig | None = None) -> DataFrame:
    """Overall score, band, severity (worst of band and components), risk driver and recommendation."""
    from ..config import BAND_SEVERITY
    cfg = cfg or DriftConfig()
    comp = components.agg(
        F.round(F.sum("weighted_score") / F.sum("weight"), 2).alias("overall_health_score"),
        F.max(severity_rank(F.col("severity"))).alias("_comp_rank"),
        F.min(F.struct("raw_score", (-severity_rank(F.col("severity"))).alias("_neg"), "component_name",
                       "severity")).alias("_worst"),
    )
    al = alerts_df.agg(F.count(F.lit(1)).alias("total_alerts"),
                       F.count(F.when(F.col("severity") == "Critical", 1)).alias("critical_alerts"),
                       F.count(F.when(F.col("severity") == "Warning", 1)).alias("warning_alerts"),
                       F.count(F.when(F.col("severity") == "Watch", 1)).alias("watch_alerts"))
    fs = feature_summary.select((F.col("critical_features") / F.col("monitored_features")).alias("critical_feature_rate"))
    t = comp.crossJoin(al).crossJoin(fs).crossJoin(dq_summary.select(F.col("severity").alias("dq_severity"))).crossJoin(
        current_rows)
    band = health_band(F.col("overall_health_score"))
    bmap = F.create_map(*[x for k, v in BAND_SEVERITY.items() for x in (F.lit(k), F.lit(v))])
    sev = rank_to_severity(F.greatest(severity_rank(bmap[band]), F.col("_comp_rank")))
    driver = F.format_string("%s (%.2f/100, %s)", F.initcap(F.regexp_replace(F.col("_worst.component_name"), "_", " ")),
                             F.col("_worst.raw_score"), F.col("_worst.severity"))
    rec = retraining_policy(F.col("overall_health_score"), F.col("critical_alerts"), F.col("warning_alerts"),
                            F.col("critical_feature_rate"), F.col("dq_severity"), F.col("current_rows"),
                            cfg.minimum_current_rows)
    return t.select(
        F.lit(run_id).alias("run_id"), "overall_health_score", band.alias("health_band"), sev.alias("severity"),
        rec.alias("recommendation"), "total_alerts", "critical_alerts", "warning_alerts", "watch_alerts",
        r6(F.col("critical_feature_rate")).alias("critical_feature_rate"), driver.alias("primary_risk_driver"),
        "current_rows")


def align_features(reference_cols: DataFrame, current_cols: DataFrame) -> DataFrame:
    """Shared / reference-only (Critical) / current-only (Warning) features from two schema frames."""
    j = reference_cols.select(F.col("feature"), F.lit(True).alias("in_ref")).join(
        current_cols.select(F.col("feature"), F.lit(True).alias("in_cur")), "feature", "full_outer")
    r, c = F.coalesce("in_ref", F.lit(False)), F.coalesce("in_cur", F.lit(False))
    return j.select("feature", r.alias("in_reference"), c.alias("in_current"),
                    F.when(r & c, "shared").when(r, "reference_only").otherwise("current_only").alias("status"),
                    F.when(r & c, "Normal").when(r, "Critical").otherwise("Warning").alias("severity"))


def run_history(history: DataFrame, new_runs: DataFrame, key: str = "run_id", time_col: str = "generated_utc") -> DataFrame:
    """Replace rows whose run id re-appears, keep the rest, order by run time (anti join + union)."""
    kept = history.join(new_runs.select(key), key, "left_anti")
    merged = kept.unionByName(new_runs)
    return merged.withColumn("history_rank", F.row_number().over(Window.partitionBy().orderBy(time_col, key)))
