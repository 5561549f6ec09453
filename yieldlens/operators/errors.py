"""Error analysis of scored records: error table, segments, error groups and sensor diagnostics.

Rank statistics (Mann-Whitney U with tie-averaged ranks, medians, quartile
edges) use the distributed prefix-sum helper keyed by feature, so a sensor is
never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import row_array, to_long
from ..functions.expressions import cut, r6
from ..functions.ranking import cumulative, exact_quantiles
from . import metrics as M

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
PROBABILITY_EDGES = [-0.001, 0.1, 0.3, 0.5, 0.7, 1.0]
PROBABILITY_BANDS = ["0.0-0.1", "0.1-0.3", "0.3-0.5", "0.5-0.7", "0.7-1.0"]
CONFIDENCE_EDGES = [-0.001, 0.5, 0.7, 0.9, 1.0]
CONFIDENCE_BANDS = ["Low", "Moderate", "High", "Very High"]
SHIFT_EDGES = [-1, 7, 15, 23]
SHIFTS = ["Night", "Morning", "Evening"]
ERROR_GROUPS = {"tp": "Detected Failure", "fn": "Missed Failure", "fp": "False Alarm", "tn": "Correct Pass"}
MIN_GROUP_VALUES = 3
SIGNIFICANCE = 0.05
COMPARISONS = [("missed_vs_detected", "Missed Failure", "Detected Failure"),
               ("false_alarm_vs_correct_pass", "False Alarm", "Correct Pass")]


def erfc(x: Column) -> Column:
    """Complementary error function, rational approximation with fractional error < 1.2e-7."""
    z = F.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
              -0.82215223, 0.17087277]
    poly = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(2.0 - ans)


def error_group(target: Column, pred: Column) -> Column:
    return (F.when((target == 1) & (pred == 1), ERROR_GROUPS["tp"]).when((target == 1) & (pred == 0), ERROR_GROUPS["fn"])
            .when((target == 0) & (pred == 1), ERROR_GROUPS["fp"]).otherwise(ERROR_GROUPS["tn"]))


def quartile_bins(df: DataFrame, col: str, out: str) -> DataFrame:
    """qcut-style quartiles: exact quantile edges (duplicates dropped), right-closed, lowest included."""
    q = exact_quantiles(df.select(col), [], col, [0.0, 0.25, 0.5, 0.75, 1.0])
    edges = q.agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("_e"))  # one row
    inner = F.slice("_e", 2, F.greatest(F.size("_e") - 2, F.lit(0)))
    t = df.crossJoin(F.broadcast(edges))
    idx = F.size(F.filter(inner, lambda e: F.col(col) > e))
    return t.withColumn(out, F.when(F.col(col).isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Q"), (idx + 1).cast("string")))).drop("_e")


def error_master(wide: DataFrame, scores: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """Record-level error table: prediction, error type, margin, confidence of the predicted side,
    bands, quality (completeness) and its quartile, anomaly score and calendar columns."""
    k = len(features)
    comp = 1 - F.size(F.filter(row_array(features), lambda x: x.isNull())) / F.lit(k)
    w = wide.select("record_id", "ts", comp.alias("quality_score"))
    s = scores.select("record_id", "target", "probability", F.col("ood_percentile").alias("anomaly_score"))
    j = s.join(w, "record_id", "left")
    p = F.col("probability")
    pred = (p >= threshold).cast("int")
    conf = F.when(pred == 1, p).otherwise(1 - p)
    hour = F.hour("ts")
    t = j.select(
        "record_id", "ts", "target", r6(p).alias("probability"), pred.alias("predicted_target"),
        error_group(F.col("target"), pred).alias("error_group"),
        F.when((F.col("target") == 1) & (pred == 0), "Missed Failure")
        .when((F.col("target") == 0) & (pred == 1), "False Alarm").otherwise("Correct").alias("error_type"),
        r6(p - threshold).alias("margin_to_threshold"), r6(conf).alias("prediction_confidence"),
        cut(p, PROBABILITY_EDGES, PROBABILITY_BANDS).alias("probability_band"),
        cut(conf, CONFIDENCE_EDGES, CONFIDENCE_BANDS).alias("confidence_band"),
        r6(F.col("quality_score")).alias("quality_score"), r6(F.col("anomaly_score")).alias("anomaly_score"),
        F.date_format("ts", "yyyy-MM-dd").alias("production_date"), hour.alias("production_hour"),
        F.date_format("ts", "EEEE").alias("production_day"),
        cut(hour, SHIFT_EDGES, SHIFTS).alias("shift"),
    )
    return quartile_bins(t, "quality_score", "quality_quartile")


def segment_metrics(em: DataFrame, segment: str) -> DataFrame:
    """Per segment (NULL kept): confusion counts, recall/precision/FPR, means, AUC and AP (NULL if one class)."""
    seg = em.withColumn("segment", F.coalesce(F.col(segment).cast("string"), F.lit("Unknown")))
    y, pr = F.col("target") == 1, F.col("predicted_target") == 1
    a = seg.groupBy("segment").agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(y, 1)).alias("failures"),
        F.count(F.when(y & pr, 1)).alias("tp"), F.count(F.when(~y & pr, 1)).alias("fp"),
        F.count(F.when(y & ~pr, 1)).alias("fn"), F.count(F.when(~y & ~pr, 1)).alias("tn"),
        F.avg("probability").alias("mp"), F.avg("quality_score").alias("mq"), F.avg("anomaly_score").alias("ma"),
    )
    ranked = M.ranked_scores(seg.select("segment", "probability", "target"), ["segment"])
    auc = M.roc_auc(ranked, ["segment"])
    ap = M.average_precision(ranked, ["segment"])
    t = a.join(auc, "segment", "left").join(ap, "segment", "left")
    div = lambda x, d: F.when(d > 0, x / d).otherwise(0.0)
    return t.select(
        F.lit(segment).alias("segment_column"), "segment", "records", "failures", "tp", "fp", "fn", "tn",
        r6(F.col("failures") / F.col("records")).alias("failure_rate"),
        r6(div(F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall"),
        r6(div(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
        r6(div(F.col("fp"), F.col("fp") + F.col("tn"))).alias("false_alarm_rate"),
        r6(F.col("mp")).alias("mean_probability"), r6(F.col("mq")).alias("mean_quality"),
        r6(F.col("ma")).alias("mean_anomaly"), r6(F.col("roc_auc")).alias("roc_auc"),
        r6(F.col("average_precision")).alias("average_precision"),
    )


def error_type_summary(em: DataFrame) -> DataFrame:
    a = em.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("records"), F.avg("probability").alias("mp"), F.avg("quality_score").alias("mq"),
        F.avg("anomaly_score").alias("ma"), F.avg("prediction_confidence").alias("mc"))
    med = exact_quantiles(em.select("error_type", "probability"), ["error_type"], "probability", [0.5]).select(
        "error_type", F.col("quantile").alias("median_probability"))
    return a.join(med, "error_type", "left").select(
        "error_type", "records", r6(F.col("mp")).alias("mean_probability"),
        r6(F.col("median_probability")).alias("median_probability"), r6(F.col("mq")).alias("mean_quality"),
        r6(F.col("ma")).alias("mean_anomaly"), r6(F.col("mc")).alias("mean_confidence"))


def error_rankings(em: DataFrame) -> DataFrame:
    """Missed failures ranked by probability ascending, false alarms by probability descending
    (distributed rank per error type, ties by record id)."""
    e = em.where(F.col("error_type").isin("Missed Failure", "False Alarm")).select(
        "record_id", "error_type", "probability", "prediction_confidence", "quality_score", "anomaly_score",
        F.when(F.col("error_type") == "Missed Failure", F.col("probability")).otherwise(-F.col("probability")).alias("_k"),
        F.lit(1).alias("_one"))
    r = cumulative(e, ["error_type"], ["_k", "record_id"], ["_one"])
    return r.select("error_type", F.col("cum__one").cast("bigint").alias("error_rank"), "record_id", "probability",
                    "prediction_confidence", "quality_score", "anomaly_score")


def mann_whitney(wide: DataFrame, groups: DataFrame, features: Sequence[str], comparison: str, group_a: str,
                 group_b: str) -> DataFrame:
    """Per sensor: group sizes, medians, median difference, two-sided U-test p (normal approximation with tie
    and continuity correction) and rank-biserial effect 2U/(nm) - 1; NULL below 3 values per group."""
    g = wide.join(groups.select("record_id", "error_group"), "record_id").where(
        F.col("error_group").isin(group_a, group_b))
    long = to_long(g, ["record_id", "error_group"], features).where(F.col("value").isNotNull())
    vc = long.groupBy("feature", "value").agg(
        F.count(F.when(F.col("error_group") == group_a, 1)).alias("ca"),
        F.count(F.when(F.col("error_group") == group_b, 1)).alias("cb"))
    vc = vc.withColumn("ct", F.col("ca") + F.col("cb"))
    cum = cumulative(vc, ["feature"], ["value"], ["ct"], with_totals=True, totals_only=["ca", "cb"])
    avg_rank = (F.col("cum_ct") - F.col("ct")) + (F.col("ct") + 1) / 2.0
    s = cum.groupBy("feature").agg(
        F.sum(F.col("ca") * avg_rank).alias("ra"), F.first("tot_ca").alias("n"), F.first("tot_cb").alias("m"),
        F.sum(F.pow(F.col("ct"), 3) - F.col("ct")).alias("ties"))
    med = exact_quantiles(long, ["feature", "error_group"], "value", [0.5]).groupBy("feature").agg(
        F.max(F.when(F.col("error_group") == group_a, F.col("quantile"))).alias("med_a"),
        F.max(F.when(F.col("error_group") == group_b, F.col("quantile"))).alias("med_b"))
    n, m = F.col("n"), F.col("m")
    N = n + m
    u = F.col("ra") - n * (n + 1) / 2.0
    sigma = F.sqrt(n * m / 12.0 * ((N + 1) - F.col("ties") / (N * (N - 1))))
    z = (F.abs(u - n * m / 2.0) - 0.5) / sigma
    p = F.when(sigma > 0, F.least(F.lit(1.0), erfc(F.greatest(z, F.lit(0.0)) / F.sqrt(F.lit(2.0)))))
    ok = (n >= MIN_GROUP_VALUES) & (m >= MIN_GROUP_VALUES)
    rb = 2.0 * u / (n * m) - 1.0
    feats = wide.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    t = feats.join(s, "feature", "left").join(med, "feature", "left")
    return t.select(
        F.lit(comparison).alias("comparison"), "feature", F.lit(group_a).alias("group_a"), F.lit(group_b).alias("group_b"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("group_a_count"), F.coalesce(m, F.lit(0)).cast("bigint").alias("group_b_count"),
        r6(F.when(ok, F.col("med_a"))).alias("group_a_median"), r6(F.when(ok, F.col("med_b"))).alias("group_b_median"),
        r6(F.when(ok, F.col("med_a") - F.col("med_b"))).alias("median_difference"),
        r6(F.when(ok, rb)).alias("rank_biserial_effect"), r6(F.when(ok, F.abs(rb))).alias("absolute_effect"),
        r6(F.when(ok, p)).alias("mann_whitney_p_value"),
    )


def error_diagnostics(wide: DataFrame, groups: DataFrame, features: Sequence[str]) -> DataFrame:
    parts = [mann_whitney(wide, groups, features, c, a, b) for c, a, b in COMPARISONS]
    t = parts[0]
    for p in parts[1:]:
        t = t.unionByName(p)
    alpha = SIGNIFICANCE / len(features)
    t = t.withColumn("adjusted_significance_flag", F.coalesce(F.col("mann_whitney_p_value") < alpha, F.lit(False)))
    # one row per (comparison, sensor): bounded by the schema
    w = Window.orderBy(F.desc_nulls_last("absolute_effect"), "comparison", "feature")
    return t.withColumn("diagnostic_rank", F.row_number().over(w))
