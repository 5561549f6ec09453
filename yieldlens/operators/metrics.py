"""Evaluation of scores against a 0/1 target, and threshold choice.

Every curve and sweep works on counts, never on rows: scores are first
aggregated to distinct (keys, score, positives, negatives), or to cells of
an integer threshold grid k/steps, so a 99- or 199-threshold sweep is a
join of two small tables instead of 199 rescans.  Rank metrics (ROC AUC,
average precision, curve points) use the distributed prefix-sum helper, so
near-unique scores never meet in one task.  ``keys`` are low-cardinality
group columns such as a model name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import r6
from ..functions.ranking import cumulative

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
MINIMUM_FAILURE_RECALL = 0.75
MISSED_FAILURE_COST = 10.0
FALSE_ALARM_COST = 1.0
LOG_LOSS_CLIP = 1e-6
SWEEP_STEPS = 100        # thresholds k/100, k = 1..99
COST_STEPS = 200         # thresholds k/200, k = 1..199
CALIBRATION_BINS = 10
ERROR_TYPES = {"missed": "Missed Failure", "false_alarm": "False Alarm", "correct": "Correct"}


def _div(a: Column, b: Column, default: float | None = 0.0) -> Column:
    d = F.lit(default).cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(b > 0, a / b).otherwise(d)


def score_counts(df: DataFrame, keys: Sequence[str], score: str = "probability", target: str = "target") -> DataFrame:
    """Distinct (keys, score) with positives and negatives (map-side combined)."""
    return df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count(F.when(F.col(target) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(target) == 0, 1)).alias("neg"),
    )


def grid_cell(score: Column, steps: int) -> Column:
    """Largest k in [0, steps] with k/steps <= score (exact: floor corrected against the double grid)."""
    g0 = F.least(F.greatest(F.floor(score * steps), F.lit(0)), F.lit(steps)).cast("int")
    g1 = F.when((g0 > 0) & ((g0 / F.lit(float(steps))) > score), g0 - 1).otherwise(g0)
    return F.when((g1 < steps) & (((g1 + 1) / F.lit(float(steps))) <= score), g1 + 1).otherwise(g1)


def grid_confusion(df: DataFrame, keys: Sequence[str], steps: int, k_from: int, k_to: int,
                   score: str = "probability", target: str = "target") -> DataFrame:
    """(keys, k, threshold = k/steps, tp, fp, fn, tn) for predictions score >= threshold."""
    keys = list(keys)
    cells = df.select(*keys, grid_cell(F.col(score), steps).alias("g"), F.col(target).alias("_y")).groupBy(
        *keys, "g"
    ).agg(F.count(F.when(F.col("_y") == 1, 1)).alias("pos"), F.count(F.when(F.col("_y") == 0, 1)).alias("neg"))
    spark = df.sparkSession
    grid = spark.range(k_from, k_to + 1).select(F.col("id").cast("int").alias("k"))
    key_tab = cells.select(*keys).distinct() if keys else None
    dom = key_tab.crossJoin(F.broadcast(grid)) if keys else grid
    # cells: at most steps + 1 rows per key, so this join is small on both sides
    j = dom.join(cells, keys, "left") if keys else dom.crossJoin(cells)
    agg = j.groupBy(*keys, "k").agg(
        F.sum(F.when(F.col("g") >= F.col("k"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("g") >= F.col("k"), F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("g") < F.col("k"), F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(F.col("g") < F.col("k"), F.col("neg")).otherwise(0)).alias("tn"),
    )
    return agg.select(*keys, "k", (F.col("k") / F.lit(float(steps))).alias("threshold"),
                      *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")])


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    f1 = _div(2 * precision * recall, precision + recall)
    spec = _div(tn, tn + fp)
    return {"precision": precision, "recall": recall, "f1": f1, "specificity": spec,
            "balanced_accuracy": (recall + spec) / 2}


def threshold_sweep(df: DataFrame, keys: Sequence[str] = (), score: str = "probability", target: str = "target",
                    steps: int = SWEEP_STEPS) -> DataFrame:
    """Metrics at thresholds k/steps, k = 1..steps-1."""
    g = grid_confusion(df, keys, steps, 1, steps - 1, score, target)
    m = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return g.select(
        *keys, r6(F.col("threshold")).alias("threshold"),
        r6(m["precision"]).alias("precision_fail"), r6(m["recall"]).alias("recall_fail"),
        r6(m["f1"]).alias("f1_fail"), r6(m["balanced_accuracy"]).alias("balanced_accuracy"),
        F.col("tn").alias("true_negative"), F.col("fp").alias("false_positive"),
        F.col("fn").alias("false_negative"), F.col("tp").alias("true_positive"),
        (F.col("tp") + F.col("fp")).alias("predicted_failures"),
    )


def cost_sweep(df: DataFrame, keys: Sequence[str] = (), score: str = "probability", target: str = "target",
               steps: int = COST_STEPS) -> DataFrame:
    """Operational cost 10 FN + FP, alert count/rate and false alarms per detection at k/steps."""
    g = grid_confusion(df, keys, steps, 1, steps - 1, score, target)
    m = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return g.select(
        *keys, r6(F.col("threshold")).alias("threshold"),
        r6(m["recall"]).alias("recall_fail"), r6(m["precision"]).alias("precision_fail"),
        r6(m["f1"]).alias("f1_fail"), r6(m["balanced_accuracy"]).alias("balanced_accuracy"),
        F.col("tn").alias("true_negative"), F.col("fp").alias("false_positive"),
        F.col("fn").alias("false_negative"), F.col("tp").alias("true_positive"),
        (F.col("tp") + F.col("fp")).alias("alert_count"),
        r6((F.col("tp") + F.col("fp")) / n).alias("alert_rate"),
        r6(F.when(F.col("tp") > 0, F.col("fp") / F.col("tp"))).alias("false_alarms_per_detected_failure"),
        r6(MISSED_FAILURE_COST * F.col("fn") + FALSE_ALARM_COST * F.col("fp")).alias("operational_cost"),
    )


def _pick(t: DataFrame, keys: Sequence[str], eligible: Column, order_eligible: list[Column],
          order_fallback: list[Column], reasons: tuple[str, str]) -> DataFrame:
    """Per key: the first eligible row by one ordering, else the first row by a fallback ordering."""
    keys = list(keys)
    w_any = Window.partitionBy(*keys) if keys else Window.partitionBy()
    t = t.withColumn("_has", F.max(eligible.cast("int")).over(w_any))  # sweep tables: <= 199 rows per key
    tier = F.when(F.col("_has") == 1, F.when(eligible, 0).otherwise(2)).otherwise(1)
    t = t.withColumn("_tier", tier)
    ordering = [F.col("_tier")]
    for e, f in zip(order_eligible, order_fallback):
        ordering.append(F.when(F.col("_tier") == 0, e).otherwise(f))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(*ordering)
    picked = t.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return picked.withColumn(
        "selection_reason", F.when(F.col("_tier") == 0, reasons[0]).otherwise(reasons[1])
    ).drop("_has", "_tier", "_rn")


def select_threshold_precision(sweep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Recall >= .75: highest precision, F1, threshold; else highest recall, precision, F1."""
    c = F.col
    return _pick(
        sweep, keys, c("recall_fail") >= MINIMUM_FAILURE_RECALL,
        [-c("precision_fail"), -c("f1_fail"), -c("threshold")],
        [-c("recall_fail"), -c("precision_fail"), -c("f1_fail")],
        ("highest precision with failure recall >= 0.75", "recall target missed: highest recall"),
    ).select(*keys, "threshold", "precision_fail", "recall_fail", "f1_fail", "balanced_accuracy", "selection_reason")


def select_threshold_cost(sweep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Recall >= .75: lowest cost, FP, then highest precision, balanced accuracy, threshold; else by recall."""
    c = F.col
    return _pick(
        sweep, keys, c("recall_fail") >= MINIMUM_FAILURE_RECALL,
        [c("operational_cost"), c("false_positive"), -c("precision_fail"), -c("balanced_accuracy"), -c("threshold")],
        [-c("recall_fail"), c("operational_cost"), c("false_positive"), -c("precision_fail"), -c("threshold")],
        ("lowest cost with failure recall >= 0.75", "recall target missed: highest recall"),
    )


def confusion_metrics(df: DataFrame, keys: Sequence[str], threshold: Column | float, score: str = "probability",
                      target: str = "target") -> DataFrame:
    """TN/FP/FN/TP, recall, precision, F1, balanced accuracy, predicted count at one threshold per key."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= thr
    y = F.col(target) == 1
    a = df.groupBy(*keys).agg(
        F.count(F.when(pred & y, 1)).alias("tp"), F.count(F.when(pred & ~y, 1)).alias("fp"),
        F.count(F.when(~pred & y, 1)).alias("fn"), F.count(F.when(~pred & ~y, 1)).alias("tn"),
    )
    m = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return a.select(
        *keys, F.col("tn").alias("true_negative"), F.col("fp").alias("false_positive"),
        F.col("fn").alias("false_negative"), F.col("tp").alias("true_positive"),
        r6(m["recall"]).alias("recall"), r6(m["precision"]).alias("precision"), r6(m["f1"]).alias("f1"),
        r6(m["balanced_accuracy"]).alias("balanced_accuracy"),
        (F.col("tp") + F.col("fp")).alias("predicted_failures"),
    )


def ranked_scores(df: DataFrame, keys: Sequence[str], score: str = "probability", target: str = "target") -> DataFrame:
    """Distinct scores with running positives/negatives in ascending score order and totals (distributed)."""
    sc = score_counts(df, keys, score, target)
    return cumulative(sc, keys, ["score"], ["pos", "neg"], with_totals=True)


def roc_auc(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mann-Whitney AUC with ties counted 1/2; NULL when a class is absent."""
    neg_below = F.col("cum_neg") - F.col("neg")
    a = ranked.groupBy(*keys).agg(
        F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))).alias("u"),
        F.first("tot_pos").alias("P"), F.first("tot_neg").alias("N"),
    )
    return a.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P") * F.col("N"))).alias(
        "roc_auc"))


def average_precision(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Step-wise AP: sum over distinct scores (desc) of (R_i - R_{i-1}) P_i."""
    tp = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    a = ranked.groupBy(*keys).agg(
        F.sum(F.when(F.col("pos") > 0, (F.col("pos") / F.col("tot_pos")) * (tp / (tp + fp))).otherwise(0.0)).alias(
            "ap"),
        F.first("tot_pos").alias("P"),
    )
    return a.select(*keys, F.when(F.col("P") > 0, F.col("ap")).alias("average_precision"))


def curve_points(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ROC and PR points at every distinct score used as a threshold (score >= t predicted positive)."""
    tp = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    return ranked.select(
        *keys, r6(F.col("score")).alias("threshold"), tp.cast("bigint").alias("true_positive"),
        fp.cast("bigint").alias("false_positive"),
        r6(_div(tp, F.col("tot_pos"))).alias("tpr"), r6(_div(fp, F.col("tot_neg"))).alias("fpr"),
        r6(_div(tp, tp + fp)).alias("precision"), r6(_div(tp, F.col("tot_pos"))).alias("recall"),
    )


def best_f1_threshold(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct score with the highest F1 (0 where P+R = 0); the lowest threshold wins ties."""
    tp = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    prec = _div(tp, tp + fp)
    rec = _div(tp, F.col("tot_pos"))
    f1 = _div(2 * prec * rec, prec + rec)
    pts = ranked.select(*keys, "score", f1.alias("f1"), prec.alias("p"), rec.alias("r"))
    # global arg-max by partial aggregation: max of struct(f1, -score) merges one value per partition
    best = pts.groupBy(*keys).agg(F.max(F.struct(F.col("f1"), (-F.col("score")).alias("ns"), "p", "r")).alias("b"))
    return best.select(*keys, r6(-F.col("b.ns")).alias("threshold"), r6(F.col("b.f1")).alias("f1"),
                       r6(F.col("b.p")).alias("precision"), r6(F.col("b.r")).alias("recall"))


def brier_log_loss(df: DataFrame, keys: Sequence[str], score: str = "probability", target: str = "target") -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(LOG_LOSS_CLIP)), F.lit(1 - LOG_LOSS_CLIP))
    y = F.col(target)
    return df.groupBy(*keys).agg(
        r6(F.avg(F.pow(F.col(score) - y, 2))).alias("brier_score"),
        r6(-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
    )


def calibration_bin(score: Column, bins: int = CALIBRATION_BINS) -> Column:
    """Equal-width bins, right-closed inner edges: greatest(0, ceil(p * bins) - 1)."""
    return F.greatest(F.lit(0), F.least(F.ceil(score * bins) - 1, F.lit(bins - 1))).cast("int")


def calibration_bins(df: DataFrame, keys: Sequence[str], score: str = "probability", target: str = "target",
                     bins: int = CALIBRATION_BINS) -> DataFrame:
    b = df.groupBy(*keys, calibration_bin(F.col(score), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("records"), F.avg(score).alias("mean_probability"),
        F.avg(target).alias("observed_rate"),
    )
    return b.select(*keys, "bin", "records", r6(F.col("mean_probability")).alias("mean_probability"),
                    r6(F.col("observed_rate")).alias("observed_rate"),
                    r6(F.abs(F.col("mean_probability") - F.col("observed_rate"))).alias("gap"))


def calibration_error(df: DataFrame, keys: Sequence[str], score: str = "probability", target: str = "target",
                      bins: int = CALIBRATION_BINS) -> DataFrame:
    """ECE (count-weighted mean gap) and MCE (max gap) over non-empty bins."""
    b = df.groupBy(*keys, calibration_bin(F.col(score), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mp"), F.avg(target).alias("orate"),
    )
    gap = F.abs(F.col("mp") - F.col("orate"))
    return b.groupBy(*keys).agg(
        r6(F.sum(F.col("n") * gap) / F.sum("n")).alias("ece"), r6(F.max(gap)).alias("mce"),
    )


def prediction_table(df: DataFrame, threshold: Column | float, id_col: str = "record_id", score: str = "probability",
                     target: str = "target", extra: Sequence[str] = ()) -> DataFrame:
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = (F.col(score) >= thr).cast("int")
    y = F.col(target)
    err = (
        F.when((y == 1) & (pred == 0), ERROR_TYPES["missed"])
        .when((y == 0) & (pred == 1), ERROR_TYPES["false_alarm"])
        .otherwise(ERROR_TYPES["correct"])
    )
    return df.select(
        id_col, *extra, target, r6(F.col(score)).alias("fail_probability"), pred.alias("predicted_target"),
        F.when(pred == 1, "Fail").otherwise("Pass").alias("predicted_status"),
        r6(thr).alias("decision_threshold"), (pred == y).alias("prediction_correct"), err.alias("error_type"),
    )


def model_comparison(df: DataFrame, key: str = "model", score: str = "probability", target: str = "target") -> DataFrame:
    """Per model: cost-optimal threshold metrics plus ROC AUC, AP and Brier."""
    sw = cost_sweep(df, [key], score, target)
    sel = select_threshold_cost(sw, [key])
    ranked = ranked_scores(df, [key], score, target)
    auc = roc_auc(ranked, [key]).select(key, r6(F.col("roc_auc")).alias("roc_auc"))
    ap = average_precision(ranked, [key]).select(key, r6(F.col("average_precision")).alias("pr_auc"))
    br = brier_log_loss(df, [key], score, target).select(key, "brier_score")
    return sel.join(auc, key).join(ap, key).join(br, key)


def select_model(comparison: DataFrame, key: str = "model") -> DataFrame:
    """Rank models by cost, FP, precision, balanced accuracy, PR-AUC among recall >= .75, else all."""
    c = F.col
    elig = c("recall_fail") >= MINIMUM_FAILURE_RECALL
    t = comparison.withColumn("_has", F.max(elig.cast("int")).over(Window.partitionBy()))  # one row per model
    t = t.withColumn("eligible", F.when(c("_has") == 1, elig).otherwise(F.lit(True)))
    w = Window.partitionBy().orderBy(
        F.desc("eligible"), c("operational_cost"), c("false_positive"), F.desc("precision_fail"),
        F.desc("balanced_accuracy"), F.desc("pr_auc"), c(key))
    return t.withColumn("model_rank", F.row_number().over(w)).withColumn(
        "selected", F.col("model_rank") == 1).drop("_has")
