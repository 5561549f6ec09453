"""Three-way decision policy: Low Risk / Engineering Review / High Risk.

The policy grid (every lower x upper threshold pair on a k/200 grid with
upper > lower) is a theta join of two small threshold tables carrying
cumulative class counts per threshold -- the rows are aggregated once into
grid cells and never rescanned per pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import r6
from .metrics import grid_cell

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
LOW, REVIEW, HIGH, ABSTAIN = "Low Risk", "Engineering Review", "High Risk", "Insufficient Evidence"
DECISIONS = [LOW, REVIEW, HIGH]
STEPS = 200
LOWER_K = (1, 50)      # lower thresholds 0.005 .. 0.25
UPPER_K = (10, 120)    # upper thresholds 0.05 .. 0.60
COST = {"low_failure": 20.0, "low_pass": 0.0, "review_failure": 0.5, "review_pass": 1.0,
        "high_failure": 0.0, "high_pass": 3.0}
MAX_LOW_RISK_LEAKAGE = 0.10
MIN_LOW_RISK_NPV = 0.98
MAX_REVIEW_RATE = 0.50
MIN_AUTOMATION_COVERAGE = 0.50
MIN_HIGH_RISK_CAPTURE = 0.20
MIN_REVIEW_PLUS_HIGH_CAPTURE = 0.90
ACTIONS = {
    LOW: "Release with routine monitoring",
    REVIEW: "Hold for engineering review",
    HIGH: "Quarantine and inspect",
    ABSTAIN: "Collect more evidence before deciding",
}


def assign_decision(p: Column, lower: Column | float, upper: Column | float) -> Column:
    lo = lower if isinstance(lower, Column) else F.lit(float(lower))
    up = upper if isinstance(upper, Column) else F.lit(float(upper))
    return F.when(p < lo, LOW).when(p >= up, HIGH).otherwise(REVIEW)


def _policy_columns(lf, lp, rf, rp, hf, hp) -> list[Column]:
    """Metric columns from the six zone x class counts."""
    P = lf + rf + hf
    N = lp + rp + hp
    T = P + N
    low, rev, high = lf + lp, rf + rp, hf + hp

    def div(a, b, d=0.0):
        return F.when(b > 0, a / b).otherwise(F.lit(d) if d is not None else F.lit(None).cast("double"))

    cost = (COST["low_failure"] * lf + COST["low_pass"] * lp + COST["review_failure"] * rf
            + COST["review_pass"] * rp + COST["high_failure"] * hf + COST["high_pass"] * hp)
    return [
        low.cast("bigint").alias("low_risk_records"), rev.cast("bigint").alias("review_records"),
        high.cast("bigint").alias("high_risk_records"),
        lf.cast("bigint").alias("low_risk_failures"), lp.cast("bigint").alias("low_risk_passes"),
        rf.cast("bigint").alias("review_failures"), rp.cast("bigint").alias("review_passes"),
        hf.cast("bigint").alias("high_risk_failures"), hp.cast("bigint").alias("high_risk_passes"),
        r6(div(lp, low, None)).alias("low_risk_npv"),
        r6(div(hf, high)).alias("high_risk_precision"),
        r6(div(lf, P)).alias("low_risk_failure_leakage"),
        r6(div(hf, P)).alias("high_risk_failure_capture"),
        r6(div(rf, P)).alias("review_failure_capture"),
        r6(div(rf + hf, P)).alias("review_plus_high_failure_capture"),
        r6(div(rev, T)).alias("review_rate"),
        r6(div(low + high, T)).alias("automation_coverage"),
        r6(div(hp, N)).alias("high_risk_false_alarm_rate"),
        r6(cost).alias("operational_cost"),
    ]


def policy_metrics(df: DataFrame, keys: Sequence[str], lower: float, upper: float, score: str = "probability",
                   target: str = "target") -> DataFrame:
    d = assign_decision(F.col(score), lower, upper)
    y = F.col(target) == 1
    a = df.groupBy(*keys).agg(*[
        F.count(F.when((d == z) & (y if cls else ~y), 1)).alias(f"{n}{'f' if cls else 'p'}")
        for z, n in ((LOW, "l"), (REVIEW, "r"), (HIGH, "h")) for cls in (1, 0)
    ])
    c = F.col
    return a.select(*keys, F.lit(lower).alias("lower_threshold"), F.lit(upper).alias("upper_threshold"),
                    *_policy_columns(c("lf"), c("lp"), c("rf"), c("rp"), c("hf"), c("hp")))


def below_counts(df: DataFrame, keys: Sequence[str], score: str = "probability", target: str = "target",
                 steps: int = STEPS) -> DataFrame:
    """(keys, k, fb, pb): failures and passes with score < k/steps, k = 0..steps (from grid cells)."""
    keys = list(keys)
    cells = df.select(*keys, grid_cell(F.col(score), steps).alias("g"), F.col(target).alias("_y")).groupBy(
        *keys, "g").agg(F.count(F.when(F.col("_y") == 1, 1)).alias("pos"),
                        F.count(F.when(F.col("_y") == 0, 1)).alias("neg"))
    grid = df.sparkSession.range(0, steps + 1).select(F.col("id").cast("int").alias("k"))
    dom = cells.select(*keys).distinct().crossJoin(F.broadcast(grid)) if keys else grid
    j = dom.join(cells, keys, "left") if keys else dom.crossJoin(cells)
    return j.groupBy(*keys, "k").agg(
        F.sum(F.when(F.col("g") < F.col("k"), F.col("pos")).otherwise(0)).alias("fb"),
        F.sum(F.when(F.col("g") < F.col("k"), F.col("neg")).otherwise(0)).alias("pb"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
    )


def policy_grid(df: DataFrame, keys: Sequence[str] = (), score: str = "probability", target: str = "target") -> DataFrame:
    """Policy metrics for every (lower, upper) pair with upper > lower."""
    keys = list(keys)
    bc = below_counts(df, keys, score, target)
    lo = bc.where(F.col("k").between(*LOWER_K)).select(*keys, F.col("k").alias("kl"), F.col("fb").alias("lfb"),
                                                       F.col("pb").alias("lpb"), "P", "N")
    up = bc.where(F.col("k").between(*UPPER_K)).select(*keys, F.col("k").alias("ku"), F.col("fb").alias("ufb"),
                                                       F.col("pb").alias("upb"))
    # theta join of two threshold tables (<= 50 x 111 rows per key)
    cond = [lo[k] == up[k] for k in keys] + [up["ku"] > lo["kl"]]
    pairs = lo.join(F.broadcast(up), cond if keys else (up["ku"] > lo["kl"])).select(
        *[lo[k] for k in keys], "kl", "ku", "lfb", "lpb", "ufb", "upb", "P", "N")
    c = F.col
    lf, lp = c("lfb"), c("lpb")
    hf, hp = c("P") - c("ufb"), c("N") - c("upb")
    rf, rp = c("ufb") - c("lfb"), c("upb") - c("lpb")
    return pairs.select(
        *keys, r6(c("kl") / float(STEPS)).alias("lower_threshold"), r6(c("ku") / float(STEPS)).alias("upper_threshold"),
        *_policy_columns(lf, lp, rf, rp, hf, hp),
    )


def select_policy(grid: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Strict tier (six constraints) by cost, review rate, precision, coverage; safe fallback by review rate;
    emergency fallback by leakage.  NULL NPV never passes the strict tier."""
    c = F.col
    keys = list(keys)
    strict = ((c("low_risk_failure_leakage") <= MAX_LOW_RISK_LEAKAGE) & c("low_risk_npv").isNotNull()
              & (c("low_risk_npv") >= MIN_LOW_RISK_NPV) & (c("review_rate") <= MAX_REVIEW_RATE)
              & (c("automation_coverage") >= MIN_AUTOMATION_COVERAGE)
              & (c("high_risk_failure_capture") >= MIN_HIGH_RISK_CAPTURE)
              & (c("review_plus_high_failure_capture") >= MIN_REVIEW_PLUS_HIGH_CAPTURE))
    safe = ((c("low_risk_failure_leakage") <= MAX_LOW_RISK_LEAKAGE)
            & (c("review_plus_high_failure_capture") >= MIN_REVIEW_PLUS_HIGH_CAPTURE))
    w_all = Window.partitionBy(*keys) if keys else Window.partitionBy()  # ~5,000 pairs per key
    t = grid.withColumn("_s", F.max(strict.cast("int")).over(w_all)).withColumn(
        "_f", F.max(safe.cast("int")).over(w_all))
    tier = (F.when(c("_s") == 1, F.when(strict, 0).otherwise(9))
            .when(c("_f") == 1, F.when(safe, 1).otherwise(9)).otherwise(2))
    t = t.withColumn("tier", tier)
    o1 = F.when(c("tier") == 0, c("operational_cost")).when(c("tier") == 1, c("review_rate")).otherwise(
        c("low_risk_failure_leakage"))
    o2 = F.when(c("tier") == 0, c("review_rate")).when(c("tier") == 1, c("operational_cost")).otherwise(
        -c("review_plus_high_failure_capture"))
    o3 = F.when(c("tier") == 0, -c("high_risk_precision")).when(c("tier") == 1, -c("high_risk_failure_capture")).otherwise(
        c("operational_cost"))
    o4 = F.when(c("tier") == 0, -c("automation_coverage")).when(c("tier") == 1, -c("high_risk_precision")).otherwise(
        c("review_rate"))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(
        "tier", o1, o2, o3, o4, "lower_threshold", "upper_threshold")
    picked = t.withColumn("_rn", F.row_number().over(w)).where(c("_rn") == 1)
    reason = (F.when(c("tier") == 0, "meets every operational constraint at the lowest weighted cost")
              .when(c("tier") == 1, "fallback: keeps failure routing safe with the least review load")
              .otherwise("emergency fallback: least unsafe low-risk leakage"))
    return picked.withColumn("selection_reason", reason).drop("_s", "_f", "_rn")


def decision_summary(df: DataFrame, decision_col: str, score: str = "probability", target: str = "target",
                     decisions: Sequence[str] = tuple(DECISIONS)) -> DataFrame:
    """Per decision: count, share, failures, passes, observed failure rate, mean probability; empty kept."""
    a = df.groupBy(F.col(decision_col).alias("decision")).agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(F.col(target) == 1, 1)).alias("failures"),
        F.count(F.when(F.col(target) == 0, 1)).alias("passes"), F.avg(score).alias("mp"),
    )
    dom = df.sparkSession.createDataFrame([(i, d) for i, d in enumerate(decisions)], "decision_order int, decision string")
    t = F.broadcast(dom).join(a, "decision", "left")
    rec = F.coalesce(F.col("records"), F.lit(0)).cast("bigint")
    tot = F.sum(rec).over(Window.partitionBy())  # one row per decision
    return t.select(
        "decision_order", "decision", rec.alias("records"), r6(F.when(tot > 0, rec / tot).otherwise(0.0)).alias("share"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
        F.coalesce(F.col("passes"), F.lit(0)).cast("bigint").alias("passes"),
        r6(F.when(rec > 0, F.col("failures") / rec)).alias("observed_failure_rate"),
        r6(F.col("mp")).alias("mean_probability"),
    )


def decide_batch(df: DataFrame, lower: float, upper: float, score: str = "probability",
                 id_col: str = "record_id") -> DataFrame:
    """Score -> decision -> action text, a stateless projection."""
    d = assign_decision(F.col(score), lower, upper)
    action = F.when(d == LOW, ACTIONS[LOW]).when(d == HIGH, ACTIONS[HIGH]).otherwise(ACTIONS[REVIEW])
    return df.select(id_col, "target", r6(F.col(score)).alias("calibrated_failure_probability"),
                     d.alias("operational_decision"), action.alias("recommended_action"),
                     F.lit(lower).alias("lower_threshold"), F.lit(upper).alias("upper_threshold"))
