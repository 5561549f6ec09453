"""Evidence aggregation, output validation and per-record reports.

All per-record work is 1:1 left joins (on the record key) and projections; the
summaries are grouped aggregates; the report document is assembled for every
record at once with ``struct`` / ordered ``collect_list`` / ``to_json`` rather
than one record at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import r6
from . import policy as PO

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
HIGH_FAMILIARITY = 0.75
MODERATE_FAMILIARITY = 0.40
UNUSUAL_FAMILIARITY = 0.15
STRONG_HISTORICAL_RATE = 0.30
MODERATE_HISTORICAL_RATE = 0.15
STRONG_FAILED_NEIGHBOURS = 3
MODERATE_FAILED_NEIGHBOURS = 1
HIGH_UNCERTAINTY = 0.80
MODERATE_UNCERTAINTY = 0.60
LOW_CONFIDENCE = 0.25
MODERATE_CONFIDENCE = 0.50
NEIGHBOURS = 10
CONFLICT_PATTERNS = ["Low-Risk Decision with Historical Conflict", "Low-Risk Decision with Reliability Caution",
                     "High Risk with Reliability Caution"]
DECISION_SCORE = {PO.ABSTAIN: 4, PO.HIGH: 3, PO.REVIEW: 2, PO.LOW: 1}
ALLOWED_DECISIONS = [PO.LOW, PO.REVIEW, PO.HIGH, PO.ABSTAIN]
SAFE_ROUTING_MINIMUM = 0.90
READY_SCORE = 90.0


def model_evidence(p: Column, lower: float, upper: float) -> Column:
    return (F.when(p >= max(upper * 2.0, upper + 0.05), "Very Strong Risk Signal").when(p >= upper, "Strong Risk Signal")
            .when(p >= lower, "Intermediate Risk Signal").when(p < lower / 2.0, "Strong Low-Risk Signal")
            .otherwise("Moderate Low-Risk Signal"))


def reliability(conf: Column, unc: Column) -> Column:
    return (F.when((conf <= LOW_CONFIDENCE) | (unc >= HIGH_UNCERTAINTY), "Low Reliability")
            .when((conf <= MODERATE_CONFIDENCE) | (unc >= MODERATE_UNCERTAINTY), "Moderate Reliability")
            .otherwise("High Reliability"))


def familiarity_band(score: Column) -> Column:
    return (F.when(score >= HIGH_FAMILIARITY, "Very Familiar").when(score >= MODERATE_FAMILIARITY, "Familiar")
            .when(score >= UNUSUAL_FAMILIARITY, "Unusual").otherwise("Outside Typical Historical Experience"))


def historical_evidence(rate: Column, failed: Column) -> Column:
    return (F.when((failed >= STRONG_FAILED_NEIGHBOURS) & (rate >= STRONG_HISTORICAL_RATE), "Strong Historical Failure Evidence")
            .when((failed >= MODERATE_FAILED_NEIGHBOURS) & (rate >= MODERATE_HISTORICAL_RATE), "Moderate Historical Failure Evidence")
            .when(failed >= 1, "Limited Historical Failure Evidence").otherwise("No Retrieved Historical Failure Evidence"))


def agreement(decision: Column, hist: Column, rel: Column, fam: Column) -> Column:
    support = hist.isin("Strong Historical Failure Evidence", "Moderate Historical Failure Evidence")
    none = hist == "No Retrieved Historical Failure Evidence"
    low_fam = fam.isin("Unusual", "Outside Typical Historical Experience")
    low_rel = rel == "Low Reliability"
    return (
        F.when(decision == PO.ABSTAIN, "Insufficient Evidence")
        .when((decision == PO.HIGH) & support & ~low_rel, "Convergent Risk Evidence")
        .when((decision == PO.HIGH) & (low_fam | low_rel), "High Risk with Reliability Caution")
        .when(decision == PO.HIGH, "Model-Led Risk Evidence")
        .when((decision == PO.REVIEW) & support, "Review with Supporting Historical Risk")
        .when((decision == PO.REVIEW) & (low_fam | low_rel), "Review Driven by Reliability Concern")
        .when(decision == PO.REVIEW, "Mixed or Intermediate Evidence")
        .when((decision == PO.LOW) & none & ~low_rel & ~low_fam, "Convergent Low-Risk Evidence")
        .when((decision == PO.LOW) & support, "Low-Risk Decision with Historical Conflict")
        .when((decision == PO.LOW) & (low_fam | low_rel), "Low-Risk Decision with Reliability Caution")
        .when(decision == PO.LOW, "Low-Risk Decision with Limited Support")
        .otherwise("Unclassified Evidence Pattern"))


def recommended_action(decision: Column, agree: Column) -> Column:
    return (F.when((decision == PO.LOW) & agree.isin(*CONFLICT_PATTERNS[:2]), "Verify the flagged evidence before release")
            .when(decision == PO.LOW, "Release under standard monitoring")
            .when(decision == PO.REVIEW, "Engineering assessment of the ranked sensors and similar cases")
            .when(decision == PO.HIGH, "Hold and inspect before further processing")
            .otherwise("Collect more evidence before deciding"))


def evidence_report(u: DataFrame, summary: DataFrame, scores: DataFrame, lower: float, upper: float,
                    id_col: str = "record_id") -> DataFrame:
    """One row per explained record: labels, agreement pattern, conflict flag, action, narrative, governance."""
    t = u.where(F.col("side") == "current").join(summary.select(id_col, "top_risk_features"), id_col, "left").join(
        scores.select(id_col, "failed_neighbour_count"), id_col, "left")
    p, conf, unc = F.col("calibrated_failure_probability"), F.col("prediction_confidence"), F.col("combined_uncertainty")
    dec = F.col("uncertainty_adjusted_decision")
    fam_score = F.least(F.greatest(1 - F.col("ood_percentile"), F.lit(0.0)), F.lit(1.0))
    failed = F.coalesce(F.col("failed_neighbour_count"), F.lit(0))
    rate = failed / float(NEIGHBOURS)
    me, rel, fb, hist = model_evidence(p, lower, upper), reliability(conf, unc), familiarity_band(fam_score), historical_evidence(rate, failed)
    agree = agreement(dec, hist, rel, fb)
    conflict = agree.isin(*CONFLICT_PATTERNS) | (dec == PO.ABSTAIN)
    narrative = F.format_string("%s: %s, %s, %s; %s.", dec, me, rel, fb, hist)
    return t.select(
        id_col, "target", "calibrated_failure_probability", "prediction_confidence", "combined_uncertainty",
        dec.alias("uncertainty_adjusted_decision"), me.alias("model_evidence_strength"), rel.alias("prediction_reliability"),
        fam_score.alias("data_familiarity_score"), fb.alias("data_familiarity_band"),
        failed.cast("int").alias("failed_neighbour_count"), rate.alias("historical_failure_rate"),
        hist.alias("historical_evidence"), agree.alias("evidence_agreement"), conflict.alias("evidence_conflict"),
        recommended_action(dec, agree).alias("recommended_action"),
        F.coalesce(F.col("top_risk_features"), F.lit("")).alias("top_risk_features"), narrative.alias("evidence_narrative"),
        ((dec != PO.LOW) | conflict).alias("human_review_required"),
        ((dec == PO.LOW) & ~conflict).alias("automatic_release_allowed"),
    )


def agreement_summary(rep: DataFrame) -> DataFrame:
    fam = F.col("data_familiarity_band").isin("Very Familiar", "Familiar")
    return rep.groupBy("evidence_agreement").agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("target") == 1, 1)).alias("failures"),
        r6(F.avg("target")).alias("failure_rate"), F.count(F.when(F.col("evidence_conflict"), 1)).alias("conflicts"),
        r6(F.avg("calibrated_failure_probability")).alias("mean_probability"),
        r6(F.avg(fam.cast("int"))).alias("familiar_share"))


OFFLINE_COLUMNS = ["uncertainty_adjusted_decision", "model_evidence_strength", "prediction_reliability",
                   "data_familiarity_band", "historical_evidence"]


def offline_evaluation(rep: DataFrame) -> DataFrame:
    """Failure rate by value of each label column, stacked (one grouping per column)."""
    long = rep.select("target", *OFFLINE_COLUMNS).unpivot(["target"], OFFLINE_COLUMNS, "label_column", "label_value")
    return long.groupBy("label_column", "label_value").agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("target") == 1, 1)).alias("failures"),
        r6(F.avg("target")).alias("failure_rate"))


def conflict_cases(rep: DataFrame) -> DataFrame:
    return rep.where(F.col("evidence_conflict"))


# -- output validation -----------------------------------------------------------

def validate_table(name: str, df: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """PASS/FAIL rows: readable (non-empty), required columns present, no duplicate / NULL keys."""
    missing = [c for c in required if c not in df.columns]
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(F.struct(*keys)).alias("distinct_keys"),
               F.count(F.when(F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull(),
                              1)).alias("null_keys"))
    rows = [
        ("non_empty", F.col("rows") > 0, "Critical", F.format_string("%d rows", F.col("rows"))),
        ("required_columns", F.lit(not missing), "Critical",
         F.lit("all present" if not missing else "missing: " + ",".join(missing))),
        ("unique_keys", F.col("distinct_keys") == F.col("rows"), "Critical",
         F.format_string("%d duplicate keys", F.col("rows") - F.col("distinct_keys"))),
        ("no_null_keys", F.col("null_keys") == 0, "Warning", F.format_string("%d null keys", F.col("null_keys"))),
    ]
    parts = [a.select(F.lit(name).alias("category"), F.lit(item).alias("item"),
                      F.when(ok, "PASS").otherwise("FAIL").alias("status"), F.lit(sev).alias("severity"),
                      det.alias("details")) for item, ok, sev, det in rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_record_sets(expected: DataFrame, produced: DataFrame, name: str, id_col: str = "record_id") -> DataFrame:
    """Missing and extra ids against the expected set (anti joins both ways)."""
    e, p = expected.select(id_col).distinct(), produced.select(id_col).distinct()
    missing = e.join(p, id_col, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    extra = p.join(e, id_col, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    exp_n = e.agg(F.count(F.lit(1)).alias("n"))

    def row(df, item, ok_expr, sev, fmt):
        return df.select(F.lit(name).alias("category"), F.lit(item).alias("item"),
                         F.when(ok_expr, "PASS").otherwise("FAIL").alias("status"), F.lit(sev).alias("severity"),
                         F.format_string(fmt, F.col("n")).alias("details"))

    return (row(exp_n, "expected_records", F.col("n") > 0, "Critical", "%d expected")
            .unionByName(row(missing, "missing_records", F.col("n") == 0, "Critical", "%d missing"))
            .unionByName(row(extra, "extra_records", F.col("n") == 0, "Critical", "%d unexpected")))


def check_governance(rep: DataFrame) -> DataFrame:
    """Flag consistency, allowed decisions and safe routing of actual failures (share not auto-released)."""
    a = rep.agg(
        F.count(F.when(~F.col("uncertainty_adjusted_decision").isin(*ALLOWED_DECISIONS), 1)).alias("bad_decisions"),
        F.count(F.when(F.col("human_review_required") == F.col("automatic_release_allowed"), 1)).alias("flag_clash"),
        F.count(F.when(F.col("target") == 1, 1)).alias("failures"),
        F.count(F.when((F.col("target") == 1) & ~F.col("automatic_release_allowed"), 1)).alias("safe_failures"))
    safe = F.when(F.col("failures") > 0, F.col("safe_failures") / F.col("failures")).otherwise(1.0)
    parts = [
        a.select(F.lit("governance").alias("category"), F.lit("allowed_decisions").alias("item"),
                 F.when(F.col("bad_decisions") == 0, "PASS").otherwise("FAIL").alias("status"),
                 F.lit("Critical").alias("severity"), F.format_string("%d outside the allowed set", F.col("bad_decisions")).alias("details")),
        a.select(F.lit("governance"), F.lit("flag_consistency"), F.when(F.col("flag_clash") == 0, "PASS").otherwise("FAIL"),
                 F.lit("Critical"), F.format_string("%d contradictory rows", F.col("flag_clash"))),
        a.select(F.lit("governance"), F.lit("safe_failure_routing"),
                 F.when(safe >= SAFE_ROUTING_MINIMUM, "PASS").otherwise("FAIL"), F.lit("Critical"),
                 F.format_string("%.4f of failures held for review", F.round(safe, 4))),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def readiness(checks: DataFrame) -> DataFrame:
    """Ready iff no critical FAIL; counts; weighted score (critical x2, WARN half credit), ready >= 90."""
    crit = F.col("severity") == "Critical"
    w = F.when(crit, 2.0).otherwise(1.0)
    credit = F.when(F.col("status") == "PASS", 1.0).when(F.col("status") == "WARN", 0.5).otherwise(0.0)
    a = checks.agg(
        F.count(F.lit(1)).alias("total_checks"), F.count(F.when(F.col("status") == "PASS", 1)).alias("passed"),
        F.count(F.when(F.col("status") == "WARN", 1)).alias("warnings"), F.count(F.when(F.col("status") == "FAIL", 1)).alias("failed"),
        F.count(F.when((F.col("status") == "FAIL") & crit, 1)).alias("critical_failures"),
        F.round(100 * F.sum(w * credit) / F.sum(w), 2).alias("weighted_score"))
    return a.select("*", (F.col("critical_failures") == 0).alias("deployment_ready"),
                    ((F.col("critical_failures") == 0) & (F.col("weighted_score") >= READY_SCORE)).alias("production_ready"))


# -- reports and index queries ------------------------------------------------------

def queue_score(decision: Column, p: Column, unc: Column, conf: Column) -> Column:
    ds = F.create_map(*[x for d, v in DECISION_SCORE.items() for x in (F.lit(d), F.lit(float(v)))])
    return 0.55 * F.coalesce(ds[decision], F.lit(0.0)) + 0.20 * F.coalesce(p, F.lit(0.0)) + 0.20 * F.coalesce(
        unc, F.lit(0.0)) + 0.05 * (1.0 - F.coalesce(conf, F.lit(0.0)))


def report_index(rep: DataFrame, prio_summary: DataFrame, id_col: str = "record_id") -> DataFrame:
    t = rep.join(prio_summary.select(id_col, "top_sensor"), id_col, "left")
    return t.select(
        id_col, "target", r6(F.col("calibrated_failure_probability")).alias("calibrated_failure_probability"),
        "uncertainty_adjusted_decision", r6(F.col("prediction_confidence")).alias("prediction_confidence"),
        r6(F.col("combined_uncertainty")).alias("combined_uncertainty"), "evidence_agreement", "evidence_conflict",
        "top_sensor",
        r6(queue_score(F.col("uncertainty_adjusted_decision"), F.col("calibrated_failure_probability"),
                       F.col("combined_uncertainty"), F.col("prediction_confidence"))).alias("queue_score"),
    )


def query_index(index: DataFrame, decision: str | None = None, min_probability: float | None = None,
                max_probability: float | None = None, min_confidence: float | None = None,
                conflict: bool | None = None, search: str | None = None, sort_by: str = "probability",
                descending: bool = True, page: int = 1, page_size: int = 20, id_col: str = "record_id") -> DataFrame:
    """Filtered, sorted page of the index plus the total match count ("desc" = highest first)."""
    cond = F.lit(True)
    if decision:
        cond &= F.col("uncertainty_adjusted_decision") == decision
    if min_probability is not None:
        cond &= F.col("calibrated_failure_probability") >= min_probability
    if max_probability is not None:
        cond &= F.col("calibrated_failure_probability") <= max_probability
    if min_confidence is not None:
        cond &= F.col("prediction_confidence") >= min_confidence
    if conflict is not None:
        cond &= F.col("evidence_conflict") == conflict
    if search:
        cond &= F.lower(F.col(id_col)).contains(search.lower())
    keys = {"probability": "calibrated_failure_probability", "uncertainty": "combined_uncertainty",
            "confidence": "prediction_confidence", "queue": "queue_score", "id": id_col}
    k = F.col(keys[sort_by])
    f = index.where(cond)
    total = f.agg(F.count(F.lit(1)).alias("total_matches"))
    ordered = f.orderBy(k.desc() if descending else k.asc(), F.col(id_col).asc())
    pg = ordered.offset((page - 1) * page_size).limit(page_size)
    return pg.crossJoin(F.broadcast(total))


def decision_mix(rep: DataFrame) -> DataFrame:
    order = F.create_map(*[x for i, d in enumerate([PO.HIGH, PO.ABSTAIN, PO.REVIEW, PO.LOW]) for x in (F.lit(d), F.lit(i))])
    a = rep.groupBy("uncertainty_adjusted_decision").agg(
        F.count(F.lit(1)).alias("records"), F.avg("calibrated_failure_probability").alias("mp"),
        F.avg("prediction_confidence").alias("mc"), F.avg("combined_uncertainty").alias("mu"))
    tot = F.sum("records").over(Window.partitionBy())  # one row per decision
    return a.select(order[F.col("uncertainty_adjusted_decision")].alias("risk_order"), "uncertainty_adjusted_decision",
                    "records", r6(F.col("records") / tot).alias("share"), r6(F.col("mp")).alias("mean_probability"),
                    r6(F.col("mc")).alias("mean_confidence"), r6(F.col("mu")).alias("mean_uncertainty"))


def report_document(rep: DataFrame, top: DataFrame, prio: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Nested JSON per record: prediction, reliability, evidence, ordered top contributions and priorities."""
    c = top.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("rank", "feature", "contribution", "direction"))).alias(
        "contributions"))
    p = prio.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        F.col("priority_rank").alias("rank"), "feature", "priority_score", "priority_level"))).alias("priorities"))
    t = rep.join(c, id_col, "left").join(p, id_col, "left")
    doc = F.struct(
        F.struct(r6(F.col("calibrated_failure_probability")).alias("probability"),
                 F.col("uncertainty_adjusted_decision").alias("decision")).alias("prediction"),
        F.struct(r6(F.col("prediction_confidence")).alias("confidence"), r6(F.col("combined_uncertainty")).alias("uncertainty"),
                 F.col("prediction_reliability").alias("reliability")).alias("reliability"),
        F.struct("historical_evidence", "evidence_agreement", "evidence_conflict", "recommended_action").alias("evidence"),
        F.coalesce("contributions", F.array()).alias("contributions"), F.coalesce("priorities", F.array()).alias("priorities"))
    return t.select(id_col, F.col("uncertainty_adjusted_decision").alias("decision"),
                    F.size(F.coalesce("contributions", F.array())).alias("contribution_count"),
                    F.size(F.coalesce("priorities", F.array())).alias("priority_count"), F.to_json(doc).alias("report_json"))


def report_flatten(docs: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Pull fields from the nested JSON with alternative paths and defaults."""
    j = F.col("report_json")
    g = lambda *paths: F.coalesce(*[F.get_json_object(j, p) for p in paths])
    return docs.select(
        id_col,
        F.coalesce(g("$.prediction.decision", "$.decision"), F.lit("Unknown")).alias("decision"),
        g("$.prediction.probability", "$.probability").cast("double").alias("probability"),
        g("$.reliability.confidence", "$.confidence").cast("double").alias("confidence"),
        F.coalesce(g("$.priorities[0].feature", "$.top_sensor"), F.lit("none")).alias("top_sensor"),
        F.coalesce(g("$.contributions[0].feature"), F.lit("none")).alias("top_contributor"),
        F.coalesce(g("$.evidence.evidence_conflict").cast("boolean"), F.lit(False)).alias("evidence_conflict"),
    )


def record_details(ids: DataFrame, rep: DataFrame, top: DataFrame, prio: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Long detail rows for the requested ids (semi joins); unknown ids reported as such (anti join)."""
    known = rep.join(ids, id_col, "left_semi")
    unknown = ids.join(rep.select(id_col), id_col, "left_anti").select(
        id_col, F.lit("unknown_id").alias("section"), F.lit(0).alias("rank"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("double").alias("value"))
    head = known.select(id_col, F.lit("prediction").alias("section"), F.lit(0).alias("rank"),
                        F.col("uncertainty_adjusted_decision").alias("name"),
                        r6(F.col("calibrated_failure_probability")).alias("value"))
    c = top.join(ids, id_col, "left_semi").select(id_col, F.lit("contribution"), F.col("rank"), "feature",
                                                  F.col("contribution"))
    p = prio.join(ids, id_col, "left_semi").select(id_col, F.lit("priority"), F.col("priority_rank"), "feature",
                                                   F.col("priority_score"))
    return head.union(c).union(p).union(unknown)
