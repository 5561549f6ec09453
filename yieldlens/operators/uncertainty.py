"""Uncertainty, confidence and abstention for scored records.

Per-record spreads over ensemble members are grouped aggregates over small
groups (five members per record).  Reference quantiles and "share of the
reference at or below" normalisations use the distributed rank helpers; the
resulting one-row threshold tables are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_array
from ..functions.expressions import r6
from ..functions.ranking import column_quantiles, cumulative
from ..session import cut_lineage
from . import policy as PO

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
DATA_WEIGHTS = {"completeness": 0.40, "ood": 0.35, "neighbour": 0.25}
CONFIDENCE_WEIGHTS = {"agreement": 0.35, "stability": 0.20, "data": 0.30, "margin": 0.15}
UPPER_QUANTILE = 0.95
BAND_QUANTILES = (0.5, 0.95)
ABSTAIN_OOD_QUANTILE = 0.975
ABSTAIN_LOW_CONFIDENCE_QUANTILE = 0.10
ABSTAIN_HIGH_UNCERTAINTY_QUANTILE = 0.95
CONFIDENCE_BANDS = [(0.8, "Very High"), (0.6, "High"), (0.4, "Moderate")]
REASONS = {"ood": "extreme distance from the reference data",
           "conflict": "low confidence together with high uncertainty"}


def _qn(p: float) -> int:
    return int(round(p * 1000))


def ensemble_spread(members: DataFrame, id_col: str = "record_id", p: str = "p") -> DataFrame:
    """Per record: member mean, sample std, 5 % / 95 % quantiles, range and interval width (groups of a
    handful of members, so one sorted list of a group gives both quantiles)."""
    a = members.groupBy(id_col).agg(
        F.avg(p).alias("member_mean"), F.stddev_samp(p).alias("member_std"), F.sort_array(F.collect_list(p)).alias("_all"),
        (F.max(p) - F.min(p)).alias("member_range"), F.count(F.lit(1)).alias("members"))

    def quantile(q):
        at = (F.size("_all") - 1) * F.lit(q)
        lo, hi = F.floor(at).cast("int"), F.ceil(at).cast("int")
        x, y = F.get("_all", lo), F.get("_all", hi)
        return F.when(x == y, x).otherwise((hi - at) * x + (at - lo) * y)

    a = a.withColumns({"interval_lower": quantile(0.05), "interval_upper": quantile(0.95)})
    return a.select(id_col, "members", r6(F.col("member_mean")).alias("member_mean"),
                    r6(F.col("member_std")).alias("member_std"), r6(F.col("interval_lower")).alias("interval_lower"),
                    r6(F.col("interval_upper")).alias("interval_upper"), r6(F.col("member_range")).alias("member_range"),
                    r6(F.col("interval_upper") - F.col("interval_lower")).alias("interval_width"))


def percentile_normalise(df: DataFrame, value: str, is_reference: Column, out: str) -> DataFrame:
    """Share of reference values <= each value (right rank), from distributed running counts over the
    pooled distinct values; the reference itself is never collected."""
    d = df.select(F.col(value).alias("_v"), is_reference.alias("_r"))
    vc = d.where(F.col("_v").isNotNull()).groupBy("_v").agg(
        F.count(F.when(F.col("_r"), 1)).alias("_cr"), F.count(F.lit(1)).alias("_ca"))
    cum = cumulative(vc, [], ["_v"], ["_cr"], with_totals=True)
    share = cum.select(F.col("_v"), (F.col("cum__cr") / F.col("tot__cr")).alias(out))
    return df.join(share, df[value] == share["_v"], "left").drop("_v")


def upper_reference_normalise(value: Column, scale: Column) -> Column:
    """value / reference upper quantile, clipped to [0, 1]; a tiny scale gives 0."""
    return F.when(scale > 1e-12, F.least(F.greatest(value / scale, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)


def decision_margin(p: Column, lower: float, upper: float) -> Column:
    """Distance to the nearest threshold over the largest possible distance, clipped."""
    near = F.least(F.abs(p - lower), F.abs(p - upper))
    return F.least(F.greatest(near / max(lower, 1.0 - upper, upper - lower, 1e-8), F.lit(0.0)), F.lit(1.0))


def reference_quantiles(df: DataFrame, metrics: dict[str, Sequence[float]], ref: Column) -> DataFrame:
    """One row with ``<metric>_q<p>`` exact quantiles over the reference rows of a stored table."""
    probs = sorted({p for ps in metrics.values() for p in ps})
    q = column_quantiles(df.where(ref).select(*metrics), list(metrics), probs)
    aggs = [F.max(F.when((F.col("feature") == m) & (F.col("prob") == p), F.col("quantile"))).alias(
        f"{m}_q{_qn(p)}") for m, ps in metrics.items() for p in sorted(set(ps))]
    return q.agg(*aggs)


def confidence_components(wide: DataFrame, scores: DataFrame, members: DataFrame, features: Sequence[str],
                          lower: float = 0.035, upper: float = 0.08) -> DataFrame:
    """Per record: spreads, data confidence, prediction confidence, uncertainty, bands, original and
    abstention-adjusted decision with reason."""
    k = len(features)
    comp = 1 - F.size(F.filter(row_array(features), lambda x: x.isNull())) / F.lit(k)
    base = scores.select("record_id", "target", "side", "probability", "ood_percentile", "failed_neighbour_count").join(
        wide.select("record_id", comp.alias("completeness")), "record_id").join(
        ensemble_spread(members), "record_id")
    is_ref = F.col("side") == "reference"
    base = cut_lineage(percentile_normalise(cut_lineage(base), "failed_neighbour_count", is_ref, "neighbour_percentile"))
    q1 = F.broadcast(reference_quantiles(base, {"member_std": [UPPER_QUANTILE], "member_range": [UPPER_QUANTILE],
                                                "ood_percentile": [ABSTAIN_OOD_QUANTILE]}, is_ref))
    t = base.crossJoin(q1)
    agreement = 1 - upper_reference_normalise(F.col("member_std"), F.col("member_std_q950"))
    stability = 1 - upper_reference_normalise(F.col("member_range"), F.col("member_range_q950"))
    data = (DATA_WEIGHTS["completeness"] * F.col("completeness") + DATA_WEIGHTS["ood"] * (1 - F.col("ood_percentile"))
            + DATA_WEIGHTS["neighbour"] * (1 - F.col("neighbour_percentile")))
    margin = decision_margin(F.col("probability"), lower, upper)
    conf = (CONFIDENCE_WEIGHTS["agreement"] * agreement + CONFIDENCE_WEIGHTS["stability"] * stability
            + CONFIDENCE_WEIGHTS["data"] * data + CONFIDENCE_WEIGHTS["margin"] * margin)
    t = t.select("*", agreement.alias("model_agreement"), stability.alias("prediction_stability"),
                 data.alias("data_confidence"), margin.alias("decision_margin"), conf.alias("prediction_confidence"),
                 (1 - conf).alias("combined_uncertainty"))
    q2 = F.broadcast(reference_quantiles(
        t, {"combined_uncertainty": [BAND_QUANTILES[0], BAND_QUANTILES[1], ABSTAIN_HIGH_UNCERTAINTY_QUANTILE],
            "prediction_confidence": [ABSTAIN_LOW_CONFIDENCE_QUANTILE]}, is_ref))
    t = t.crossJoin(q2)
    unc, cf = F.col("combined_uncertainty"), F.col("prediction_confidence")
    ub = (F.when(unc < F.col(f"combined_uncertainty_q{_qn(BAND_QUANTILES[0])}"), "Low")
          .when(unc < F.col(f"combined_uncertainty_q{_qn(BAND_QUANTILES[1])}"), "Moderate").otherwise("High"))
    cb = F.lit("Low")
    for lo, name in reversed(CONFIDENCE_BANDS):
        cb = F.when(cf >= lo, name).otherwise(cb)
    original = PO.assign_decision(F.col("probability"), lower, upper)
    automatic = original.isin(PO.LOW, PO.HIGH)
    ood_hit = F.col("ood_percentile") >= F.col(f"ood_percentile_q{_qn(ABSTAIN_OOD_QUANTILE)}")
    conflict = (cf < F.col(f"prediction_confidence_q{_qn(ABSTAIN_LOW_CONFIDENCE_QUANTILE)}")) & (
        unc >= F.col(f"combined_uncertainty_q{_qn(ABSTAIN_HIGH_UNCERTAINTY_QUANTILE)}"))
    abstain = automatic & (ood_hit | conflict)
    reason = F.when(abstain & ood_hit, REASONS["ood"]).when(abstain, REASONS["conflict"])
    # full precision (roll-ups average these); ``rounded`` prepares an emitted table
    return t.select(
        "record_id", "target", "side", F.col("probability").alias("calibrated_failure_probability"),
        "members", "member_mean", "member_std", "interval_lower", "interval_upper", "interval_width",
        "completeness", "ood_percentile", "neighbour_percentile", "model_agreement", "prediction_stability",
        "data_confidence", "decision_margin", cf.alias("prediction_confidence"), unc.alias("combined_uncertainty"),
        ub.alias("uncertainty_band"), cb.alias("confidence_band"), original.alias("original_decision"),
        F.when(abstain, PO.ABSTAIN).otherwise(original).alias("uncertainty_adjusted_decision"),
        reason.alias("abstention_reason"),
    )


def rounded(df: DataFrame) -> DataFrame:
    """Every double column rounded to 6 places (for emitted tables)."""
    return df.select(*[r6(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def band_performance(u: DataFrame, band_col: str) -> DataFrame:
    d, y = F.col("uncertainty_adjusted_decision"), F.col("target") == 1
    return u.groupBy(F.col(band_col).alias("band")).agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(y, 1)).alias("failures"),
        F.count(F.when(y & (d == PO.LOW), 1)).alias("unsafe_low_risk"),
        F.count(F.when(y & (d == PO.HIGH), 1)).alias("high_risk_failures"),
        F.count(F.when(y & d.isin(PO.REVIEW, PO.ABSTAIN), 1)).alias("review_or_abstain_failures"),
        r6(F.avg("calibrated_failure_probability")).alias("mean_probability"),
        r6(F.avg("prediction_confidence")).alias("mean_confidence"),
        r6(F.avg("combined_uncertainty")).alias("mean_uncertainty"),
    ).select(F.lit(band_col).alias("band_column"), "*")
