"""Attribution tables and their roll-ups.

The reference explains a tree model with a per-row solver; that is re-aimed
here as the exact additive attribution of a linear score: contribution =
coef * (x - mean) / std with reference-side mean and std (missing -> mean,
so contribution 0).  Everything is SQL over the long (record, feature) frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, to_long
from ..functions.expressions import r6
from . import policy as PO

TOP_K = 10
TOP_LIST = 5
GROUP_TOP = 20
QUEUE_SIZE = 25
DECISION_PRIORITY = {PO.HIGH: 0, PO.ABSTAIN: 1, PO.REVIEW: 2, PO.LOW: 3}


def coefficients(features: Sequence[str]) -> dict[str, float]:
    """Fixed illustrative linear coefficients, generated by a rule (position i -> ((7 i) mod 13 - 6) / 10)."""
    return {f: ((7 * (i + 1)) % 13 - 6) / 10.0 for i, f in enumerate(features)}


def attributions(wide: DataFrame, features: Sequence[str], coefs: dict[str, float] | None = None,
                 id_col: str = "record_id", explain_side: str = "current", tasks: int | None = None) -> DataFrame:
    """(record, feature, value, contribution) for the explained side; stats from the reference side.

    With ``tasks`` the explained records are dealt by id into so many tasks before their sensors become rows, so that
    grouping, ranking or joining these by record moves none of them again."""
    coefs = coefs or coefficients(features)
    long = to_long(wide, [id_col, "side", "target"], features)
    st = long.where(F.col("side") == "reference").groupBy("feature").agg(
        F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    cmap = F.create_map(*[x for f, c in coefs.items() for x in (F.lit(f), F.lit(c))])
    explained = long.where(F.col("side") == explain_side)
    if tasks:
        own = wide.where(F.col("side") == explain_side).select(id_col, "target", *features).repartition(tasks, id_col)
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), finite(c).alias("value")) for c in features])
        explained = own.select(id_col, "target", F.explode(cells).alias("_x")).select(id_col, "target", "_x.*")
    t = explained.join(F.broadcast(st), "feature")  # one row per feature
    z = F.when(F.col("_s").isNull() | (F.col("_s") == 0) | F.col("value").isNull(), 0.0).otherwise(
        (F.col("value") - F.col("_m")) / F.col("_s"))
    # full precision here; rounded only where a table is emitted (aggregating rounded values invites ties)
    return t.select(id_col, "target", "feature", "value", (cmap[F.col("feature")] * z).alias("contribution"))


def global_importance(att: DataFrame) -> DataFrame:
    a = att.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean_c"),
        F.avg((F.col("contribution") > 0).cast("int")).alias("share_pos"))
    w = Window.partitionBy()  # one row per feature
    rel = F.col("mean_abs") / F.sum("mean_abs").over(w)
    t = a.select("feature", "mean_abs", "mean_c", "share_pos", rel.alias("rel"))
    o = Window.orderBy(F.desc("rel"), "feature")
    return t.select(
        "feature", r6(F.col("mean_abs")).alias("mean_absolute_contribution"), r6(F.col("mean_c")).alias("mean_contribution"),
        r6(F.col("share_pos")).alias("share_positive"), r6(F.col("rel")).alias("relative_importance"),
        r6(F.sum("rel").over(o.rowsBetween(Window.unboundedPreceding, 0))).alias("cumulative_importance"),
        F.row_number().over(o).alias("importance_rank"))


def local_top_k(att: DataFrame, k: int = TOP_K, id_col: str = "record_id") -> DataFrame:
    """Top-k features per record by |contribution| (ties by name) with direction."""
    w = Window.partitionBy(id_col).orderBy(F.desc(F.abs("contribution")), "feature")  # one row per sensor
    t = att.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)
    d = F.when(F.col("contribution") > 0, "increases risk").when(F.col("contribution") < 0, "decreases risk").otherwise(
        "neutral")
    return t.select(id_col, "rank", "feature", r6(F.col("value")).alias("value"),
                    r6(F.col("contribution")).alias("contribution"), d.alias("direction"))


def local_summary(att: DataFrame, n: int = TOP_LIST, id_col: str = "record_id") -> DataFrame:
    """Per record: positive and negative totals and the first n risk / protective feature names."""
    def names(cond, order_desc):
        s = F.struct((-F.col("contribution") if order_desc else F.col("contribution")).alias("k"), F.col("feature"))
        arr = F.array_sort(F.collect_list(F.when(cond, s)))
        return F.concat_ws(",", F.transform(F.slice(arr, 1, n), lambda x: x["feature"]))

    return att.groupBy(id_col).agg(
        r6(F.sum(F.when(F.col("contribution") > 0, F.col("contribution")).otherwise(0.0))).alias("positive_total"),
        r6(F.sum(F.when(F.col("contribution") < 0, F.col("contribution")).otherwise(0.0))).alias("negative_total"),
        names(F.col("contribution") > 0, True).alias("top_risk_features"),
        names(F.col("contribution") < 0, False).alias("top_protective_features"),
    )


def explanation_text(summary: DataFrame, scores: DataFrame, lower: float = 0.035, upper: float = 0.08,
                     id_col: str = "record_id") -> DataFrame:
    t = summary.join(scores.select(id_col, "probability", "confidence"), id_col)
    d = PO.assign_decision(F.col("probability"), lower, upper)
    top3 = F.concat_ws(",", F.slice(F.split(F.col("top_risk_features"), ","), 1, 3))
    text = F.format_string("%s: failure probability %.3f, confidence %.2f; main risk drivers: %s", d,
                           F.round("probability", 3), F.round("confidence", 2),
                           F.when(top3 == "", F.lit("none")).otherwise(top3))
    return t.select(id_col, d.alias("decision"), text.alias("explanation_text"))


def group_top_features(att: DataFrame, groups: DataFrame, group_col: str, top: int = GROUP_TOP,
                       id_col: str = "record_id") -> DataFrame:
    t = att.join(groups.select(id_col, group_col), id_col)
    a = t.groupBy(group_col, "feature").agg(F.avg(F.abs("contribution")).alias("m"),
                                             F.avg("contribution").alias("mc"))
    w = Window.partitionBy(group_col).orderBy(F.desc("m"), "feature")  # groups x features rows
    return a.select(group_col, "feature", r6(F.col("m")).alias("mean_absolute_contribution"),
                    r6(F.col("mc")).alias("mean_contribution"), F.row_number().over(w).alias("feature_rank")).where(
        F.col("feature_rank") <= top)


def failure_features(att: DataFrame, top: int | None = GROUP_TOP) -> DataFrame:
    """Features by mean absolute contribution over the failed records: the first ``top`` as a report, all for None."""
    a = att.where(F.col("target") == 1).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("m"), F.avg((F.col("contribution") > 0).cast("int")).alias("sp"),
        F.count(F.lit(1)).alias("failures"))
    w = Window.orderBy(F.desc("m"), "feature")  # one row per feature
    ranked = a.select("feature", "failures", r6(F.col("m")).alias("mean_absolute_contribution"),
                      r6(F.col("sp")).alias("share_positive"), F.row_number().over(w).alias("feature_rank"))
    return ranked if top is None else ranked.where(F.col("feature_rank") <= top)


def review_queue(u: DataFrame, size: int = QUEUE_SIZE, id_col: str = "record_id") -> DataFrame:
    """Records to review first: actual failures, then decision priority, probability, uncertainty (top-k report)."""
    pr = F.create_map(*[x for d, p in DECISION_PRIORITY.items() for x in (F.lit(d), F.lit(p))])
    t = u.select(id_col, "target", "decision", "probability", "uncertainty",
                 pr[F.col("decision")].alias("decision_priority"))
    return t.orderBy(F.desc("target"), "decision_priority", F.desc("probability"), F.desc("uncertainty"), id_col).limit(
        size)
