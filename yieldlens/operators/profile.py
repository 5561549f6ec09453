"""Data audit and profiling of a wide record table.

Per-feature statistics reuse the drift base with every row on one side: one
shuffle to distinct values, one distributed ranking, then small aggregates.
Per-row statistics are expressions over an array of the sensor columns (no
shuffle at all).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, row_array, to_long
from ..functions.expressions import cut, r6, sig
from .drift import DriftBase

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------
MODERATE_MISSING = 0.30
HIGH_MISSING = 0.60
NEAR_CONSTANT_VARIANCE = 1e-8
CORRELATION_THRESHOLD = 0.95
MISSINGNESS_CATEGORY_EDGES = [-0.001, 0.0, MODERATE_MISSING, HIGH_MISSING, 1.0]
MISSINGNESS_CATEGORIES = ["No missingness", "Low missingness", "Moderate missingness", "High missingness"]
MISSING_ACTIONS = [
    "Consider dropping",
    "Evaluate carefully before imputation",
    "Median imputation likely acceptable",
    "No missing-value treatment required",
]
ROW_QUALITY_EDGES = [-0.001, 0.05, 0.15, 0.30, 1.0]
ROW_QUALITY_FLAGS = ["Good", "Acceptable", "Review", "Poor"]
ROW_MISSING_BAND_EDGES = [-0.001, 0.01, 0.03, 0.05, 0.10, 1.0]
ROW_MISSING_BANDS = ["0-1%", "1-3%", "3-5%", "5-10%", ">10%"]
RECORD_QUALITY_EDGES = [-0.001, 0.60, 0.75, 0.90, 1.0]
RECORD_QUALITY_BANDS = ["Poor", "Review", "Acceptable", "High"]
SPLIT_SHARES = {"train": 0.64, "validation": 0.16, "test": 0.20}


def profile_base(df: DataFrame, features: Sequence[str], id_col: str = "record_id") -> DriftBase:
    one_side = df.select(id_col, *features).withColumn("side", F.lit("reference"))
    return DriftBase(one_side, features, 1e-8, id_col, "side")


def feature_stats(b: DriftBase) -> DataFrame:
    """One row per feature: counts, distinct, variance, min/max/mean/median/quartiles/mean |x|."""
    o = b.order_stats(extra_probs=(0.25, 0.75)).where(F.col("side") == "reference")
    q = o.groupBy("feature").agg(
        F.max(F.when(F.col("kind") == 0, F.col("quantile"))).alias("median"),
        F.max(F.when((F.col("kind") == 3) & (F.col("j") == 0), F.col("quantile"))).alias("q1"),
        F.max(F.when((F.col("kind") == 3) & (F.col("j") == 1), F.col("quantile"))).alias("q3"),
    )
    st = b.stats.select(
        "feature",
        F.col("rows_ref").alias("rows"),
        F.col("n_ref").alias("n"),
        F.col("distinct_ref").alias("distinct"),
        F.col("mean_ref").alias("mean"),
        F.col("mean_abs_ref").alias("mean_abs"),
        F.col("ss_ref").alias("ss"),
        F.col("std_ref").alias("std"),
        F.col("min_ref").alias("minimum"),
        F.col("max_ref").alias("maximum"),
    )
    return st.join(q, "feature", "left")


def feature_manifest(fs: DataFrame) -> DataFrame:
    miss = F.col("rows") - F.col("n")
    rate = miss / F.col("rows")
    var = F.when(F.col("n") > 1, F.col("ss") / (F.col("n") - 1))
    out = fs.select(
        "feature",
        F.lit("double").alias("dtype"),
        F.col("n").cast("bigint").alias("non_missing_count"),
        miss.cast("bigint").alias("missing_count"),
        r6(rate).alias("missing_rate"),
        F.col("distinct").cast("bigint").alias("unique_count"),
        (F.col("distinct") <= 1).alias("is_constant"),
        sig(var).alias("variance"),
        r6(F.col("minimum")).alias("minimum"),
        r6(F.col("maximum")).alias("maximum"),
        r6(F.col("mean")).alias("mean"),
        r6(F.col("median")).alias("median"),
        r6(F.col("std")).alias("standard_deviation"),
        cut(rate, MISSINGNESS_CATEGORY_EDGES, MISSINGNESS_CATEGORIES).alias("missingness_category"),
    )
    # one row per feature: bounded by the schema
    w = Window.orderBy(F.desc("missing_rate"), F.asc_nulls_last("variance"), F.asc("feature"))
    return out.withColumn("manifest_rank", F.row_number().over(w))


def constant_features(fs: DataFrame) -> DataFrame:
    return fs.where(F.col("distinct") <= 1).select("feature", F.col("distinct").cast("bigint").alias("unique_count"))


def near_constant_features(fs: DataFrame, threshold: float = NEAR_CONSTANT_VARIANCE) -> DataFrame:
    """Population variance after median fill <= threshold; constants excluded first.

    Exact from the stats: filled mean mf = (n mean + m median)/N and
    var_pop = (ss + n (mean - mf)^2 + m (median - mf)^2) / N."""
    n, m, N = F.col("n"), F.col("rows") - F.col("n"), F.col("rows")
    mf = (n * F.col("mean") + m * F.col("median")) / N
    vp = (F.col("ss") + n * F.pow(F.col("mean") - mf, 2) + m * F.pow(F.col("median") - mf, 2)) / N
    t = fs.where((F.col("distinct") > 1) & (F.col("n") > 1)).select("feature", vp.alias("filled_variance"))
    return t.where(F.col("filled_variance") <= threshold).select("feature", sig(F.col("filled_variance")).alias(
        "filled_variance"))


def missingness_report(fs: DataFrame) -> DataFrame:
    miss = F.col("rows") - F.col("n")
    rate = miss / F.col("rows")
    action = (
        F.when(rate > HIGH_MISSING, MISSING_ACTIONS[0])
        .when(rate > MODERATE_MISSING, MISSING_ACTIONS[1])
        .when(rate > 0, MISSING_ACTIONS[2])
        .otherwise(MISSING_ACTIONS[3])
    )
    return fs.select("feature", miss.cast("bigint").alias("missing_count"), r6(rate).alias("missing_rate"),
                     action.alias("recommended_action"))


def excluded_features(fs: DataFrame) -> DataFrame:
    """Constant plus near-constant features."""
    return constant_features(fs).select("feature").unionByName(near_constant_features(fs).select("feature"))


def outlier_report(b: DriftBase, fs: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """IQR fences (x1.5) and the count/rate of values strictly outside, over non-null values."""
    f = fs.select("feature", "n", "q1", "q3")
    if excluded is not None:
        f = f.join(F.broadcast(excluded), "feature", "left_anti")
    f = f.select("*", (F.col("q3") - F.col("q1")).alias("iqr"))
    f = f.select("*", (F.col("q1") - 1.5 * F.col("iqr")).alias("lower"), (F.col("q3") + 1.5 * F.col("iqr")).alias("upper"))
    fences = F.broadcast(f)  # one row per feature
    cnt = b.cum.join(fences.select("feature", "lower", "upper"), "feature").groupBy("feature").agg(
        F.sum(F.when((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")), F.col("c_ref"))
              .otherwise(0)).alias("outliers")
    )
    o = f.join(cnt, "feature", "left")
    outliers = F.coalesce(F.col("outliers"), F.lit(0))
    return o.select(
        "feature",
        r6(F.col("q1")).alias("q1"), r6(F.col("q3")).alias("q3"), r6(F.col("iqr")).alias("iqr"),
        r6(F.col("lower")).alias("lower_bound"), r6(F.col("upper")).alias("upper_bound"),
        outliers.cast("bigint").alias("outlier_count"),
        r6(F.when(F.col("n") > 0, outliers / F.col("n")).otherwise(0.0)).alias("outlier_rate"),
    )


def sensor_reliability(b: DriftBase, fs: DataFrame) -> DataFrame:
    """completeness .5 + (1 - outlier rate) .25 + 1/(1 + std/(mean|x|+1e-8)) .25, clipped; all-NULL -> 0."""
    o = outlier_report(b, fs).select("feature", "outlier_rate")
    t = fs.join(o, "feature", "left")
    miss = 1 - F.col("n") / F.col("rows")
    rv = F.col("std") / (F.col("mean_abs") + 1e-8)
    comp = 1 - miss
    osc = F.greatest(F.lit(0.0), 1 - F.col("outlier_rate"))
    stab = 1.0 / (1.0 + rv)
    score = F.least(F.greatest(0.5 * comp + 0.25 * osc + 0.25 * stab, F.lit(0.0)), F.lit(1.0))
    empty = F.col("n") == 0
    return t.select(
        F.col("feature").alias("sensor"),
        r6(F.when(empty, 1.0).otherwise(miss)).alias("missing_rate"),
        r6(F.when(empty, 1.0).otherwise(F.col("outlier_rate"))).alias("outlier_rate"),
        r6(F.when(empty, F.lit(None)).otherwise(rv)).alias("relative_variability"),
        r6(F.when(empty, 0.0).otherwise(stab)).alias("stability_score"),
        r6(F.when(empty, 0.0).otherwise(comp)).alias("completeness_score"),
        r6(F.when(empty, 0.0).otherwise(osc)).alias("outlier_score"),
        r6(F.when(empty, 0.0).otherwise(score)).alias("sensor_reliability_score"),
    )


def row_quality(df: DataFrame, features: Sequence[str], id_col: str = "record_id") -> DataFrame:
    arr = row_array(features)
    k = len(features)
    missing = F.size(F.filter(arr, lambda x: x.isNull()))
    rate = missing / F.lit(k)
    return df.select(
        id_col, "target",
        missing.cast("bigint").alias("missing_count"),
        r6(rate).alias("missing_rate"),
        (F.lit(k) - missing).cast("bigint").alias("available_count"),
        cut(rate, ROW_QUALITY_EDGES, ROW_QUALITY_FLAGS).alias("quality_flag"),
    )


def record_quality(df: DataFrame, features: Sequence[str], reliability: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Mean reliability of the observed sensors, completeness, score .6c + .4r, band.

    The reliability table has one row per sensor (bounded by the schema), so it is
    collected as a literal map and applied as a row expression: no join, no shuffle."""
    rel = {r["sensor"]: float(r["sensor_reliability_score"]) for r in reliability.collect()}
    k = len(features)
    pairs = F.array(*[F.struct(finite(c).alias("v"), F.lit(rel.get(c, 0.0)).alias("r")) for c in features])
    observed = F.filter(pairs, lambda s: s["v"].isNotNull())
    n_obs = F.size(observed)
    rsum = F.aggregate(observed, F.lit(0.0), lambda acc, s: acc + s["r"])
    mean_rel = rsum / F.greatest(n_obs, F.lit(1))
    comp = n_obs / F.lit(k)
    score = F.least(F.greatest(0.6 * comp + 0.4 * mean_rel, F.lit(0.0)), F.lit(1.0))
    return df.select(
        id_col, "ts", "target", "status",
        (F.lit(k) - n_obs).cast("bigint").alias("missing_sensor_count"),
        r6(1 - comp).alias("missing_sensor_rate"),
        n_obs.cast("bigint").alias("observed_sensor_count"),
        r6(mean_rel).alias("mean_observed_sensor_reliability"),
        r6(comp).alias("completeness_score"),
        r6(score).alias("data_quality_score"),
        cut(score, RECORD_QUALITY_EDGES, RECORD_QUALITY_BANDS).alias("data_quality_band"),
    )


def basic_summary(df: DataFrame, features: Sequence[str], id_col: str = "record_id", ts_col: str = "ts") -> DataFrame:
    """One row: counts, class balance, duplicates (sum of n-1 over identical rows), missing cells, time range."""
    k = len(features)
    miss = F.size(F.filter(row_array(features), lambda x: x.isNull()))
    base = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(F.col("target") == 0, 1)).alias("pass_count"),
        F.count(F.when(F.col("target") == 1, 1)).alias("fail_count"),
        F.sum(miss).alias("missing_cells"),
        F.min(ts_col).alias("start_time"),
        F.max(ts_col).alias("end_time"),
    )
    others = [c for c in df.columns if c != id_col]
    dup_full = df.groupBy(*others).count().agg(F.sum(F.col("count") - 1).alias("duplicate_rows"))
    dup_sens = df.groupBy(*features).count().agg(F.sum(F.col("count") - 1).alias("duplicate_sensor_rows"))
    b = base.crossJoin(dup_full).crossJoin(dup_sens)
    return b.select(
        "total_rows",
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.lit(k).cast("bigint").alias("sensor_columns"),
        "pass_count", "fail_count",
        r6(F.col("fail_count") / F.col("total_rows")).alias("failure_rate"),
        F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.coalesce("duplicate_sensor_rows", F.lit(0)).cast("bigint").alias("duplicate_sensor_rows"),
        F.col("missing_cells").cast("bigint").alias("missing_cells"),
        r6(F.col("missing_cells") / (F.col("total_rows") * k)).alias("missing_rate"),
        "start_time", "end_time",
    )


def daily_trend(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    return df.groupBy(F.date_format(ts_col, "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(F.col("target") == 1, 1)).alias("failures"),
    ).select("day", "records", "failures", r6(F.col("failures") / F.col("records")).alias("failure_rate"))


def class_distribution(df: DataFrame) -> DataFrame:
    w = Window.partitionBy()  # two rows (one per class)
    c = df.groupBy("target", "status").agg(F.count(F.lit(1)).alias("records"))
    return c.select("target", "status", "records", r6(F.col("records") / F.sum("records").over(w)).alias("share"))


def missingness_association(df: DataFrame, features: Sequence[str], id_col: str = "record_id") -> DataFrame:
    """Per sensor: failure rate when missing / observed, difference, mutual information (nats)."""
    long = to_long(df, [id_col, "target"], features)
    c = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("value").isNull(), 1)).alias("m"),
        F.count(F.when(F.col("value").isNull() & (F.col("target") == 1), 1)).alias("m1"),
        F.count(F.when(F.col("value").isNotNull() & (F.col("target") == 1), 1)).alias("o1"),
    )
    n, m, m1, o1 = F.col("n"), F.col("m"), F.col("m1"), F.col("o1")
    o = n - m
    m0, o0 = m - m1, o - o1

    def term(nxy, nx, ny):
        return F.when(nxy > 0, (nxy / n) * F.log((nxy * n) / (nx * ny))).otherwise(0.0)

    y1, y0 = m1 + o1, m0 + o0
    mi = term(m1, m, y1) + term(m0, m, y0) + term(o1, o, y1) + term(o0, o, y0)
    rate_m = F.when(m > 0, m1 / m)
    rate_o = F.when(o > 0, o1 / o)
    return c.select(
        "feature",
        m.cast("bigint").alias("missing_count"),
        r6(m / n).alias("missing_rate"),
        r6(rate_m).alias("failure_rate_when_missing"),
        r6(rate_o).alias("failure_rate_when_observed"),
        r6(rate_m - rate_o).alias("failure_rate_difference"),
        r6(F.when(m == 0, 0.0).otherwise(mi)).alias("mutual_information"),
    )


def row_missingness_bands(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Records, failures and failure rate per row-missingness band; empty bands kept."""
    rate = F.size(F.filter(row_array(features), lambda x: x.isNull())) / F.lit(len(features))
    banded = df.select(cut(rate, ROW_MISSING_BAND_EDGES, ROW_MISSING_BANDS).alias("band"), "target")
    counts = banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("target") == 1, 1)).alias("failures")
    )
    spark = df.sparkSession
    domain = spark.createDataFrame([(i, b) for i, b in enumerate(ROW_MISSING_BANDS)], "band_order int, band string")
    t = F.broadcast(domain).join(counts, "band", "left")
    records = F.coalesce("records", F.lit(0)).cast("bigint")
    failures = F.coalesce("failures", F.lit(0)).cast("bigint")
    return t.select("band_order", "band", records.alias("records"), failures.alias("failures"),
                    r6(F.when(records > 0, failures / records)).alias("failure_rate"))


def correlated_pairs(df: DataFrame, fs: DataFrame, features: Sequence[str], threshold: float = CORRELATION_THRESHOLD,
                     excluded: Sequence[str] = ()) -> DataFrame:
    """Median-filled Pearson r for every unordered pair, |r| >= threshold.

    The d x d moment matrix is a tree aggregate of per-row outer products over
    the assembled vector (MLlib Correlation); only that matrix -- bounded by the
    schema width, not by the rows -- reaches the driver."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    keep = [c for c in features if c not in set(excluded)]
    med = {r["feature"]: r["median"] for r in fs.select("feature", "median").collect()}
    keep = [c for c in keep if med.get(c) is not None]
    filled = df.select(*[F.coalesce(finite(c), F.lit(float(med[c]))).alias(c) for c in keep])
    vec = VectorAssembler(inputCols=keep, outputCol="_v").transform(filled).select("_v")
    mat = Correlation.corr(vec, "_v", "pearson").head()[0].toArray()
    rows = []
    for i in range(len(keep)):
        for j in range(i + 1, len(keep)):
            r = float(mat[i, j])
            if not math.isnan(r) and abs(r) >= threshold:
                rows.append((keep[i], keep[j], round(r, 6), round(abs(r), 6)))
    spark = df.sparkSession
    return spark.createDataFrame(rows, "feature_a string, feature_b string, correlation double, abs_correlation double")


def audited_dataset(df: DataFrame, fs: DataFrame, features: Sequence[str], high_missing: float = HIGH_MISSING) -> DataFrame:
    """Drop constant sensors and sensors with more than 60 % missing (a projection decided from one row per sensor)."""
    drop = [
        r["feature"]
        for r in fs.select("feature", "distinct", "n", "rows").collect()
        if r["distinct"] <= 1 or (1 - r["n"] / r["rows"]) > high_missing
    ]
    return df.drop(*drop)


def stratified_split(df: DataFrame, hash_col: str, shares: dict[str, float] | None = None,
                     id_col: str = "record_id") -> DataFrame:
    """Per class, rank rows by a deterministic hash (distributed rank, not a 2-task window) and cut at
    quotas test = round(.2 n), validation = round(.16 n), rest train: exact shares, independent of
    partitioning."""
    from ..functions.ranking import cumulative

    shares = shares or SPLIT_SHARES
    base = df.select(id_col, "target", F.col(hash_col).alias("_h"), F.lit(1).alias("_one"))
    ranked = cumulative(base, ["target"], ["_h", id_col], ["_one"], with_totals=True)
    r, n = F.col("cum__one"), F.col("tot__one")
    n_test = F.round(n * shares["test"])
    n_val = F.round(n * shares["validation"])
    split = F.when(r <= n_test, "test").when(r <= n_test + n_val, "validation").otherwise("train")
    return ranked.select(id_col, "target", split.alias("split"))


def split_summary(split: DataFrame) -> DataFrame:
    tot = Window.partitionBy()  # three rows
    c = split.groupBy("split").agg(F.count(F.lit(1)).alias("records"),
                                   F.count(F.when(F.col("target") == 1, 1)).alias("failures"))
    return c.select("split", "records", "failures", r6(F.col("failures") / F.col("records")).alias("failure_rate"),
                    r6(F.col("records") / F.sum("records").over(tot)).alias("share"))
