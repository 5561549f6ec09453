"""Preparation and feature engineering on the wide record table.

Statistics are fitted on the reference (training) side with the distributed
quantile helper and read as one row per feature (bounded by the schema);
transforms are row expressions, or numpy over the batches of a task for the
statistics of a row, so they never shuffle the records.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite, row_array, to_long
from ..functions.expressions import r6, sig
from ..functions.ranking import column_quantiles, exact_quantiles

ZONES = 6
DEVIATION_LEVELS = (1.0, 1.5, 3.0)
STRESS_RATES = [0.0, 0.05, 0.1, 0.2, 0.3, 0.4]


def development_stats(wide: DataFrame, features: Sequence[str], id_col: str = "record_id",
                      fit: Column | None = None) -> DataFrame:
    """Per sensor on the fitting rows: median, Q1, Q3, IQR, mean, std, missing rate, observed count."""
    src = wide.where(fit) if fit is not None else wide
    long = to_long(src, [id_col], features)
    q = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("j") == 0, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("j") == 1, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("j") == 2, F.col("quantile"))).alias("q3"))
    m = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                    F.count("value").alias("observed_count"),
                                    (1 - F.count("value") / F.count(F.lit(1))).alias("missing_rate"))
    t = m.join(q, "feature", "left")
    iqr = F.col("q3") - F.col("q1")
    return t.select("feature", "median", "q1", "q3", F.coalesce(iqr, F.lit(0.0)).alias("iqr"), "mean",
                    F.coalesce(F.col("std"), F.lit(0.0)).alias("std"), "missing_rate", "observed_count")


def medians(stored: DataFrame, features: Sequence[str], fit: Column) -> DataFrame:
    """feature, median on the fitting rows of a stored table, as ``development_stats`` gives it."""
    return column_quantiles(stored.where(fit), features, [0.5]).select("feature", F.col("quantile").alias("median"))


def _stat_map(stats: DataFrame, col: str) -> dict[str, float]:
    """One value per feature (bounded by the schema) as a driver-side literal map."""
    return {r["feature"]: (None if r[col] is None else float(r[col])) for r in stats.select("feature", col).collect()}


def median_impute(wide: DataFrame, features: Sequence[str], stats: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Fill with fitted medians; add a ``<col>_missing`` flag for columns that had missing values when fitted."""
    med = _stat_map(stats, "median")
    miss = _stat_map(stats, "missing_rate")
    flags = [c for c in features if (miss.get(c) or 0) > 0]
    return wide.select(
        id_col, *[F.coalesce(finite(c), F.lit(med.get(c))).alias(c) for c in features],
        *[finite(c).isNull().cast("int").alias(f"{c}_missing") for c in flags])


def robust_scale(wide: DataFrame, features: Sequence[str], stats: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(x - median) / IQR with fitted statistics; a zero IQR divides by 1."""
    med, iqr = _stat_map(stats, "median"), _stat_map(stats, "iqr")

    def z(c):
        d = iqr.get(c) or 0.0
        return r6((finite(c) - F.lit(med.get(c))) / F.lit(d if abs(d) > 0 else 1.0)).alias(c)

    return wide.select(id_col, *[z(c) for c in features])


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """Balanced weight n / (2 n_c) per class and scale_pos_weight = negatives / positives."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("records"))
    tot = df.agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col(target) == 0, 1)).alias("_neg"),
                 F.count(F.when(F.col(target) == 1, 1)).alias("_pos"))
    return c.crossJoin(F.broadcast(tot)).select(
        target, "records", r6(F.col("_n") / (2.0 * F.col("records"))).alias("balanced_weight"),
        r6(F.when(F.col("_pos") > 0, F.col("_neg") / F.col("_pos"))).alias("scale_pos_weight"))


def missingness_features(wide: DataFrame, features: Sequence[str], id_col: str = "record_id") -> DataFrame:
    arr = row_array(features)
    m = F.size(F.filter(arr, lambda x: x.isNull()))
    return wide.select(id_col, m.alias("row_missing_count"), r6(m / F.lit(len(features))).alias("row_missing_rate"),
                       (F.lit(len(features)) - m).alias("row_observed_count"),
                       *[finite(c).isNull().cast("int").alias(f"{c}_missing") for c in features])


def inject_missingness(wide: DataFrame, features: Sequence[str], rate: float, key: str = "o_orderkey",
                       id_col: str = "record_id") -> DataFrame:
    """Blank each observed cell when a mixing hash of (key, column, seed 42 + 1000 r) falls below r, so that the cells of a
    record are blanked independently of each other."""
    return wide.select(id_col, key, *[c.alias(name) for name, c in injected(features, rate, key).items()])


def injected(features: Sequence[str], rate: float, key: str = "o_orderkey") -> dict[str, Column]:
    """The cells that ``inject_missingness`` leaves, by column."""
    seed = int(42 + 1000 * rate)

    def u(c):
        word = F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(c), F.lit(str(seed)))), 1, 8)
        return F.conv(word, 16, 10).cast("long") / 4294967296.0

    return {c: F.when(u(c) < rate, F.lit(None).cast("double")).otherwise(finite(c)) for c in features}


def min_max_normalise(df: DataFrame, col: str, id_col: str = "record_id", out: str | None = None) -> DataFrame:
    """(x - min) / (max - min) with min/max from one aggregate (broadcast); a range below 1e-12 gives 0."""
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    t = df.crossJoin(F.broadcast(mm))
    rng = F.col("_hi") - F.col("_lo")
    return t.select(id_col, col, r6(F.when(rng < 1e-12, 0.0).otherwise((F.col(col) - F.col("_lo")) / rng)).alias(
        out or f"{col}_normalised"))


def merge_context(wide: DataFrame, quality: DataFrame, anomaly: DataFrame, side: str,
                  id_col: str = "record_id") -> DataFrame:
    """Filter one side, 1:1 left joins of quality and anomaly, with an unmatched-record count column."""
    base = wide.where(F.col("side") == side).select(id_col, "target")
    t = base.join(quality, id_col, "left").join(anomaly, id_col, "left")
    qcols = [c for c in quality.columns if c != id_col]
    acols = [c for c in anomaly.columns if c != id_col]
    unmatched = F.col(qcols[0]).isNull() | F.col(acols[0]).isNull()
    t = t.withColumn("matched", ~unmatched)
    n_bad = t.agg(F.count(F.when(~F.col("matched"), 1)).alias("unmatched_records"))  # one row
    return t.crossJoin(F.broadcast(n_bad))


def _described(v: np.ndarray, seen: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Statistics of each row's seen values as (numbers, whether defined); ``v`` has a line for each sensor.

    Sums run in the sensors' order, as an aggregate over the row's array would."""
    v = np.where(seen, v, np.nan)
    n, at = seen.sum(0), np.arange(v.shape[1])
    ordered = np.sort(v, axis=0)  # missing values last

    def total(x):
        s = np.zeros(v.shape[1])
        for line, known in zip(x, seen):
            s = s + np.where(known, line, 0.0)
        return s

    mean = total(v) / n
    low, high = ordered[np.maximum(n - 1, 0) // 2, at], ordered[np.minimum(n // 2, len(v) - 1), at]
    least, most = ordered[0], ordered[np.maximum(n - 1, 0), at]
    return {"mean": (mean, n > 0), "median": ((low + high) / 2.0, n > 0), "std": (np.sqrt(total((v - mean) * (v - mean)) / (n - 1)), n > 1),
            "min": (least, n > 0), "max": (most, n > 0), "range": (most - least, n > 0), "rms": (np.sqrt(total(v * v) / n), n > 0)}


def _share(count: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return count / of, of > 0


def _by_row(wide: DataFrame, features: Sequence[str], id_col: str, describe, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """id and what ``describe`` makes of each batch's values (a line for each sensor, and whether they are there): by name an
    array of counts, or numbers with whether they are defined.  Numbers are rounded to 6 places."""
    cols = list(features)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.stack([batch.column(1 + j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(len(cols))])
            with np.errstate(all="ignore"):
                out = describe(v, ~np.isnan(v))
            arrays = [pa.array(out[name].astype(np.int32)) if kind == "int" else pa.array(out[name][0], mask=~out[name][1])
                      for name, kind in schema]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, *[name for name, _ in schema]])

    kind = wide.schema[id_col].dataType.simpleString()
    t = wide.select(id_col, *[finite(c).alias(c) for c in cols]).mapInArrow(
        run, ", ".join([f"{id_col} {kind}", *[f"{name} {k}" for name, k in schema]]))
    return t.select(id_col, *[F.col(name) if k == "int" else r6(F.col(name)).alias(name) for name, k in schema])


def _kinds(names: Sequence[str], counts: Sequence[str]) -> list[tuple[str, str]]:
    return [(name, "int" if name in counts else "double") for name in names]


def aggregate_features(wide: DataFrame, features: Sequence[str], id_col: str = "record_id") -> DataFrame:
    """Row mean / median / std / min / max / range / abs mean / abs median, missing, sign counts and rates."""

    def describe(v, seen):
        n = seen.sum(0)
        row, size = _described(v, seen), _described(np.abs(v), seen)
        signs = {"positive": (v > 0).sum(0), "negative": (v < 0).sum(0), "zero": (v == 0).sum(0)}
        return {**{f"row_{k}": x for k, x in row.items()}, "row_abs_mean": size["mean"], "row_abs_median": size["median"],
                "row_missing_count": len(v) - n, **{f"{k}_count": c for k, c in signs.items()},
                **{f"{k}_rate": _share(c, n) for k, c in signs.items()}}

    counts = ["row_missing_count", "positive_count", "negative_count", "zero_count"]
    return _by_row(wide, features, id_col, describe, _kinds(
        ["row_mean", "row_median", "row_std", "row_min", "row_max", "row_range", "row_abs_mean", "row_abs_median", *counts,
         "positive_rate", "negative_rate", "zero_rate"], counts))


def _scales(features: Sequence[str], stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fitted medians (NaN: none) and IQRs (1 where next to zero), read from ``stats`` in one go."""
    by = {r["feature"]: r for r in stats.select("feature", "median", "iqr").collect()}  # one row per feature

    def number(c, col):
        return None if c not in by or by[c][col] is None else float(by[c][col])

    iqr = [number(c, "iqr") or 0.0 for c in features]
    return (np.array([np.nan if number(c, "median") is None else number(c, "median") for c in features]),
            np.array([d if abs(d) > 1e-12 else 1.0 for d in iqr]))


def robust_deviation_features(wide: DataFrame, features: Sequence[str], stats: DataFrame,
                              id_col: str = "record_id") -> DataFrame:
    """Robust z per sensor against fitted median/IQR; extreme counts, balance, rates and z summaries per row."""
    med, iqr = _scales(features, stats)
    names = ["abs_z_ge_1", "abs_z_ge_1_5", "abs_z_ge_3"]

    def describe(v, seen):
        seen = seen & ~np.isnan(med)[:, None]
        z = (v - med[:, None]) / iqr[:, None]
        n, row = seen.sum(0), _described(z, seen)
        over = {name: (np.abs(z) >= t).sum(0) for name, t in zip(names, DEVIATION_LEVELS)}
        hi3, lo3 = (z >= DEVIATION_LEVELS[2]).sum(0), (z <= -DEVIATION_LEVELS[2]).sum(0)
        return {**over, "high_extremes": hi3, "low_extremes": lo3, "extreme_balance": hi3 - lo3,
                **{f"{name}_rate": _share(c, n) for name, c in over.items()}, **{f"z_{k}": x for k, x in row.items()},
                "z_abs_max": _described(np.abs(z), seen)["max"]}

    counts = [*names, "high_extremes", "low_extremes", "extreme_balance"]
    return _by_row(wide, features, id_col, describe, _kinds(
        [*counts, *[f"{name}_rate" for name in names], "z_mean", "z_rms", "z_abs_max", "z_median", "z_std"], counts))


def zones(features: Sequence[str], n_zones: int = ZONES) -> list[list[str]]:
    """Ordered sensors cut into contiguous zones; the first zones take the remainder."""
    base, extra = divmod(len(features), n_zones)
    out, i = [], 0
    for z in range(n_zones):
        size = base + (1 if z < extra else 0)
        out.append(list(features[i:i + size]))
        i += size
    return [z for z in out if z]


def zone_features(wide: DataFrame, features: Sequence[str], stats: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Seventeen statistics a zone: of its values, of their presence, and of |robust z| against the fitted statistics
    (one column per statistic).  A zone without values has NULL statistics, counts and rates of 0."""
    med, iqr = _scales(features, stats)
    cut = [len(z) for z in zones(features)]
    counts = ["missing", "observed", "mild_count", "moderate_count", "extreme_count"]
    names = ["mean", "median", "std", "min", "max", "range", "abs_mean", "missing", "missing_rate", "observed", "mean_abs_z",
             "median_abs_z", "max_abs_z", "mild_count", "moderate_count", "extreme_count", "extreme_rate"]

    def describe(v, seen):
        az = np.abs((v - med[:, None]) / iqr[:, None])
        fitted = seen & ~np.isnan(med)[:, None]
        out, start = {}, 0
        for zi, size in enumerate(cut, start=1):
            own = slice(start, start + size)
            start += size
            n, deviation = seen[own].sum(0), _described(az[own], fitted[own])
            mild, moderate, extreme = [(az[own] >= t).sum(0) for t in DEVIATION_LEVELS]
            named = {**_described(v[own], seen[own]), "abs_mean": _described(np.abs(v[own]), seen[own])["mean"],
                     "missing": size - n, "missing_rate": ((size - n) / size, n >= 0), "observed": n,
                     "mean_abs_z": deviation["mean"], "median_abs_z": deviation["median"], "max_abs_z": deviation["max"],
                     "mild_count": mild, "moderate_count": moderate, "extreme_count": extreme,
                     "extreme_rate": (extreme / np.maximum(n, 1), n >= 0)}
            out.update({f"zone{zi}_{name}": x for name, x in named.items()})
        return out

    return _by_row(wide, features, id_col, describe,
                   [(f"zone{zi}_{name}", kind) for zi in range(1, len(cut) + 1) for name, kind in _kinds(names, counts)])


INTERACTIONS = [("anomaly", "quality"), ("anomaly", "completeness"), ("anomaly", "missing_rate"), ("anomaly", "extremes"),
                ("anomaly", "range"), ("anomaly", "std"), ("quality", "extremes"), ("quality", "std"),
                ("completeness", "range"), ("missing_rate", "extremes"), ("extremes", "std"), ("range", "std")]


def interaction_features(base: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Twelve pairwise products of context signals; +-inf -> NULL."""
    def prod(a, b):
        v = F.col(a) * F.col(b)
        return sig(F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(None)).otherwise(v)).alias(f"{a}_x_{b}")

    return base.select(id_col, *[prod(a, b) for a, b in INTERACTIONS])
