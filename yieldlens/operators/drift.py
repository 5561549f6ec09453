"""Feature and output drift between a reference and a current side.

Both sides live in ONE wide frame.  Its values are counted by side in numpy, a
chunk of rows at a time, dealt by range of (feature, value), sorted and stored
once with their running counts inside the task -- the only shuffle over the
values.  What a task needs to know of the tasks before it is a table of one
row for each (task, feature), so every metric is a plain aggregation over the
stored rows:

* totals, extremes and numbers of values from one pass, which also gives the offsets;
* spread, KS (the largest gap between the two running counts) and the
  Wasserstein area from a second one;
* every order statistic (medians, PSI reference edges, quartiles) from the
  rows that cover its rank, looked up in the one task that holds the rank.

No feature is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DriftConfig
from ..functions.columns import finite, to_long
from ..functions.expressions import max_severity, r6, severity, severity_rank, weighted_health
from ..functions.ranking import _partitions
from ..session import cut_lineage

REF, CUR = "reference", "current"
SIDES = ((REF, "ref"), (CUR, "cur"))
CELLS = 1 << 22  # values of a task that are counted at a time
TASK_ROWS = 1 << 22  # counted values, about, that one task sorts


def side_long(df: DataFrame, features: Sequence[str], id_col: str = "record_id", side_col: str = "side") -> DataFrame:
    """(id, side, feature, value) with non-finite values as NULL."""
    src = df.withColumnRenamed(side_col, "side") if side_col != "side" else df
    return to_long(src, [id_col, "side"], features)


def _counted(width: int):
    """Task function over (side code, values of each feature): feature number, value and its counts by side in a chunk of rows.

    The NULL value of each feature carries the missing counts; sides but 0 and 1 count nowhere."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(part):
            side = part.column(0).to_numpy()
            for k in range(width):
                x = part.column(k + 1).to_numpy()
                missing = np.isnan(x)
                lost = np.bincount(side[missing], minlength=3)
                own = ~missing & (side < 2)
                x, s = x[own] + 0.0, side[own]
                order = np.argsort(x)
                x, s = x[order], s[order].astype(np.int64)
                first = np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])
                cur = np.add.reduceat(s, first) if len(first) else s
                both = np.diff(np.append(first, len(x)))
                cells = [np.append(x[first], 0.0), np.append(both - cur, lost[0]), np.append(cur, lost[1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first) + 1, k, np.int32)), pa.array(cells[0], mask=np.arange(len(first) + 1) == len(first)),
                     pa.array(cells[1], pa.int64()), pa.array(cells[2], pa.int64())], names=["_f", "value", "c_ref", "c_cur"])

        held, rows, most = [], 0, max(1, CELLS // max(width, 1))
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from out(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from out(pa.Table.from_batches(held))

    return run


def _running(batches):
    """Task function over rows sorted by (feature number, value): equal values become one row, with running counts by side
    since the feature's first row in the task.  The NULL row takes no part in them."""
    import numpy as np
    import pyarrow as pa

    names = ["_f", "value", "c_ref", "c_cur", "l_ref", "l_cur", "_pid"]
    at, ran = -1, [0, 0]  # feature of the last row given out and its running counts
    held = None

    def merged(cols, last):
        nonlocal at, ran, held
        f, x, null, ref, cur, pid = cols
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (null[1:] != null[:-1]) | (~null[1:] & (x[1:] != x[:-1]))
        first = np.flatnonzero(new)
        f, x, null, pid = f[first], x[first], null[first], pid[first]
        ref, cur = np.add.reduceat(ref, first), np.add.reduceat(cur, first)
        if not last:  # the last value may go on in the next batch
            held = [c[-1:] for c in (f, x, null, ref, cur, pid)]
            f, x, null, ref, cur, pid = (c[:-1] for c in (f, x, null, ref, cur, pid))
        if not len(f):
            return None
        start = np.maximum.accumulate(np.where(np.append(True, f[1:] != f[:-1]), np.arange(len(f)), 0))
        sums = []
        for k, c in enumerate((ref, cur)):
            counts = np.where(null, 0, c)
            total = np.cumsum(counts)
            sums.append(total - (total - counts)[start] + np.where(f == at, ran[k], 0))
        at, ran = f[-1], [sums[0][-1], sums[1][-1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(f), pa.array(x, mask=null), pa.array(ref), pa.array(cur), pa.array(sums[0]), pa.array(sums[1]), pa.array(pid)],
            names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        value = batch.column(1)
        cols = [batch.column(0).to_numpy(), value.to_numpy(zero_copy_only=False), value.is_null().to_numpy(zero_copy_only=False),
                batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4).to_numpy()]
        if held is not None:
            cols = [np.concatenate(c) for c in zip(held, cols)]
        rows = merged(cols, False)
        if rows is not None:
            yield rows
    if held is not None:
        yield merged(held, True)


class DriftBase:
    """Shared intermediate frames of one drift run."""

    def __init__(self, df: DataFrame, features: Sequence[str], eps: float = 1e-8, id_col: str = "record_id",
                 side_col: str = "side"):
        self.eps = eps
        self.names = F.array(*[F.lit(f) for f in features])
        side = F.coalesce(F.when(F.col(side_col) == REF, 0).when(F.col(side_col) == CUR, 1), F.lit(2))
        cells = df.select(side.cast("int").alias("_side"), *[finite(f).alias(f"_v{k}") for k, f in enumerate(features)])
        # stored, as the range partitioner reads it twice
        counted = cut_lineage(cells.mapInArrow(_counted(len(features)), "_f int, value double, c_ref long, c_cur long"))
        dealt = counted.repartitionByRange(max(_partitions(df, None), -(-counted.count() // TASK_ROWS)), "_f", "value")
        dealt = dealt.withColumn("_pid", F.spark_partition_id()).sortWithinPartitions("_f", "value")
        # the range bounds come from a sample: partition numbers and running counts are stored together, every reader sees the same
        self.stored = cut_lineage(dealt.mapInArrow(
            _running, "_f int, value double, c_ref long, c_cur long, l_ref long, l_cur long, _pid int"))
        self.values = self.stored.where(F.col("value").isNotNull())
        self.pieces = cut_lineage(self._pieces())
        self._stats = None
        self._order = None

    def _pieces(self) -> DataFrame:
        """One row for each (task, feature): counts before it (o_), in it (t_) and of the whole feature (tot_), and the
        feature's rows, extremes and numbers of values."""
        value, there = F.col("value"), F.col("value").isNotNull()
        aggs, w = [], Window.partitionBy("_f")
        for _, s in SIDES:
            c = F.col(f"c_{s}")
            aggs += [
                F.sum(c).alias(f"rows_{s}"), F.max(f"l_{s}").alias(f"t_{s}"), F.sum(c * value).alias(f"sv_{s}"),
                F.sum(c * F.abs(value)).alias(f"sa_{s}"), F.count(F.when(there & (c > 0), 1)).alias(f"distinct_{s}"),
                F.min(F.when(c > 0, value)).alias(f"min_{s}"), F.max(F.when(c > 0, value)).alias(f"max_{s}"),
            ]
        before = w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        cols = ["_pid", "_f"]
        for _, s in SIDES:
            cols += [F.col(f"t_{s}"), F.coalesce(F.sum(f"t_{s}").over(before), F.lit(0)).alias(f"o_{s}"),
                     F.sum(f"t_{s}").over(w).alias(f"tot_c_{s}")]
            cols += [F.sum(f"{c}_{s}").over(w).alias(n) for c, n in (
                ("sv", f"tot_sv_{s}"), ("sa", f"tot_sa_{s}"), ("rows", f"rows_{s}"), ("distinct", f"distinct_{s}"))]
            cols += [F.min(f"min_{s}").over(w).alias(f"min_{s}"), F.max(f"max_{s}").over(w).alias(f"max_{s}")]
        return self.stored.groupBy("_pid", "_f").agg(*aggs).select(*cols)

    def named(self) -> Column:
        return F.element_at(self.names, F.col("_f") + 1).alias("feature")

    def _joined(self) -> DataFrame:
        """The stored values with the running counts (cum_c_) and the totals of their feature."""
        tot = [f"tot_{c}_{s}" for c in ("c", "sv", "sa") for _, s in SIDES]
        offsets = F.broadcast(self.pieces.select("_pid", "_f", "o_ref", "o_cur", *tot))  # tasks + features rows
        return self.values.join(offsets, ["_pid", "_f"]).select(
            "_f", "value", "c_ref", "c_cur", (F.col("o_ref") + F.col("l_ref")).alias("cum_c_ref"),
            (F.col("o_cur") + F.col("l_cur")).alias("cum_c_cur"), *tot)

    @property
    def cum(self) -> DataFrame:
        """(feature, value, c_, cum_c_, tot_) by side: running counts in value order, side totals and value sums."""
        j = self._joined()
        return j.select(self.named(), *j.columns[1:])

    @property
    def whole(self) -> DataFrame:
        """One row a feature: totals, rows, extremes and numbers of values by side."""
        cols = [f"{c}_{s}" for c in ("tot_c", "tot_sv", "tot_sa", "rows", "distinct", "min", "max") for _, s in SIDES]
        return self.pieces.groupBy("_f").agg(*[F.first(c).alias(c) for c in cols])

    # -- one pass of aggregates over the stored values ----------------------
    @property
    def stats(self) -> DataFrame:
        if self._stats is None:
            share = lambda n, s: n / F.nullif(F.col(f"tot_c_{s}"), F.lit(0))
            cum = lambda s: share(F.col(f"cum_c_{s}"), s)
            past = lambda s: share(F.col(f"cum_c_{s}") - F.col(f"c_{s}"), s)
            mean = {s: share(F.col(f"tot_sv_{s}"), s) for _, s in SIDES}
            gap, before = F.abs(cum("ref") - cum("cur")), F.abs(past("ref") - past("cur"))
            aggs = [F.max(gap).alias("ks_d"), F.sum((F.col("value") - mean["ref"]) * (before - gap)).alias("area")]
            aggs += [F.sum(F.col(f"c_{s}") * F.pow(F.col("value") - mean[s], 2)).alias(f"ss_{s}") for _, s in SIDES]
            passed = self._joined().groupBy("_f").agg(*aggs)
            cols = [self.named(), "rows_ref", "rows_cur", "ks_d", "area"]
            for _, s in SIDES:
                n = F.coalesce(F.col(f"tot_c_{s}"), F.lit(0))
                cols += [
                    n.alias(f"n_{s}"),
                    F.when(n > 0, mean[s]).alias(f"mean_{s}"),
                    F.when(n > 0, share(F.col(f"tot_sa_{s}"), s)).alias(f"mean_abs_{s}"),
                    F.coalesce(F.col(f"distinct_{s}"), F.lit(0)).alias(f"distinct_{s}"),
                    F.when(n > 1, F.col(f"ss_{s}")).alias(f"ss_{s}"),
                    F.when(n > 1, F.sqrt(F.col(f"ss_{s}") / (n - 1))).alias(f"std_{s}"),
                    F.col(f"min_{s}"), F.col(f"max_{s}"),
                    F.when(F.col(f"rows_{s}") > 0, 1 - n / F.col(f"rows_{s}")).alias(f"missing_rate_{s}"),
                    F.when(n == 0, False).when(n == 1, True)
                    .otherwise(F.abs(F.col(f"max_{s}") - F.col(f"min_{s}")) <= self.eps).alias(f"constant_{s}"),
                ]
            # one row a feature, read by every metric
            self._stats = cut_lineage(self.whole.join(passed, "_f", "left").select(*cols))
        return self._stats

    # -- every order statistic in one pass -----------------------------------
    def order_stats(self, bins: int = 10, extra_probs: Sequence[float] = (0.25, 0.75)) -> DataFrame:
        """(feature, side, kind, j, quantile): kind 0 = median, 1 = PSI reference edge j/bins,
        3 = extra_probs[j] (quartiles by default)."""
        if self._order is not None:
            return self._order
        items = [(0, 0, 0.5)] + [(3, j, float(p)) for j, p in enumerate(extra_probs)]
        edges = [(1, j, j / bins) for j in range(bins + 1)]
        wanted = None
        for side, s in SIDES:
            grid = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(j).alias("j"), F.lit(p).alias("p"))
                             for k, j, p in items + (edges if side == REF else [])])
            part = self.pieces.where(F.col(f"t_{s}") > 0).select(
                "_pid", "_f", F.lit(side).alias("side"), F.explode(grid).alias("g"), F.col(f"o_{s}").alias("_o"),
                F.col(f"t_{s}").alias("_t"), (F.col(f"tot_c_{s}") - 1).alias("_n1"))
            wanted = part if wanted is None else wanted.unionByName(part)
        h = F.col("_n1") * F.col("g.p")
        ends = F.array(F.struct(F.lit(False).alias("up"), F.floor(h).alias("at")), F.struct(F.lit(True).alias("up"), F.ceil(h).alias("at")))
        wanted = wanted.select("*", h.alias("_h"), F.explode(ends).alias("e")).select(
            "_pid", "_f", "side", "g.kind", "g.j", "_h", "e.up", (F.col("e.at") - F.col("_o")).alias("_at"), "_t")
        wanted = F.broadcast(wanted.where((F.col("_at") >= 0) & (F.col("_at") < F.col("_t"))))  # features x ranks rows
        end = F.when(F.col("side") == REF, F.col("l_ref")).otherwise(F.col("l_cur"))
        own = F.when(F.col("side") == REF, F.col("c_ref")).otherwise(F.col("c_cur"))
        claims = self.values.join(wanted, ["_pid", "_f"]).where((F.col("_at") < end) & (F.col("_at") >= end - own))
        agg = claims.groupBy("_f", "side", "kind", "j").agg(
            F.first("_h").alias("_h"), F.max(F.when(~F.col("up"), F.col("value"))).alias("_vlo"),
            F.max(F.when(F.col("up"), F.col("value"))).alias("_vhi"))
        frac = F.col("_h") - F.floor(F.col("_h"))
        order = agg.select(
            self.named(), "side", "kind", "j",
            F.when(frac == 0, F.col("_vlo")).otherwise(F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias(
                "quantile"
            ),
        )
        # small (features x claimed points) and read by medians and PSI edges: claim once
        self._order = cut_lineage(order)
        return self._order


def medians(b: DriftBase, bins: int = 10) -> DataFrame:
    o = b.order_stats(bins).where(F.col("kind") == 0)
    return o.groupBy("feature").agg(
        F.max(F.when(F.col("side") == REF, F.col("quantile"))).alias("median_ref"),
        F.max(F.when(F.col("side") == CUR, F.col("quantile"))).alias("median_cur"),
    )


def psi(b: DriftBase, bins: int = 10) -> DataFrame:
    """Population stability index per feature: reference-quantile edges (unique, open ends), left-closed
    bins, proportions clipped at eps and renormalised; NULL when a side has no finite values."""
    eps = b.eps
    qs = b.order_stats(bins).where((F.col("kind") == 1) & (F.col("side") == REF))
    edges = qs.groupBy("feature").agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("edges"))
    st = b.stats.select("feature", "n_ref", "n_cur", "min_ref", "max_ref")
    e = st.join(edges, "feature", "left")
    constant = (F.col("n_ref") == 0) | (F.abs(F.col("max_ref") - F.col("min_ref")) <= eps) | F.col(
        "edges"
    ).isNull() | (F.size("edges") < 2)
    inner = F.when(constant, F.array().cast("array<double>")).otherwise(
        F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    )
    ed = F.broadcast(e.select("feature", "n_ref", "n_cur", inner.alias("inner_edges")))  # one row per feature
    numbered = b.whole.select("_f", b.named()).join(ed, "feature").select(
        "_f", *[F.get("inner_edges", F.lit(i)).alias(f"_e{i}") for i in range(bins - 1)])
    place = F.lit(0)
    for i in range(bins - 1):
        place = place + F.when(F.col("value") >= F.col(f"_e{i}"), 1).otherwise(0)
    binned = (
        b.values.join(F.broadcast(numbered), "_f")
        .groupBy("_f", place.alias("bin"))
        .agg(F.sum("c_ref").alias("cnt_ref"), F.sum("c_cur").alias("cnt_cur"))
        .select(b.named(), "bin", "cnt_ref", "cnt_cur")
    )
    domain = ed.select("feature", F.explode(F.sequence(F.lit(0), F.size("inner_edges"))).alias("bin"))
    full = domain.join(binned, ["feature", "bin"], "left").fillna(0, ["cnt_ref", "cnt_cur"])
    w = Window.partitionBy("feature")  # at most `bins` rows per feature
    props = {}
    for s in ("ref", "cur"):
        tot = F.sum(f"cnt_{s}").over(w)
        p = F.when(tot > 0, F.col(f"cnt_{s}") / tot).otherwise(1.0 / F.count(F.lit(1)).over(w))
        props[s] = F.greatest(p, F.lit(eps))
    clipped = full.select("feature", props["ref"].alias("pr"), props["cur"].alias("pc"))
    normed = clipped.select(
        "feature", (F.col("pr") / F.sum("pr").over(w)).alias("pr"), (F.col("pc") / F.sum("pc").over(w)).alias("pc")
    )
    out = normed.groupBy("feature").agg(
        F.sum((F.col("pc") - F.col("pr")) * F.log(F.col("pc") / F.col("pr"))).alias("psi_raw")
    )
    return ed.join(out, "feature", "left").select(
        "feature",
        F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.greatest(F.col("psi_raw"), F.lit(0.0))).alias("psi"),
    )


def ks_p_value(n_ref: Column, n_cur: Column, d: Column) -> Column:
    """Asymptotic two-sided p-value: 2 sum_{k=1..100} (-1)^(k-1) exp(-2 k^2 s^2), s = (sqrt(ne)+.12+.11/sqrt(ne)) d."""
    ne = n_ref * n_cur / (n_ref + n_cur)
    scaled = (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(ne)) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0).cast("double"),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    return F.when(scaled <= 0, 1.0).otherwise(F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(b: DriftBase) -> DataFrame:
    """Two-sample KS statistic (sup |F_ref - F_cur| over the pooled points) and p-value."""
    st = b.stats
    ok = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return st.select(
        "feature",
        F.when(ok, F.col("ks_d")).alias("ks_statistic"),
        F.when(ok, ks_p_value(F.col("n_ref"), F.col("n_cur"), F.col("ks_d"))).alias("ks_p_value"),
    )


def wasserstein(b: DriftBase, bins: int = 10) -> DataFrame:
    """Exact first Wasserstein distance: the area between the two distribution functions (summed in the pass of ``stats``).

    The sum of |F_ref - F_cur| times the step to the next value is summed by parts, so each value needs only the running
    counts before and at itself: no neighbour, no order within a task and no grid of points.  The steps' weights add up to
    nothing, so values are taken from the reference mean: digits stay where all values are far from 0."""
    ok = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return b.stats.select("feature", F.when(ok, F.greatest("area", F.lit(0.0))).alias("wasserstein_distance"))


def _notes(c: dict[str, Column]) -> Column:
    parts = [
        F.when(c["ref_n"] == 0, F.lit("reference side has no finite values")),
        F.when(c["cur_n"] == 0, F.lit("current side has no finite values")),
        F.when(c["ref_const"], F.lit("constant on reference side")),
        F.when(c["cur_const"], F.lit("constant on current side")),
        F.when(c["ref_const"] & ~c["cur_const"], F.lit("started to vary")),
        F.when(~c["ref_const"] & c["cur_const"], F.lit("stopped varying")),
        F.when(c["shift"].isNull() & (c["ref_n"] > 0) & (c["cur_n"] > 0),
               F.lit("mean shift undefined: reference spread too small")),
        F.when(c["psi"].isNull(), F.lit("psi undefined")),
        F.when(c["miss_delta"] > 0, F.lit("more missing values on current side")),
    ]
    joined = F.concat_ws("; ", *parts)
    return F.when(joined == "", F.lit("none")).otherwise(joined)


def standardised_shift(ref_mean: Column, cur_mean: Column, ref_std: Column, eps: float) -> Column:
    shift = F.abs(cur_mean - ref_mean)
    return (
        F.when(ref_mean.isNull() | cur_mean.isNull(), F.lit(None).cast("double"))
        .when(ref_std.isNull() | (ref_std < eps), F.when(shift < eps, F.lit(0.0)))
        .otherwise(shift / ref_std)
    )


def safe_ratio(num: Column, den: Column, eps: float) -> Column:
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(F.abs(den) < eps, F.when(F.abs(num) < eps, F.lit(1.0)))
        .otherwise(num / den)
    )


def feature_drift(
    df: DataFrame,
    features: Sequence[str],
    cfg: DriftConfig | None = None,
    id_col: str = "record_id",
    side_col: str = "side",
    base: DriftBase | None = None,
) -> DataFrame:
    """Per shared feature: all drift metrics, six severities, weighted health and a monitoring rank."""
    cfg = cfg or DriftConfig()
    eps = cfg.epsilon
    b = base or DriftBase(df, features, eps, id_col, side_col)
    t = (
        b.stats.join(medians(b, cfg.number_of_bins), "feature", "left")
        .join(psi(b, cfg.number_of_bins), "feature", "left")
        .join(ks_two_sample(b), "feature", "left")
        .join(wasserstein(b, cfg.number_of_bins), "feature", "left")
    )
    ref_n, cur_n = F.col("n_ref"), F.col("n_cur")
    ref_mean, cur_mean, ref_std, cur_std = F.col("mean_ref"), F.col("mean_cur"), F.col("std_ref"), F.col("std_cur")
    abs_shift = F.abs(cur_mean - ref_mean)
    std_shift = standardised_shift(ref_mean, cur_mean, ref_std, eps)
    std_ratio = safe_ratio(cur_std, ref_std, eps)
    miss_delta_signed = F.col("missing_rate_cur") - F.col("missing_rate_ref")
    miss_delta = F.abs(miss_delta_signed)
    ref_const = F.coalesce("constant_ref", F.lit(False))
    cur_const = F.coalesce("constant_cur", F.lit(False))
    th = cfg.feature_thresholds
    sev = {
        "psi": severity(F.col("psi"), th["psi"]),
        "ks_statistic": severity(F.col("ks_statistic"), th["ks_statistic"]),
        "standardised_mean_shift": severity(std_shift, th["standardised_mean_shift"]),
        "missing_rate_difference": severity(miss_delta, th["missing_rate_difference"]),
        "constant_sensor_change": F.when(~ref_const & cur_const & (cur_n > 1), "Critical")
        .when(ref_const != cur_const, "Warning")
        .otherwise("Normal"),
        "measurement_availability": F.when((ref_n == 0) | (cur_n == 0), "Critical").otherwise("Normal"),
    }
    overall = max_severity(*sev.values())
    health = weighted_health(sev, cfg.feature_weights)
    notes = _notes(
        {
            "ref_n": ref_n, "cur_n": cur_n, "ref_const": ref_const, "cur_const": cur_const,
            "shift": std_shift, "psi": F.col("psi"), "miss_delta": miss_delta_signed,
        }
    )
    out = t.select(
        "feature",
        ref_n.cast("bigint").alias("reference_count"),
        cur_n.cast("bigint").alias("current_count"),
        r6(F.col("missing_rate_ref")).alias("reference_missing_rate"),
        r6(F.col("missing_rate_cur")).alias("current_missing_rate"),
        r6(miss_delta).alias("missing_rate_difference"),
        r6(ref_mean).alias("reference_mean"),
        r6(cur_mean).alias("current_mean"),
        r6(abs_shift).alias("absolute_mean_shift"),
        r6(std_shift).alias("standardised_mean_shift"),
        r6(ref_std).alias("reference_std"),
        r6(cur_std).alias("current_std"),
        r6(std_ratio).alias("standard_deviation_ratio"),
        r6(F.col("median_ref")).alias("reference_median"),
        r6(F.col("median_cur")).alias("current_median"),
        r6(F.abs(F.col("median_cur") - F.col("median_ref"))).alias("absolute_median_shift"),
        r6(F.col("psi")).alias("psi"),
        r6(F.col("ks_statistic")).alias("ks_statistic"),
        r6(F.col("ks_p_value")).alias("ks_p_value"),
        r6(F.col("wasserstein_distance")).alias("wasserstein_distance"),
        ref_const.alias("reference_constant"),
        cur_const.alias("current_constant"),
        *[v.alias(f"{k}_severity") for k, v in sev.items()],
        overall.alias("overall_severity"),
        health.alias("feature_health_score"),
        (overall != "Normal").alias("drift_detected"),
        notes.alias("notes"),
    ).withColumn("severity_rank", severity_rank(F.col("overall_severity")))
    # ranking a table with one row per feature: bounded by the schema, a single small task is fine
    order = Window.orderBy(
        F.desc("severity_rank"), F.asc("feature_health_score"), F.desc_nulls_last("psi"),
        F.desc_nulls_last("ks_statistic"), F.asc("feature"),
    )
    return out.withColumn("monitoring_rank", F.row_number().over(order))


SEVERITY_NAMES = ("Normal", "Watch", "Warning", "Critical")


def dominant(rank_col: Column) -> Column:
    return F.coalesce(F.element_at(F.array(*[F.lit(s) for s in SEVERITY_NAMES]), (rank_col + 1).cast("int")),
                      F.lit("Normal"))


def feature_drift_summary(drift: DataFrame) -> DataFrame:
    """Counts by severity, drift rate, mean health and maxima (one row)."""
    sev = F.col("overall_severity")
    n = F.count(F.lit(1))
    drifted = F.count(F.when(sev != "Normal", 1))
    return drift.agg(
        n.alias("monitored_features"),
        F.count(F.when(sev == "Normal", 1)).alias("normal_features"),
        F.count(F.when(sev == "Watch", 1)).alias("watch_features"),
        F.count(F.when(sev == "Warning", 1)).alias("warning_features"),
        F.count(F.when(sev == "Critical", 1)).alias("critical_features"),
        drifted.alias("drifted_features"),
        r6(F.when(n > 0, drifted / n).otherwise(0.0)).alias("drift_rate"),
        F.round(F.coalesce(F.avg("feature_health_score"), F.lit(100.0)), 2).alias("mean_feature_health_score"),
        F.max("psi").alias("maximum_psi"),
        F.max("ks_statistic").alias("maximum_ks_statistic"),
        F.max("standardised_mean_shift").alias("maximum_standardised_mean_shift"),
        F.max("missing_rate_difference").alias("maximum_missing_rate_difference"),
        dominant(F.max("severity_rank")).alias("dominant_severity"),
    )
