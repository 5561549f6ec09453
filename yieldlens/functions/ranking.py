"""Distributed exact ranks, prefix sums and quantiles.

A plain ``Window.orderBy`` (or a window partitioned only by a low-cardinality
key such as ``feature`` or ``target``) sends every row of a group to one task.
At cluster scale one group may hold a third of all rows, so the helpers here
never do that:

* ``cumulative`` range-partitions rows on (keys, order) so a hot key is spread
  over many tasks, sums each partition per key (a table of at most
  ``partitions + #keys`` rows), turns those sums into per-partition offsets
  and adds them to a running sum computed inside each partition.
* ``exact_quantiles`` first collapses values to distinct (key, value, count)
  rows (map-side combine), runs ``cumulative`` over them and lets each value
  row claim the order-statistic positions it covers, so no group is ever
  gathered in one place.  Interpolation is linear, like ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .columns import finite

#: Ranks of a quantile sketch are off by at most 1 / ACCURACY of its rows; a longer table is sketched from about SKETCHED of them.
ACCURACY = 2000
SKETCHED = 200_000


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of ``cols`` (a NULL key is a key like any other)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def _ranged(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """Rows dealt by range of (keys, order) with their partition number ``_pid``, stored once.

    The range bounds come from a sample, so only stored partition numbers agree between readers and retries."""
    return cut_lineage(
        df.repartitionByRange(n, *[F.col(k) for k in keys], *[F.col(o) for o in order])
        .withColumn("_pid", F.spark_partition_id())
    )


def cumulative(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    *,
    partitions: int | None = None,
    bounded_keys: bool = False,
    prefix: str = "cum_",
    with_totals: bool = False,
    totals_only: Sequence[str] = (),
    materialize: bool = False,
) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``order`` within ``keys``.

    ``order`` must be unique within ``keys`` (aggregate to distinct values
    first).  Rows are range-partitioned on (keys, order) -- a hot key spreads
    over many tasks -- and written once to the shared checkpoint folder with
    their partition number; a window inside (partition, keys) gives local
    running sums (exact for longs).  Because the partition id is then stored
    data, the per-(partition, key) totals (at most ``partitions + #keys``
    rows) and the offsets derived from them agree with the rows in every
    reader and in every retried task.  ``bounded_keys`` says the number of
    keys is small (features, models, classes), so that offset table is
    broadcast; by default the join is left to the optimizer, which knows the
    table's size at run time.  ``with_totals`` adds the group totals ``tot_<c>``;
    ``totals_only`` columns get a group total but no running sum.
    """
    keys = list(keys)
    order = list(order)
    sums = list(sums)
    stored = _ranged(df, keys, order, _partitions(df, partitions))
    inside = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = stored.select("*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in sums])
    all_sums = sums + [c for c in totals_only if c not in sums]
    totals = stored.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in all_sums])
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        "_pid", *keys,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(whole).alias(f"tot_{c}") for c in all_sums],
    )
    if bounded_keys:
        offsets = F.broadcast(offsets)
    joined = local.join(offsets, _same(local, offsets, ["_pid", *keys]), "inner")
    joined = joined.select(*[local[c] for c in local.columns], *[offsets[c] for c in offsets.columns
                                                                 if c != "_pid" and c not in keys])
    tot_cols = list(sums) if with_totals else []
    tot_cols += [c for c in totals_only if c not in tot_cols]
    out = joined.select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"{prefix}{c}") for c in sums],
        *[F.col(f"tot_{c}") for c in tot_cols],
    )
    return cut_lineage(out) if materialize else out


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct non-null (keys, value) with multiplicity ``_c`` (partial aggregation before the shuffle)."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))


def positioned(df: DataFrame, keys: Sequence[str], value: str, *, partitions: int | None = None,
               bounded_keys: bool = False) -> DataFrame:
    """Distinct values with their 0-based order-statistic span [_start, _end] and group size _n."""
    keys = list(keys)
    vc = value_counts(df, keys, value)
    cum = cumulative(vc, keys, [value], ["_c"], partitions=partitions, bounded_keys=bounded_keys, with_totals=True)
    cum = cum.withColumnRenamed("tot__c", "_n")
    return cum.select(
        *keys, value, "_c", "_n",
        (F.col("cum__c") - F.col("_c")).alias("_start"),
        (F.col("cum__c") - 1).alias("_end"),
    )


def _claim(pos: DataFrame, keys: Sequence[str], value: str, grid: Column) -> DataFrame:
    """Each value row claims the grid positions (j, h) whose floor or ceil falls in its span."""
    claims = pos.select(
        *keys, value, "_start", "_end",
        F.explode(
            F.filter(
                grid,
                lambda s: ((F.floor(s["h"]) >= F.col("_start")) & (F.floor(s["h"]) <= F.col("_end")))
                | ((F.ceil(s["h"]) >= F.col("_start")) & (F.ceil(s["h"]) <= F.col("_end"))),
            )
        ).alias("g"),
    )
    lo_in = (F.floor(F.col("g.h")) >= F.col("_start")) & (F.floor(F.col("g.h")) <= F.col("_end"))
    hi_in = (F.ceil(F.col("g.h")) >= F.col("_start")) & (F.ceil(F.col("g.h")) <= F.col("_end"))
    agg = claims.groupBy(*keys, F.col("g.j").alias("j")).agg(
        F.first("g.p").alias("prob"),
        F.first("g.h").alias("_h"),
        F.max(F.when(lo_in, F.col(value))).alias("_vlo"),
        F.max(F.when(hi_in, F.col(value))).alias("_vhi"),
    )
    frac = F.col("_h") - F.floor(F.col("_h"))
    return agg.select(
        *keys, "j", "prob",
        F.when(frac == 0, F.col("_vlo")).otherwise(F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias(
            "quantile"
        ),
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    partitions: int | None = None,
    bounded_keys: bool = False,
) -> DataFrame:
    """Exact linear-interpolated quantiles per key: columns keys..., j, prob, quantile."""
    keys = list(keys)
    pos = positioned(df, keys, value, partitions=partitions, bounded_keys=bounded_keys)
    grid = F.transform(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda p, j: F.struct(j.alias("j"), p.alias("p"), ((F.col("_n") - 1) * p).alias("h")),
    )
    return _claim(pos, keys, value, grid)


def _between(spans: dict):
    """Task function over batches of the columns: for each (column, j) and its span (low, high) the different values between
    with their counts, and at the end the number of all values and of those below."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def rows(found):
            names, types = ["feature", "j", "value", "_c", "_n", "_below"], [pa.string(), pa.int32(), pa.float64(), *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), types)], names=names)

        totals = {k: [0, 0] for k in spans}
        for batch in batches:
            found, values = [], {}
            for (c, j), (lo, hi) in spans.items():
                if c not in values:
                    x = batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    values[c] = x[np.isfinite(x)]
                x = values[c]
                inside = (x >= lo) & (x <= hi)
                totals[c, j][0] += len(x)
                totals[c, j][1] += int((x < lo).sum())
                found += [(c, j, v, n, 0, 0) for v, n in zip(*[y.tolist() for y in np.unique(x[inside], return_counts=True)])]
            if found:
                yield rows(found)
        if totals:
            yield rows([(c, j, None, 0, n, below) for (c, j), (n, below) in totals.items()])

    return run


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """What ``exact_quantiles`` gives for the long form (feature, value) of a wide table: feature, j, prob, quantile.

    A sketch of the table (of about SKETCHED of its rows, if it has more) says between which two values a quantile lies.
    All rows are then counted below these, and the different values between are ranked, about one in a hundred; nothing
    else is dealt out.  The counts show whether the wanted ranks do lie between; if one does not, all values are ranked.
    ``df`` is read three times, so it should be stored."""
    columns, probs = list(columns), [float(p) for p in probs]
    few = min(1.0, SKETCHED / max(df.count(), 1))
    d = 2.0 / ACCURACY + (2.0 / math.sqrt(SKETCHED) if few < 1.0 else 0.0)
    at = [min(max(p + x, 0.0), 1.0) for p in probs for x in (-d, d)]
    some = df.sample(few, 42) if few < 1.0 else df
    near = some.agg(*[F.percentile_approx(finite(c), at, ACCURACY).alias(c) for c in columns]).first()
    spans = {(c, j): tuple(near[c][2 * j:2 * j + 2]) if near[c] is not None else (0.0, 0.0) for c in columns for j in range(len(probs))}
    parts = cut_lineage(df.select(*[finite(c).alias(c) for c in columns]).mapInArrow(
        _between(spans), "feature string, j int, value double, _c long, _n long, _below long"))
    totals = parts.groupBy("feature", "j").agg(*[F.sum(c).alias(c) for c in ("_n", "_below", "_c")]).collect()
    base = [(r["feature"], r["j"], probs[r["j"]], r["_n"], r["_below"]) for r in totals if r["_n"]]
    for r in totals:
        h = (r["_n"] - 1) * probs[r["j"]]
        if r["_n"] and not r["_below"] <= math.floor(h) <= math.ceil(h) < r["_below"] + r["_c"]:
            long = df.select(*[finite(c).alias(c) for c in columns]).unpivot([], columns, "feature", "value")
            return exact_quantiles(long, ["feature"], "value", probs)
    met = parts.where("value is not null").groupBy("feature", "j", "value").agg(F.sum("_c").alias("_c"))
    cum = cumulative(met, ["feature", "j"], ["value"], ["_c"], bounded_keys=True)
    base = df.sparkSession.createDataFrame(base, "feature string, j int, _p double, _n long, _below long")
    pos = cum.join(F.broadcast(base), ["feature", "j"]).select(
        "feature", "j", "value", "_p", "_n", (F.col("_below") + F.col("cum__c") - F.col("_c")).alias("_start"),
        (F.col("_below") + F.col("cum__c") - 1).alias("_end"))
    grid = F.array(F.struct(F.col("j"), F.col("_p").alias("p"), ((F.col("_n") - 1) * F.col("_p")).alias("h")))
    return _claim(pos, ["feature"], "value", grid)


def average_rank(df: DataFrame, keys: Sequence[str], value: str, *, partitions: int | None = None,
                 bounded_keys: bool = False) -> DataFrame:
    """Tie-averaged 1-based rank of every distinct value within keys: keys..., value, _c, _n, avg_rank."""
    pos = positioned(df, keys, value, partitions=partitions, bounded_keys=bounded_keys)
    return pos.select(
        *keys, value, "_c", "_n", ((F.col("_start") + F.col("_end")) / 2 + 1).alias("avg_rank")
    )


def previous_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], *,
                      partitions: int | None = None) -> DataFrame:
    """``lag`` of ``cols`` within ``keys`` in ``order`` without gathering a key into one task.

    Rows are range-partitioned on (keys, order) and written once to the shared checkpoint folder; a window inside
    (partition, keys) gives the local lag.  A key's first row in a partition takes its previous values
    from the last row of that key in the nearest earlier partition: a table of one row per (partition, key),
    lagged over partitions and joined back by shuffle (it grows with the number of keys, so it is not
    broadcast)."""
    keys, order, cols = list(keys), list(order), list(cols)
    stored = _ranged(df, keys, order, _partitions(df, partitions))
    inside = Window.partitionBy("_pid", *keys).orderBy(*order)
    local = stored.select("*", *[F.lag(c).over(inside).alias(f"_lag_{c}") for c in cols],
                          (F.row_number().over(inside) == 1).alias("_first"))
    last = stored.groupBy("_pid", *keys).agg(F.max(F.struct(*[F.col(o) for o in order], *[F.col(c).alias(f"_v_{c}")
                                                                                           for c in cols])).alias("_last"))
    w = Window.partitionBy(*keys).orderBy("_pid")  # one row per partition a key spans
    carry = last.select("_pid", *keys, *[F.lag(F.col(f"_last._v_{c}")).over(w).alias(f"_carry_{c}") for c in cols])
    j = local.join(carry, _same(local, carry, ["_pid", *keys]), "left")
    return j.select(*[local[c] for c in df.columns],
                    *[F.when(F.col("_first"), F.col(f"_carry_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
                      for c in cols])
