"""Investigation priority: which sensors to look at first for each record.

Per record, four signals are turned into within-record percentile ranks
(average ties; NULL -> 0; all equal -> 0.5) and averaged.  Rows are dealt by
record and sorted once, in a number of tasks that grows with the rows; numpy
ranks all records of a batch together.  Reference medians/IQR come from the
distributed quantile helper.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import r6
from ..functions.ranking import column_quantiles

TOP_K = 10
LEVELS = [(0.80, "Very High"), (0.65, "High")]
MODERATE = 0.45
DEVIATION = [(3.0, "Extreme Deviation"), (1.5, "Moderate Deviation"), (1.0, "Mild Deviation")]
ROLLUP_TOP = 30
ROWS_IN_TASK = 2_000_000
ROWS_IN_BATCH = 10_000


def _average_ranks(group: np.ndarray, v: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Average-tie rank / n within groups, numbered in ascending order; a constant group gives 0.5."""
    order = np.lexsort((v, group))
    g, x = group[order], v[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | ~((x[1:] == x[:-1]) | (np.isnan(x[1:]) & np.isnan(x[:-1])))
    start = np.nonzero(new)[0]
    ties = np.diff(np.append(start, len(g)))
    rank = start - (np.cumsum(size) - size)[g[start]] + 1 + (ties - 1) / 2.0
    n = size[g[start]]
    out = np.empty(len(g))
    out[order] = np.repeat(np.where(ties == n, 0.5, rank / n), ties)
    return out


def _ranked(ids: int, signals: int, label: int | None, top: int | None):
    """Task function over rows sorted by the column ``ids``: appends the percentile rank of each of the last ``signals`` columns
    in its group.  With ``label`` appends their mean and the row's place by it (ties by the label), up to place ``top``.

    Whole groups of a batch are ranked together; the rows of a batch's last group wait for the next batch."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def codes(column):
            at = column.dictionary_encode()
            at = at.combine_chunks() if isinstance(at, pa.ChunkedArray) else at
            return at.indices.fill_null(-1).to_numpy(zero_copy_only=False), at.dictionary

        def done(parts):
            t = pa.Table.from_batches(parts).combine_chunks()
            own, _ = codes(t.column(ids))
            group = np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
            size = np.bincount(group)
            ranks = [_average_ranks(group, t.column(t.num_columns - signals + i).to_numpy(), size) for i in range(signals)]
            arrays, names = list(t.columns), list(t.column_names)
            keep = None
            if label is not None:
                score = sum(ranks[1:], ranks[0]) / float(signals)
                at, words = codes(t.column(label))
                by_word = np.empty(len(words) + 1, np.int64)
                by_word[np.asarray(pc.array_sort_indices(words))] = np.arange(len(words))
                by_word[-1] = -1  # null labels come first
                order = np.lexsort((by_word[at], -score, group))
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order)) - (np.cumsum(size) - size)[group[order]] + 1
                ranks += [score, place]
                keep = place <= top
            arrays += [pa.array(r) for r in ranks]
            names += [f"_r{i}" for i in range(len(ranks))]
            t = pa.Table.from_arrays(arrays, names=names)
            yield from (t if keep is None else t.filter(pa.array(keep))).to_batches(max_chunksize=ROWS_IN_BATCH)

        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            own, _ = codes(batch.column(ids))
            last = len(own) - 1 - int(np.argmax((own != own[-1])[::-1])) + 1 if (own != own[-1]).any() else 0
            if held and held[-1].column(ids)[-1].as_py() != batch.column(ids)[0].as_py():
                yield from done(held)
                held = []
            if last:
                yield from done([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        if held:
            yield from done(held)

    return run


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks of about ``ROWS_IN_TASK`` rows each, not fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // ROWS_IN_TASK))


def percentile_ranks(df: DataFrame, signals: dict[str, Column], id_col: str, rows: int, label: str | None = None,
                     top: int | None = None, dealt: bool = False) -> DataFrame:
    """``df`` with the average-tie rank / n of each signal within its ``id_col`` under the signal's name; NULL counts as 0, a
    constant group gives 0.5.  With ``label`` also their mean ``_score`` and the place ``_place`` by it, up to ``top``.

    Rows are dealt by id, unless they are ``dealt`` already, and sorted once, in tasks of about ``ROWS_IN_TASK``; ``rows``
    says about how many there are."""
    t = df.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"_s{i}") for i, c in enumerate(signals.values())])
    added = [*signals, *(["_score", "_place"] if label else [])]
    schema = T.StructType([*t.schema.fields, *[T.StructField(f"_r{i}", T.IntegerType() if c == "_place" else T.DoubleType())
                                               for i, c in enumerate(added)]])
    task = _ranked(t.columns.index(id_col), len(signals), t.columns.index(label) if label else None, top)
    t = t if dealt else t.repartition(tasks_for(df.sparkSession, rows), id_col)
    out = t.sortWithinPartitions(id_col).mapInArrow(task, schema)
    return out.select(*df.columns, *[F.col(f"_r{i}").alias(c) for i, c in enumerate(added)])


def importance_reference(imp: DataFrame, col: str, out: str) -> DataFrame:
    """Normalise by the maximum (one row per feature)."""
    return imp.select("feature", (F.col(col) / F.max(col).over(Window.partitionBy())).alias(out))


def sensor_priority(att: DataFrame, wide: DataFrame, features, importance: DataFrame, recurrence: DataFrame,
                    id_col: str = "record_id", dealt: bool = False) -> DataFrame:
    """The TOP_K sensors of each record; ``dealt`` says that ``att`` comes dealt by record, ``wide`` is a stored table."""
    q = column_quantiles(wide.where(F.col("side") == "reference"), features, [0.25, 0.5, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("j") == 0, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("j") == 1, F.col("quantile"))).alias("med"),
        F.max(F.when(F.col("j") == 2, F.col("quantile"))).alias("q3"))
    ref = q.join(importance_reference(importance, "mean_absolute_contribution", "importance_normalized"), "feature",
                 "left").join(importance_reference(recurrence, "mean_absolute_contribution", "recurrence_normalized"),
                              "feature", "left")
    t = att.join(F.broadcast(ref), "feature", "left")  # one row per feature
    iqr = F.col("q3") - F.col("q1")
    z = (F.col("value") - F.col("med")) / F.when(F.abs(iqr) < 1e-12, 1.0).otherwise(iqr)
    missing = F.col("value").isNull()
    t = t.select(id_col, "feature", "value", "contribution", z.alias("robust_z"), missing.alias("is_missing"),
                 F.coalesce("importance_normalized", F.lit(0.0)).alias("importance_normalized"),
                 F.coalesce("recurrence_normalized", F.lit(0.0)).alias("recurrence_normalized"))
    pos = F.greatest(F.col("contribution"), F.lit(0.0))
    t = percentile_ranks(t, {"_pos": pos, "_dev": F.abs(F.col("robust_z")), "_imp": F.col("importance_normalized"),
                             "_rec": F.col("recurrence_normalized")}, id_col, wide.count() * len(features), "feature", TOP_K, dealt)
    t = t.withColumnsRenamed({"_score": "priority_score", "_place": "priority_rank"})
    level = F.when(F.col("is_missing"), "Data Verification")
    for lo, name in LEVELS:
        level = level.when((F.col("priority_score") >= lo) & (F.col("contribution") > 0), name)
    level = level.when(F.col("priority_score") >= MODERATE, "Moderate").otherwise("Low")
    az = F.abs(F.col("robust_z"))
    dev = F.when(F.col("is_missing"), "Missing Measurement")
    for lo, name in DEVIATION:
        dev = dev.when(az >= lo, name)
    dev = dev.otherwise("Within Typical Range")
    reason = F.concat_ws("; ",
                         F.when(F.col("is_missing"), F.lit("measurement missing")),
                         F.when(F.col("contribution") > 0, F.lit("raises the failure score")),
                         F.when(az >= 1.5, F.lit("far from the reference median")),
                         F.when(F.col("importance_normalized") >= 0.5, F.lit("globally important")),
                         F.when(F.col("recurrence_normalized") >= 0.5, F.lit("recurs in failures")))
    return t.select(id_col, "feature", r6(F.col("value")).alias("value"), r6(F.col("contribution")).alias("contribution"),
                   r6(F.col("robust_z")).alias("robust_z"), "is_missing",
                   r6(F.col("importance_normalized")).alias("importance_normalized"),
                   r6(F.col("recurrence_normalized")).alias("recurrence_normalized"),
                   r6(F.col("priority_score")).alias("priority_score"), level.alias("priority_level"),
                   dev.alias("deviation_level"),
                   F.when(reason == "", F.lit("no notable signal")).otherwise(reason).alias("reason"),
                   "priority_rank")


def record_priority_summary(pr: DataFrame, id_col: str = "record_id") -> DataFrame:
    top5 = F.array_sort(F.collect_list(F.when(F.col("priority_rank") <= 5, F.struct("priority_rank", "feature"))))
    return pr.groupBy(id_col).agg(
        F.max(F.when(F.col("priority_rank") == 1, F.col("feature"))).alias("top_sensor"),
        F.concat_ws(",", F.transform(top5, lambda s: s["feature"])).alias("top_five_sensors"),
        F.count(F.when(F.col("priority_level") == "Very High", 1)).alias("very_high_count"),
        F.count(F.when(F.col("priority_level") == "High", 1)).alias("high_count"),
        F.count(F.when(F.col("is_missing"), 1)).alias("missing_count"),
    ).select("*", F.format_string("Start with %s; %d very high and %d high priority sensors in the top ten",
                                  F.col("top_sensor"), F.col("very_high_count"), F.col("high_count")).alias("summary_text"))


def sensor_priority_rollups(pr: DataFrame, groups: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Per sensor over all records, per decision (top 30) and over actual failures."""
    t = pr.join(groups.select(id_col, "decision", "target"), id_col)
    t = t.withColumn("_micro", F.round(F.col("priority_score") * 1000000).cast("long"))
    # the mean in whole millionths, rounded half up: the same whatever the order of summation
    mean = (F.expr("(2 * sum(_micro) + count(1)) div (2 * count(1))") / 1000000).alias("mean_priority_score")

    def roll(df, scope):
        a = df.groupBy("feature").agg(
            F.count(F.lit(1)).alias("times_in_top_ten"), F.count(F.when(F.col("priority_rank") == 1, 1)).alias("times_first"),
            mean,
            F.count(F.when(F.col("priority_level") == "Very High", 1)).alias("very_high_count"))
        return a.select(F.lit(scope).alias("scope"), "*")

    parts = [roll(t, "all"), roll(t.where(F.col("target") == 1), "failures")]
    d = t.groupBy("decision", "feature").agg(
        F.count(F.lit(1)).alias("times_in_top_ten"), F.count(F.when(F.col("priority_rank") == 1, 1)).alias("times_first"),
        mean,
        F.count(F.when(F.col("priority_level") == "Very High", 1)).alias("very_high_count"))
    parts.append(d.select(F.concat(F.lit("decision:"), F.col("decision")).alias("scope"), "feature", "times_in_top_ten",
                          "times_first", "mean_priority_score", "very_high_count"))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    w = Window.partitionBy("scope").orderBy(F.desc("times_in_top_ten"), F.desc("mean_priority_score"), "feature")
    return u.withColumn("rollup_rank", F.row_number().over(w)).where(F.col("rollup_rank") <= ROLLUP_TOP)
