"""Properties of the drift metrics."""

from pyspark.sql import functions as F

from yieldlens.operators import drift as D


def _two_sides(spark, ref, cur):
    rows = [(f"r{i}", "reference", float(v)) for i, v in enumerate(ref)] + \
           [(f"c{i}", "current", float(v)) for i, v in enumerate(cur)]
    return spark.createDataFrame(rows, "record_id string, side string, sensor_001 double")


def test_psi_zero_and_ks_zero_for_identical_sides(spark):
    vals = [float(i % 17) for i in range(200)]
    b = D.DriftBase(_two_sides(spark, vals, vals), ["sensor_001"])
    assert D.psi(b).first().psi == 0.0
    ks = D.ks_two_sample(b).first()
    assert ks.ks_statistic == 0.0 and ks.ks_p_value == 1.0


def test_ks_symmetric_and_bounded(spark):
    a = [float(i) for i in range(100)]
    c = [float(i) + 30.0 for i in range(80)]
    d1 = D.ks_two_sample(D.DriftBase(_two_sides(spark, a, c), ["sensor_001"])).first().ks_statistic
    d2 = D.ks_two_sample(D.DriftBase(_two_sides(spark, c, a), ["sensor_001"])).first().ks_statistic
    assert abs(d1 - d2) < 1e-12 and 0.0 <= d1 <= 1.0


def test_constant_reference_is_flagged(spark):
    fd = D.feature_drift(_two_sides(spark, [1.0] * 50, [float(i) for i in range(50)]), ["sensor_001"]).first()
    assert fd.reference_constant and not fd.current_constant
    assert fd.constant_sensor_change_severity == "Warning"


def test_wasserstein_keeps_its_digits_far_from_zero(spark):
    ref, cur = [i * 0.5 for i in range(200)], [i * 0.5 + (i % 7) * 0.25 for i in range(200)]
    near = D.wasserstein(D.DriftBase(_two_sides(spark, ref, cur), ["sensor_001"])).first().wasserstein_distance
    far = D.wasserstein(D.DriftBase(_two_sides(spark, [v + 1e12 for v in ref], [v + 1e12 for v in cur]), ["sensor_001"])).first()
    want = sum(abs(a - b) for a, b in zip(sorted(ref), sorted(cur))) / 200
    assert abs(near - want) < 1e-12
    assert abs(far.wasserstein_distance - want) < 1e-9


def test_running_counts_are_stored_and_match_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 64)  # many chunks
    monkeypatch.setattr(D, "TASK_ROWS", 8)  # many tasks for few values
    nan, inf = float("nan"), float("inf")
    values = [0.0, -0.0, 1.5, 1.5, None, nan, inf, -3.0, 7.25, 1.5]
    rows = [(None if i % 11 == 0 else f"r{i}", ("reference", "current", None, "other")[i * i % 7 % 4], values[i % 10], float(i % 23), 5.0)
            for i in range(400)]
    df = spark.createDataFrame(rows, "record_id string, side string, a double, b double, c double").repartition(5)
    b = D.DriftBase(df, ["a", "b", "c"])
    plan = b.cum._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan  # readers add offsets, nothing is dealt or sorted again
    got = sorted((r.feature, r.value, r.c_ref, r.c_cur, r.cum_c_ref, r.cum_c_cur, r.tot_c_ref, r.tot_c_cur) for r in b.cum.collect())
    want = []
    for k, name in enumerate("abc"):
        sides = {s: [r[2 + k] + 0.0 for r in rows if r[1] == s and r[2 + k] is not None and abs(r[2 + k]) < inf] for s in (D.REF, D.CUR)}
        for v in sorted(set(sides[D.REF]) | set(sides[D.CUR])):
            own = [sides[s].count(v) for s in (D.REF, D.CUR)]
            want.append((name, v, *own, *[sum(x <= v for x in sides[s]) for s in (D.REF, D.CUR)], *[len(sides[s]) for s in (D.REF, D.CUR)]))
    assert got == want
    for r in b.stats.collect():
        k = 2 + "abc".index(r.feature)
        assert (r.rows_ref, r.rows_cur) == tuple(sum(x[1] == s for x in rows) for s in (D.REF, D.CUR))
        assert r.distinct_ref == len({x[k] + 0.0 for x in rows if x[1] == D.REF and x[k] is not None and abs(x[k]) < inf})


def test_monitoring_run_stores_its_small_tables(spark):
    from yieldlens.plans.monitoring_run import MonitoringRun

    df = _two_sides(spark, [float(i) for i in range(40)], [float(i) + 9 for i in range(30)])
    df = df.select("*", (F.col("sensor_001") / 100).alias("probability"), F.lit("Low").alias("decision"))
    run = MonitoringRun(df, ["sensor_001"], "r", ["probability"])
    for t in (run.feature_drift, run.output_drift, run.category_drift, run.data_quality):
        plan = t._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" in plan and "Exchange" not in plan  # read again by alerts and health, computed once
