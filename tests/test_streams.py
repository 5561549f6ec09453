"""Streams give the same rows from one file and from a folder of part files, and lock-out follows time order."""

import pytest

from paths import SF_SMALL
from oracle_harness import rows_of


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("folders"))
    for t in ("events", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(4).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", ["stream_window_profile", "stream_sessions", "stream_decide", "stream_drift", "stream_lockout"])
def test_folder_equals_file(spark, folder_tables, name):
    from yieldlens.streaming.streams import STREAMS

    one, many = (rows_of(STREAMS[name](spark, d).toPandas()) for d in (SF_SMALL, folder_tables))
    assert one == many


def test_drift_does_not_depend_on_triggers(spark, folder_tables):
    from yieldlens.streaming import streams as st

    one = rows_of(st.drift(spark, SF_SMALL).toPandas())
    several = rows_of(st.drift(spark, folder_tables, files_per_trigger=1).toPandas())  # every file spans the whole period
    assert one == several and len(one) > 5


def test_lockout_against_one_pass(spark):
    from yieldlens.streaming import streams as st

    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("user_id", "ts", "event_id").collect()
    want, by = [], {}
    for r in rows:
        by.setdefault(r["user_id"], []).append((r["ts"], r["event_type"] == "error"))
    for user, seq in by.items():
        want += [(u, n) for u, _, _, n in st.lock_step(user, seq, 0, None)[0]]
    got = [(r["user_id"], r["failures"]) for r in st.lockout(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(want)


def test_missing_table_raises(spark, tmp_path):
    from yieldlens.streaming.streams import STREAMS

    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        STREAMS["stream_decide"](spark, str(tmp_path))


def test_lockout_over_batches_with_a_hot_user(spark, tmp_path):
    """A third of all events is one user's; files are slices of time, a trigger takes one, Arrow batches hold seven rows."""
    import datetime
    import random

    from yieldlens.streaming import streams as st

    dice, start, rows = random.Random(4), datetime.datetime(2024, 1, 1), []
    for i in range(900):
        user = 1 if i % 3 == 0 else dice.choice([None, *range(2, 9)])
        rows.append((i, user, start + datetime.timedelta(seconds=60 * i + dice.randrange(60)), "error" if dice.random() < 0.75 else "view"))
    rows += [(901 + i, 99, start + datetime.timedelta(days=6 * (i // 4), minutes=i), "error") for i in range(5)]  # 4, then 1 six days later
    rows.append((950, 3, None, "error"))
    schema = "event_id long, user_id long, ts timestamp, event_type string"
    last = start + datetime.timedelta(minutes=900)
    for at, part in enumerate(([r for r in rows if r[2] is None or r[2] < start + datetime.timedelta(minutes=300)],
                               [r for r in rows if r[2] and start + datetime.timedelta(minutes=300) <= r[2] < last],
                               [r for r in rows if r[2] and last <= r[2]], [(999, 98, start + datetime.timedelta(days=9), "error")])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    want, by = [], {}
    for r in sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[0])):
        by.setdefault(r[1], []).append((r[2], r[3] == "error"))
    for user, seq in by.items():
        want += st.lock_step(user, seq, 0, None)[0]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = [tuple(r) for r in st.lockout(spark, str(tmp_path), files_per_trigger=1).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(want, key=key) and len({r[0] for r in got}) >= 8 and sum(r[0] == 1 for r in got) > 10


def test_lockout_drops_idle_states(spark, tmp_path):
    import datetime

    from yieldlens.streaming import streams as st

    start, schema = datetime.datetime(2024, 1, 1), "event_id long, user_id long, ts timestamp, event_type string"
    slices = [[(i, 7, start + datetime.timedelta(minutes=i), "error") for i in range(4)], [(10, 8, start + datetime.timedelta(days=3), "error")],
              [(11, 7, start + datetime.timedelta(days=3, minutes=1), "error")]]
    for part in slices:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert st.lockout(spark, str(tmp_path), files_per_trigger=1).count() == 0  # four failures were forgotten
    assert st.lockout(spark, str(tmp_path)).count() == 1  # in one batch nothing is idle
