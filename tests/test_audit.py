"""Audit chain: a freshly built chain verifies; tampering is detected."""

from pyspark.sql import functions as F

from yieldlens.operators import audit as A
from yieldlens.session import cut_lineage
from yieldlens.sources import fixtures as fx
from paths import SF_SMALL


def test_chain_verifies_and_detects_tampering(spark):
    ev = fx.audit_events(spark, SF_SMALL)
    chained = cut_lineage(A.hash_chain(ev, segment=50))
    n = ev.count()

    def broken(events, chain):
        return A.verify_chain(events, chain, segment=50, expected_events=n).where(~F.col("chain_valid")).collect()

    assert not broken(ev, chained)
    victim = ev.orderBy("event_id").first()["event_id"]
    assert len(broken(ev.withColumn("outcome", F.when(F.col("event_id") == victim, F.lit("x")).otherwise(F.col("outcome"))), chained)) == 1
    day = chained.groupBy("chain_day").count().orderBy("chain_day").collect()[3]["chain_day"]
    last = chained.orderBy(F.desc("position")).first()["event_id"]
    for gone in (F.col("event_id") == victim, F.to_date("timestamp_utc") == F.lit(day), F.col("event_id") == last):
        assert broken(ev.where(~gone), chained)                      # only the events were cut
        assert broken(ev.where(~gone), chained.where(~gone))         # both tables were cut
    swapped = chained.withColumn("event_hash", F.when(F.col("event_id") == victim, F.lit("0")).otherwise(F.col("event_hash")))
    assert broken(ev, swapped)


def test_nested_and_odd_case_secrets_are_redacted(spark):
    texts = ['{"token": {"a": "x}", "b": [1, {"c": 2}]}, "k": 1}', '{"secret": ["a", "b"], "n": {"Password": "p"}}', '{"a": 1}', None,
             '{"api_key": {"broken": "sec', '{"AUTHORIZATION": true, "x": "token"}']
    ev = spark.createDataFrame(list(enumerate(texts)), "event_id long, details_json string")
    got = [r["details_json"] for r in A.redact_details(ev).orderBy("event_id").collect()]
    assert got == ['{"token": "[REDACTED]", "k": 1}', '{"secret": "[REDACTED]", "n": {"Password": "[REDACTED]"}}', '{"a": 1}', None,
                   '{"api_key": "[REDACTED]"', '{"AUTHORIZATION": "[REDACTED]", "x": "token"}']
