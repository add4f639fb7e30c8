"""Streaming runner behaviour beyond the oracle layer."""

from pyspark.sql import functions as F

from eddy.sources import events
from eddy.streaming import twins

SF = "/root/testdata/sf0.001"


def test_stream_run_leaves_session_conf_alone(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.streaming.noDataMicroBatches.enabled",
            "spark.sql.streaming.stateStore.providerClass"]
    before = {k: spark.conf.get(k, None) for k in keys}
    twins.stream_tumbling_count(spark, events(spark, SF), "user_id", "1 day", "2 seconds",
                                chunks=2).count()
    assert {k: spark.conf.get(k, None) for k in keys} == before


def test_restart_equals_single_run(spark):
    """K2: two chunks with a restart in between give the same closed windows
    as one chunk (one uninterrupted run)."""
    ev = events(spark, SF)
    a = twins.stream_tumbling_count(spark, ev, "user_id", "1 day", "2 seconds", chunks=1)
    b = twins.stream_tumbling_count(spark, ev, "user_id", "1 day", "2 seconds", chunks=2,
                                    splits=[0.5], name="resume")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() > 0


def test_buffered_equals_ordered_on_released_rows(spark):
    """Out-of-order arrival through the buffered processor gives the ordered
    processor's rows for everything the final watermark released."""
    from eddy.functions.columns import epoch_us, ntz_from_us
    ev = events(spark, SF).select("event_id", "user_id", "ts", "value")
    lag = (F.expr("(event_id * 7919) % 10007") * F.lit(3_600_000_000 // 10007)).cast("bigint")
    shuffled = ev.withColumn("arrival", ntz_from_us(epoch_us("ts") + lag))
    o = twins.stream_rolling(spark, ev, chunks=2).select("event_id", "cnt", "best_v")
    u = twins.stream_rolling_unordered(spark, shuffled, "arrival", "2 hours", chunks=3
                                       ).select("event_id", "cnt", "best_v")
    got = sorted(map(tuple, u.collect()))
    want = {r[0]: tuple(r) for r in o.collect()}
    assert got and all(want[g[0]] == g for g in got)
