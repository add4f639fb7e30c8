"""Streaming twins of the core operators (same semantics, Structured
Streaming execution). Each returns the *batch* DataFrame read back from the
stream's parquet sink, so the driver can compare it with the oracle.

Event time: ``events.ts`` is ``timestamp_ntz``; watermarks need an instant,
so streams work on ``ets = to_event_time(ts)`` (read as UTC) and convert
results back with ``ntz_from_us``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import duration_us, epoch_us, ntz_from_us, to_event_time
from ..operators import joins
from pyspark.sql.streaming.state import GroupStateTimeout

from .processors import (BUFFERED_RISE_STATE, BUFFERED_ROLLING_STATE, RISE_OUT, RISE_STATE,
                         ROLLING_OUT, ROLLING_STATE, buffered_rise_group,
                         bucket_of, buffered_rolling_group, rise_group, rolling_group)
from .runner import ChunkedStream

ETS = "ets"


def _with_ets(stream: DataFrame, ts: str = "ts") -> DataFrame:
    return stream.withColumn(ETS, to_event_time(ts))


def _ntz(col: str):
    return ntz_from_us(F.unix_micros(F.col(col)))


def _key_number(key: str):
    """The key for :mod:`processors`; the NULL key is told by its bucket."""
    return F.coalesce(F.col(key), F.lit(0)).cast("bigint").alias("user_id")


def stream_tumbling_count(spark: SparkSession, events: DataFrame, key: str, size: str,
                          delay: str, chunks: int = 3, splits=None,
                          name="tumbling") -> DataFrame:
    """W1 + E1: watermark ``delay``, append mode: a window is emitted once
    the watermark passes its end."""
    def build(s):
        s = _with_ets(s).withWatermark(ETS, delay)
        g = s.groupBy(key, F.window(ETS, size).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
        return g.select(key, _ntz("w.start").alias("window_start"),
                        _ntz("w.end").alias("window_end"), "cnt")
    return ChunkedStream(spark, name, events, "ts", chunks, splits, flush=True).run(build)


def stream_session_count(spark, events, key, gap, delay, chunks=3) -> DataFrame:
    """W3 on a stream: session windows closed by the watermark."""
    def build(s):
        s = _with_ets(s).withWatermark(ETS, delay)
        g = s.groupBy(key, F.session_window(ETS, gap).alias("w")).agg(
            F.count(F.lit(1)).alias("cnt"))
        return g.select(key, _ntz("w.start").alias("session_start"),
                        _ntz("w.end").alias("session_end"), "cnt")
    return ChunkedStream(spark, "session", events, "ts", chunks, flush=True).run(build)


def _split_sides(s, left_pred, right_pred, cols, delay_l, delay_r):
    s = _with_ets(s)
    l = s.filter(left_pred).select(*cols, ETS).withWatermark(ETS, delay_l)
    r = s.filter(right_pred).select(*cols, ETS).withWatermark(ETS, delay_r)
    return l, r


def stream_tumbling_window_join(spark, events, key, size, left_pred, right_pred,
                                cols, delay_l="2 seconds", delay_r="5 seconds",
                                chunks=3) -> DataFrame:
    """J1 on streams: stream-stream inner join on (key, window start); the
    window in the join key lets the watermarks drop old state."""
    def build(s):
        l, r = _split_sides(s, left_pred, right_pred, cols, delay_l, delay_r)
        j = joins.tumbling_window_join(l, r, key, ETS, size, [c for c in cols if c != key],
                                       [c for c in cols if c != key])
        return j.select(key, _ntz("window_start").alias("window_start"),
                        *[c for c in j.columns if c not in (key, "window_start")])
    return ChunkedStream(spark, "wjoin", events, "ts", chunks, no_data="never").run(build)


def stream_interval_join(spark, events, key, lower, upper, left_pred, right_pred, cols,
                         delay_l="2 seconds", delay_r="5 seconds", chunks=3) -> DataFrame:
    """J2 + E2 on streams: range condition on event time bounds the join
    state by the two watermarks (Spark uses their minimum)."""
    def build(s):
        l, r = _split_sides(s, left_pred, right_pred, cols, delay_l, delay_r)
        # plain form: the range condition is what lets Spark evict join state
        return joins.interval_join(l, r, key, ETS, lower, upper,
                                   [c for c in cols if c != key],
                                   [c for c in cols if c != key], bucketed=False)
    return ChunkedStream(spark, "ijoin", events, "ts", chunks, no_data="never").run(build)


def stream_cogroup_session(spark, events, key, gap, value, tiebreak, left_pred,
                           right_pred, delay, chunks=3) -> DataFrame:
    """J3 on a stream: tagged union of both sides, one watermark, shared
    session windows, side lists folded into the text block."""
    def build(s):
        s = _with_ets(s)
        side = F.when(left_pred, F.lit(1)).when(right_pred, F.lit(2))
        u = (s.withColumn("_side", side).filter(F.col("_side").isNotNull())
             .withWatermark(ETS, delay))
        item = F.struct(F.col(ETS).alias("_o"), F.col(tiebreak).alias("_o0"),
                        F.col(key).alias("k"), F.col(value).cast("string").alias("v"))
        g = u.groupBy(key, F.session_window(ETS, gap).alias("w")).agg(
            F.collect_list(F.when(F.col("_side") == 1, item)).alias("_l"),
            F.collect_list(F.when(F.col("_side") == 2, item)).alias("_r"))
        return g.select(key, _ntz("w.start").alias("session_start"),
                        _ntz("w.end").alias("session_end"),
                        F.size("_l").cast("bigint").alias("n_left"),
                        F.size("_r").cast("bigint").alias("n_right"),
                        joins._blocks(F.array_sort("_l"), F.array_sort("_r")).alias("text"))
    return ChunkedStream(spark, "cogroup", events, "ts", chunks, flush=True).run(build)


def stream_rolling(spark, events, key="user_id", ts="ts", value="value",
                   tiebreak="event_id", chunks=3) -> DataFrame:
    """R2 + K3 + K5 as one keyed value state (``applyInPandasWithState``).
    Output per input row: count so far, previous value, running arg-max."""

    def build(s):
        s = s.select(F.col(tiebreak).alias("event_id"), _key_number(key),
                     epoch_us(ts).alias("t_us"), F.col(value).alias("value"), bucket_of(key).alias("bucket"))
        return s.groupBy("bucket").applyInPandasWithState(
            rolling_group, ROLLING_OUT, ROLLING_STATE, "append", GroupStateTimeout.NoTimeout)
    out = ChunkedStream(spark, "rolling", events, ts, chunks, no_data="never").run(build)
    return out.withColumn("ts", ntz_from_us("t_us")).withColumn(
        "best_ts", ntz_from_us("best_t"))


def stream_rolling_unordered(spark, events, arrival: str, delay: str, key="user_id",
                             ts="ts", value="value", tiebreak="event_id",
                             chunks=3) -> DataFrame:
    """R2 + K3 + K5 for input that arrives out of event-time order: chunks
    are cut by the ``arrival`` column, rows wait in keyed list state until the
    watermark (max event time - ``delay``) passes them, then are applied in
    event-time order; the end of input releases the last ones."""

    def build(s):
        s = (_with_ets(s, ts).withWatermark(ETS, delay)
             .select(F.col(tiebreak).alias("event_id"), _key_number(key),
                     epoch_us(ts).alias("t_us"), F.col(value).alias("value"), bucket_of(key).alias("bucket"), ETS))
        return s.groupBy("bucket").applyInPandasWithState(
            buffered_rolling_group, ROLLING_OUT, BUFFERED_ROLLING_STATE, "append",
            GroupStateTimeout.EventTimeTimeout)
    out = ChunkedStream(spark, "unordered", events, arrival, chunks, flush=True).run(build)
    return out.withColumn("ts", ntz_from_us("t_us")).withColumn(
        "best_ts", ntz_from_us("best_t"))


def stream_rise_alarm(spark, events, interval: str, key="user_id", ts="ts",
                      value="value", tiebreak="event_id", delay="0 seconds",
                      chunks=3, first_floor=None) -> DataFrame:
    """A2 on a stream: keyed state with an event-time timeout at the pending
    alarm's due time (``applyInPandasWithState``)."""
    n_us = duration_us(interval)

    def build(s):
        s = (_with_ets(s, ts).withWatermark(ETS, delay)
             .select(F.col(key).alias("user_id"), epoch_us(ts).alias("t_us"),
                     F.col(value).alias("value"), F.col(tiebreak).alias("event_id"), ETS))
        return s.groupBy("user_id").applyInPandasWithState(
            rise_group(n_us, first_floor), RISE_OUT, RISE_STATE, "append",
            GroupStateTimeout.EventTimeTimeout)
    out = ChunkedStream(spark, "rise", events, ts, chunks, flush=True).run(build)
    return out.select("user_id", ntz_from_us("alarm_us").alias("alarm_ts"))


def stream_rise_alarm_unordered(spark, events, arrival: str, interval: str, delay: str,
                                key="user_id", ts="ts", value="value",
                                tiebreak="event_id", chunks=3,
                                first_floor=None) -> DataFrame:
    """A2 for out-of-order input: readings buffered until the watermark,
    applied in event-time order; the end of input fires what is still due."""
    n_us = duration_us(interval)

    def build(s):
        s = (_with_ets(s, ts).withWatermark(ETS, delay)
             .select(F.col(key).alias("user_id"), epoch_us(ts).alias("t_us"),
                     F.col(value).alias("value"), F.col(tiebreak).alias("event_id"), ETS))
        return s.groupBy("user_id").applyInPandasWithState(
            buffered_rise_group(n_us, first_floor), RISE_OUT, BUFFERED_RISE_STATE, "append",
            GroupStateTimeout.EventTimeTimeout)
    out = ChunkedStream(spark, "rise-unordered", events, arrival, chunks, flush=True).run(build)
    return out.select("user_id", ntz_from_us("alarm_us").alias("alarm_ts"))


__all__ = ["stream_rise_alarm_unordered", "stream_tumbling_count", "stream_session_count", "stream_tumbling_window_join",
           "stream_interval_join", "stream_cogroup_session", "stream_rolling",
           "stream_rise_alarm", "stream_rolling_unordered", "duration_us"]
