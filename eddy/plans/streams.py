"""Streaming twins as registered queries. Their oracles are the batch SQL: at the
end of input the runner moves the watermark past the last event, so every window,
session, timer and waiting row is emitted."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import alert_text, duration_us, epoch_us, ntz_from_us, to_event_time
from ..streaming import process, twins
from ..streaming.process import KeyedProcess
from ..streaming.runner import ChunkedStream
from .batch import ARRIVAL_SQL as ARRIVAL
from .batch import (EID, GAP, K, LATE_DELAY, LEFT_TYPE, LOWER, RIGHT_TYPE, RISE, RISE_US, SIDES_SQL, THRESHOLD,
                    TS, TUMBLE, UPPER, V, ev)
from .catalog import ORACLE_SQL, register

WM_DELAY = "2 seconds"        # the reference's first watermark (2,000 ms)
WM_DELAY_R = "5 seconds"      # and its second (5,000 ms)
CHUNKS = 3


def _sides_pred():
    return F.col("event_type") == LEFT_TYPE, F.col("event_type") == RIGHT_TYPE


def _join_input(spark, d):
    """The two input streams of the joins (left and right event types)."""
    return (ev(spark, d).filter(F.col("event_type").isin(LEFT_TYPE, RIGHT_TYPE))
            .select(EID, K, TS, "event_type",
                    F.col(V).cast("decimal(10,2)").cast("string").alias("v")))


@register("stream_tumbling_count", ORACLE_SQL["tumbling_count"])
def q_stream_tumbling_count(spark, d):
    """W1 + E1 as a stream (three time-ordered chunks, restart in between)."""
    return twins.stream_tumbling_count(spark, ev(spark, d).select(EID, K, TS), K, TUMBLE,
                                       WM_DELAY, chunks=CHUNKS)


@register("stream_resume_count", ORACLE_SQL["tumbling_count"])
def q_stream_resume_count(spark, d):
    """K2: run on the first half, stop, add the rest, restart from the
    checkpoint; equals one uninterrupted run."""
    return twins.stream_tumbling_count(spark, ev(spark, d).select(EID, K, TS), K, TUMBLE,
                                       WM_DELAY, chunks=2, splits=[0.5], name="resume")


@register("stream_session_count", ORACLE_SQL["session_count"])
def q_stream_session_count(spark, d):
    """W3 as a stream."""
    return twins.stream_session_count(spark, ev(spark, d).select(EID, K, TS), K, GAP,
                                      WM_DELAY, chunks=CHUNKS)


@register("stream_tumbling_window_join", f"""
WITH {SIDES_SQL}
SELECT l.user_id, time_bucket(INTERVAL '{TUMBLE}', l.ts) AS window_start,
       l.ts AS l_ts, r.ts AS r_ts, l.event_id AS l_event_id, r.event_id AS r_event_id,
       l.v || ' ' || r.v AS joined
FROM l JOIN r ON l.user_id = r.user_id
 AND time_bucket(INTERVAL '{TUMBLE}', l.ts) = time_bucket(INTERVAL '{TUMBLE}', r.ts)""")
def q_stream_tumbling_window_join(spark, d):
    """J1 as a stream-stream join (watermarks 2 s / 5 s)."""
    lp, rp = _sides_pred()
    j = twins.stream_tumbling_window_join(spark, _join_input(spark, d), K, TUMBLE, lp, rp,
                                          [K, EID, "v"], WM_DELAY, WM_DELAY_R, CHUNKS)
    return j.select(K, "window_start", ntz_from_us(F.unix_micros("l_ets")).alias("l_ts"),
                    ntz_from_us(F.unix_micros("r_ets")).alias("r_ts"),
                    "l_event_id", "r_event_id",
                    F.concat_ws(" ", "l_v", "r_v").alias("joined"))


@register("stream_interval_join", f"""
WITH {SIDES_SQL}
SELECT l.user_id, l.ts AS l_ts, r.ts AS r_ts, l.event_id AS l_event_id,
       r.event_id AS r_event_id, l.v || ' ' || r.v AS joined
FROM l JOIN r ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL '3 hours' AND l.ts + INTERVAL '3 hours'""")
def q_stream_interval_join(spark, d):
    """J2 + E2 as a stream-stream range join."""
    lp, rp = _sides_pred()
    j = twins.stream_interval_join(spark, _join_input(spark, d), K, LOWER, UPPER, lp, rp,
                                   [K, EID, "v"], WM_DELAY, WM_DELAY_R, CHUNKS)
    return j.select(K, ntz_from_us(F.unix_micros("l_ets")).alias("l_ts"),
                    ntz_from_us(F.unix_micros("r_ets")).alias("r_ts"),
                    "l_event_id", "r_event_id",
                    F.concat_ws(" ", "l_v", "r_v").alias("joined"))


@register("stream_cogroup_session", ORACLE_SQL["cogroup_session"])
def q_stream_cogroup_session(spark, d):
    """J3 as a stream."""
    lp, rp = _sides_pred()
    return twins.stream_cogroup_session(spark, _join_input(spark, d), K, GAP, "v", EID,
                                        lp, rp, WM_DELAY, CHUNKS)


def _rolling(spark, d):
    return twins.stream_rolling(spark, ev(spark, d).select(EID, K, TS, V), chunks=CHUNKS)


@register("stream_rolling_max_by", ORACLE_SQL["rolling_max_by"])
def q_stream_rolling_max_by(spark, d):
    """R2 with keyed value state."""
    return _rolling(spark, d).select(EID, K, F.col("best_ts").alias(TS),
                                     F.col("best_v").alias(V))


@register("stream_running_count_keyed", ORACLE_SQL["running_count_keyed"])
def q_stream_running_count_keyed(spark, d):
    """K3 with keyed value state."""
    return _rolling(spark, d).select(EID, K, "cnt")


@register("stream_jump_alarm", ORACLE_SQL["jump_alarm"])
def q_stream_jump_alarm(spark, d):
    """K5 with keyed value state."""
    r = _rolling(spark, d)
    return (r.filter(F.col("last_value").isNotNull() & ~F.isnan("last_value")
                     & ~F.isnan(V) & (F.abs(F.col(V) - F.col("last_value")) >= THRESHOLD))
            .select(EID, K, "last_value", V))


@register("stream_rise_alarm", ORACLE_SQL["rise_alarm"])
def q_stream_rise_alarm(spark, d):
    """A2 with keyed state and event-time timers (watermark delay 0)."""
    a = twins.stream_rise_alarm(spark, ev(spark, d).select(EID, K, TS, V), RISE,
                                chunks=CHUNKS)
    return a.withColumn("message", alert_text(K, RISE_US // 1_000_000))


UNORDERED_DELAY = "12 hours"
JITTER_US = 6 * 3600 * 1_000_000     # arrival lag < watermark delay: nothing is late


@register("stream_rolling_max_by_unordered", ORACLE_SQL["rolling_max_by"])
def q_stream_rolling_max_by_unordered(spark, d):
    """R2 over out-of-order input: rows arrive up to 6 hours late relative to
    event time (a deterministic lag per event); list state buffers them until
    the 12-hour watermark passes, then they are applied in event-time order."""
    e = ev(spark, d).select(EID, K, TS, V)
    lag = (F.expr("(event_id * 7919) % 10007") * F.lit(JITTER_US // 10007)).cast("bigint")
    e = e.withColumn("arrival", ntz_from_us(epoch_us(TS) + lag))
    r = twins.stream_rolling_unordered(spark, e, "arrival", UNORDERED_DELAY, chunks=CHUNKS)
    return r.select(EID, K, F.col("best_ts").alias(TS), F.col("best_v").alias(V))


@register("stream_rise_alarm_unordered", ORACLE_SQL["rise_alarm"])
def q_stream_rise_alarm_unordered(spark, d):
    """A2 over out-of-order input (same 6-hour arrival lag and 12-hour
    watermark as the unordered rolling twin)."""
    e = ev(spark, d).select(EID, K, TS, V)
    lag = (F.expr("(event_id * 7919) % 10007") * F.lit(JITTER_US // 10007)).cast("bigint")
    e = e.withColumn("arrival", ntz_from_us(epoch_us(TS) + lag))
    a = twins.stream_rise_alarm_unordered(spark, e, "arrival", RISE, UNORDERED_DELAY,
                                          chunks=CHUNKS)
    return a.withColumn("message", alert_text(K, RISE_US // 1_000_000))


@register("stream_side_output", f"""
SELECT 'main' AS stream, event_id, user_id, value FROM events
WHERE NOT isnan(value) AND value > {THRESHOLD}
UNION ALL
SELECT 'side', event_id, user_id, value FROM events
WHERE NOT (NOT isnan(value) AND value > {THRESHOLD})""")
def q_stream_side_output(spark, d):
    """M6 on a stream: main and side outputs of one process function,
    written by one foreachBatch to two sinks, read back labelled."""
    from ..functions.columns import strictly_above
    from ..sources import labelled
    from ..streaming.runner import split_sink
    high = F.coalesce(strictly_above(V, THRESHOLD), F.lit(False))
    outs = split_sink(spark, "side", ev(spark, d).select(EID, K, TS, V), TS,
                      lambda s: s.select(EID, K, V), {"main": high, "side": ~high},
                      chunks=CHUNKS)
    return labelled(outs["main"].select(EID, K, V), "main").unionByName(
        labelled(outs["side"].select(EID, K, V), "side"))


# ------------------------------------------------- keyed process function
class Quiet(KeyedProcess):
    """Each row reports the length of its key and the time of the row before; when a
    key is quiet for ``wait`` microseconds, a timer reports how many rows came since it
    was last quiet and how many event types the key has had."""

    states = {"due": ("value", "long"), "since": ("list", "long"), "types": ("map", "long")}
    output = "kind string, user string, at long, n long, seen long"

    def __init__(self, wait: int):
        self.wait = wait

    def process(self, row, ctx):
        due = ctx.state("due").get()
        if due is not None:
            ctx.delete_timer(due)
        ctx.state("since").append(int(row.event_id))
        types = ctx.state("types")
        types.put(row.event_type, types.get(row.event_type, 0) + 1)
        ctx.state("due").update(ctx.timestamp + self.wait)
        ctx.register_timer(ctx.timestamp + self.wait)
        yield "row", ctx.key[0], ctx.timestamp, len(ctx.key[0]), -1 if due is None else due - self.wait
        if row.event_type == LEFT_TYPE:
            ctx.output("left", ("side", ctx.key[0], ctx.timestamp, int(row.event_id), types.get(LEFT_TYPE)))

    def on_timer(self, at_us, ctx):
        rows = ctx.state("since").get()
        ctx.state("since").clear()
        ctx.state("due").clear()
        yield "quiet", ctx.key[0], at_us, len(rows), len(ctx.state("types").items())


QUIET_US = 12 * 3600 * 1_000_000
QUIET_SQL = f"""
WITH e AS (SELECT 'user_' || user_id AS user, epoch_us(ts) AS t, event_id, event_type,
                  lag(epoch_us(ts)) OVER w AS before, lead(epoch_us(ts)) OVER w AS after,
                  len(list_distinct(list(event_type) OVER (w ROWS UNBOUNDED PRECEDING))) AS seen,
                  count(*) FILTER (event_type = '{LEFT_TYPE}') OVER (w ROWS UNBOUNDED PRECEDING) AS lefts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
q AS (SELECT *, coalesce(before + {QUIET_US} < t, true)::INT AS fresh, coalesce(after > t + {QUIET_US}, true) AS quiet FROM e),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM q),
n AS (SELECT *, count(*) OVER (PARTITION BY user, grp) AS n FROM g)
SELECT 'row' AS kind, user, t AS at, length(user)::BIGINT AS n, CASE WHEN fresh = 1 THEN -1 ELSE before END::BIGINT AS seen, NULL::VARCHAR AS tag FROM n
UNION ALL SELECT 'side', user, t, event_id, lefts, 'left' FROM n WHERE event_type = '{LEFT_TYPE}'
UNION ALL SELECT 'quiet', user, t + {QUIET_US}, n, seen, NULL FROM n WHERE quiet"""


def _named_events(spark, d):
    """Events with string keys."""
    return ev(spark, d).select(F.concat(F.lit("user_"), F.col(K).cast("string")).alias("user"), TS, EID, "event_type")


@register("keyed_process", QUIET_SQL)
def q_keyed_process(spark, d):
    """U10 + A1 + A4 + A5: user code with value, list and map state, timers that are
    set and deleted, context reads and a side output."""
    return process.keyed_process(_named_events(spark, d), "user", TS, Quiet(QUIET_US), tiebreak=EID)


@register("stream_keyed_process", QUIET_SQL)
def q_stream_keyed_process(spark, d):
    """The same user code on a stream with restarts in between."""
    def build(s):
        s = s.withColumn("ets", to_event_time(TS)).drop(TS).withWatermark("ets", WM_DELAY)
        return process.stream_keyed_process(s, "user", "ets", Quiet(QUIET_US), tiebreak=EID)
    return ChunkedStream(spark, "process", _named_events(spark, d), TS, CHUNKS, flush=True).run(build)


def _late_split(spark, d):
    e = ev(spark, d).select(F.concat(F.lit("user_"), F.col(K).cast("string")).alias("user"), K, TS, EID,
                            F.expr(ARRIVAL).cast("bigint").alias("arrival"))
    # chunks are cut by arrival, seen as seconds
    e = e.withColumn("arrived", ntz_from_us(F.col("arrival") * 1_000_000))
    return ChunkedStream(spark, "late", e, "arrived", CHUNKS, no_data="never").run(
        lambda s: process.stream_late_split(s, "user", TS, ["arrival", EID], duration_us(LATE_DELAY)))


@register("stream_late_events", ORACLE_SQL["late_events"])
def q_stream_late_events(spark, d):
    """E4 on a stream: the late output."""
    late = _late_split(spark, d).where("late")
    return late.select(EID, K, TS, ntz_from_us("watermark_us").alias("watermark"))
