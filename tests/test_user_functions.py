"""User surfaces: keyed process functions, window aggregates, flatMap with and
without state, whole list state; hot and NULL keys, ties, empty input."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eddy.functions.columns import to_event_time
from eddy.operators import aggregate, rolling
from eddy.plans.batch import Jump, Spread
from eddy.plans.streams import Quiet
from eddy.streaming import process
from eddy.streaming.runner import ChunkedStream

T0 = datetime(2024, 1, 1)
SCHEMA = "user string, ts timestamp_ntz, event_id long, event_type string, value double"


def hot_rows(n=900, seed=2):
    """One key with nine tenths of all rows, many at one instant; a NULL key."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 10 else r.choice(["a", "b", None, "ü"])
        at = T0 + timedelta(seconds=3600 if r.random() < 0.4 else r.randrange(200_000))
        rows.append((key, at, i, r.choice(["purchase", "view", "error"]), float(r.randrange(0, 500))))
    return rows


@pytest.fixture(scope="module")
def rows():
    return hot_rows()


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def test_keyed_flat_map_hands_state_over(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = aggregate.keyed_flat_map(df, "user", "ts", Jump(150.0), tiebreak="event_id").collect()
    want = [(k, b[2], a[4], b[4]) for k, own in by_key(rows).items() for a, b in zip(own, own[1:]) if abs(b[4] - a[4]) >= 150]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert aggregate.keyed_flat_map(df.where("false"), "user", "ts", Jump(1.0), tiebreak="event_id").collect() == []


def test_keyed_flat_map_splits_a_hot_key(spark):
    """Rows of one key are dealt over several ranges."""
    df = spark.range(4000).select(F.lit("k").alias("user"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id)").alias("ts"),
                                  F.col("id").alias("event_id"), (F.col("id") % 7 * 100).cast("double").alias("value"))

    class Where(aggregate.KeyedFlatMap):
        output = "part int, had boolean"

        def apply(self, row, state):
            from pyspark import TaskContext
            return [(TaskContext.get().partitionId(), state is not None)], row.value

    got = aggregate.keyed_flat_map(df, "user", "ts", Where(), tiebreak="event_id").collect()
    assert len({r.part for r in got}) > 1 and sum(not r.had for r in got) == 1


def test_window_aggregate(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = {}
    for k, at, _, kind, v in rows:
        slot = (k, at.replace(hour=0, minute=0, second=0))
        want.setdefault(slot, []).append((kind, v))

    def expected(xs):
        kinds = [x[0] for x in xs]
        most = min(set(kinds), key=lambda t: (-kinds.count(t), t))
        return len(xs), sum(round(x[1] * 100) for x in xs) / len(xs) / 100, min(x[1] for x in xs), max(x[1] for x in xs), most
    for held in (20_000, 3):  # also with accumulators passed on early
        monkeypatch.setattr(aggregate, "HELD", held)
        got = {(r.user, r.window_start): (r.n, r.mean, r.low, r.high, r.most) for r in aggregate.window_aggregate(df, "user", "ts", "1 day", Spread()).collect()}
        assert got == {k: expected(v) for k, v in want.items()}
    sliding = aggregate.window_aggregate(df, "user", "ts", "1 day", Spread(), slide="12 hours")
    assert sliding.agg(F.sum("n")).first()[0] == 2 * len(rows)
    assert aggregate.window_aggregate(df.where("false"), "user", "ts", "1 day", Spread()).collect() == []


def test_flat_map_gives_none_one_or_many(spark):
    df = spark.createDataFrame([(1, "a b  c"), (2, ""), (3, None), (4, "x")], "id long, text string")
    words = lambda t: ((i, w) for i, w in enumerate((t or "").split()))
    got = aggregate.flat_map(df, words, "nth int, word string", "text", keep=["id"])
    assert got.columns == ["id", "nth", "word"]
    assert sorted(map(tuple, got.collect())) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (4, 0, "x")]


def plain_quiet(rows, wait):
    out = []
    for k, own in by_key(rows).items():
        us = [int((r[1] - datetime(1970, 1, 1)) / timedelta(microseconds=1)) for r in own]
        since, kinds, lefts = 0, set(), 0
        for i, r in enumerate(own):
            since += 1
            kinds.add(r[3])
            lefts += r[3] == "purchase"
            fresh = i == 0 or us[i - 1] + wait < us[i]
            out.append(("row", k, us[i], len(k), -1 if fresh else us[i - 1], None))
            if r[3] == "purchase":
                out.append(("side", k, us[i], r[2], lefts, "left"))
            if i + 1 == len(own) or us[i + 1] > us[i] + wait:
                out.append(("quiet", k, us[i] + wait, since, len(kinds), None))
                since = 0
    return out


@pytest.mark.parametrize("wait", [1_000_000, 3_600_000_000])
def test_keyed_process(spark, rows, wait):
    own = [r for r in rows if r[0] is not None]
    df = spark.createDataFrame(own, SCHEMA).repartition(4)
    got = process.keyed_process(df, "user", "ts", Quiet(wait), tiebreak="event_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_quiet(own, wait), key=str)
    assert process.keyed_process(df.where("false"), "user", "ts", Quiet(wait)).collect() == []


def test_timers_fire_in_order_and_once(spark):
    class Chain(process.KeyedProcess):
        """A timer that sets the next, one that is set twice, one that is deleted."""
        output = "at long, what string"
        states = {"n": ("value", "long")}

        def process(self, row, ctx):
            for at in (5, 5, 9):
                ctx.register_timer(ctx.timestamp + at)
            ctx.delete_timer(ctx.timestamp + 9)
            yield ctx.watermark, "row"

        def on_timer(self, at_us, ctx):
            n = (ctx.state("n").get() or 0) + 1
            ctx.state("n").update(n)
            if n < 3:
                ctx.register_timer(at_us + 1)
            yield at_us, f"timer {n}"

    df = spark.createDataFrame([(None, T0, 1), (None, T0 + timedelta(microseconds=5), 2)], "user string, ts timestamp_ntz, event_id long")
    base = int((T0 - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    got = [(r.at - base, r.what) for r in process.keyed_process(df, "user", "ts", Chain(), tiebreak="event_id").collect()]
    # the row at 5 comes before the timer at 5; timers 1 and 2 set the next one
    assert got == [(0, "row"), (5, "row"), (5, "timer 1"), (6, "timer 2"), (7, "timer 3"), (10, "timer 4")]


def test_stream_takes_rows_out_of_order(spark):
    """A caller's stream: rows arrive up to six hours late, in any order."""
    own = [r for r in hot_rows(150, 6) if r[0] is not None]
    df = spark.createDataFrame(own, SCHEMA)
    arriving = df.withColumn("arrival", F.expr("ts + make_interval(0,0,0,0,0,0,(event_id * 7919) % 21600)"))

    def build(s):
        s = s.withColumn("ets", to_event_time("ts")).drop("ts", "arrival").withWatermark("ets", "12 hours")
        return process.stream_keyed_process(s, "user", "ets", Quiet(3_600_000_000), tiebreak="event_id")
    got = ChunkedStream(spark, "late-rows", arriving, "arrival", 3, flush=True).run(build).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_quiet(own, 3_600_000_000), key=str)


def test_whole_list_state(spark, rows):
    df = spark.createDataFrame([(*r, None if r[2] % 6 == 0 else f"i{r[2]}") for r in rows], SCHEMA + ", item string")
    log = rolling.history_log(df, "user", "ts", "item", tiebreak=["event_id"], keep=["event_id"])
    assert log.count() == len(rows)
    want = {}
    for own in by_key(rows).values():
        items = [None if r[2] % 6 == 0 else f"i{r[2]}" for r in own]
        want.update({r[2]: items[:i] for i, r in enumerate(own) if r[2] % 50 == 0 and r[0] is not None})
    got = rolling.read_history(log, "user", "item", (F.col("event_id") % 50 == 0) & F.col("user").isNotNull(), keep=["event_id"]).collect()
    assert {r.event_id: r.history for r in got} == want
    assert all(r.n_before == len(r.history) for r in got)


def test_late_rows_of_a_stream(spark):
    """Rows in arrival order against each key's own watermark; a NULL time is never
    late, and no row is lost."""
    delay = timedelta(hours=3)
    rows = [r if r[2] % 37 else (r[0], None, *r[2:]) for r in hot_rows(300, 9) if r[0] is not None]
    df = spark.createDataFrame([(*r, T0 + timedelta(seconds=r[2])) for r in rows], SCHEMA + ", arrived timestamp_ntz")
    got = ChunkedStream(spark, "late", df, "arrived", 3, no_data="never").run(
        lambda s: process.stream_late_split(s, "user", "ts", ["event_id"], delay // timedelta(microseconds=1))).collect()
    most, want = {}, {}
    for k, at, i, *_ in sorted(rows, key=lambda r: r[2]):
        before = most.get(k)
        want[i] = bool(before and at and at <= before - delay)
        if at:
            most[k] = max(before or at, at)
    assert {r.event_id: r.late for r in got} == want and any(want.values()) and len(got) == len(rows)
