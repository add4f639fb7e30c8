"""Layer 4: properties. Results do not depend on input order, partitioning
or the time-bucket width of the two-level scans; randomized agreement with a
plain sequential model."""

import random

import pytest
from pyspark.sql import functions as F

from eddy.functions.columns import ntz_from_us
from eddy.operators import alarms, joins, partition, rolling, windows
from eddy.sources import events

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def ev(spark):
    return events(spark, SF).cache()


@pytest.fixture(scope="module")
def hot(spark):
    """Random readings where one key holds over a third of the rows."""
    rnd = random.Random(7)
    data, i = [], 0
    for key in range(40):
        n = 400 if key == 0 else rnd.randint(1, 15)
        t = 0
        for _ in range(n):
            t += rnd.choice([1, 2, 3, 5, 8]) * 1_000_000
            data.append((key, t, float(rnd.randint(0, 6)), i))
            i += 1
    df = spark.createDataFrame(data, "k bigint, us bigint, v double, e bigint")
    return df.withColumn("ts", ntz_from_us("us")).cache()


def rise_model(seq, interval, floor=None):
    """Plain sequential model of the continuous-rise alarm."""
    last, has, timer, out = floor, floor is not None, None, []
    for t, v in seq:
        if timer is not None and t > timer:
            out.append(timer)
            timer = None
        if ((not has) or v > last) and timer is None:
            timer = t + interval
        elif has and v < last and timer is not None:
            timer = None
        last, has = v, True
    if timer is not None:
        out.append(timer)
    return out


@pytest.mark.parametrize("bucket,max_fold", [(None, 100_000), ("7 seconds", 100_000),
                                             ("1 minute", 100_000), ("30 seconds", 3),
                                             ("1 minute", 0)])
def test_rise_alarm_matches_model(hot, bucket, max_fold):
    """max_fold small forces the pointer-doubling path for long streaks."""
    by_key = {}
    for r in hot.orderBy("us", "e").collect():
        by_key.setdefault(r["k"], []).append((r["us"], r["v"]))
    want = sorted((k, t) for k, s in by_key.items() for t in rise_model(s, 10_000_000))
    got = alarms.rise_alarm(hot, "k", "ts", "v", "10 seconds", tiebreak=["e"], bucket=bucket,
                            max_fold=max_fold)
    got = sorted((r["k"], r["us"]) for r in got.select(
        "k", F.unix_micros(F.col("alarm_ts").cast("timestamp")).alias("us")).collect())
    assert got == want


@pytest.mark.parametrize("op", ["max", "max_by", "reduce", "count", "jump", "history"])
def test_bucket_width_invariance(hot, op):
    def run(bucket):
        if op in ("max", "max_by", "reduce"):
            return rolling.rolling_max(hot, "k", "ts", "v", tiebreak=["e"], bucket=bucket,
                                       mode=op, keep=["e"])
        if op == "count":
            return rolling.running_count(hot, "k", "ts", tiebreak=["e"], bucket=bucket,
                                         keep=["e"])
        if op == "jump":
            return alarms.jump_alarm(hot, "k", "ts", "v", 3.0, tiebreak=["e"], bucket=bucket,
                                     keep=["e"])
        h = rolling.running_history(hot, "k", "ts", "e", depth=4, tiebreak=["e"],
                                    bucket=bucket, keep=["e"])
        return h.select("e", "k", "n_before", F.array_join(
            F.transform("history", lambda x: x.cast("string")), ",").alias("h"))
    base = rows(run(None))
    assert rows(run("5 seconds")) == base
    assert rows(run("2 minutes")) == base


def test_input_order_invariance(ev):
    shuffled = ev.repartition(7, F.rand(3))
    a = rolling.rolling_max(ev, "user_id", "ts", "value", tiebreak=["event_id"],
                            mode="max_by", keep=["event_id"])
    b = rolling.rolling_max(shuffled, "user_id", "ts", "value", tiebreak=["event_id"],
                            mode="max_by", keep=["event_id"])
    assert rows(a) == rows(b)
    ga = rolling.running_count_global(ev, ["ts", "event_id"], partitions=5, keep=["event_id"])
    gb = rolling.running_count_global(shuffled, ["ts", "event_id"], partitions=3,
                                      keep=["event_id"])
    assert rows(ga) == rows(gb)


def test_partitioning_preserves_bag(ev):
    base = rows(ev.select("event_id", "value"))
    assert rows(partition.shuffle(ev, 5).select("event_id", "value")) == base
    assert rows(partition.shuffle(ev, 5, seed=1).select("event_id", "value")) == base
    assert rows(partition.by_key(ev, 5, "user_id").select("event_id", "value")) == base
    g = partition.with_partition_id(partition.to_global(ev))
    assert g.select("part").distinct().count() == 1
    k = partition.with_partition_id(partition.by_key(ev, 5, "user_id"))
    assert k.groupBy("user_id").agg(F.countDistinct("part").alias("n")).filter("n > 1").count() == 0
    tagged = partition.tag_partition_index(partition.shuffle(ev, 4, seed=2), "user_id")
    assert tagged.count() == ev.count()
    assert {r["part"] for r in tagged.select("part").distinct().collect()} <= {0, 1, 2, 3}


def test_sliding_with_slide_equal_size_is_tumbling(ev):
    a = windows.sliding_count(ev, "user_id", "ts", "1 day", "1 day")
    b = windows.tumbling_count(ev, "user_id", "ts", "1 day")
    assert rows(a) == rows(b)


def test_window_join_pairs_within_per_arrival(ev):
    l = ev.filter("event_type = 'purchase'")
    r = ev.filter("event_type = 'error'")
    pairs = joins.tumbling_window_join(l, r, "user_id", "ts", "1 day", ["event_id"],
                                       ["event_id"])
    per = joins.tumbling_join_per_arrival(l, r, "user_id", "ts", "1 day", "event_id")
    a = {(x["l_event_id"], x["r_event_id"]) for x in pairs.collect()}
    b = {(x["l_event_id"], x["r_event_id"]) for x in per.collect()}
    assert a == b


def test_interval_join_bucketed_equals_plain(ev):
    l = ev.filter("event_type = 'purchase'")
    r = ev.filter("event_type = 'error'")
    for lo, hi in [("-3 hours", "3 hours"), ("-1 hour", "5 hours"), ("0 seconds", "2 days")]:
        a = joins.interval_join(l, r, "user_id", "ts", lo, hi, ["event_id"], ["event_id"])
        b = joins.interval_join(l, r, "user_id", "ts", lo, hi, ["event_id"], ["event_id"],
                                bucketed=False)
        assert rows(a) == rows(b)


def test_null_keys_and_times_are_kept(spark):
    """Per-event operators emit one row per input row, NULL key or NULL time
    included (NULL keys form one key, NULL times sort first)."""
    data = [(None, 1_000_000, 1.0, 0), (None, 2_000_000, 5.0, 1), (1, None, 2.0, 2),
            (1, 3_000_000, 9.0, 3), (2, 4_000_000, 1.0, 4)]
    df = spark.createDataFrame(data, "k bigint, us bigint, v double, e bigint")
    df = df.withColumn("ts", ntz_from_us("us"))
    for mode in ("max", "max_by", "reduce"):
        assert rolling.rolling_max(df, "k", "ts", "v", tiebreak=["e"], mode=mode,
                                   keep=["e"]).count() == 5
    c = {r["e"]: r["cnt"] for r in rolling.running_count(
        df, "k", "ts", tiebreak=["e"], keep=["e"]).collect()}
    assert c == {0: 1, 1: 2, 2: 1, 3: 2, 4: 1}
    h = rolling.running_history(df, "k", "ts", "e", depth=3, tiebreak=["e"], keep=["e"])
    assert h.count() == 5
    j = {r["e"] for r in alarms.jump_alarm(df, "k", "ts", "v", 3.0, tiebreak=["e"],
                                           keep=["e"]).collect()}
    assert j == {1, 3}


@pytest.mark.parametrize("bracket", [None, (0.9, 0.95), (0.0, 0.1), (0.5, 0.5)])
def test_exact_median_matches_spark_median(hot, bracket):
    """Sketch-bracketed median equals Spark's exact median, including when
    the bracket misses the middle ranks and the fallback path runs."""
    from eddy.operators.quantiles import exact_median
    d = hot.withColumn("g", (F.col("e") % 3)).union(
        hot.limit(0).withColumn("g", F.lit(None).cast("bigint")))
    d = d.unionByName(d.limit(1).withColumn("v", F.lit(None).cast("double"))
                      .withColumn("k", F.lit(999).cast("bigint")))
    want = rows(d.groupBy("k", "g").agg(F.median("v").alias("m")))
    got = rows(exact_median(d, ["k", "g"], "v", accuracy=50, out="m", bracket=bracket))
    assert got == want


def test_epoch_micros_ignore_session_zone(spark):
    """Event-time arithmetic on timestamp_ntz does not depend on the session
    time zone, even for wall-clock times inside a DST gap."""
    from eddy.functions.columns import epoch_us
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS ts "
                       "UNION ALL SELECT timestamp_ntz'2024-07-01 12:00:00.123456'")
        got = sorted(r[0] for r in df.select(epoch_us("ts")).collect())
        rt = df.select((ntz_from_us(epoch_us("ts")) == F.col("ts")).alias("same")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1710037800000000, 1719835200123456]
    assert all(r["same"] for r in rt)


@pytest.mark.parametrize("vb", [0.5, 2.0, 1000.0])
def test_window_sorted_value_buckets(spark, hot, vb):
    """Value-bucketed in-window ranks equal the plain window sort, with NaN,
    infinities and NULLs present."""
    extra = spark.createDataFrame(
        [(0, 5_000_000, float("nan"), 10_001), (0, 6_000_000, float("inf"), 10_002),
         (0, 7_000_000, float("-inf"), 10_003), (0, 8_000_000, None, 10_004),
         (0, 9_000_000, 1e300, 10_005)], "k bigint, us bigint, v double, e bigint")
    d = hot.select("k", "us", "v", "e").unionByName(extra).withColumn("ts", ntz_from_us("us"))
    a = windows.window_sorted(d, "k", "ts", "1 minute", "v", tiebreak=["e"], keep=["e"])
    b = windows.window_sorted(d, "k", "ts", "1 minute", "v", tiebreak=["e"], keep=["e"],
                              value_bucket=vb)
    assert rows(a.select("e", "rank")) == rows(b.select("e", "rank"))


@pytest.mark.parametrize("bucket", ["20 seconds", "10 minutes", None])
def test_keyed_reduce_matches_sequential_fold(hot, bucket):
    from eddy.operators.udf import keyed_reduce

    def _sum_count_max(acc, new):   # nested: pickled by value for the workers
        return (acc[0] + new[0], acc[1] + new[1], max(acc[2], new[2]))

    d = hot.withColumn("one", F.lit(1).cast("bigint")).withColumn("m", F.col("v"))
    got = keyed_reduce(d, "k", "ts", ["v", "one", "m"], _sum_count_max, tiebreak=["e"],
                       bucket=bucket, keep=["e"], partitions=5)
    want, acc_by_key = [], {}
    for r in d.orderBy("k", "us", "e").collect():
        acc = acc_by_key.get(r["k"])
        new = (r["v"], 1, r["v"])
        acc = new if acc is None else _sum_count_max(acc, new)
        acc_by_key[r["k"]] = acc
        want.append((r["e"], r["k"], acc[0], acc[1], acc[2]))
    assert rows(got.select("e", "k", "v", "one", "m")) == sorted(want)


@pytest.mark.parametrize("max_fold", [100_000, 1])
def test_rise_alarm_nan_is_neither_rise_nor_fall(spark, max_fold):
    df = (spark.createDataFrame([(1, 0, 1.0), (1, 5, float("nan")), (1, 8, 3.0), (1, 12, 4.0)],
                                "k int, s long, v double")
          .withColumn("ts", ntz_from_us(F.col("s") * 1_000_000)))
    got = alarms.rise_alarm(df, "k", "ts", "v", "10 seconds", bucket="5 seconds", max_fold=max_fold)
    assert sorted(r["alarm_ts"].timestamp() - r["z"].timestamp() for r in got.withColumn(
        "z", ntz_from_us(F.lit(0).cast("bigint"))).collect()) == [10.0, 22.0]


def test_doubling_keeps_one_jump_per_instant(spark):
    """24 rises at 6 instants: ties must not multiply the jump table."""
    r = spark.createDataFrame([(i % 6, 0) for i in range(24)], "_t long, _streak long").select(
        F.struct(F.lit(1).alias("k")).alias(alarms.KEY), "_streak", "_t")
    got = alarms._chain_by_doubling(r, 1, bucket="1 second")
    assert sorted(x["_t"] for x in got.collect()) == [0, 2, 4]


@pytest.mark.parametrize("bucket", [None, "1 second", "1 hour"])
def test_history_keeps_null_items(spark, bucket):
    df = (spark.createDataFrame([(1, 0, "x0"), (1, 1, None), (1, 2, "x2"), (1, 3, "x3")],
                                "k int, s long, v string")
          .withColumn("ts", ntz_from_us(F.col("s") * 1_000_000)))
    got = rolling.running_history(df, "k", "ts", "v", depth=5, bucket=bucket)
    assert {r["n_before"]: r["history"] for r in got.collect()} == {
        0: [], 1: ["x0"], 2: ["x0", None], 3: ["x0", None, "x2"]}


def test_keyed_reduce_null_keys(spark):
    from eddy.operators.udf import keyed_reduce

    def _max(acc, new):
        return (max(acc[0], new[0]),)

    df = (spark.createDataFrame([(None, 0, 1.0), (None, 1, 5.0), (None, 2, 2.0), (7, 0, 3.0)],
                                "k long, s long, v double")
          .withColumn("ts", ntz_from_us(F.col("s") * 1_000_000)))
    for bucket in (None, "1 second", "1 hour"):
        got = keyed_reduce(df, "k", "ts", ["v"], _max, bucket=bucket, keep=["s"])
        assert {(r["k"], r["s"]): r["v"] for r in got.collect()} == {
            (None, 0): 1.0, (None, 1): 5.0, (None, 2): 5.0, (7, 0): 3.0}


@pytest.mark.parametrize("values", [[1.0, float("nan"), 5.0, 7.0], [float("-inf"), 2.0, 2.0],
                                    [float("nan"), float("inf"), 1.0], [3.0, 3.0, float("inf")]])
def test_stream_max_by_does_not_depend_on_batches(values):
    import numpy as np
    from eddy.streaming.processors import roll
    best, want = None, []
    for i, v in enumerate(values):
        if best is None or (best == best and (v != v or v > values[want[-1]])):
            best = v
            want.append(i)
        else:
            want.append(want[-1])
    for cut in range(len(values) + 1):
        state, got = None, []
        for part in (range(cut), range(cut, len(values))):
            if len(part):
                t = np.array(part, "int64")
                out, state = roll(1, state, t, t, np.array([values[i] for i in part]))
                got += out["best_t"].tolist()
        assert got == want
