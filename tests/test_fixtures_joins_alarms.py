"""Layer 1 continued: the two-stream inputs shown in the reference's
comments, the rise-alarm state machine cases, and exact boundaries."""

import pytest
from pyspark.sql import functions as F

from eddy.functions.columns import ntz_from_us
from eddy.operators import alarms, joins, windows

S = 1_000_000  # microseconds per second


def _pairs(spark, rows, t0=0):
    """rows: list of (side, k, v, seconds) -> two DataFrames (k, v, ts, seq)."""
    data = [(s, k, v, int((t0 + sec) * S), i) for i, (s, k, v, sec) in enumerate(rows)]
    df = spark.createDataFrame(data, "side int, k string, v string, us bigint, seq bigint")
    df = df.withColumn("ts", ntz_from_us("us")).drop("us")
    return (df.filter("side = 1").drop("side"), df.filter("side = 2").drop("side"))


def test_window_join_fixture(spark):
    rows = [(1, "1", "hello", 0.0), (1, "2", "world", 0.1), (1, "3", "shinelon", 0.2),
            (1, "5", "lllll", 0.3), (1, "4", "sssss", 0.4),
            (2, "1", "hello", 0.5), (2, "2", "limig", 0.6), (2, "3", "nihao", 0.7),
            (2, "4", "oooo", 0.8)]
    l, r = _pairs(spark, rows)
    j = joins.tumbling_window_join(l, r, "k", "ts", "5 seconds", ["v"], ["v"], text=("v", "v"))
    assert sorted(x["joined"] for x in j.collect()) == [
        "hello hello", "shinelon nihao", "sssss oooo", "world limig"]
    per = joins.tumbling_join_per_arrival(l, r, "k", "ts", "5 seconds", "seq")
    # each pair is re-emitted on every later arrival in the window
    assert per.count() >= j.count()
    assert {x["l_seq"] for x in per.collect()} <= {0, 1, 2, 3, 4}


def test_cogroup_fixture(spark):
    rows = [(1, "1", "lj", 0.0), (1, "1", "al", 0.1), (1, "2", "af", 0.2),
            (2, "2", "ac", 0.3), (2, "1", "ao", 0.4), (2, "2", "14", 0.5)]
    l, r = _pairs(spark, rows)
    g = {x["k"]: x["text"] for x in
         joins.cogroup_session(l, r, "k", "ts", "5 seconds", "v", tiebreak=["seq"]).collect()}
    assert g["1"] == "input stream 1: \n1=>lj\n1=>al\ninput stream 2: \n1=>ao\n"
    assert g["2"] == "input stream 1: \n2=>af\ninput stream 2: \n2=>ac\n2=>14\n"
    per = joins.cogroup_per_arrival(l, r, "k", "ts", "5 seconds", "v", "seq", bucket="1 second")
    last = {x["k"]: x["text"] for x in per.collect() if x["arrival_id"] in (4, 5)}
    assert last == g


def test_interval_join_bounds(spark):
    """+-3 s, both ends inclusive; 3.001 s is out. Bucketed = plain."""
    rows = [(1, "a", "L", 10.0),
            (2, "a", "m3", 7.0), (2, "a", "p3", 13.0),
            (2, "a", "m3x", 6.999), (2, "a", "p3x", 13.001), (2, "b", "other", 10.0)]
    l, r = _pairs(spark, rows)
    for bucketed in (True, False):
        j = joins.interval_join(l, r, "k", "ts", "-3 seconds", "3 seconds", ["v"], ["v"],
                                bucketed=bucketed)
        assert sorted(x["r_v"] for x in j.collect()) == ["m3", "p3"]


def test_session_gap_boundary(spark):
    """Events exactly one gap apart share a session; gap + 1 us splits."""
    rows = [(1, "a", "x", 0.0), (1, "a", "y", 5.0), (1, "b", "x", 0.0),
            (1, "b", "y", 5.000001)]
    l, _ = _pairs(spark, rows)
    s = {x["k"]: x["cnt"] for x in windows.session_count(l, "k", "ts", "5 seconds").collect()}
    assert s["a"] == 2
    n_b = windows.session_count(l, "k", "ts", "5 seconds").filter("k = 'b'").count()
    assert n_b == 2
    ids = joins.session_ids(l, "k", "ts", "5 seconds", ["seq"], bucket="1 second")
    got = {(x["k"], x["seq"]): x["session_id"] for x in ids.collect()}
    assert got[("a", 0)] == got[("a", 1)] and got[("b", 2)] != got[("b", 3)]


def test_window_edges(spark):
    rows = [(1, "a", "start", 10.0), (1, "a", "end", 20.0)]
    l, _ = _pairs(spark, rows)
    t = windows.tumbling_count(l, "k", "ts", "10 seconds").collect()
    assert sorted(x["cnt"] for x in t) == [1, 1]    # [10, 20) holds 10, not 20


RISE_CASES = {
    "steady rise": ([(0, 1), (5, 2), (12, 3)], [10, 22], None),
    "fall cancels": ([(0, 1), (5, 2), (8, 1), (20, 1)], [], None),
    "plateau keeps timer": ([(0, 1), (5, 1), (11, 1)], [10], None),
    "fall exactly at due time": ([(0, 1), (10, 0), (20, 0)], [], None),
    "fall just after due time": ([(0, 1), (10.001, 0)], [10], None),
    "negative start": ([(0, -5), (3, -4), (14, -4)], [10], None),
    "negative start, floor": ([(0, -5), (3, -4), (14, -4)], [13], 4.9e-324),
}


def _rise_df(spark, cases):
    data, i = [], 0
    for key, (rows, _, _) in cases.items():
        for sec, v in rows:
            data.append((key, int(sec * S), float(v), i))
            i += 1
    df = spark.createDataFrame(data, "key string, us bigint, value double, seq bigint")
    return df.withColumn("ts", ntz_from_us("us"))


@pytest.mark.parametrize("name", list(RISE_CASES))
def test_rise_alarm_cases(spark, name):
    rows, want, floor = RISE_CASES[name]
    df = _rise_df(spark, {name: RISE_CASES[name]})
    a = alarms.rise_alarm(df, "key", "ts", "value", "10 seconds", tiebreak=["seq"],
                          bucket="4 seconds", first_floor=floor)
    got = sorted(round(x["s"], 3) for x in a.select(
        (F.unix_micros(F.col("alarm_ts").cast("timestamp")) / S).alias("s")).collect())
    assert got == want


def test_rise_alarm_keys_independent(spark):
    cases = {k: v for k, v in RISE_CASES.items() if v[2] is None}
    df = _rise_df(spark, cases)
    a = alarms.rise_alarm(df, "key", "ts", "value", "10 seconds", tiebreak=["seq"])
    got = {}
    for x in a.select("key", (F.unix_micros(F.col("alarm_ts").cast("timestamp")) / S)
                      .alias("s")).collect():
        got.setdefault(x["key"], []).append(round(x["s"], 3))
    for k, (_, want, _) in cases.items():
        assert sorted(got.get(k, [])) == want, k
