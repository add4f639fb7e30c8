"""Layer 1: golden values on the reference's 33-line data file."""

from pyspark.sql import functions as F

from eddy.operators import alarms, rolling, route, transform, windows
from eddy.sources import parse_readings


def test_counts(sensor_text, readings):
    assert sensor_text.count() == 33
    assert transform.explode_fields(sensor_text).count() == 99
    assert transform.filter_prefix(sensor_text, "value", "sensor_1").count() == 24
    per_id = {r["id"]: r["count"] for r in readings.groupBy("id").count().collect()}
    assert per_id == {"sensor_1": 19, "sensor_10": 5, "sensor_6": 4, "sensor_7": 5}


def test_split_select_connect_union(readings):
    t = route.split_tags(readings, "temperature", 30.0)
    high, low = route.select_tags(t, "high"), route.select_tags(t, "low")
    assert (high.count(), low.count()) == (24, 9)
    assert route.select_tags(t, "high", "low").count() == 33
    cm = route.connect_comap(high, low, "id", "temperature")
    got = {r["status"]: r["count"] for r in cm.groupBy("status").count().collect()}
    assert got == {"high temp warning": 24, "normal": 9}
    assert cm.filter("status = 'normal' AND temperature IS NOT NULL").count() == 0
    assert route.union_all(high, low, route.select_tags(t, "high", "low")).count() == 66
    main, side = route.side_output(readings, F.col("temperature") > 30)
    assert (main.count(), side.count()) == (24, 9)


def _last_per_key(df, order="seq"):
    from pyspark.sql import Window
    w = Window.partitionBy("id").orderBy(F.col("ts").desc(), F.col(order).desc())
    return {r["id"]: (r["timestamp"], r["temperature"]) for r in
            df.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .withColumn("timestamp", F.unix_seconds(F.col("ts").cast("timestamp")))
            .collect()}


def test_rolling_max_variants(readings):
    base = readings.select("seq", "id", "ts", "temperature")
    out = {}
    for mode in ("max", "max_by", "reduce"):
        r = rolling.rolling_max(base, "id", "ts", "temperature", tiebreak=["seq"],
                                bucket="5 seconds", mode=mode, keep=["seq"])
        # last emitted row of each key in event-time order
        j = r.alias("r").join(base.select("seq", F.col("ts").alias("ets")), "seq")
        from pyspark.sql import Window
        w = Window.partitionBy("id").orderBy(F.col("ets").desc(), F.col("seq").desc())
        rows = (j.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
                .select("id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"),
                        "temperature").collect())
        out[mode] = {x["id"]: (x["t"], x["temperature"]) for x in rows}
    assert out["max"]["sensor_1"] == (1547718199, 56.3)
    assert out["max_by"]["sensor_1"] == (1547718207, 56.3)
    assert out["reduce"]["sensor_1"] == (1547718212, 56.3)
    for mode in out:
        assert out[mode]["sensor_10"] == (1547718205, 38.1)
        assert out[mode]["sensor_6"] == (1547718201, 15.4)
    assert out["max_by"]["sensor_7"] == (1547718202, 26.7)


def test_running_counts(readings):
    c0 = rolling.running_count(readings, "id", "ts", tiebreak=["seq"], bucket="5 seconds")
    last = {r["id"]: r["m"] for r in c0.groupBy("id").agg(F.max("cnt").alias("m")).collect()}
    assert last == {"sensor_1": 19, "sensor_10": 5, "sensor_6": 4, "sensor_7": 5}
    c1 = rolling.running_count(readings, "id", "ts", tiebreak=["seq"], initial=1)
    assert c1.agg(F.min("cnt")).first()[0] == 2          # the reference's first emit
    g = rolling.running_count_global(readings, ["ts", "seq"], partitions=3, keep=["seq"])
    vals = sorted(r["cnt"] for r in g.collect())
    assert vals == list(range(1, 34))


def test_jump_alarm_arrival_order(readings):
    """In arrival order (seq), threshold 10: exactly three alarms."""
    j = alarms.jump_alarm(readings, "id", "seq", "temperature", 10.0, bucket=None, keep=["seq"])
    got = sorted((r["seq"], r["id"], r["last_value"], r["temperature"]) for r in j.collect())
    assert got == [(28, "sensor_7", 6.7, 26.7), (30, "sensor_1", 37.1, 56.3),
                   (31, "sensor_1", 56.3, 32.8)]


def test_tumbling_10s(readings):
    t = windows.tumbling_count(readings, "id", "ts", "10 seconds")
    got = {(r["id"], r["window_start"].strftime("%H:%M:%S")): r["cnt"] for r in t.collect()}
    assert got[("sensor_1", "09:43:10")] == 4
    assert got[("sensor_1", "09:43:20")] == 10
    assert got[("sensor_1", "09:43:30")] == 5
    assert got[("sensor_10", "09:43:20")] == 5
    assert got[("sensor_6", "09:43:20")] == 4
    assert got[("sensor_7", "09:43:20")] == 5


def test_parse_modes(spark):
    bad = spark.createDataFrame([("a,1,2.5",), ("b,x,1.0",), ("c,3",)], "value string")
    p = parse_readings(bad, mode="permissive").collect()
    assert [r["_bad"] for r in p] == [False, True, True]
    import pytest
    with pytest.raises(Exception):
        parse_readings(bad.limit(0).union(spark.createDataFrame([("c,3",)], "value string"))
                       ).collect()


def test_java_split_rules(spark):
    df = spark.createDataFrame([("a,b,,",), (",,,",), ("",), (",a,",)], "value string")
    n = {r["value"]: r["n"] for r in transform.explode_fields(df, keep=["value"])
         .groupBy("value").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n.get("a,b,,") == 2 and n.get(",,,") is None and n.get("") == 1 and n.get(",a,") == 2
