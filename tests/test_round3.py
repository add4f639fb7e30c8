"""Findings of the third round on events and streams."""

from datetime import datetime, timedelta

import pytest

from eddy.plans import QUERIES
from eddy.sources.tables import EVENTS_SCHEMA

START = datetime(2024, 1, 1)


def events(spark, tmp_path, rows):
    """Rows ``(event_id, hours, user_id, event_type, value)`` as the driver's table."""
    data = [(e, None if h is None else START + timedelta(hours=h), k, t, v, None) for e, h, k, t, v in rows]
    spark.createDataFrame(data, EVENTS_SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("step", [1, 30])
def test_running_history_is_whole(spark, tmp_path, step):
    d = events(spark, tmp_path, [(i, i * step, k, "view", 1.0) for i in range(9) for k in (7, None)])
    got = {(r.user_id, r.n_before): (r.item, r.history) for r in QUERIES["running_history"](spark, d).collect()}
    assert got == {(k, i): (str(i), ",".join(map(str, range(i)))) for i in range(9) for k in (7, None)}


def test_user_flat_map_is_dealt_over_tasks(spark, tmp_path):
    """One file of few rows is one split; the function runs in all partitions."""
    d = events(spark, tmp_path, [(i, i, 1, "error", 1.0) for i in range(64)])
    out = QUERIES["user_flat_map"](spark, d)
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(r.step, r.n) for r in out.where("event_id = 6").collect()} == {(1, 3), (3, 5)}


def test_cogroup_function_sees_rows_not_frames(spark):
    from pyspark.sql import functions as F

    from eddy.operators.udf import cogroup_apply
    data = [(k, START + timedelta(hours=h), i) for i, (k, h) in enumerate([(1, 0), (1, 1), (1, 9), (None, 0), (None, 2)])]
    df = spark.createDataFrame(data, "user_id long, ts timestamp_ntz, event_id long")

    def both(left, right):
        assert type(left) is type(right) is list
        for r in (left + right)[:1]:
            yield r.user_id, [x.event_id for x in left], [x.event_id for x in right]

    got = cogroup_apply(df.where("event_id % 2 = 0"), df.where("event_id % 2 = 1"), "user_id", "ts", "3 hours", both,
                        "user_id long, l array<long>, r array<long>", tiebreak="event_id")
    order = F.coalesce("user_id", F.lit(0)), F.size("l") + F.size("r")
    assert list(map(tuple, got.orderBy(*order).collect())) == [(None, [4], [3]), (1, [2], []), (1, [0], [1])]


@pytest.mark.parametrize("name", ["stream_running_count_keyed", "stream_rolling_max_by", "stream_rolling_max_by_unordered"])
def test_rolling_streams_call_python_per_bucket_of_keys(spark, tmp_path, monkeypatch, name):
    """Many keys (a NULL one too) in few buckets; equal to the batch form."""
    from eddy.streaming import twins
    of = twins.bucket_of
    monkeypatch.setattr(twins, "bucket_of", lambda key: of(key, 3))
    rows = [(i, (i * 37) % 200, (i % 23) or None, "view", float((i * 7) % 13)) for i in range(300)]
    d = events(spark, tmp_path, rows)
    batch = "running_count_keyed" if "count" in name else "rolling_max_by"
    got, want = (sorted(repr(tuple(r)) for r in QUERIES[q](spark, d).collect()) for q in (name, batch))
    assert got == want


def test_late_split_holds_many_keys_in_a_bucket(spark, monkeypatch):
    from eddy.streaming import process
    from eddy.streaming.runner import ChunkedStream
    monkeypatch.setattr(process, "LATE_BUCKETS", 2)
    rows = [(i % 11 or None, START + timedelta(hours=(i * 29) % 100), i, START + timedelta(seconds=i)) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, event_id long, arrived timestamp_ntz")
    got = ChunkedStream(spark, "late", df, "arrived", 3, no_data="never").run(
        lambda s: process.stream_late_split(s, "k", "ts", ["event_id"], 5 * 3_600_000_000)).collect()
    most, want = {}, {}
    for k, at, i, _ in rows:
        before = most.get(k)
        want[i] = (k, before is not None and at <= before - timedelta(hours=5))
        most[k] = max(before or at, at)
    assert {r.event_id: (r.k, r.late) for r in got} == want and len(got) == len(rows)
