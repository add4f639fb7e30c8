"""Findings of the third round on keyed process functions of streams."""

from datetime import datetime, timedelta

from eddy.functions.columns import to_event_time
from eddy.streaming import process
from eddy.streaming.runner import ChunkedStream


def test_keyed_process_calls_by_bucket(spark, monkeypatch, tmp_path):
    """many keys share a call, and each keeps its own list, map, value and timers
    over micro-batches; a NULL integer stays NULL and leaves the others exact."""
    class Counts(process.KeyedProcess):
        """Rows of a key so far by kind, the list of all ids, and a timer a second later."""
        output = "k double, n int, at long, ids array<long>, kinds map<string, int>, extra long"
        states = {"ids": ("list", "long"), "kinds": ("map", "int"), "n": ("value", "int")}

        def process(self, row, ctx):
            ctx.state("ids").append(row.event_id)
            ctx.state("kinds").put(row.kind, ctx.state("kinds").get(row.kind, 0) + 1)
            ctx.state("n").update((ctx.state("n").get() or 0) + 1)
            ctx.register_timer(ctx.timestamp + 1_000_000)
            yield ctx.key[0], ctx.state("n").get(), ctx.timestamp, None, None, row.extra

        def on_timer(self, at_us, ctx):
            yield ctx.key[0], ctx.state("n").get(), at_us, ctx.state("ids").get(), ctx.state("kinds").items(), None
            if ctx.state("n").get() % 7 == 0:
                ctx.state("ids").clear()
                ctx.state("kinds").clear()

    monkeypatch.setattr(process, "PROCESS_BUCKETS", 4)
    monkeypatch.setattr(process, "CHUNK", 5)
    seen, calls = process.Processor.handleInputRows, str(tmp_path)

    def counting(self, key, rows, timerValues):
        import tempfile
        tempfile.mkdtemp(dir=calls)
        yield from seen(self, key, rows, timerValues)

    monkeypatch.setattr(process.Processor, "handleInputRows", counting)
    keys = [None, *map(float, range(40))]
    rows = [(keys[i * 31 % 41], datetime(2024, 1, 1) + timedelta(seconds=i // 3), i, "abc"[i % 3], None if i % 11 == 0 else 2 ** 60 + i)
            for i in range(1200)]
    df = spark.createDataFrame(rows, "k double, ts timestamp_ntz, event_id long, kind string, extra long")

    def build(s):
        s = s.withColumn("ets", to_event_time("ts")).drop("ts").withWatermark("ets", "2 seconds")
        return process.stream_keyed_process(s, "k", "ets", Counts(), tiebreak="event_id")

    def sorted_rows(out):
        return sorted((repr((r.k, r.n, r.at, r.ids and sorted(r.ids), r.kinds and sorted(r.kinds.items()), r.extra)) for r in out), key=str)
    got = sorted_rows(ChunkedStream(spark, "buckets", df, "ts", 3, flush=True).run(build).collect())
    held = {}
    want = []
    for k, at, i, kind, extra in rows:
        held.setdefault(k, []).append((int((at - datetime(1970, 1, 1)) / timedelta(microseconds=1)), i, kind, extra))
    for k, own in held.items():
        ids, kinds, n = [], {}, 0
        for j, (at, i, kind, extra) in enumerate(own):
            n += 1
            ids.append(i)
            kinds[kind] = kinds.get(kind, 0) + 1
            want.append(repr((k, n, at, None, None, extra)))
            # a key's rows lie more than a second apart, so each row's timer fires before the next
            assert j + 1 == len(own) or own[j + 1][0] > at + 1_000_000
            want.append(repr((k, n, at + 1_000_000, sorted(ids), sorted(kinds.items()), None)))
            if n % 7 == 0:
                ids, kinds = [], {}
    assert got == sorted(want, key=str)
    assert 0 < len(list(tmp_path.iterdir())) <= 4 * 2 * 4  # chunks, choices of NULL keys, buckets
