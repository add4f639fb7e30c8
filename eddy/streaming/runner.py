"""Running a Structured Streaming query over a table, chunk by chunk.

The reference reads unbounded sockets. Here the unbounded source is a
folder of parquet files (``readStream.parquet``): Spark stages the table into
that folder in event-time chunks; after each chunk the streaming query is
(re)started from its checkpoint with ``trigger(availableNow=True)`` and
processes exactly the new files. So every run also exercises the
checkpoint/restore path of the reference's fault-tolerance demo.

All folders (source, checkpoint, sink) live under ``spark.checkpoint.dir``,
the shared folder of the cluster. The sink is parquet in append mode; the
query result is read back with ``spark.read``.
"""

from __future__ import annotations

import os
import sys
from dataclasses import dataclass
from datetime import timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_us
from ..session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: how far past the last event the end of input lies: beyond any window, gap,
#: watermark delay or timer
FLUSH_DAYS = 3650

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
SHUFFLE = "spark.sql.shuffle.partitions"


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@dataclass
class ChunkedStream:
    """Stage ``table`` into a stream source folder in ``chunks`` event-time
    ranges and run ``build(stream)`` after each one.

    build:   streaming DataFrame -> streaming DataFrame to sink
    ts:      event-time column of ``table`` used to cut the chunks
    splits:  optional explicit cut points as fractions of the time span
    no_data: when to let Spark run a trailing batch without input after the
             watermark moved: "always", "last" (only after the final chunk:
             enough for watermark-closed windows and timers, since the next
             chunk's batch closes them otherwise) or "never" (operators that
             emit eagerly: joins, per-row state)
    state_partitions: partitions of the stream's shuffles and state stores,
             fixed by the checkpoint at the first start. Default: the session's
             ``spark.sql.shuffle.partitions``, whatever cluster starts it first.
    flush:   end of input: after the last chunk one copied row with all its
             times far past the last event moves the watermark, so that every
             window, session, timer and waiting row of the input is emitted.
             Only for operators that emit at the watermark: the copied row's
             own window never closes, so it leaves no output.
    state_store: state store provider for the stream (default RocksDB: large
             state stays off the JVM heap; changelog checkpointing uploads only
             each batch's changes). ``None`` keeps the session's provider.
    """
    spark: SparkSession
    name: str
    table: DataFrame
    ts: str
    chunks: int = 3
    splits: list[float] | None = None
    output_mode: str = "append"
    no_data: str = "last"
    state_partitions: int | None = None
    state_store: str | None = ROCKSDB
    flush: bool = False

    def _bounds(self) -> list[int]:
        # one small aggregate (two numbers) to place the cuts
        row = self.table.agg(F.min(epoch_us(self.ts)).alias("lo"),
                             F.max(epoch_us(self.ts)).alias("hi")).first()
        lo, hi = row["lo"], row["hi"]
        if lo is None:
            return []
        fr = self.splits or [i / self.chunks for i in range(1, self.chunks)]
        return [lo + int((hi - lo) * f) for f in fr]

    def staged(self, src: str):
        """Append each event-time chunk of the table to the source folder
        ``src``; yields ``(streaming DataFrame over src, is_last_chunk)``
        after each append."""
        schema = self.table.schema
        edges = [None, *self._bounds(), None]
        us = epoch_us(self.ts)
        for lo, hi in zip(edges[:-1], edges[1:]):
            cond = F.lit(True)
            if lo is not None:
                cond = cond & (us >= F.lit(lo))
            if hi is not None:
                cond = cond & (us < F.lit(hi))
            self.table.filter(cond).write.mode("append").parquet(src)
            yield self.spark.readStream.schema(schema).parquet(src), hi is None and not self.flush
        if self.flush:
            self._end_row().write.mode("append").parquet(src)
            yield self.spark.readStream.schema(schema).parquet(src), True

    def _end_row(self) -> DataFrame:
        """One row of the table with its times ``FLUSH_DAYS`` past the last one."""
        times = [f.name for f in self.table.schema if f.dataType.typeName().startswith("timestamp")]
        end = self.table.agg(*[F.max(t).alias(t) for t in times]).first()
        far = {t: F.lit(max(end) + timedelta(days=FLUSH_DAYS)).cast(self.table.schema[t].dataType)
               for t in times} if None not in end else {}
        return self.table.limit(1).withColumns(far)

    def _partitions(self) -> int:
        return self.state_partitions or int(self.spark.conf.get(SHUFFLE, "200"))

    def _start(self, writer, last: bool):
        want = {"always": True, "never": False, "last": last}[self.no_data]
        settings = {NO_DATA: "true" if want else "false", SHUFFLE: str(self._partitions())}
        if self.state_store:
            settings[PROVIDER] = self.state_store
            if self.state_store == ROCKSDB:
                settings[CHANGELOG] = "true"
        saved = {k: self.spark.conf.get(k, None) for k in settings}
        # the query copies the session conf when it starts; restore after
        for k, v in settings.items():
            self.spark.conf.set(k, v)
        try:
            q = writer.trigger(availableNow=True).start()
        finally:
            for k, v in saved.items():
                if v is None:
                    self.spark.conf.unset(k)
                else:
                    self.spark.conf.set(k, v)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if os.environ.get("EDDY_STREAM_DEBUG"):
            for p in q.recentProgress:
                print("eddy-stream", self.name, p["batchId"], p["numInputRows"],
                      p["durationMs"], file=sys.stderr)

    def run(self, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        root = scratch_path(self.spark, self.name)
        ckpt, sink = f"{root}/checkpoint", f"{root}/sink"
        out_schema = None
        for stream, last in self.staged(f"{root}/source"):
            out = build(stream)
            out_schema = out.schema
            self._start(out.writeStream.format("parquet").option("path", sink)
                        .option("checkpointLocation", ckpt).outputMode(self.output_mode), last)
        return self.spark.read.schema(out_schema).parquet(sink)


def split_sink(spark: SparkSession, name: str, table: DataFrame, ts: str,
               build: Callable[[DataFrame], DataFrame], routes: dict,
               chunks: int = 3) -> dict[str, DataFrame]:
    """Side outputs on a stream (M6): one ``foreachBatch`` writes every route
    of a micro-batch (``routes``: name -> predicate Column, rows where it is
    NULL go nowhere) to its own parquet folder. Each batch writes into
    ``<route>/batch=<id>`` with overwrite, so a batch re-run after a failure
    replaces its own output instead of duplicating it. The batch is cached
    once and read by all routes. Returns name -> batch DataFrame."""
    root = scratch_path(spark, name)
    src, ckpt = f"{root}/source", f"{root}/checkpoint"
    outs = {r: f"{root}/{r}" for r in routes}
    out_schema = None

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            for r, pred in routes.items():
                (batch_df.filter(pred).write.mode("overwrite")
                 .parquet(f"{outs[r]}/batch={batch_id}"))
        finally:
            batch_df.unpersist()

    cs = ChunkedStream(spark, name, table, ts, chunks, no_data="never")
    for stream, last in cs.staged(src):
        out = build(stream)
        out_schema = out.schema
        cs._start(out.writeStream.foreachBatch(write).option("checkpointLocation", ckpt), last)
    return {r: spark.read.schema(out_schema).parquet(p) for r, p in outs.items()}
