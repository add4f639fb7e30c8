"""Keyed ordered scans that do not put a whole key into one task.

A per-event operator ("emit one row per input, using everything earlier for
the same key") is a running window ``partitionBy(key).orderBy(ts)``. On a
cluster that window sends every row of a key to one task, so one hot key
(a third of all rows, say) becomes one giant sort.

``keyed_scan`` splits the scan in two levels:

1. rows are partitioned by ``(key, time bucket)``; the running value is
   computed inside each bucket with a window;
2. each bucket is summarised to one row (count, max, last, ...) by a partial
   aggregate; a window over the *summary* (``#buckets`` rows per key) carries
   the value of all earlier buckets;
3. the carry is joined back on ``(key, bucket)`` -- the big side is already
   hash-partitioned on exactly those columns, so only the small summary moves
   (or AQE broadcasts it once it has measured its size).

The result equals the plain per-key window for any associative carry
(count, sum, max, arg-max, last value, bounded history).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import duration_us, epoch_us

TB = "_tb"
KEY = "_k"
# bucket of rows without event time: before every real bucket
NULL_BUCKET = -(2 ** 62)


@dataclass
class KeyedOrder:
    """Key columns, event time and unique tie-breaks, plus the time-bucket
    width of the two-level scan (``None``: one bucket per key)."""
    keys: list[str]
    ts: str
    tiebreak: list[str] = field(default_factory=list)
    bucket: str | int | None = "1 hour"
    # optional explicit bucket expression (e.g. for a numeric arrival order)
    bucket_col: Column | None = None

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tiebreak]

    @property
    def pkeys(self) -> list[str]:
        # the key columns travel as one struct: a struct is never NULL, so
        # joins on it keep rows whose key is NULL (they form one key, as in
        # a window's partitionBy)
        return [KEY, TB]

    # window specs inside one (key, bucket)
    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.pkeys).orderBy(*self.order)

    def running(self) -> WindowSpec:
        return self.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def whole_bucket(self) -> WindowSpec:
        return Window.partitionBy(*self.pkeys)

    # window specs over the per-bucket summary
    def buckets(self) -> WindowSpec:
        return Window.partitionBy(KEY).orderBy(TB)

    def buckets_before(self) -> WindowSpec:
        return self.buckets().rowsBetween(Window.unboundedPreceding, -1)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        if TB in df.columns and KEY in df.columns:
            return df
        df = df.withColumn(KEY, F.struct(*[F.col(c) for c in self.keys]))
        if self.bucket_col is not None:
            tb = self.bucket_col.cast("bigint")
        elif self.bucket is None:
            tb = F.lit(0).cast("bigint")
        else:
            w = duration_us(self.bucket)
            tb = F.floor(epoch_us(self.ts) / F.lit(w)).cast("bigint")
        return df.withColumn(TB, F.coalesce(tb, F.lit(NULL_BUCKET).cast("bigint")))


def strip(df: DataFrame) -> DataFrame:
    """Drop the scan's internal key/bucket columns."""
    return df.drop(KEY, TB)


def keyed_scan(df: DataFrame, ko: KeyedOrder, *,
               within: dict[str, Column],
               summary: dict[str, Column],
               carry: dict[str, Callable[[KeyedOrder], Column]],
               result: dict[str, Column],
               drop: bool = True) -> DataFrame:
    """Run a two-level ordered scan.

    within:  window expressions over ``ko.ordered()/running()`` (one bucket)
    summary: aggregates per ``(key, bucket)``
    carry:   per-bucket values from earlier buckets (windows over the
             summary, e.g. ``F.sum('n').over(ko.buckets_before())``)
    result:  final columns combining within-bucket and carried values
    """
    d = ko.with_bucket(df)
    big = d.select("*", *[c.alias(n) for n, c in within.items()])
    summ = d.groupBy(*ko.pkeys).agg(*[c.alias(n) for n, c in summary.items()])
    prior = summ.select(*ko.pkeys, *[fn(ko).alias(n) for n, fn in carry.items()])
    j = big.join(prior, on=ko.pkeys, how="inner")
    out = j.select("*", *[c.alias(n) for n, c in result.items()])
    if drop:
        internal = set(within) | set(carry)
        out = out.drop(*[c for c in internal if c not in result])
    return out


def previous_value(df: DataFrame, ko: KeyedOrder, value: str,
                   out: str = "prev") -> DataFrame:
    """``lag(value)`` per key in (ts, tie-break) order, split by bucket."""
    last_of_bucket = F.max(F.struct(*[F.col(c) for c in ko.order],
                                    F.col(value).alias("_v")))["_v"]
    return keyed_scan(
        df, ko,
        within={"_wprev": F.lag(value).over(ko.ordered()),
                "_wrn": F.row_number().over(ko.ordered())},
        summary={"_blast": last_of_bucket},
        carry={"_pprev": lambda k: F.lag("_blast").over(k.buckets())},
        result={out: F.when(F.col("_wrn") == 1, F.col("_pprev"))
                .otherwise(F.col("_wprev"))},
    ).drop("_wrn", "_wprev", "_pprev")


def running_sum(df: DataFrame, ko: KeyedOrder, value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` per key, split by bucket."""
    return keyed_scan(
        df, ko,
        within={"_wsum": F.sum(value).over(ko.running())},
        summary={"_bsum": F.sum(value)},
        carry={"_psum": lambda k: F.sum("_bsum").over(k.buckets_before())},
        result={out: F.coalesce(F.col("_psum"), F.lit(0)) + F.col("_wsum")},
    ).drop("_wsum", "_psum")
