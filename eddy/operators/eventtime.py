"""Event time helpers: monotone timestamps, late-row marking, ingestion
stamps (E3-E5). Watermarks themselves (E1/E2) are ``withWatermark`` on
streams, see ``eddy.streaming``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import duration_us
from .scan import KeyedOrder, keyed_scan


def _running_max_ts(df, key, ts, arrival, bucket_col, inclusive: bool, out: str):
    keys = [key] if isinstance(key, str) else list(key)
    ko = KeyedOrder(keys, arrival[0], list(arrival[1:]), None, bucket_col)
    frame = ko.running() if inclusive else ko.ordered().rowsBetween(
        Window.unboundedPreceding, -1)
    return keyed_scan(
        df, ko,
        within={"_wmax": F.max(ts).over(frame)},
        summary={"_bmax": F.max(ts)},
        carry={"_pmax": lambda k: F.max("_bmax").over(k.buckets_before())},
        result={out: F.greatest("_pmax", "_wmax")}).drop("_tb", "_k")


def monotone_ts(df: DataFrame, key, ts: str, arrival: list[str],
                bucket_col: Column | None = None, out: str = "monotone_ts") -> DataFrame:
    """``ts := max(ts seen so far)`` per key in arrival order (the
    reference's timestamp extractor returns the running maximum)."""
    return _running_max_ts(df, key, ts, arrival, bucket_col, True, out)


def late_events(df: DataFrame, key, ts: str, arrival: list[str], delay: str,
                bucket_col: Column | None = None) -> DataFrame:
    """Rows whose event time is at or below the bounded-out-of-order
    watermark (max ts of the key's earlier arrivals minus ``delay``)."""
    d = _running_max_ts(df, key, ts, arrival, bucket_col, False, "_prior_max")
    wm = F.col("_prior_max") - F.expr(f"INTERVAL {duration_us(delay)} MICROSECONDS")
    return (d.withColumn("watermark", wm)
            .filter(F.col("watermark").isNotNull() & (F.col(ts) <= F.col("watermark")))
            .drop("_prior_max"))


def ingest_stamp(df: DataFrame, out: str = "ingest_ts") -> DataFrame:
    """E5: ingestion time, stamped once when the row enters the job."""
    return df.withColumn(out, F.current_timestamp())
