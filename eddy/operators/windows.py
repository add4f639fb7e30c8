"""Time windows with incremental and full-window aggregation.

The same functions serve batch and streaming DataFrames (for a stream, add
``withWatermark`` first; see ``streaming``). Windows are ``[start, end)``,
aligned to the epoch. Output windows are flattened to
``window_start``/``window_end`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_median


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _flatten(df: DataFrame, wcol: str, prefix: str = "window") -> DataFrame:
    cols = [c for c in df.columns if c != wcol]
    return df.select(F.col(f"{wcol}.start").alias(f"{prefix}_start"),
                     F.col(f"{wcol}.end").alias(f"{prefix}_end"), *cols)


def window_agg(df: DataFrame, key, ts: str, size: str, aggs: dict[str, Column],
               slide: str | None = None) -> DataFrame:
    """Tumbling (``slide=None``) or sliding window aggregation per key.
    Built-in aggregates are split into partial (map side) and final."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = df.groupBy(*_keys(key), w.alias("_w")).agg(
        *[c.alias(n) for n, c in aggs.items()])
    return _flatten(g, "_w").select(*_keys(key), "window_start", "window_end", *aggs)


def session_agg(df: DataFrame, key, ts: str, gap: str,
                aggs: dict[str, Column]) -> DataFrame:
    """Event-time session windows per key (W3/W4): a session ends once no
    event of the key arrives for ``gap``; end = last event + gap. Spark merges
    sessions inside each input partition before the shuffle, so a busy key
    ships partial sessions, not rows."""
    g = df.groupBy(*_keys(key), F.session_window(ts, gap).alias("_w")).agg(
        *[c.alias(n) for n, c in aggs.items()])
    g = g.select(*_keys(key), F.col("_w.start").alias("session_start"),
                 F.col("_w.end").alias("session_end"), *aggs)
    return g


def tumbling_count(df, key, ts, size, out="cnt"):
    """W1 (+W6): the incremental count of the reference's AggregateFunction."""
    return window_agg(df, key, ts, size, {out: F.count(F.lit(1))})


def sliding_count(df, key, ts, size, slide, out="cnt"):
    """W2."""
    return window_agg(df, key, ts, size, {out: F.count(F.lit(1))}, slide=slide)


def session_count(df, key, ts, gap, out="cnt"):
    """W3."""
    return session_agg(df, key, ts, gap, {out: F.count(F.lit(1))})


def window_sum_min_max(df, key, ts, size, value, digits: int = 2):
    """Incremental sum / min / max per window (sum rounded to the data's
    precision so that it does not depend on summation order)."""
    return window_agg(df, key, ts, size, {
        "cnt": F.count(F.lit(1)),
        "sum_value": F.round(F.sum(value), digits),
        "min_value": F.min(value),
        "max_value": F.max(value)})


def window_median(df, key, ts, size, value, exact: bool = True, digits: int = 3,
                  accuracy: int = 10000):
    """Full-window median per key. ``exact`` uses the two-pass
    sketch-bracketed median of ``quantiles.exact_median`` (no window's
    values are buffered in one task); otherwise ``percentile_approx``
    (fixed-size sketch, partial aggregation)."""
    if not exact:
        return window_agg(df, key, ts, size, {"median_value": F.round(
            F.percentile_approx(value, 0.5, accuracy), digits)})
    keys = _keys(key)
    d = df.withColumn("_w", F.window(ts, size))
    m = exact_median(d, [*keys, "_w"], value, accuracy=accuracy, out="_m")
    return m.select(*keys, F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"),
                    F.round("_m", digits).alias("median_value"))


def window_sorted(df, key, ts, size, value, tiebreak=(), keep=(),
                  value_bucket: float | None = None):
    """The elements of each window in sorted order (by value, then time
    and tie-breaks), as a rank column per element.

    ``value_bucket`` splits a busy window: rows are partitioned by
    (key, window, value range of that width); the rank is the row number
    inside the range plus the row count of all lower ranges of the window
    (a two-level keyed scan over value instead of time). NaN and infinities
    fall into the outermost ranges, keeping Spark's value order."""
    from .scan import KeyedOrder, keyed_scan
    keys = _keys(key)
    d = df.withColumn("_w", F.window(ts, size))
    if value_bucket is None:
        w = Window.partitionBy(*keys, "_w").orderBy(F.col(value), F.col(ts),
                                                    *[F.col(c) for c in tiebreak])
        d = d.withColumn("rank", F.row_number().over(w).cast("bigint"))
    else:
        scaled = F.col(value) / F.lit(float(value_bucket))
        vb = F.floor(F.least(F.greatest(scaled, F.lit(-4e18)), F.lit(4e18)))
        ko = KeyedOrder([*keys, "_w"], value, [ts, *tiebreak], None, vb)
        d = keyed_scan(
            d, ko,
            within={"_wrn": F.row_number().over(ko.ordered())},
            summary={"_bn": F.count(F.lit(1))},
            carry={"_pn": lambda k: F.sum("_bn").over(k.buckets_before())},
            result={"rank": (F.coalesce("_pn", F.lit(0)) + F.col("_wrn")).cast("bigint")})
    return d.select(*keys, F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"), *keep, value, "rank")
