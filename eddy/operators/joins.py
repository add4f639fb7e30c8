"""Two-stream joins: tumbling-window join, interval join, session cogroup
and their per-arrival (count-trigger) emissions (J1-J5).

Both inputs carry the same key and event-time column names; every other
column is taken from the side given and prefixed ``l_`` / ``r_``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import concat_pair, duration_us, epoch_us, fold_block
from ..functions.fixed import COGROUP_HEADER_LEFT, COGROUP_HEADER_RIGHT
from .scan import KeyedOrder, previous_value, running_sum


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _side(df: DataFrame, keys, ts, cols, prefix) -> DataFrame:
    return df.select(*keys, F.col(ts).alias(f"{prefix}{ts}"),
                     *[F.col(c).alias(f"{prefix}{c}") for c in cols])


def tumbling_window_join(left: DataFrame, right: DataFrame, key, ts: str,
                         size: str, left_cols, right_cols,
                         text: tuple[str, str] | None = None) -> DataFrame:
    """Pairs of the same key that fall into the same tumbling window.
    An equi-join on ``(key, window_start)``: the window is part of the join
    key, so a hot key is spread over its windows."""
    keys = _keys(key)
    l = _side(left, keys, ts, left_cols, "l_").withColumn(
        "window_start", F.window(f"l_{ts}", size)["start"])
    r = _side(right, keys, ts, right_cols, "r_").withColumn(
        "window_start", F.window(f"r_{ts}", size)["start"])
    j = l.join(r, on=[*keys, "window_start"], how="inner")
    cols = [*keys, "window_start", f"l_{ts}", f"r_{ts}",
            *[f"l_{c}" for c in left_cols], *[f"r_{c}" for c in right_cols]]
    if text:
        return j.select(*cols, concat_pair(f"l_{text[0]}", f"r_{text[1]}").alias("joined"))
    return j.select(*cols)


def interval_join(left: DataFrame, right: DataFrame, key, ts: str,
                  lower: str, upper: str, left_cols, right_cols,
                  text: tuple[str, str] | None = None,
                  bucketed: bool = True) -> DataFrame:
    """Pairs with ``left.ts + lower <= right.ts <= left.ts + upper``
    (both ends inclusive) and equal keys.

    ``bucketed=True`` adds a time bucket of width ``upper - lower`` to the
    equi-key: the left row takes its bucket, the right row is copied to the
    (at most two) left buckets its range can touch. Each pair is found exactly
    once, and no task ever holds a whole key -- only one bucket of it."""
    keys = _keys(key)
    lo, hi = duration_us(lower), duration_us(upper)
    l = _side(left, keys, ts, left_cols, "l_")
    r = _side(right, keys, ts, right_cols, "r_")
    cond_range = ((F.col(f"r_{ts}") >= F.col(f"l_{ts}") + F.expr(f"INTERVAL {lo} MICROSECONDS"))
                  & (F.col(f"r_{ts}") <= F.col(f"l_{ts}") + F.expr(f"INTERVAL {hi} MICROSECONDS")))
    if bucketed:
        width = max(hi - lo, 1)
        l = l.withColumn("_b", F.floor(epoch_us(f"l_{ts}") / F.lit(width)).cast("bigint"))
        rus = epoch_us(f"r_{ts}")
        r = r.withColumn("_b", F.explode(F.sequence(
            F.floor((rus - F.lit(hi)) / F.lit(width)).cast("bigint"),
            F.floor((rus - F.lit(lo)) / F.lit(width)).cast("bigint"))))
        j = l.join(r, on=[*keys, "_b"], how="inner").filter(cond_range)
    else:
        j = l.join(r, on=keys, how="inner").filter(cond_range)
    cols = [*keys, f"l_{ts}", f"r_{ts}", *[f"l_{c}" for c in left_cols],
            *[f"r_{c}" for c in right_cols]]
    if text:
        return j.select(*cols, concat_pair(f"l_{text[0]}", f"r_{text[1]}").alias("joined"))
    return j.select(*cols)


def _tagged_union(left, right, keys, ts, tiebreak, value):
    pick = [*keys, ts, *tiebreak, F.col(value).cast("string").alias("_v")]
    return (left.select(*pick, F.lit(1).alias("_side"))
            .unionByName(right.select(*pick, F.lit(2).alias("_side"))))


def _blocks(items_l, items_r):
    return F.concat(fold_block(COGROUP_HEADER_LEFT, items_l),
                    fold_block(COGROUP_HEADER_RIGHT, items_r))


def cogroup_session(left: DataFrame, right: DataFrame, key, ts: str, gap: str,
                    value: str, tiebreak=()) -> DataFrame:
    """Cogroup of two streams over shared session windows (sessions are
    formed from both sides' events together); a group is emitted even when
    one side is empty. Output: key, session bounds, side counts and the text
    block of the reference's CoGroupFunction (items in event-time order)."""
    keys, tb = _keys(key), list(tiebreak)
    u = _tagged_union(left, right, keys, ts, tb, value)
    item = F.struct(F.col(ts).alias("_o"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(tb)],
                    F.col(keys[0]).alias("k"), F.col("_v").alias("v"))
    g = u.groupBy(*keys, F.session_window(ts, gap).alias("_w")).agg(
        F.array_sort(F.collect_list(F.when(F.col("_side") == 1, item))).alias("_l"),
        F.array_sort(F.collect_list(F.when(F.col("_side") == 2, item))).alias("_r"))
    return g.select(*keys, F.col("_w.start").alias("session_start"),
                    F.col("_w.end").alias("session_end"),
                    F.size("_l").cast("bigint").alias("n_left"),
                    F.size("_r").cast("bigint").alias("n_right"),
                    _blocks(F.col("_l"), F.col("_r")).alias("text"))


def tumbling_join_per_arrival(left: DataFrame, right: DataFrame, key, ts: str,
                              size: str, tiebreak: str, left_cols=(),
                              right_cols=()) -> DataFrame:
    """The window join under a count trigger of 1 that never purges: on
    every arrival in a ``(key, window)`` all pairs complete so far are
    emitted again. A pair is complete once its later member has arrived.
    Output: one row per (arrival, pair): key, window_start, arrival_id,
    l_<tiebreak>, r_<tiebreak> and the requested side columns."""
    keys = _keys(key)
    lc = [tiebreak, *[c for c in left_cols if c != tiebreak]]
    rc = [tiebreak, *[c for c in right_cols if c != tiebreak]]
    pairs = tumbling_window_join(left, right, keys, ts, size, lc, rc)
    pairs = pairs.withColumn("_done", F.greatest(
        F.struct(F.col(f"l_{ts}").alias("t"), F.col(f"l_{tiebreak}").alias("i")),
        F.struct(F.col(f"r_{ts}").alias("t"), F.col(f"r_{tiebreak}").alias("i"))))
    arr = (left.select(*keys, ts, tiebreak).unionByName(right.select(*keys, ts, tiebreak))
           .select(*keys, F.window(ts, size)["start"].alias("window_start"),
                   F.struct(F.col(ts).alias("t"), F.col(tiebreak).alias("i")).alias("_ao"),
                   F.col(tiebreak).alias("arrival_id")))
    j = pairs.join(arr, on=[*keys, "window_start"]).filter(F.col("_ao") >= F.col("_done"))
    return j.select(*keys, "window_start", "arrival_id",
                    *[f"l_{c}" for c in lc], *[f"r_{c}" for c in rc])


def session_ids(df: DataFrame, key, ts: str, gap: str, tiebreak=(),
                bucket="1 hour", out: str = "session_id") -> DataFrame:
    """Gaps-and-islands session numbering per key: a new session starts when
    the previous event of the key is more than ``gap`` earlier (events exactly
    ``gap`` apart share a session, as in ``session_window``). Both the lag and
    the running count are two-level keyed scans, so a busy key is split by
    time bucket."""
    ko = KeyedOrder(_keys(key), ts, list(tiebreak), bucket)
    d = previous_value(df, ko, ts, out="_prev_ts")
    d = d.withColumn("_new", F.when(
        F.col("_prev_ts").isNull()
        | (F.col(ts) > F.col("_prev_ts") + F.expr(f"INTERVAL {duration_us(gap)} MICROSECONDS")),
        F.lit(1)).otherwise(F.lit(0)))
    d = running_sum(d, ko, "_new", out)
    return d.drop("_prev_ts", "_new", "_tb", "_k")


def cogroup_per_arrival(left: DataFrame, right: DataFrame, key, ts: str, gap: str,
                        value: str, tiebreak: str, bucket="1 hour") -> DataFrame:
    """The session cogroup under a count trigger of 1: every arrival emits
    the cogroup text of its session as it stands after that arrival.
    Output: key, session_id, arrival_id, side (1/2) and the text block."""
    keys = _keys(key)
    u = _tagged_union(left, right, keys, ts, [tiebreak], value)
    u = session_ids(u, keys, ts, gap, [tiebreak], bucket)
    w = (Window.partitionBy(*keys, "session_id").orderBy(ts, tiebreak)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    item = F.struct(F.col(keys[0]).alias("k"), F.col("_v").alias("v"))
    res = u.select(
        *keys, "session_id", F.col(tiebreak).alias("arrival_id"),
        F.col("_side").cast("bigint").alias("side"),
        _blocks(F.collect_list(F.when(F.col("_side") == 1, item)).over(w),
                F.collect_list(F.when(F.col("_side") == 2, item)).over(w)).alias("text"))
    return res
