"""Keyed alarms and timers: jump alarm (K5), per-row delayed timers (A1) and
the continuous-rise alarm (A2), in batch form. Streaming forms with real
state and timers are in ``eddy.streaming.processors``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import abs_diff_at_least, duration_us, epoch_us, ntz_from_us, strictly_above
from ..session import ensure_checkpoint_dir
from .scan import KEY, KeyedOrder, previous_value, running_sum, strip


def _ko(key, ts, tiebreak, bucket) -> KeyedOrder:
    keys = [key] if isinstance(key, str) else list(key)
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    return KeyedOrder(keys, ts, tb, bucket)


def jump_alarm(df: DataFrame, key, ts: str, value: str, threshold: float, *,
               tiebreak=(), bucket="1 hour", keep=()) -> DataFrame:
    """K5: emit ``(key, last, current)`` whenever a key's value moves by at
    least ``threshold`` from its previous reading. The first reading of a key
    only sets the state."""
    ko = _ko(key, ts, tiebreak, bucket)
    d = strip(previous_value(df, ko, value, out="last_value"))
    return (d.filter(F.col("last_value").isNotNull()
                     & abs_diff_at_least("last_value", value, threshold))
            .select(*keep, *ko.keys, "last_value", value))


def delayed_timer(df: DataFrame, key, ts: str, delay: str) -> DataFrame:
    """A1: every row registers a timer at ``ts + delay``; a key holds one
    timer per instant, so timers are de-duplicated per (key, time). Output:
    the timers that fire, ``(key, fire_ts)``."""
    keys = [key] if isinstance(key, str) else list(key)
    fire = F.col(ts) + F.expr(f"INTERVAL {duration_us(delay)} MICROSECONDS")
    return df.select(*keys, fire.alias("fire_ts")).distinct()


def rise_alarm(df: DataFrame, key, ts: str, value: str, interval: str, *,
               tiebreak=(), bucket="1 hour", first_floor: float | None = None,
               max_fold: int = 100_000) -> DataFrame:
    """A2: alarm when a key's value has not fallen for ``interval`` after a
    rise. State machine per key, in (ts, tie-break) order:

    * a row later than a pending timer first fires it (emit, clear);
    * a rise (value > last) with no timer starts one at ``ts + interval``;
    * a fall (value < last) cancels a pending timer; equal values do nothing;
    * ``last`` is always updated; at end of input pending timers fire.

    The first reading counts as a rise; ``first_floor`` (e.g. 4.9e-324, the
    reference's initial state) makes it compare against that value instead.

    Plan. A fall always leaves no timer, so each run between falls (a
    *streak*) is independent; streak ids are a running count of falls (two
    bucketed keyed scans). Inside a streak only rises matter: the timers form
    the chain c1 = first rise, c(k+1) = first rise later than c(k)+interval,
    and c(k)+interval fires iff the next streak starts after it (or never).
    Streaks with at most ``max_fold`` rises fold their sorted rise times with
    the built-in ``aggregate`` function; longer ones follow the chain by
    pointer doubling (``_chain_by_doubling``), so no group is ever gathered
    beyond ``max_fold`` values. Output ``(key, alarm_ts)``.

    NaN is neither a rise nor a fall, as a value or as the value before it
    (the first row of a key counts as a rise whatever its value); after a
    NULL value the next row counts as a first row.
    """
    ko = _ko(key, ts, tiebreak, bucket)
    n_us = duration_us(interval)
    d = previous_value(df, ko, value, out="_prev")
    # Spark orders NaN above every number; a comparison with it is false here
    d = d.withColumn("_fall", (F.col("_prev").isNotNull() & ~F.isnan("_prev")
                               & (F.col(value) < F.col("_prev"))).cast("bigint"))
    d = running_sum(d, ko, "_fall", "_streak").drop("_tb")  # keeps the struct key
    first_rise = (F.lit(True) if first_floor is None
                  else strictly_above(value, first_floor))
    is_rise = F.when(F.col("_prev").isNull(), first_rise).otherwise(
        ~F.isnan(value) & (F.col(value) > F.col("_prev")))
    rows = d.select(KEY, "_streak", epoch_us(ts).alias("_t"), is_rise.alias("_rise"))
    # end bound of a streak: the first row of the next streak
    starts = rows.groupBy(KEY, "_streak").agg(F.min("_t").alias("_start"))
    ends = starts.select(KEY, (F.col("_streak") - 1).alias("_streak"), F.col("_start").alias("_end"))
    rises = rows.filter(F.col("_rise")).select(KEY, "_streak", "_t")

    big_possible = False
    if max_fold is not None:
        # cheap upper bound: a streak has no more rises than its key has rows
        top = df.groupBy(*ko.keys).count().agg(F.max("count")).first()[0]
        big_possible = top is not None and top > max_fold
    if big_possible:
        sizes = rises.groupBy(KEY, "_streak").agg(F.count(F.lit(1)).alias("_n"))
        rises = rises.join(sizes, [KEY, "_streak"])
        small = rises.filter(F.col("_n") <= max_fold).drop("_n")
        large = rises.filter(F.col("_n") > max_fold).drop("_n")
    else:
        small, large = rises, None

    def step(s, x):
        fire = s["timer"].isNotNull() & (x > s["timer"])
        fired = F.when(fire, F.array_append(s["fired"], s["timer"])).otherwise(s["fired"])
        timer1 = F.when(fire, F.lit(None).cast("bigint")).otherwise(s["timer"])
        timer2 = F.when(timer1.isNull(), x + F.lit(n_us)).otherwise(timer1)
        return F.struct(timer2.alias("timer"), fired.alias("fired"))

    zero = F.struct(F.lit(None).cast("bigint").alias("timer"),
                    F.array().cast("array<bigint>").alias("fired"))
    folded = (small.groupBy(KEY, "_streak").agg(F.array_sort(F.collect_list("_t")).alias("_r"))
              .select(KEY, "_streak", F.explode(F.aggregate(
                  "_r", zero, step,
                  lambda s: F.array_append(s["fired"], s["timer"]))).alias("_due")))
    chains = folded
    if large is not None:
        nodes = _chain_by_doubling(large, n_us, bucket=ko.bucket)
        chains = chains.unionByName(nodes.select(KEY, "_streak",
                                                 (F.col("_t") + F.lit(n_us)).alias("_due")))
    due = chains.join(ends, [KEY, "_streak"], "left").filter(
        F.col("_end").isNull() | (F.col("_end") > F.col("_due")))
    return due.select(*[F.col(f"{KEY}.{c}").alias(c) for c in ko.keys],
                      ntz_from_us("_due").alias("alarm_ts"))


def _chain_by_doubling(rises: DataFrame, n_us: int, bucket="1 hour") -> DataFrame:
    """Rise times on the timer chain of each (key, streak), for streaks too
    long to fold: c1 = first rise, c(k+1) = first rise > c(k) + n_us.

    1. next pointer of every rise by an as-of scan: probes at t + n_us and
       the rises themselves, scanned newest first (bucketed keyed scan), keep
       the smallest rise time seen -- that is the first rise after the probe;
    2. pointer doubling: the chain is the set {next^k(c1)}; each round joins
       the known chain prefix with the jump table and squares the jump table
       (joins on node ids, so no key is gathered). Each round is checkpointed
       and the loop stops when the chain stops growing (at most
       log2(longest chain) + 1 rounds).
    """
    from .scan import KeyedOrder, keyed_scan
    spark = rises.sparkSession
    ensure_checkpoint_dir(spark)
    # pack the node key: (struct key, streak) -> one struct column
    # rises at one instant are one node, so the jump table stays a function
    r = rises.select(F.struct(KEY, "_streak").alias("_n"), "_t").distinct()
    probes = r.select("_n", (F.col("_t") + F.lit(n_us)).alias("_time"),
                      F.lit(0).alias("_tag"), F.col("_t").alias("_src"),
                      F.lit(None).cast("bigint").alias("_rt"))
    pts = r.select("_n", F.col("_t").alias("_time"), F.lit(1).alias("_tag"),
                   F.lit(None).cast("bigint").alias("_src"), F.col("_t").alias("_rt"))
    u = probes.unionByName(pts).withColumn("_neg", -F.col("_time"))
    width = duration_us(bucket) if bucket else None
    ko = KeyedOrder(["_n"], "_neg", ["_tag"], bucket,
                    F.floor(F.col("_neg") / F.lit(width)) if width else F.lit(0))
    nxt = keyed_scan(
        u, ko,
        within={"_wmin": F.min("_rt").over(ko.running())},
        summary={"_bmin": F.min("_rt")},
        carry={"_pmin": lambda k: F.min("_bmin").over(k.buckets_before())},
        result={"_next": F.least("_pmin", "_wmin")})
    jump = (nxt.filter(F.col("_tag") == 0)
            .select("_n", F.col("_src").alias("_from"), F.col("_next").alias("_to"))
            .filter(F.col("_to").isNotNull()).checkpoint())
    chain = r.groupBy("_n").agg(F.min("_t").alias("_t")).checkpoint()
    size = chain.count()
    while True:
        step = (chain.alias("c").join(jump.alias("j"), (F.col("c._n") == F.col("j._n"))
                                      & (F.col("c._t") == F.col("j._from")))
                .select(F.col("c._n").alias("_n"), F.col("j._to").alias("_t")))
        grown = chain.unionByName(step).distinct().checkpoint()
        new_size = grown.count()
        chain = grown
        if new_size == size:
            break
        size = new_size
        j2 = jump.alias("a").join(jump.alias("b"), (F.col("a._n") == F.col("b._n"))
                                  & (F.col("a._to") == F.col("b._from")))
        jump = j2.select(F.col("a._n").alias("_n"), F.col("a._from").alias("_from"),
                         F.col("b._to").alias("_to")).checkpoint()
    return chain.select(F.col("_n").getField(KEY).alias(KEY),
                        F.col("_n").getField("_streak").alias("_streak"), "_t")
