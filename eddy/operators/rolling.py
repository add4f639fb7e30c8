"""Per-event rolling aggregates and keyed state.

Each function returns one row per input row (the reference emits on every
element), except ``attribute_map`` which is a keyed-state snapshot.
All keyed scans go through ``scan.keyed_scan`` (key x time-bucket split)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_us
from ..session import default_parallelism, ensure_checkpoint_dir
from .scan import KeyedOrder, keyed_scan


def _ko(key, ts, tiebreak, bucket) -> KeyedOrder:
    keys = [key] if isinstance(key, str) else list(key)
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    return KeyedOrder(keys, ts, tb, bucket)


def rolling_max(df: DataFrame, key, ts: str, value: str, *, tiebreak=(),
                bucket="1 hour", mode: str = "max",
                keep: list[str] | None = None) -> DataFrame:
    """Running maximum of ``value`` per key, one output row per input row.

    mode='max'    (R1): other fields from the key's first row (ts of it)
    mode='max_by' (R2): the whole record holding the maximum; on ties the
                        earliest such record wins
    mode='reduce' (R3): ts of the current row, value = max so far
    Output columns: keep + key(s) + ts + value.
    """
    ko = _ko(key, ts, tiebreak, bucket)
    keep = list(keep or [])
    cols = [*keep, *ko.keys]
    if mode == "max_by":
        # greatest value first, then the earliest (smallest ts, tie-break)
        rank = F.struct(F.col(value).alias("v"), (-epoch_us(ts)).alias("nts"),
                        *[(-F.col(c)).alias(f"n{i}") for i, c in enumerate(ko.tiebreak)],
                        F.col(ts).alias("ts"))
        out = keyed_scan(
            df.withColumn("_rank", rank), ko,
            within={"_wbest": F.max("_rank").over(ko.running())},
            summary={"_bbest": F.max("_rank")},
            carry={"_pbest": lambda k: F.max("_bbest").over(k.buckets_before())},
            result={"_best": F.greatest("_pbest", "_wbest")})
        return out.select(*cols, F.col("_best.ts").alias(ts),
                          F.col("_best.v").alias(value))
    first = F.struct(*[F.col(c) for c in ko.order])
    out = keyed_scan(
        df.withColumn("_first", first), ko,
        within={"_wmax": F.max(value).over(ko.running()),
                "_wfirst": F.min("_first").over(ko.running())},
        summary={"_bmax": F.max(value), "_bfirst": F.min("_first")},
        carry={"_pmax": lambda k: F.max("_bmax").over(k.buckets_before()),
               "_pfirst": lambda k: F.min("_bfirst").over(k.buckets_before())},
        result={"_max": F.greatest("_pmax", "_wmax"),
                "_f": F.coalesce("_pfirst", "_wfirst")})
    ts_out = F.col(f"_f.{ts}") if mode == "max" else F.col(ts)
    if mode not in ("max", "reduce"):
        raise ValueError(f"unknown mode {mode!r}")
    return out.select(*cols, ts_out.alias(ts), F.col("_max").alias(value))


def running_count(df: DataFrame, key, ts: str, *, tiebreak=(), bucket="1 hour",
                  initial: int = 0, keep: list[str] | None = None,
                  out: str = "cnt") -> DataFrame:
    """Per-key running count (K3): the n-th row of a key emits n + initial.
    ``initial=1`` reproduces the reference's descriptor default."""
    ko = _ko(key, ts, tiebreak, bucket)
    res = keyed_scan(
        df, ko,
        within={"_wrn": F.row_number().over(ko.ordered())},
        summary={"_bn": F.count(F.lit(1))},
        carry={"_pn": lambda k: F.sum("_bn").over(k.buckets_before())},
        result={out: (F.coalesce("_pn", F.lit(0)) + F.col("_wrn")
                      + F.lit(initial)).cast("bigint")})
    return res.select(*(keep or []), *ko.keys, out)


def running_count_global(df: DataFrame, order: list[str], *,
                         partitions: int | None = None,
                         keep: list[str] | None = None,
                         out: str = "cnt") -> DataFrame:
    """Running count over all rows in ``order`` (K1), without a one-task
    window: range-partition on the full order (sampled bounds split even a
    hot time range), number rows inside each partition, and add the row
    count of all earlier partitions (a table of ``partitions`` rows, so its
    broadcast size is bounded by construction).

    The numbered rows are cut from their lineage with a reliable
    ``checkpoint()`` in ``spark.checkpoint.dir``: partition ids come from
    sampled range bounds, and the per-partition counts must be taken from
    the very same partitioning (two independent samplings of a shuffled
    input can disagree). Only ``keep`` + ``order`` columns are written."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or default_parallelism(spark)
    keep = list(keep or [])
    cols = list(dict.fromkeys([*keep, *order]))
    ranged = (df.select(*cols).repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_idx", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("bigint"), 33)))
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_off"))
    res = ranged.join(F.broadcast(offsets), "_pid")
    return res.select(*keep,
                      (F.col("_off") + F.col("_idx") + 1).cast("bigint").alias(out))


def history_log(df: DataFrame, key, ts: str, item: str, *, tiebreak=(), bucket="1 hour",
                keep: list[str] | None = None) -> DataFrame:
    """Whole list state (K4) as its append log: ``keep``, the keys, ``n_before`` (the
    item's position, which is the length of the list the row finds) and the item. The
    list of a row is the items of its key at positions below; the log is linear in the
    input where copies of the lists would be quadratic (:func:`read_history` makes the
    lists of chosen rows)."""
    counted = running_count(df, key, ts, tiebreak=tiebreak, bucket=bucket, keep=[*(keep or []), item], out="n_before")
    return counted.withColumn("n_before", F.col("n_before") - 1)


def read_history(log: DataFrame, key, item: str, rows, *, keep: list[str] | None = None) -> DataFrame:
    """``keep``, the keys, ``n_before`` and ``history`` of the rows of a
    :func:`history_log` where ``rows`` holds: the whole lists they find, oldest
    first. Its size is that of the lists asked for."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [*(keep or []), *[k for k in keys if k not in (keep or [])]]
    asked = log.where(rows).select(*cols, F.struct(*keys).alias("_k"), "n_before", F.monotonically_increasing_id().alias("_row"))
    items = log.select(F.struct(*keys).alias("_k2"), F.col("n_before").alias("_at"), F.struct(F.col(item).alias("i")).alias("_item"))
    met = asked.join(items, (F.col("_k") == F.col("_k2")) & (F.col("_at") < F.col("n_before")), "left")
    found = F.sort_array(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_item"))))
    got = met.groupBy("_row", *cols, "n_before").agg(F.transform(found, lambda x: x["_item"]["i"]).alias("history"))
    return got.drop("_row")


def running_history(df: DataFrame, key, ts: str, item: str, *, depth: int | None,
                    tiebreak=(), bucket="1 hour",
                    keep: list[str] | None = None) -> DataFrame:
    """List state read-then-append (K4): each row sees the items of the
    ``depth`` most recent *earlier* rows of its key (oldest first) and the
    number of earlier rows. ``depth`` is the length of the history the
    operator reports, so output stays linear in the input; ``None`` reports all
    earlier items, whose total is quadratic in a key's rows (a task holds one
    key's items once, and writes the lists bucket by bucket)."""
    ko = _ko(key, ts, tiebreak, bucket)
    d = ko.with_bucket(df)
    w = ko.ordered()
    first = Window.unboundedPreceding if depth is None else -depth
    big = d.select(
        "*",
        # in a struct: collect_list skips NULL items otherwise
        F.transform(F.collect_list(F.struct(F.col(item).alias("_i"))).over(w.rowsBetween(first, -1)),
                    lambda x: x["_i"]).alias("_wl"),
        F.row_number().over(w).alias("_wrn"),
        F.count(F.lit(1)).over(ko.whole_bucket()).alias("_wn"))
    # last `depth` items (or all) of each bucket, from the rows already numbered above
    tail = ((big if depth is None else big.filter(F.col("_wn") - F.col("_wrn") < depth))
            .groupBy(*ko.pkeys)
            .agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in ko.order],
                                                      F.col(item).alias("_i"))))
                 .alias("_t"), F.first("_wn").alias("_bn")))
    tail = tail.select(*ko.pkeys, "_bn", F.transform("_t", lambda x: x["_i"]).alias("_t"))
    prior = tail.select(
        *ko.pkeys,
        F.flatten(F.collect_list("_t").over(ko.buckets().rowsBetween(first, -1)))
        .alias("_pt"),
        F.coalesce(F.sum("_bn").over(ko.buckets_before()), F.lit(0)).alias("_pn"))
    j = big.join(prior, on=ko.pkeys)
    hist = F.concat("_pt", "_wl")
    if depth is not None:
        hist = F.slice(hist, F.greatest(F.size(hist) - depth + 1, F.lit(1)), depth)
    return j.select(*(keep or []), *ko.keys,
                    (F.col("_pn") + F.col("_wrn") - 1).cast("bigint").alias("n_before"),
                    hist.alias("history"))


def attribute_map(df: DataFrame, key, attr: str, value: str, ts: str, *,
                  tiebreak=(), delete_when=None, as_map: bool = False) -> DataFrame:
    """Map state per key (K6): the latest value of each attribute, with
    deletes applied. Long form ``(key, attr, value, ts)``; ``as_map`` folds it
    into one ``map<attr, value>`` per key (bounded by the attribute count).
    A partial aggregate: no key's rows are gathered in one place."""
    keys = [key] if isinstance(key, str) else list(key)
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    d = df
    if delete_when is not None:
        d = d.withColumn("_del", delete_when)
    else:
        d = d.withColumn("_del", F.lit(False))
    latest = (d.groupBy(*keys, attr)
              .agg(F.max(F.struct(F.col(ts).alias("ts"), *[F.col(c) for c in tb],
                                  F.col("_del").alias("d"),
                                  F.col(value).alias("v"))).alias("_m")))
    long = latest.filter(~F.col("_m.d")).select(
        *keys, attr, F.col("_m.v").alias(value), F.col("_m.ts").alias(ts))
    if not as_map:
        return long
    return long.groupBy(*keys).agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct(F.col(attr), F.col(value))))).alias("attrs"))
