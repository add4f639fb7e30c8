"""Exact median per group without buffering a group's values in one task.

Spark's exact ``median``/``percentile`` keeps a value->count map per group,
so one hot group (a busy key's window) is one in-memory buffer as large as
its distinct values. Here:

1. a ``percentile_approx`` sketch per group (fixed size, partial
   aggregation) gives values ``lo``/``hi`` whose ranks bracket the median:
   its rank error is at most n/accuracy, and the bracket is 2n/accuracy wide
   on each side;
2. rows below ``lo`` are only counted; rows inside ``[lo, hi]`` are counted
   per distinct value (partial aggregation again) -- at most ~4n/accuracy
   distinct values per group;
3. a running count over those few values finds the values at the two middle
   ranks; the result interpolates like ``median`` (percentile 0.5).

The bracket is verified per group; a group where it fails (never, within the
sketch's error bound) is recomputed from counts over all its values, so the
result is exact in every case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

G = "_g"


def _picks(counted: DataFrame) -> DataFrame:
    """From per-(group, slot) counts (slot = struct(flag, value), ordered),
    the slots holding the two middle ranks ``_i1``/``_i2`` (0-based)."""
    w = Window.partitionBy(G).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_cum", F.sum("_c").over(w))
    return ranked.groupBy(G).agg(
        F.min(F.when(F.col("_cum") > F.col("_i1"), F.col("_s"))).alias("_p1"),
        F.min(F.when(F.col("_cum") > F.col("_i2"), F.col("_s"))).alias("_p2"))


def exact_median(df: DataFrame, group: list, value: str, *, accuracy: int = 10000,
                 out: str = "median_value",
                 bracket: tuple[float, float] | None = None) -> DataFrame:
    """One row per group: the group columns and the exact median of
    ``value`` (NULLs ignored; a group with only NULLs gets NULL).
    ``bracket`` overrides the sketch percentiles (tests use it to force the
    fallback path)."""
    eps = 2.0 / accuracy
    plo, phi = bracket or (max(0.0, 0.5 - eps), min(1.0, 0.5 + eps))
    gcols = [F.col(c) for c in group]
    d = df.select(F.struct(*gcols).alias(G), F.col(value).alias("_v"))
    stats = (d.groupBy(G).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", [plo, phi], accuracy)
        .alias("_q"))
        .select(G, "_n", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"),
                F.floor((F.col("_n") - 1) / 2).alias("_i1"),
                F.ceil((F.col("_n") - 1) / 2).alias("_i2")))
    vals = d.filter(F.col("_v").isNotNull())
    j = vals.join(stats.select(G, "_lo", "_hi", "_i1", "_i2"), G)
    # slot: (0, NULL) below the bracket, (1, v) inside, (2, NULL) above
    flag = (F.when(F.col("_v") < F.col("_lo"), F.lit(0))
            .when(F.col("_v") <= F.col("_hi"), F.lit(1)).otherwise(F.lit(2)))
    slot = F.struct(flag.alias("f"), F.when(flag == 1, F.col("_v")).alias("v"))
    counted = j.groupBy(G, slot.alias("_s"), "_i1", "_i2").agg(F.count(F.lit(1)).alias("_c"))
    picks = _picks(counted)
    inside = (F.col("_p1.f") == 1) & (F.col("_p2.f") == 1)
    good = picks.filter(inside).select(G, F.col("_p1.v").alias("_v1"),
                                       F.col("_p2.v").alias("_v2"))
    # fallback, outside the sketch's error bound: every value is a slot
    bad = picks.filter(~inside).select(G)
    full = (vals.join(bad, G).join(stats.select(G, "_i1", "_i2"), G)
            .groupBy(G, F.struct(F.lit(1).alias("f"), F.col("_v").alias("v")).alias("_s"),
                     "_i1", "_i2").agg(F.count(F.lit(1)).alias("_c")))
    fixed = _picks(full).select(G, F.col("_p1.v").alias("_v1"), F.col("_p2.v").alias("_v2"))
    both = good.unionByName(fixed)
    med = F.col("_v1") + (F.col("_v2") - F.col("_v1")) * F.lit(0.5)
    res = stats.select(G).join(both, G, "left")
    return res.select(*[F.col(f"{G}.{c}").alias(c) for c in group], med.alias(out))
