"""Routing one stream to several and merging several into one (M1-M6).

Routes are complementary filters over one parent plan. When several routes
are consumed by one job, Spark reuses the scan (``ReusedExchange``) or the
caller caches the parent; on a stream whose routes go to different sinks use
``streaming.runner.split_sink`` (one ``foreachBatch`` writing all routes)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import strictly_above
from ..functions.fixed import MSG_HIGH, MSG_LOW, TAG_HIGH, TAG_LOW

HIGH, LOW = TAG_HIGH, TAG_LOW


def split_tags(df: DataFrame, value: str, threshold: float,
               tag: str = "tag") -> DataFrame:
    """Tag each row 'high' (value > threshold, NaN never high) or 'low' (M1)."""
    return df.withColumn(tag, F.when(strictly_above(value, threshold), F.lit(HIGH))
                         .otherwise(F.lit(LOW)))


def select_tags(tagged: DataFrame, *tags: str, tag: str = "tag") -> DataFrame:
    """Rows carrying any of ``tags`` (M2/M3); a row appears once."""
    if len(tags) == 1:
        return tagged.filter(F.col(tag) == tags[0])
    return tagged.filter(F.col(tag).isin(list(tags)))


def connect_comap(high: DataFrame, low: DataFrame, key: str, value: str,
                  high_msg: str = MSG_HIGH,
                  low_msg: str = MSG_LOW) -> DataFrame:
    """Connect two differently shaped streams and map each side (M4):
    high -> (key, value, high_msg), low -> (key, NULL, low_msg)."""
    a = high.select(F.col(key), F.col(value).cast("double").alias(value),
                    F.lit(high_msg).alias("status"))
    b = low.select(F.col(key), F.lit(None).cast("double").alias(value),
                   F.lit(low_msg).alias("status"))
    return a.unionByName(b)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union of n streams (M5): no de-duplication, no shuffle."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def side_output(df: DataFrame, main_pred) -> tuple[DataFrame, DataFrame]:
    """A process function with a side output (M6): rows matching
    ``main_pred`` go to the main output, all others to the side output
    (NULL predicates go to the side, so the two are complementary)."""
    cond = F.coalesce(main_pred, F.lit(False))
    return df.filter(cond), df.filter(~cond)
