"""User-visible physical partitioning (D1-D3) and per-partition functions
with an open/close lifecycle (P5)."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffle(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Random redistribution (D1). Round-robin without a seed; with a seed a
    deterministic hash of a random column, so retries place rows alike."""
    if seed is None:
        return df.repartition(n)
    return df.repartition(n, F.rand(seed))


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Hash partitioning by key (D2): a key lives in exactly one partition."""
    return df.repartition(n, *keys)


def to_global(df: DataFrame) -> DataFrame:
    """All rows to one partition (D3). Does not scale: small outputs only."""
    return df.repartition(1)


def with_partition_id(df: DataFrame, out: str = "part") -> DataFrame:
    return df.withColumn(out, F.spark_partition_id().cast("bigint"))


def map_partitions_with_lifecycle(
        df: DataFrame, schema: str,
        fn: Callable[[pd.DataFrame, dict], pd.DataFrame],
        open_fn: Callable[[], dict] | None = None,
        close_fn: Callable[[dict], None] | None = None) -> DataFrame:
    """Rich map function (P5): ``open_fn`` runs once per partition before the
    first batch, ``fn`` maps each Arrow batch with the opened context,
    ``close_fn`` runs after the last batch (also on failure)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        ctx = dict(open_fn() if open_fn else {})
        tc = TaskContext.get()
        ctx.setdefault("partition", tc.partitionId() if tc else 0)
        try:
            for b in batches:
                yield fn(b, ctx)
        finally:
            if close_fn:
                close_fn(ctx)

    return df.mapInPandas(run, schema)


def tag_partition_index(df: DataFrame, key: str, out: str = "part") -> DataFrame:
    """The reference's RichMapFunction example: ``(key, index of the subtask)``."""
    def fn(b: pd.DataFrame, ctx: dict) -> pd.DataFrame:
        return pd.DataFrame({key: b[key], out: ctx["partition"]})
    sch = f"{key} {df.schema[key].dataType.simpleString()}, {out} bigint"
    return map_partitions_with_lifecycle(df.select(key), sch, fn)


# Functions of this module run inside Spark tasks: ship them by value so
# executors need no copy of this package on their Python path.
__import__("pyspark").cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
