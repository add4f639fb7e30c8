"""User surfaces that can be split: aggregate functions (U4), flatMap (U2) and
flatMap with keyed state (U5).

:func:`window_aggregate` runs a user :class:`Aggregate` (create / add / merge /
result) per key and window. Each task folds its own rows into one accumulator per
(key, window) before anything is shuffled; accumulators then meet in a tree: the
partial ones of a (key, window) are merged ``FAN_IN`` at a time in rounds, so a key
or window that holds most rows is folded by all tasks, and no task ever holds its
rows.

:func:`flat_map` runs a user function that gives 0..n rows for a row, over Arrow
batches of rows that are dealt evenly over the session's partitions.

:func:`keyed_flat_map` runs a user function ``fn(row, state) -> (rows, state)`` over
each key's rows in event-time order, a single key over many tasks: rows are
range-partitioned by (key, time), and a key that spans several ranges hands its
state over from one to the next. That needs a state that follows from the last row
alone, as a last value does: one row for each range and key is handed on. Functions
with any other state see a whole key in ``streaming.process.keyed_process``.
"""

from __future__ import annotations

import pickle
import sys
from typing import Any, Iterable

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.columns import epoch_us

#: accumulators merged at a time, and those a task holds before it passes them on
FAN_IN, HELD = 64, 20_000
#: rows whose outputs a flatMap holds at a time
FLAT_ROWS = 1000


def none(x):
    return None if x is None or x is pd.NaT or x != x else x


def ddl(df: DataFrame, cols) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


# ------------------------------------------------------------------ aggregates
class Aggregate:
    """To be subclassed; accumulators are picklable Python values. ``merge`` has to
    be associative and commutative and agree with ``add``. ``output``: DDL of the
    tuple that :meth:`result` gives."""

    output = ""

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, row) -> Any:
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def result(self, acc: Any) -> tuple:
        raise NotImplementedError


def window_aggregate(df: DataFrame, keys, ts: str, size: str, fn: Aggregate, *, slide: str | None = None) -> DataFrame:
    """``keys, window_start, window_end`` and the columns of ``fn.output`` per key
    and tumbling (or sliding) window."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    slots = df.withColumn("w_", F.window(ts, size, slide) if slide else F.window(ts, size))
    rows = slots.select(*cols, F.col("w_.start").alias("window_start"), F.col("w_.end").alias("window_end"))
    slot = [*keys, "window_start", "window_end"]
    kept = ddl(rows, slot)
    acc_ddl = f"{kept}, acc binary"

    def frame(accs: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, pickle.dumps(a)) for k, a in accs.items()], columns=[*slot, "acc"])

    def fold(batches):
        accs: dict = {}
        for b in batches:
            at = [tuple(none(x) for x in k) for k in b[slot].itertuples(index=False, name=None)]
            for k, row in zip(at, b[cols].itertuples(index=False, name="Row")):
                accs[k] = fn.add(accs[k] if k in accs else fn.create(), row)
            if len(accs) > HELD:  # partial ones meet later anyway
                yield frame(accs)
                accs = {}
        yield frame(accs)

    def merged(batches):
        """Partial accumulators, those of a (key, window) next to each other."""
        at, acc, out = None, None, []
        for b in batches:
            for *k, a in b[[*slot, "acc"]].itertuples(index=False, name=None):
                k, a = tuple(none(x) for x in k), pickle.loads(a)
                if k == at:
                    acc = fn.merge(acc, a)
                    continue
                if at is not None:
                    out.append((*at, pickle.dumps(acc)))
                at, acc = k, a
            if len(out) > HELD:
                yield pd.DataFrame(out, columns=[*slot, "acc"])
                out = []
        if at is not None:
            out.append((*at, pickle.dumps(acc)))
        yield pd.DataFrame(out, columns=[*slot, "acc"])

    def results(batches):
        names = [f.name for f in out_schema]
        for b in merged(batches):
            yield pd.DataFrame([(*k, *fn.result(pickle.loads(a))) for *k, a in b.itertuples(index=False, name=None)], columns=names)

    from pyspark.sql.types import StructType
    out_schema = StructType.fromDDL(f"{kept}, {fn.output}")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    partial = rows.mapInPandas(fold, acc_ddl).withColumn("salt", F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(FAN_IN)))
    # two rounds: up to FAN_IN branches of a (key, window), then its branches
    branch = (partial.repartition(parts, *slot, "salt").sortWithinPartitions(*slot, "salt").drop("salt")
              .mapInPandas(merged, acc_ddl))
    return branch.repartition(parts, *slot).sortWithinPartitions(*slot).mapInPandas(results, out_schema)


# --------------------------------------------------------------------- flatMap
def flat_map(df: DataFrame, fn, output: str, *args, keep=()) -> DataFrame:
    """Columns ``keep`` of each row of ``df`` with every row (a tuple of the columns
    of ``output``) that ``fn(*args)`` yields for it; none, one or many."""
    names = [*keep, *StructType.fromDDL(output).names]
    given = df.select(*keep, *[F.col(a).alias(f"_a{i}") for i, a in enumerate(args)])
    # a small file is few splits: the function's work is dealt over all tasks
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    kept = given.select(*keep).schema
    schema = StructType([*kept.fields, *StructType.fromDDL(output).fields])
    types = to_arrow_schema(StructType.fromDDL(output)).types

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, FLAT_ROWS):
                part = b.slice(at, FLAT_ROWS)
                values = [part.column(i).to_pylist() for i in range(len(keep), part.num_columns)]
                origin, rows = [], []
                for i, v in enumerate(zip(*values) if values else [()] * part.num_rows):
                    for r in fn(*v) or ():
                        origin.append(i)
                        rows.append(tuple(r))
                take = pa.array(origin, pa.int64())
                made = zip(*rows) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays([*[part.column(i).take(take) for i in range(len(keep))],
                                                  *[pa.array(c, t) for c, t in zip(made, types)]], names=names)

    return given.repartition(parts).mapInArrow(run, schema)


# ------------------------------------------------------- flatMap with keyed state
class KeyedFlatMap:
    """To be subclassed. ``state``: DDL of the state's one column ``s``; a key begins
    with ``None``. ``output``: DDL of the tuples that :meth:`apply` gives."""

    state = "s double"
    output = ""

    def open(self) -> None:
        """Before a task's first row."""

    def apply(self, row, state) -> tuple[Iterable[tuple], Any]:
        """Rows to emit for ``row``, and the state after it."""
        raise NotImplementedError

    def close(self) -> None:
        """After its last row."""


def keyed_flat_map(df: DataFrame, keys, ts: str, fn: KeyedFlatMap, *, tiebreak=()) -> DataFrame:
    """``keys`` and the columns of ``fn.output``: what ``fn`` emits for each key's
    rows in event-time order, with the state that the row before left.

    The state after a row must follow from that row alone (a last value, a last
    time, a flag): then the state before a range is that after the key's last row in
    an earlier range, and the ranges of one key work at the same time."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [ts, *([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    cols = df.columns
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    dealt = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id())
    dealt = dealt.checkpoint(eager=True).withColumn("_range", F.shiftright("_m", 33))  # one sampling for rows and carries
    # a key's last row in each range; the next range of that key begins with it
    last = dealt.groupBy(*keys, "_range").agg(F.max_by(F.struct(*cols), "_m").alias("_row"), F.min("_m").alias("_first"))
    before = F.lag("_row").over(Window.partitionBy(*keys).orderBy("_range"))
    carried = last.select("_first", before.alias("_row")).where("_row is not null").select(
        *[F.col(f"_row.{c}").alias(c) for c in cols], F.col("_first").alias("_m"), F.lit(0).alias("_own"))
    rows = dealt.select(*cols, "_m", F.lit(1).alias("_own")).unionByName(carried)
    # by range again: the carried rows (one a range at most) join their range's rows
    rows = rows.withColumn("_range", F.shiftright("_m", 33)).repartition(ranges, "_range").sortWithinPartitions("_range", "_m", "_own")
    from pyspark.sql.types import StructType
    out_schema = StructType.fromDDL(f"{ddl(df, keys)}, {fn.output}")
    names = out_schema.names

    def run(batches):
        fn.open()
        key, state, at = object(), None, None
        try:
            for b in batches:
                out = []
                for row, own, where in zip(b[cols].itertuples(index=False, name="Row"), b["_own"], b["_range"]):
                    k = tuple(none(getattr(row, c)) for c in keys)
                    if k != key or where != at:
                        key, state, at = k, None, where
                    emitted, state = fn.apply(row, state)
                    if own:
                        out.extend((*k, *e) for e in emitted)
                yield pd.DataFrame(out, columns=names)
        finally:
            fn.close()

    return rows.mapInPandas(run, out_schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
