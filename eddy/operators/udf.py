"""User-function surfaces without a built-in equivalent.

``keyed_reduce`` runs a user ``ReduceFunction`` (``fn(acc, new) -> acc``) as a
per-event running reduce. A hot key is split like every keyed scan here:

1. rows are grouped by (key, time bucket); ``applyInPandas`` folds each
   bucket in (time, tie-break) order and emits the running value per row;
2. the last value of each bucket is folded per key over the buckets in
   order (one row per bucket) giving the reduce of all earlier buckets;
3. the two are combined per row: ``fn(earlier, running_in_bucket)``.

This equals the left fold over the whole key when ``fn`` is associative --
which an incrementally applied reduce function has to be anyway.

``cogroup_apply`` runs a user ``CoGroupFunction`` on both sides' rows of each
(key, session): one group is one session of one key.
"""

from __future__ import annotations

from collections import namedtuple
from itertools import groupby, islice
from typing import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .scan import KEY, TB, KeyedOrder

#: rows of an output batch of a cogroup
OUT_ROWS = 1000


def _ddl(df: DataFrame, cols: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def _scan_sorted(batches, group_cols, fn, fields, out_cols, emit_prefix: bool):
    """Fold ``fields`` with ``fn`` over consecutive rows of each group in an
    iterator of sorted pandas batches (groups may span batches). With
    ``emit_prefix`` each row gets the fold of the rows *before* it in its
    group (``None`` first); otherwise the fold up to and including it."""
    cur_key, acc = object(), None
    for b in batches:
        # a NULL key arrives as NaN, which never equals itself
        gk = [tuple(None if x != x else x for x in k)
              for k in b[group_cols].itertuples(index=False, name=None)]
        vals = list(b[fields].itertuples(index=False, name=None))
        outs = []
        for k, v in zip(gk, vals):
            if k != cur_key:
                cur_key, acc = k, None
            if emit_prefix:
                outs.append(acc)
                acc = v if acc is None else tuple(fn(acc, v))
            else:
                acc = v if acc is None else tuple(fn(acc, v))
                outs.append(acc)
        res = b.copy()
        for i, c in enumerate(out_cols):
            res[c] = [None if o is None else o[i] for o in outs]
        if emit_prefix:
            res["_has"] = [o is not None for o in outs]
        yield res


def keyed_reduce(df: DataFrame, key, ts: str, fields: list[str],
                 fn: Callable[[tuple, tuple], tuple], *, tiebreak=(), bucket="1 hour",
                 keep: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Running reduce of ``fields`` per key with a user function; one output
    row per input row: ``keep + keys + fields`` (the reduced values).

    Rows are hash-partitioned by (key, time bucket) and sorted inside each
    partition, so ``mapInPandas`` sees each bucket's rows consecutively and in
    order; the fold state is carried across Arrow batches. The last value of
    each bucket comes from a Spark aggregate; the per-key fold over buckets
    runs the same way on that small table."""
    from ..session import default_parallelism
    keys = [key] if isinstance(key, str) else list(key)
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    keep = [c for c in (keep or []) if c not in keys and c not in fields]
    ko = KeyedOrder(keys, ts, tb, bucket)
    order = [ts, *[c for c in tb if c != ts]]
    carry = [c for c in dict.fromkeys([*keep, *order]) if c not in fields and c not in keys]
    n = partitions or default_parallelism(df.sparkSession)
    d = ko.with_bucket(df).select(KEY, *keys, TB, *carry, *fields)
    wcols = [f"_w_{f}" for f in fields]
    ftypes = [d.schema[f].dataType.simpleString() for f in fields]
    base = _ddl(d, [*keys, TB, *carry, *fields])
    within_schema = base + ", " + ", ".join(f"`{w}` {t}" for w, t in zip(wcols, ftypes))
    grp = [*keys, TB]
    within = (d.repartition(n, KEY, TB).sortWithinPartitions(KEY, TB, *order)
              .drop(KEY)
              .mapInPandas(lambda it: _scan_sorted(it, grp, fn, fields, wcols, False),
                           within_schema)
              .withColumn(KEY, F.struct(*keys)))
    # last running value of each bucket (= the fold of the whole bucket)
    last = F.max(F.struct(*[F.col(c) for c in order], *[F.col(w) for w in wcols]))
    summ = within.groupBy(KEY, *keys, TB).agg(last.alias("_s")).select(
        KEY, *keys, TB, *[F.col(f"_s.{w}").alias(w) for w in wcols])
    pcols = [f"_p_{f}" for f in fields]
    prior_schema = (_ddl(summ, [KEY, *keys, TB, *wcols]) + ", "
                    + ", ".join(f"`{p}` {t}" for p, t in zip(pcols, ftypes))
                    + ", `_has` boolean")
    prior = (summ.repartition(n, KEY).sortWithinPartitions(KEY, TB)
             .drop(KEY)
             .mapInPandas(lambda it: _scan_sorted(it, keys, fn, wcols, pcols, True),
                          prior_schema.split(", ", 1)[1])
             .withColumn(KEY, F.struct(*keys))
             .select(KEY, TB, *pcols, "_has"))
    j = within.join(prior, [KEY, TB])
    out_schema = _ddl(d, [*keep, *keys, *fields])

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vals = []
            prev = list(b[pcols].itertuples(index=False, name=None))
            for w, p, h in zip(b[wcols].itertuples(index=False, name=None), prev,
                               b["_has"].tolist()):
                vals.append(tuple(fn(p, w)) if h else w)
            res = b[[*keep, *keys]].copy()
            for i, f in enumerate(fields):
                res[f] = [v[i] for v in vals]
            yield res

    return j.drop(KEY).mapInPandas(combine, out_schema)


def _plain(x):
    """A value to tell groups by: NaN never equals itself."""
    return "nan" if x != x else x


def _cogrouped(batches, group, fn, types, names):
    """Call ``fn(left, right)`` once per group of an iterator of Arrow batches sorted
    by the columns ``group`` (a group may span batches; only the current group's rows
    are held). The last two columns are the session and the side."""
    row, key = None, None
    def each():
        nonlocal row, key
        for b in batches:
            if row is None:
                row = namedtuple("Row", b.schema.names[:-2], rename=True)
                key = [b.schema.names.index(c) for c in group]
            yield from zip(*[c.to_pylist() for c in b.columns])

    def made():
        for _, g in groupby(each(), key=lambda r: [_plain(r[i]) for i in key]):
            sides = [], []
            for r in g:
                sides[r[-1] - 1].append(row(*r[:-2]))
            yield from fn(*sides) or ()

    rows = made()
    while part := list(islice(rows, OUT_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)


def cogroup_apply(left: DataFrame, right: DataFrame, key: str, ts: str, gap: str,
                  fn: Callable[[list, list], Iterable[tuple]], schema: str, *,
                  tiebreak: str, bucket="1 hour", partitions: int | None = None) -> DataFrame:
    """U8: a user CoGroupFunction over session windows: ``fn(left_rows,
    right_rows)`` (lists of named tuples, both sorted by time, either may be empty)
    is called once per (key, session) formed from both sides' events together and
    yields tuples of the columns of ``schema``.

    The tagged union is hash-partitioned by (key, session) and sorted inside
    each partition; ``mapInArrow`` walks the sorted rows and calls ``fn`` per
    group, holding one session at a time (no frame per group, whose making would
    cost more than the function)."""
    from ..session import default_parallelism
    from .joins import session_ids
    n = partitions or default_parallelism(left.sparkSession)
    u = session_ids(left.withColumn("_side", F.lit(1)).unionByName(
        right.withColumn("_side", F.lit(2)), allowMissingColumns=True),
        key, ts, gap, [tiebreak], bucket)
    grp = [key, "session_id"]
    u = u.select(*[c for c in u.columns if c not in ("session_id", "_side")], "session_id", "_side")
    out = StructType.fromDDL(schema)
    types, names = to_arrow_schema(out).types, out.names
    return (u.repartition(n, *grp).sortWithinPartitions(*grp, ts, tiebreak)
            .mapInArrow(lambda it: _cogrouped(it, grp, fn, types, names), schema))


# Functions of this module run inside Spark tasks: ship them by value so
# executors need no copy of this package on their Python path.
__import__("pyspark").cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
