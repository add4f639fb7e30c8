"""Keyed process functions (U10, A5, and A1/A4 for a caller): user code per row
and per timer, with state of the user's own and event-time timers, in batch and
on a stream.

A :class:`KeyedProcess` sees the rows of one key in event-time order (ties by the
tie-break columns). A timer for time t fires after all rows up to t and before any
later row; one time has one timer, which can be deleted. So results do not depend
on how rows arrive, and the batch form and the stream form give the same rows.

Batch: rows are hash-partitioned by key, sorted inside their partition and walked
one at a time (``mapInPandas``); a key's state is all that is held. Stream:
``transformWithStateInPandas`` over buckets of keys, since a call costs milliseconds
and a key's own work microseconds; rows wait in the bucket's list state until the
watermark passes them, a Spark timer wakes the bucket up, and what is due is applied
key by key, in order. A key's state is entries of map states of its bucket, read when
user code first asks for it (for many keys, all at once) and written when it has
changed; a list is kept in chunks, so that what is appended rewrites one chunk at
most. A user function has to see a key's rows one after another, so a key is never
split; functions that can be merged belong to ``operators.aggregate``.

NULL keys are one key. Rows without a time come first in batch; a stream has none
(its watermark column must not be NULL).
"""

from __future__ import annotations

import heapq
import pickle
import sys
from collections import namedtuple
from functools import reduce
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import IntegralType, StructType

from ..functions.columns import epoch_us

#: not to begin with an underscore: Spark renames such columns on their way to the processor
TIME = "event_time_us"
TAG = "tag"
BUCKET = "key_bucket"
NULLS = "null_integers"
#: buckets of keys of the late split
LATE_BUCKETS = 1024
#: buckets of keys of a stream's keyed process, for each choice of NULL keys
PROCESS_BUCKETS = 1024
#: values of a list that are stored together
CHUNK = 256
#: keys of a bucket beyond which their state is read all at once
FEW_KEYS = 8
#: stands for no time yet
UNKNOWN = -(2 ** 63)


class Value:
    """A single value, ``None`` when empty."""

    def __init__(self, stored=None):
        self.stored, self.loaded, self.dirty, self.now = stored, stored is None, False, None

    def get(self):
        if not self.loaded:
            got = self.stored.get() if self.stored.exists() else None
            self.now, self.loaded = (got[0] if got is not None else None), True
        return self.now

    def update(self, value) -> None:
        self.now, self.loaded, self.dirty = value, True, True

    def clear(self) -> None:
        self.update(None)

    def save(self) -> None:
        if self.dirty and self.stored is not None:
            if self.now is None:
                self.stored.clear()
            else:
                self.stored.update((self.now,))
        self.dirty = False


class List:
    """Values in the order they were appended."""

    def __init__(self, stored=None):
        self.stored, self.fresh, self.cleared = stored, [], False
        self.old = [] if stored is None else None

    def get(self) -> list:
        if self.old is None:
            self.old = [x[0] for x in self.stored.get()] if self.stored.exists() else []
        return self.old + self.fresh

    def append(self, value) -> None:
        self.fresh.append(value)

    def clear(self) -> None:
        self.old, self.fresh, self.cleared = [], [], True

    def save(self) -> None:
        if self.stored is None:
            return
        if self.cleared:
            self.stored.clear()
        if self.fresh:  # only what is new is written
            self.stored.appendList([(x,) for x in self.fresh])
        self.old, self.fresh, self.cleared = None, [], False


class Map:
    """Values by name; what was read once is remembered until :meth:`save`."""

    def __init__(self, stored=None):
        self.stored, self.changed, self.wiped, self.read = stored, {}, stored is None, {}

    def get(self, name, default=None):
        if name in self.changed:
            got = self.changed[name]
        elif self.wiped:
            got = None
        else:
            if name not in self.read:
                self.read[name] = self.stored.getValue((name,))[0] if self.stored.containsKey((name,)) else None
            got = self.read[name]
        return default if got is None else got

    def put(self, name, value) -> None:
        self.changed[name] = value

    def remove(self, name) -> None:
        self.changed[name] = None

    def items(self) -> dict:
        if not self.wiped:
            self.read = {k[0]: v[0] for k, v in self.stored.iterator()} if self.stored.exists() else {}
        return {k: v for k, v in {**self.read, **self.changed}.items() if v is not None}

    def clear(self) -> None:
        self.changed, self.wiped, self.read = {}, True, {}

    def save(self) -> None:
        if self.stored is None:
            return
        if self.wiped:
            self.stored.clear()
        for name, value in self.changed.items():
            if value is not None:
                self.stored.updateValue((name,), (value,))
            elif not self.wiped and self.stored.containsKey((name,)):
                self.stored.removeKey((name,))
        self.changed, self.wiped, self.read = {}, False, {}


KINDS = {"value": Value, "list": List, "map": Map}


class Context:
    """What user code can read and do: ``key`` (a tuple), ``timestamp`` (of the row
    or timer, microseconds), ``watermark`` (all earlier rows and timers are done),
    its states, timers and side outputs."""

    def __init__(self, key: tuple, states: dict, timers=()):
        self.key, self.states, self.timestamp, self.out = key, states, None, []
        self.pending, self.queue = set(timers), list(timers)
        heapq.heapify(self.queue)

    @property
    def watermark(self):
        return self.timestamp

    def state(self, name: str):
        return self.states[name]

    def register_timer(self, at_us: int) -> None:
        if at_us not in self.pending:
            self.pending.add(at_us)
            heapq.heappush(self.queue, at_us)

    def delete_timer(self, at_us: int) -> None:
        self.pending.discard(at_us)

    def output(self, tag: str, row: tuple) -> None:
        self.out.append((*row, tag))


class KeyedProcess:
    """To be subclassed. ``states``: name -> ``(kind, type)`` with the kinds value,
    list and map (names are strings) and a SQL type; ``output``: DDL of the rows
    that :meth:`process` and :meth:`on_timer` yield as tuples."""

    states: dict[str, tuple[str, str]] = {}
    output = ""

    def open(self) -> None:
        """Before a task's (or state partition's) first row."""

    def process(self, row, ctx: Context) -> Iterator[tuple]:
        """One row, a named tuple of the input's columns."""
        yield from ()

    def on_timer(self, at_us: int, ctx: Context) -> Iterator[tuple]:
        yield from ()

    def close(self) -> None:
        """After its last row."""


def fire(fn: KeyedProcess, ctx: Context, limit: int | None) -> None:
    """Timers up to ``limit`` (``None``: all), in order; also those they set."""
    while ctx.queue and (limit is None or ctx.queue[0] <= limit):
        at = heapq.heappop(ctx.queue)
        if at in ctx.pending:
            ctx.pending.discard(at)
            ctx.timestamp = at
            ctx.out.extend((*r, None) for r in fn.on_timer(at, ctx) or ())


def apply(fn: KeyedProcess, ctx: Context, row, at) -> None:
    """One row, after the timers before it."""
    if at is not None:
        fire(fn, ctx, at - 1)
    ctx.timestamp = at
    ctx.out.extend((*r, None) for r in fn.process(row, ctx) or ())


def out_ddl(fn: KeyedProcess) -> str:
    return f"{fn.output}, {TAG} string"


def out_names(df: DataFrame, fn: KeyedProcess) -> list[str]:
    return StructType.fromDDL(out_ddl(fn)).names


def none(x):
    return None if x is None or x is pd.NaT or x != x else x


# ------------------------------------------------------------------------ batch
def keyed_process(df: DataFrame, keys, ts: str, fn: KeyedProcess, *, tiebreak=()) -> DataFrame:
    """``fn`` over the rows of ``df`` by key; its rows, with the side output's name
    in ``tag`` (NULL: main output). All timers fire at the end."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [TIME, *([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    cols, names = df.columns, out_names(df, fn)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.withColumn(TIME, epoch_us(ts)).repartition(parts, *keys).sortWithinPartitions(*keys, *order)

    def run(batches):
        fn.open()
        ctx, out, key = None, [], object()
        try:
            for b in batches:
                times = [none(x) for x in b[TIME]]
                for row, at in zip(b[cols].itertuples(index=False, name="Row"), times):
                    own = tuple(none(getattr(row, k)) for k in keys)
                    if own != key:
                        if ctx is not None:
                            fire(fn, ctx, None)
                            out += ctx.out
                        key, ctx = own, Context(own, {n: KINDS[k]() for n, (k, _) in fn.states.items()})
                    apply(fn, ctx, row, None if at is None else int(at))
                    if len(ctx.out) + len(out) >= 10_000:
                        yield pd.DataFrame(out + ctx.out, columns=names)
                        out, ctx.out = [], []
            if ctx is not None:
                fire(fn, ctx, None)
                out += ctx.out
            yield pd.DataFrame(out, columns=names)
        finally:
            fn.close()

    return dealt.mapInPandas(run, out_ddl(fn))


# ----------------------------------------------------------------------- stream
def plain(k) -> tuple:
    """A key as it is found again."""
    return tuple(bytes(x) if isinstance(x, bytearray) else x for x in map(none, k))


class Entries:
    """A map state of a bucket, whose entries belong to a key of ``width`` columns and
    a place below it: read one by one or, after :meth:`load`, all at once. Changes are
    written by :meth:`save`."""

    def __init__(self, stored, width: int):
        self.stored, self.width, self.all, self.changed = stored, width, None, {}

    def load(self) -> None:
        if self.all is None:
            self.all = {}
            for k, v in self.stored.iterator() if self.stored.exists() else ():
                k = plain(k)
                self.all.setdefault(k[:self.width], {})[k[self.width:]] = tuple(v)
            for (key, place), v in self.changed.items():
                self.all.setdefault(key, {})[place] = v

    def begin(self, whole: bool) -> None:
        """``whole``: most entries will be asked for."""
        if whole or not self.stored.exists():
            self.load()

    def of(self, key: tuple) -> dict:
        self.load()
        return {place: v for place, v in self.all.get(key, {}).items() if v is not None}

    def get(self, key: tuple, place: tuple = ()):
        if self.all is not None:
            return self.all.get(key, {}).get(place)
        if (key, place) not in self.changed:
            return self.stored.getValue((*key, *place))
        return self.changed[key, place]

    def put(self, key: tuple, place: tuple, value) -> None:
        """``value``: a tuple, or ``None`` to remove the entry."""
        self.changed[key, place] = value
        if self.all is not None:
            self.all.setdefault(key, {})[place] = value

    def save(self) -> None:
        for (key, place), value in self.changed.items():
            if value is None:
                self.stored.removeKey((*key, *place))
            else:
                self.stored.updateValue((*key, *place), value)
        self.all, self.changed = None, {}


class KeyValue:
    """One key's part of :class:`Entries`, as a value state."""

    def __init__(self, entries: Entries, key: tuple):
        self.entries, self.key = entries, key

    def exists(self) -> bool:
        return self.get() is not None

    def get(self):
        return self.entries.get(self.key)

    def update(self, value: tuple) -> None:
        self.entries.put(self.key, (), value)

    def clear(self) -> None:
        if self.exists():
            self.entries.put(self.key, (), None)


class KeyList:
    """As a list state: the number of full chunks and the values behind them in one
    entry, each full chunk in an entry of ``full``."""

    def __init__(self, entries: Entries, full: Entries, key: tuple):
        self.entries, self.full, self.key = entries, full, key

    def head(self) -> tuple:
        n, rest = self.entries.get(self.key) or (0, [])
        return n, list(rest)

    def exists(self) -> bool:
        return self.entries.get(self.key) is not None

    def get(self):
        n, rest = self.head()
        for i in range(n):
            yield from ((x,) for x in self.full.get(self.key, (i,))[0])
        yield from ((x,) for x in rest)

    def appendList(self, rows: list) -> None:
        n, rest = self.head()
        rest += [r[0] for r in rows]
        whole = len(rest) // CHUNK
        for i in range(whole):
            self.full.put(self.key, (n + i,), (rest[i * CHUNK:(i + 1) * CHUNK],))
        self.entries.put(self.key, (), (n + whole, rest[whole * CHUNK:]))

    def clear(self) -> None:
        if self.exists():
            for i in range(self.head()[0]):
                self.full.put(self.key, (i,), None)
            self.entries.put(self.key, (), None)


class KeyMap:
    """As a map state."""

    def __init__(self, entries: Entries, key: tuple):
        self.entries, self.key = entries, key

    def exists(self) -> bool:
        return bool(self.entries.of(self.key))

    def containsKey(self, name: tuple) -> bool:
        return self.entries.get(self.key, name) is not None

    def getValue(self, name: tuple):
        return self.entries.get(self.key, name)

    def iterator(self):
        return iter(self.entries.of(self.key).items())

    def updateValue(self, name: tuple, value: tuple) -> None:
        self.entries.put(self.key, name, value)

    def removeKey(self, name: tuple) -> None:
        self.entries.put(self.key, name, None)

    def clear(self) -> None:
        for name in self.entries.of(self.key):
            self.entries.put(self.key, name, None)


class Processor(StatefulProcessor):
    """Rows of a bucket of keys wait in ``_rows`` (pickled lists, as each value of a
    state costs as much as a call), its user timers are in ``_timers``; a bucket wakes
    up when the watermark passes the earliest of them."""

    def __init__(self, fn, keys, key_types, cols, order, whole, real, names, numbers):
        self.fn, self.keys, self.key_types, self.cols, self.order = fn, keys, key_types, cols, order
        self.whole, self.real, self.names, self.numbers = whole, real, names, numbers

    def init(self, handle) -> None:
        self.handle, self.done = handle, {}
        own = ", ".join(f"k{i} {t}" for i, t in enumerate(self.key_types))

        def entries(name, value, place=""):
            return Entries(handle.getMapState(name, own + place, value), len(self.keys))

        self.rows = handle.getListState("_rows", "rows binary")
        self.timers = entries("_timers", "at array<long>")
        make = {"value": lambda n, t: (KeyValue, entries(n, f"v {t}")), "map": lambda n, t: (KeyMap, entries(n, f"v {t}", ", k string")),
                "list": lambda n, t: (KeyList, entries(n, f"n int, v array<{t}>"), entries(f"_full_{n}", f"v array<{t}>", ", i int"))}
        self.stored = {n: (k, *make[k](n, t)) for n, (k, t) in self.fn.states.items()}
        self.row = namedtuple("Row", self.cols, rename=True)._make
        self.fn.open()

    def handleInputRows(self, key, rows, timerValues):
        wake = []
        for b in rows:
            if not len(b):
                continue
            wake.append(int(b[TIME].min()))
            empty = b[NULLS].to_numpy()
            b = b[[*self.cols, TIME]]
            b = b.astype(object).where(b.notna(), None)
            for i, c in enumerate(self.whole):  # a NULL came as 0, as other integers would become floats
                if (gone := empty >> i & 1).any():
                    b[c] = b[c].where(gone == 0, None)
            self.rows.appendList([(pickle.dumps(list(b.itertuples(index=False, name=None))),)])
        self.wake_up(wake)
        yield pd.DataFrame([], columns=self.names)

    def wake_up(self, times: list) -> None:
        """One Spark timer at the earliest of ``times``; the next is set when it fires."""
        if times:
            self.handle.registerTimer(-(-min(times) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        if self.done.get(key) == limit:  # another timer of the bucket; all that was due is done
            yield pd.DataFrame([], columns=self.names)
            return
        self.done[key] = limit
        waiting = [r for x in self.rows.get() for r in pickle.loads(x[0])] if self.rows.exists() else []
        later = [r for r in waiting if r[-1] > limit]
        at = {c: i for i, c in enumerate([*self.cols, TIME])}
        # NULL tie-breaks first, as in a batch
        ranked = sorted((r for r in waiting if r[-1] <= limit), key=lambda r: [(r[at[c]] is not None, r[at[c]]) for c in self.order])
        due: dict[tuple, list] = {}
        for r in ranked:
            due.setdefault(plain(r[at[k]] for k in self.keys), []).append(r)
        self.timers.load()
        timers = {k: list(own[()][0]) for k, own in self.timers.all.items()}
        for k, own in timers.items():
            if min(own) <= limit:
                due.setdefault(k, [])
        states = [e for _, _, *own in self.stored.values() for e in own]
        for _, _, first, *_ in self.stored.values():
            first.begin(bool(timers) and len(due) > len(timers) / 4)
        wake, out = [r[-1] for r in later], []
        for k, own in due.items():
            ctx = self.applied(k, own, limit, timers.pop(k, []))
            out += ctx.out
            wake += ctx.pending
            if len(out) >= 10_000:
                yield self.frame(out)
                out = []
        if ranked:
            self.rows.clear()
            if later:
                self.rows.appendList([(pickle.dumps(later),)])
        for entries in (self.timers, *states):
            entries.save()
        self.wake_up(wake + [min(x) for x in timers.values()])
        yield self.frame(out)

    def frame(self, out: list) -> pd.DataFrame:
        """Rows of several keys; a NULL of one makes no floats of another's integers."""
        got = pd.DataFrame(out, columns=self.names)
        return got.assign(**{self.names[i]: pd.Series([r[i] for r in out], dtype=object) for i in self.numbers})

    def applied(self, key: tuple, rows: list, limit: int, timers: list) -> Context:
        """What is due of one key."""
        ctx = Context(key, {n: KINDS[kind](make(*own, key)) for n, (kind, make, *own) in self.stored.items()}, timers)
        for r in rows:
            own = list(r[:-1])
            for i in self.real:  # as in a batch
                own[i] = float("nan") if own[i] is None else own[i]
            apply(self.fn, ctx, self.row(own), r[-1])
        fire(self.fn, ctx, limit)
        for s in ctx.states.values():
            s.save()
        if ctx.pending != set(timers):
            self.timers.put(key, (), (sorted(ctx.pending),) if ctx.pending else None)
        return ctx

    def close(self) -> None:
        self.fn.close()


def stream_keyed_process(stream: DataFrame, keys, ts: str, fn: KeyedProcess, *, tiebreak=()) -> DataFrame:
    """The same on a caller's stream. ``ts`` is its event-time column, of type
    ``timestamp``, with a watermark on it; rows that come later than the watermark
    allows are dropped by Spark. Needs the RocksDB state store."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [TIME, *([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    cols = [c for c in stream.columns if c != ts]
    kinds = {c: stream.schema[c].dataType for c in cols}
    whole = [c for c, t in kinds.items() if isinstance(t, IntegralType)]
    real = [i for i, t in enumerate(kinds.values()) if t.simpleString() in ("float", "double")]
    numbers = [i for i, f in enumerate(StructType.fromDDL(out_ddl(fn))) if isinstance(f.dataType, IntegralType)]
    processor = Processor(fn, keys, [kinds[k].simpleString() for k in keys], cols, order, whole, real, out_names(stream, fn), numbers)

    def bits(names) -> Column:
        return reduce(Column.__add__, [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(names)], F.lit(0)).cast("long")

    # keys of one bucket are NULL in the same columns, so that a NaN is not taken for NULL
    bucket = bits(keys) * PROCESS_BUCKETS + F.pmod(F.xxhash64(*keys), F.lit(PROCESS_BUCKETS))
    timed = (stream.withColumn(TIME, F.unix_micros(F.col(ts))).withColumn(BUCKET, bucket).withColumn(NULLS, bits(whole))
             .withColumns({c: F.coalesce(c, F.lit(0)).cast(kinds[c]) for c in whole}))
    return timed.groupBy(BUCKET).transformWithStateInPandas(processor, out_ddl(fn), "Append", "EventTime")


# --------------------------------------------------------------------- late rows
def stream_late_split(stream: DataFrame, keys, ts: str, arrival: list[str], delay_us: int) -> DataFrame:
    """Every row of a caller's stream with its key's watermark when it arrives (the
    largest event time of the key's earlier rows less ``delay_us``; NULL for the
    first) and ``late``, whether its own time is not above that: the late output is
    ``where("late")``, what stays ``where("not late")``, and nothing is dropped.
    Micro-batches come in order of ``arrival``, rows inside one in any order. The
    state is one number a key (E4), held side by side for a bucket of keys: Python is
    called once per bucket and micro-batch."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = stream.columns
    timed = stream.withColumn(TIME, epoch_us(ts)).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(LATE_BUCKETS)).cast("int"))
    out = ", ".join(f"`{c}` {stream.schema[c].dataType.simpleString()}" for c in cols) + ", watermark_us long, late boolean"
    whole = [isinstance(stream.schema[k].dataType, IntegralType) for k in keys]
    kept = ", ".join(f"k{i} array<{stream.schema[k].dataType.simpleString()}>" for i, k in enumerate(keys)) + ", most array<long>"

    def split(key, batches, state):
        held = {}
        if state.exists:
            *names, most = state.get
            held = dict(zip(zip(*names), most))
        rows = pd.concat(list(batches), ignore_index=True)
        rows = rows.assign(**{BUCKET: rows.groupby(keys, dropna=False, sort=False).ngroup()})
        rows = rows.sort_values([BUCKET, *arrival], kind="stable", ignore_index=True)
        code = rows[BUCKET].to_numpy()
        first = np.concatenate([[True], code[1:] != code[:-1]])
        own = [tuple(int(x) if w and x is not None else x for x, w in zip(map(none, k), whole))
               for k in rows.loc[first, keys].itertuples(index=False, name=None)]
        start = np.array([held.get(k, UNKNOWN) for k in own], "int64")
        # the largest time before each row; rows without a time are never late
        times = rows[TIME].astype("Int64").fillna(UNKNOWN).astype("int64")
        so_far = np.maximum(times.groupby(code).cummax().to_numpy(), start[code])
        before = np.where(first, start[code], np.concatenate([[UNKNOWN], so_far[:-1]]))
        known = before > UNKNOWN
        mark = np.where(known, before - delay_us * known, 0)
        late = known & (times.to_numpy() > UNKNOWN) & (times.to_numpy() <= mark)
        yield rows[cols].assign(watermark_us=pd.Series(mark, dtype="Int64").mask(~known), late=late)
        last = np.concatenate([code[1:] != code[:-1], [True]])
        held.update((k, int(m)) for k, m in zip(own, so_far[last]) if m > UNKNOWN)
        if held:
            state.update((*([k[i] for k in held] for i in range(len(keys))), list(held.values())))

    return timed.groupBy(BUCKET).applyInPandasWithState(split, out, kept, "append", GroupStateTimeout.NoTimeout)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
