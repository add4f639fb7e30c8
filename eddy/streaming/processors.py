"""Keyed-state stream operators, the streaming forms of R2, K3, K5 and A2.

* ordered input (micro-batches in event-time order): group functions for
  ``applyInPandasWithState`` -- the key's state travels with its rows in the
  Arrow batch, and the rise alarm uses the group's event-time timeout;
* out-of-order input: rows wait in the group state until the watermark
  passes them, then are applied in event-time order
  (``buffered_rolling_group``, ``buffered_rise_group``).

Inside one micro-batch a key's rows are sorted by (event time, tie-break)
and processed with vectorised numpy where the update is a scan (count,
running arg-max, previous value); the rise alarm is a small per-row state
machine. State is per key: a few numbers, never the key's rows.

The rolling forms meet Python once per bucket of keys (``bucket_of``), not once
per key: a call costs milliseconds, a key's arithmetic microseconds. The state of
a bucket is that of its keys side by side; the NULL key has a bucket of its own.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: buckets of keys of the rolling forms, whatever the number of state partitions
BUCKETS = 1024
ROLLING_STATE = ("k array<bigint>, cnt array<bigint>, last array<double>, best_v array<double>, "
                 "best_t array<bigint>, best_e array<bigint>")
ROLLING_OUT = ("event_id bigint, user_id bigint, t_us bigint, value double, cnt bigint, "
               "last_value double, best_t bigint, best_v double")


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """The bucket of a key; -1 for NULL."""
    return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets))).otherwise(F.lit(-1)).cast("int")


def roll_arrays(st, t, e, v):
    """Apply one key's rows (any order; sorted here by time, tie-break) to
    the rolling state ``st`` (or None). Returns the per-row columns and the new
    state: running count, previous value, running arg-max (a row becomes the
    best only if strictly greater, so the earliest wins ties; the first row is
    the best so far whatever its value, and NaN is above all numbers, as in the
    batch form)."""
    order = np.lexsort((e, t))
    t, e, v = t[order], e[order], v[order]
    n = len(t)
    cnt0, last0, bv0, bt0, be0 = st if st is not None else (0, None, None, None, None)
    cnt = cnt0 + np.arange(1, n + 1, dtype="int64")
    prev = np.empty(n, dtype="float64")
    prev[1:] = v[:-1]
    prev[0] = np.nan if last0 is None else last0
    start = -np.inf if bv0 is None else bv0
    runmax_before = np.maximum.accumulate(np.concatenate([[start], v]))[:-1]
    new_best = (v > runmax_before) | (np.isnan(v) & ~np.isnan(runmax_before))
    new_best[0] |= bv0 is None
    idx = np.maximum.accumulate(np.where(new_best, np.arange(n), -1))
    best_v = np.where(idx >= 0, v[np.maximum(idx, 0)], np.nan if bv0 is None else bv0)
    best_t = np.where(idx >= 0, t[np.maximum(idx, 0)], -1 if bt0 is None else bt0)
    li = int(idx[-1])
    nb = (float(v[li]), int(t[li]), int(e[li])) if li >= 0 else (bv0, bt0, be0)
    return (e, t, v, cnt, prev, best_t, best_v), (int(cnt[-1]), float(v[-1]), *nb)


def rolled_frame(users, columns) -> pd.DataFrame:
    e, t, v, cnt, prev, best_t, best_v = columns
    return pd.DataFrame({
        "event_id": e, "user_id": users, "t_us": t, "value": v, "cnt": cnt,
        "last_value": pd.array(prev, dtype="Float64"),  # NaN (no previous) -> NULL
        "best_t": best_t, "best_v": best_v})


def roll(key, st, t, e, v):
    """:func:`roll_arrays` with the columns as a frame of ``ROLLING_OUT``."""
    columns, state = roll_arrays(st, t, e, v)
    return rolled_frame(np.full(len(t), key, dtype="int64"), columns), state


def roll_keys(k, t, e, v, held: dict, null: bool) -> pd.DataFrame:
    """The rows of several keys; ``held`` (key -> state) is brought up to date."""
    order = np.argsort(k, kind="stable")
    k, t, e, v = k[order], t[order], e[order], v[order]
    cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
    parts = []
    for i, j in zip(cuts, cuts[1:]):
        key = int(k[i])
        columns, held[key] = roll_arrays(held.get(key), t[i:j], e[i:j], v[i:j])
        parts.append(columns)
    users = pd.array([None] * len(k), dtype="Int64") if null else k
    return rolled_frame(users, [np.concatenate(c) for c in zip(*parts)])


def unpacked(k, cnt, last, best_v, best_t, best_e) -> dict:
    # a NaN may come back from the state store as None
    number = lambda x: np.nan if x is None else x
    return {key: (c, number(l), number(bv), bt, be) for key, c, l, bv, bt, be in zip(k, cnt, last, best_v, best_t, best_e)}


def packed(held: dict) -> tuple:
    return (list(held), *([s[i] for s in held.values()] for i in range(5)))


def bucket_rows(pdfs) -> tuple:
    """Keys (0 in the NULL key's bucket), times, ids and values."""
    parts = list(pdfs)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return (pdf["user_id"].to_numpy("int64"), pdf["t_us"].to_numpy("int64"), pdf["event_id"].to_numpy("int64"),
            pdf["value"].to_numpy("float64"))


def rolling_group(key, pdfs, state):
    """``applyInPandasWithState`` function for R2 + K3 + K5 (ordered input):
    the rows of this micro-batch of a bucket of keys are applied in (time,
    tie-break) order to the rolling state of each key."""
    held = unpacked(*state.get) if state.exists else {}
    out = roll_keys(*bucket_rows(pdfs), held, key[0] < 0)
    state.update(packed(held))
    yield out


RISE_STATE = "last double, has_last boolean, timer bigint"
RISE_OUT = "user_id bigint, alarm_us bigint"


def rise_step(state, t, v, n_us, fired):
    """Apply one reading to the rise-alarm state ``(last, has_last, timer)``;
    a pending timer due strictly before ``t`` fires first (appended to
    ``fired``). Returns the new state and whether the timer changed."""
    last, has_last, timer = state
    if timer is not None and t > timer:
        fired.append(timer)
        timer = None
    if ((not has_last) or v > last) and timer is None:
        timer = t + n_us
    elif has_last and v < last and timer is not None:
        timer = None
    return (v, True, timer)


def rise_group(interval_us: int, first_floor: float | None = None):
    """``applyInPandasWithState`` function for the rise alarm (ordered input)
    with an event-time timeout at the pending alarm's due time."""
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            last, has_last, timer = state.get
            state.update((last, has_last, None))
            if timer is not None:
                yield pd.DataFrame({"user_id": [key[0]], "alarm_us": [timer]})
            return
        parts = list(pdfs)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        ts = pdf["t_us"].to_numpy("int64")
        order = np.lexsort((pdf["event_id"].to_numpy("int64"), ts))
        st = state.get if state.exists else (first_floor, first_floor is not None, None)
        fired: list[int] = []
        for t, v in zip(ts[order].tolist(), pdf["value"].to_numpy("float64")[order].tolist()):
            st = rise_step(st, t, v, interval_us, fired)
        state.update(st)
        if st[2] is not None:
            state.setTimeoutTimestamp(-((-st[2]) // 1000))
        if fired:
            yield pd.DataFrame({"user_id": [key[0]] * len(fired), "alarm_us": fired})
    return fn


BUFFERED_ROLLING_STATE = (ROLLING_STATE + ", buf_k array<bigint>, buf_t array<bigint>, buf_e array<bigint>, "
                          "buf_v array<double>")


def buffered_rolling_group(key, pdfs, state):
    """``applyInPandasWithState`` function for R2 + K3 + K5 over out-of-order
    input: the waiting rows (newer than the watermark) of a bucket of keys are kept
    in its state next to the rolling values; each call adds the new rows, applies
    every waiting row at or below the watermark in event-time order and sets
    an event-time timeout at the oldest row still waiting."""
    wm_us = state.getCurrentWatermarkMs() * 1000
    held, waiting = {}, ([], [], [], [])
    if state.exists:
        held, waiting = unpacked(*state.get[:6]), state.get[6:]
    rows = [np.array(x, dtype=d) for x, d in zip(waiting, ("int64", "int64", "int64", "float64"))]
    if not state.hasTimedOut:
        rows = [np.concatenate(x) for x in zip(rows, bucket_rows(pdfs))]
    ready = rows[1] <= wm_us
    out = roll_keys(*(x[ready] for x in rows), held, key[0] < 0) if ready.any() else None
    rest = [x[~ready].tolist() for x in rows]
    state.update((*packed(held), *rest))
    if rest[1]:
        state.setTimeoutTimestamp(-((-min(rest[1])) // 1000))
    if out is not None:
        yield out


BUFFERED_RISE_STATE = (RISE_STATE + ", buf_t array<bigint>, buf_e array<bigint>, "
                       "buf_v array<double>")


def buffered_rise_group(interval_us: int, first_floor: float | None = None):
    """``applyInPandasWithState`` function for the rise alarm over
    out-of-order input: waiting readings live in the group state; readings at
    or below the watermark are applied in event-time order, a pending alarm
    fires once the watermark reaches its due time, and the event-time timeout
    is set at the earlier of the oldest waiting reading and the pending alarm."""
    def fn(key, pdfs, state):
        wm_us = state.getCurrentWatermarkMs() * 1000
        if state.exists:
            last, has_last, timer, buf_t, buf_e, buf_v = state.get
            t = list(buf_t or []); e = list(buf_e or []); v = list(buf_v or [])
        else:
            last, has_last, timer = first_floor, first_floor is not None, None
            t, e, v = [], [], []
        if not state.hasTimedOut:
            for pdf in pdfs:
                t += pdf["t_us"].astype("int64").tolist()
                e += pdf["event_id"].astype("int64").tolist()
                v += pdf["value"].astype("float64").tolist()
        ta, ea, va = (np.array(t, dtype="int64"), np.array(e, dtype="int64"),
                      np.array(v, dtype="float64"))
        ready = ta <= wm_us
        order = np.lexsort((ea[ready], ta[ready]))
        st, fired = (last, has_last, timer), []
        for tt, vv in zip(ta[ready][order].tolist(), va[ready][order].tolist()):
            st = rise_step(st, tt, vv, interval_us, fired)
        if st[2] is not None and st[2] <= wm_us:
            fired.append(st[2])
            st = (st[0], st[1], None)
        keep = ~ready
        state.update((*st, ta[keep].tolist(), ea[keep].tolist(), va[keep].tolist()))
        wake = [int(ta[keep].min())] if keep.any() else []
        if st[2] is not None:
            wake.append(st[2])
        if wake:
            state.setTimeoutTimestamp(-((-min(wake)) // 1000))
        if fired:
            yield pd.DataFrame({"user_id": [key[0]] * len(fired), "alarm_us": fired})
    return fn


# Functions of this module run inside Spark tasks: ship them by value so
# executors need no copy of this package on their Python path.
__import__("pyspark").cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
