"""Suffix-array dedup with a logarithmic index family (operator 6).

Removes every byte covered by a string of ``length`` bytes that also starts
anywhere else in the table (same document included); strings are judged on the
input and never cross documents. Texts are UTF-8 bytes.

Which suffixes are sorted
    Every window of ``length`` bytes has an anchor: the place of the smallest
    8-byte hash in its middle (leftmost of equals). Equal windows have their
    anchor at the same offset, so suffixes need comparing only within one anchor
    context (a 64-bit hash of ``2 * CONTEXT + 8`` bytes around the anchor, which
    lie inside every window of that anchor). The windows of one anchor in one
    text are a block.

    1. Every distinct text yields its blocks: context, a digest of the block's
       whole bytes, first and last window. A context that occurs once holds no
       repeat. If all blocks of a repeated context are equal, they are wholly
       covered. Both are plain aggregations with partial sums, and settle all
       but the edges of repeated passages.
    2. For contexts with differing blocks, one representative of each distinct
       block carries the 64-bit fingerprints of its suffixes' first ``length``
       bytes. Blocks are dealt by context (a context with many blocks is salted
       by window offset, since equal windows share the offset).
    3. In each part, blocks come in batches. A batch gets its suffix array (its
       suffixes sorted by context and the fingerprint of their first ``length``
       bytes, which puts equal prefixes side by side), is merge-scanned against
       the existing levels for matches, and becomes a new level; levels of equal
       size are merged, so there are only logarithmically many. Hits mark both
       sides. A block with several copies is marked as repeated from the start.

    Fingerprints are polynomial hashes of mixed 8-byte hashes; together with the
    context hash a false match needs 128 equal bits for unrelated windows.

Scale: equal texts are processed under one digest (SHA-256), so a text that is a
third of all rows is one text with a count. No step compares pairs. Ranges are
collected per text and joined with the texts that have any; a text without
ranges keeps the digest it already has.

Edge cases: NULL counts as empty; texts shorter than ``length`` bytes are never
touched; NULL ids and repeated rows are output row by row (a repeated text of
``length`` bytes or more is wholly removed); long texts are read whole, in
sections that overlap by ``length``. An empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_by_value, small_batches, stored, text_column

LENGTH = 400
#: bytes on either side of an anchor that every one of its windows holds
CONTEXT = 64
GRAM = 8
#: bytes of a text that are worked on at once
SECTION = 1 << 22
#: low bits of a hash that give way to the place; the same for all texts, so that
#: equal windows choose alike
PLACE_BITS = 23
#: suffixes of a batch in the index of one part
BATCH = 1 << 16
#: window offsets are dealt into so many parts per context
SALTS = 8
#: suffixes of a block table's batch that leaves Python
HELD_SUFFIXES = 1 << 18
ODD = 0x9E3779B97F4A7C15
ODD2 = 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Window fingerprints of one section of bytes."""

    def __init__(self):
        self.size = 0

    def tables(self, n: int):
        if n > self.size:
            self.size = max(n, 2 * self.size)
            self.up = [powers(b, self.size) for b in (ODD, ODD2)]
            self.down = [powers(pow(b, -1, 1 << 64), self.size) for b in (ODD, ODD2)]

    def load(self, data: np.ndarray):
        """``data``: uint8. Mixed hashes of its 8-byte grams and prefix sums."""
        m = len(data) - GRAM + 1
        self.tables(m + 1)
        g = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, GRAM)).view("<u8").ravel()
        g = (g ^ (g >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
        self.grams = g ^ (g >> np.uint64(32))
        self.sums = [None, None]

    def prefix(self, k: int) -> np.ndarray:
        if self.sums[k] is None:
            s = np.empty(len(self.grams) + 1, np.uint64)
            s[0] = 0
            np.cumsum(self.grams * self.up[k][:len(self.grams)], out=s[1:])
            self.sums[k] = s
        return self.sums[k]

    def windows(self, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        """Fingerprints of the byte ranges [start, end)."""
        s = self.prefix(k)
        h = (s[end - GRAM + 1] - s[start]) * self.down[k][start]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(33))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value of every window of ``width``."""
    n = len(values)
    keyed = (values >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64)
    pad = (-n) % width
    full = np.concatenate([keyed, np.full(pad, MASK, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(right[:n - width + 1], left[width - 1:n])
    return (low & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def section_blocks(h: Hasher, data: np.ndarray, length: int):
    """Blocks of one section: anchor, first and last window, context and
    digest, as arrays."""
    h.load(data)
    first = CONTEXT  # offset of the first gram in a window that may be its anchor
    width = length - 2 * CONTEXT - GRAM + 1
    n_windows = len(data) - length + 1
    anchor = sliding_argmin(h.grams[first:first + n_windows + width - 1], width) + first
    change = np.flatnonzero(np.diff(anchor)) + 1
    p0 = np.concatenate([[0], change])
    p1 = np.concatenate([change - 1, [n_windows - 1]])
    a = anchor[p0]
    core = h.windows(a - CONTEXT, a + GRAM + CONTEXT, 0)
    # digest of the block: its bytes and where the anchor lies
    dig = h.windows(p0, p1 + length, 1)
    dig = (dig ^ ((a - p0).astype(np.uint64) << np.uint64(32)) ^ (p1 - p0).astype(np.uint64)) * np.uint64(ODD)
    dig = dig ^ (dig >> np.uint64(29))
    return a, p0, p1, core, dig


def sections(data: np.ndarray, length: int):
    """``(offset, bytes)`` of overlapping sections; windows of neighbours do not
    overlap."""
    if len(data) < length:
        return
    step = SECTION
    for at in range(0, len(data) - length + 1, step):
        yield at, data[at:min(len(data), at + step + length - 1)]


def text_blocks(length):
    """``(sha, n, core, dig, p0, p1)`` of every block of every text; texts that
    come twice in a batch yield theirs once, with a count ``n``."""
    def run(batches):
        h = Hasher()
        for b in batches:
            seen: dict[bytes, list] = {}
            for sha, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if len(t) < length:
                    continue
                if sha in seen:
                    seen[sha][1] += 1
                else:
                    seen[sha] = [t, 1]
            out = [[] for _ in range(6)]
            held = 0

            def flush():
                cols = [np.concatenate(c) for c in out[1:]]
                return pa.RecordBatch.from_arrays(
                    [pa.array([s for s, m in out[0] for _ in range(m)], pa.binary()),
                     pa.array(cols[0], pa.int64()), pa.array(cols[1].view(np.int64)), pa.array(cols[2].view(np.int64)),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    names=["sha", "n", "core", "dig", "p0", "p1"])

            for sha, (t, n) in seen.items():
                for at, part in sections(np.frombuffer(t, np.uint8), length):
                    _, p0, p1, core, dig = section_blocks(h, part, length)
                    for c, v in zip(out, ((sha, len(p0)), np.full(len(p0), n), core, dig, p0 + at, p1 + at)):
                        c.append(v)
                    held += len(p0)
                if held > 100_000:
                    yield flush()
                    out, held = [[] for _ in range(6)], 0
            if held:
                yield flush()
    return run


def block_suffixes(length):
    """Fingerprints of the suffixes of the wanted blocks of a text: input
    ``sha, text, blocks``; output ``core, dig, salt, off, prints`` where ``off``
    are anchor-relative window offsets."""
    def run(batches):
        h = Hasher()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(core, pa.int64()), pa.array(dig, pa.int64()), pa.array(salt, pa.int32()),
                 pa.array(off, pa.binary()), pa.array(prints, pa.binary())],
                names=["core", "dig", "salt", "off", "prints"])

        for b in batches:
            core, dig, salt, off, prints = [], [], [], [], []
            held = 0
            for t, blocks in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                data = np.frombuffer(t, np.uint8)
                for x in blocks:
                    p = np.arange(x["p0"], x["p1"] + 1)
                    h.load(data[x["p0"]:x["p1"] + length])
                    rel = p - x["p0"]
                    fp = h.windows(rel, rel + length, 0).view(np.int64)
                    # offsets are counted from the anchor, so that equal windows
                    # of different blocks get one salt
                    width = length - 2 * CONTEXT - GRAM + 1
                    anchor = int(sliding_argmin(h.grams[CONTEXT:CONTEXT + width], width)[0]) + CONTEXT
                    o = (anchor - rel) % SALTS
                    for s in range(SALTS):
                        mine = rel[o == s]
                        if len(mine):
                            core.append(x["core"])
                            dig.append(x["dig"])
                            salt.append(s)
                            off.append(mine.astype(np.int32).tobytes())
                            prints.append(fp[mine].tobytes())
                    held += len(rel)
                    if held >= HELD_SUFFIXES:  # a suffix takes twelve bytes, so a batch of texts would give many times its size
                        yield flush()
                        core, dig, salt, off, prints = [], [], [], [], []
                        held = 0
            if core:
                yield flush()
    return run


class Levels:
    """The logarithmic index family of one part: suffix arrays (sorted context
    hash and fingerprint, suffix number) of geometrically growing sizes."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.hits: list[np.ndarray] = []

    def add(self, keys: np.ndarray, refs: np.ndarray) -> None:
        """A new batch: its suffix array, the scan against every level, merges."""
        order = np.argsort(keys, kind="stable")
        keys, refs = keys[order], refs[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        self.hits += [refs[same], refs[same + 1]]
        for old, old_refs in self.levels:
            at = np.searchsorted(old, keys)
            at[at == len(old)] = 0
            match = old[at] == keys
            self.hits += [refs[match], old_refs[at[match]]]
        # a level needs one suffix of each prefix: later equals hit that one
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.levels.append((keys[first], refs[first]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, ra), (b, rb) = self.levels[-2:]
            k, r = np.concatenate([a, b]), np.concatenate([ra, rb])
            o = np.argsort(k, kind="stable")  # a merge of two runs
            k, r = k[o], r[o]
            first = np.concatenate([[True], k[1:] != k[:-1]])
            self.levels[-2:] = [(k[first], r[first])]


def repeated_suffixes(batches):
    """Marks of one part: for every block the offsets of windows that occur in
    another block too, as half-open runs of windows ``(core, dig, w0, w1)``."""
    index, blocks, total = Levels(), [], 0
    starts, offs = [], []
    pend_k, pend_r, held = [], [], 0
    for b in batches:
        cores = b.column(0).to_numpy().view(np.uint64)
        digs = b.column(1).to_numpy()
        for i, (o, p) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist())):
            o, p = np.frombuffer(o, np.int32), np.frombuffer(p, np.uint64)
            blocks.append((int(cores[i].view(np.int64)), int(digs[i])))
            starts.append(total)
            offs.append(o)
            pend_k.append((p ^ (cores[i:i + 1] * np.uint64(ODD2))) * np.uint64(ODD))
            pend_r.append(np.arange(total, total + len(o)))
            total += len(o)
            held += len(o)
            if held >= BATCH:
                index.add(np.concatenate(pend_k), np.concatenate(pend_r))
                pend_k, pend_r, held = [], [], 0
    if held:
        index.add(np.concatenate(pend_k), np.concatenate(pend_r))
    if not total:
        return
    hit = np.zeros(total, bool)
    for r in index.hits:
        hit[r] = True
    core, dig, w = [], [], []
    for (c, d), s, o in zip(blocks, starts, offs):
        mine = o[hit[s:s + len(o)]]
        if len(mine):
            core.append(c)
            dig.append(d)
            w.append(mine)
    yield pa.RecordBatch.from_arrays([pa.array(core, pa.int64()), pa.array(dig, pa.int64()), pa.array(w, pa.list_(pa.int32()))],
                                     names=["core", "dig", "w"])


def cut_out(length):
    """``(sha, n_removed, n_spans, kept)`` from ``sha, text, runs`` (runs of
    repeated window starts)."""
    def run(batches):
        for b in batches:
            removed, spans, kept = [], [], []
            for t, runs in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                r = np.array([(x["w0"], x["w1"]) for x in runs], np.int64)
                r = r[np.argsort(r[:, 0], kind="stable")]
                s, e = r[:, 0], r[:, 1] + length  # bytes covered by windows w0..w1
                top = np.maximum.accumulate(e)
                new = np.concatenate([[True], s[1:] > top[:-1]])
                first = np.flatnonzero(new)
                s, e = s[first], top[np.concatenate([first[1:] - 1, [len(top) - 1]])]
                removed.append(int((e - s).sum()))
                spans.append(len(s))
                cuts = [0, *np.column_stack([s, e]).ravel().tolist(), len(t)]
                kept.append(b"".join(t[x:y] for x, y in zip(cuts[::2], cuts[1::2])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["sha", "n_removed", "n_spans", "kept"])
    return run


def digested(batches):
    for b in batches:
        kept = [hashlib.sha256(x).hexdigest() for x in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(kept, pa.string())], names=["sha", "n_removed", "n_spans", "kept_sha256"])


def repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    """``(sha, w0, w1)``: runs of window starts that are repeated elsewhere."""
    blocks = stored(texts.mapInArrow(text_blocks(length), "sha binary, n long, core long, dig long, p0 long, p1 long"), "blocks")
    seen = (blocks.groupBy("core").agg(F.sum("n").alias("m"), F.min("dig").alias("d0"), F.max("dig").alias("d1"))
            .where("m > 1").select("core", (F.col("d0") != F.col("d1")).alias("mixed")))
    flagged = stored(blocks.join(seen, "core"), "repeated-blocks")
    whole = flagged.where("not mixed").select("sha", F.col("p0").alias("w0"), F.col("p1").alias("w1"))

    mixed = flagged.where("mixed")
    # one representative of each distinct block; with copies it is repeated as such
    reps = mixed.groupBy("core", "dig").agg(F.sum("n").alias("m"), F.min(F.struct("sha", "p0", "p1")).alias("at"))
    wanted = (reps.select("core", "dig", F.col("at.sha").alias("sha"), F.col("at.p0").alias("p0"), F.col("at.p1").alias("p1"))
              .groupBy("sha").agg(F.collect_list(F.struct("core", "dig", "p0", "p1")).alias("blocks")))
    once = texts.join(wanted, "sha").dropDuplicates(["sha"]).select("sha", "text", "blocks")
    suffixes = once.mapInArrow(block_suffixes(length), "core long, dig long, salt int, off binary, prints binary")
    marks = suffixes.repartition("core", "salt").mapInArrow(repeated_suffixes, "core long, dig long, w array<int>")
    hits = marks.groupBy("core", "dig").agg(F.flatten(F.collect_list("w")).alias("w"))
    copies = reps.where("m > 1").select("core", "dig", F.lit(True).alias("all"))
    some = (mixed.join(copies, ["core", "dig"], "left").where("all is null").drop("all", "mixed")
            .join(hits, ["core", "dig"]).select("sha", F.explode("w").alias("w"), "p0")
            .select("sha", (F.col("p0") + F.col("w")).alias("w0")).withColumn("w1", F.col("w0")))
    full = mixed.join(copies, ["core", "dig"]).select("sha", F.col("p0").alias("w0"), F.col("p1").alias("w1"))
    return whole.union(full).union(some)


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    if length < 2 * CONTEXT + 2 * GRAM:
        raise ValueError(f"length must be at least {2 * CONTEXT + 2 * GRAM}")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_column(text_col).alias("text"))
    rows = rows.withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = rows.select("sha", "text")
    runs = (repeated_runs(texts, length).groupBy("sha")
            .agg(F.collect_list(F.struct("w0", "w1")).alias("runs")))
    touched = texts.join(runs, "sha").dropDuplicates(["sha"]).select("sha", "text", "runs")
    cut = touched.mapInArrow(cut_out(length), "sha binary, n_removed long, n_spans long, kept binary")
    cut = cut.mapInArrow(digested, "sha binary, n_removed long, n_spans long, kept_sha256 string")
    out = rows.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")).join(cut, "sha", "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                      F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"))


ship_by_value(__name__)
