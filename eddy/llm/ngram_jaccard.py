"""N-gram Jaccard join with token-combination prefixes (operator 1).

Documents are sets of word n-grams (64-bit hashes of the lower-cased words).
Two documents link when ``|a & b| / |a | b| >= threshold``. All documents with
one set are one node (a 128-bit digest of the set), so copies are joined once.

Candidate generation
    The n-grams of a document are ordered from rare to frequent by a count
    sketch over all documents (equal counts by hash), the same order for all.
    N-grams whose counter is above ``frequent`` times the mean form the frequent
    classes, all others the rare class. With overlap o needed, two linked
    documents share at least e n-grams among the first ``size - o + e`` of each.

    * A prefix that lies in the rare class has e = 1: its n-grams are indexed
      one by one.
    * A prefix that reaches the frequent n-grams is extended. These are split
      by hash into s classes and e = 1 + s: the documents then share a rare
      n-gram or, by the pigeonhole principle, two n-grams of one class. So
      pairs (2-token combinations) within each class are indexed. s grows with
      the length of the prefix (``per_class`` n-grams a class), so the pairs
      grow in proportion. s depends on a size level; sizes of linked documents
      differ by at most the threshold, hence by one level at most, and every
      document is indexed for its own level and the next. Where o may be s or
      less (low thresholds, few n-grams), the prefix for e = 1 is indexed one by
      one as well.

Joining
    A signature at place i of a document leaves room for only so much overlap
    (positional filter); pairs whose sizes or rooms rule a link out are never made.
    Round 1 (hubs): each signature's members are checked against one member (with
    the most room) of their size level only, which is linear in the postings. Links
    found make components.
    Round 2 (rest): within a signature, members of different components whose
    sizes are compatible are checked pairwise, unless the parity bits of their sets
    (:func:`parities`) differ in too many places for a link. Every pair that shares a
    signature is thus checked or already connected: no link between different
    components is lost, and a large group of near copies costs its hubs only.
    The result is one row per document with its component, and the verified links
    between representatives (:func:`similar_pairs`). Link counts are optional, since
    they need all pairs of a component (of near sizes), intersected as products of
    presence matrices, block by block (:func:`link_counts`): quadratic in a
    component's distinct sets, as the counts themselves are.

    A pair is first checked by count vectors (n-grams per hash cell), which
    bound the overlap from above; the whole sets, recomputed from the texts, are
    intersected for the pairs that are left.

Scale: two text passes (counts, signatures) and one over the candidates' texts.
The sketch is a fixed ``2 ** SKETCH_BITS`` counters, whatever the input; tasks
send it in slices that are summed by slice. Postings hold a hash and a node.
A signature that many documents share is handled by ordinary joins (AQE splits
it) against one hub row. Labels come from :func:`common.connected_components`.
The driver reads the sketch's ranks (8 MB) and small counters.

Edge cases: fewer words than n make one n-gram of the whole sequence; NULL,
empty and wordless texts have the empty set, link with nothing and are their
own component; NULL ids never name a component (a component of NULL ids only
is NULL); repeated rows and repeated ids are nodes by their text. An empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import reduce
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, connected_components, emptied, give_back, ship_by_value, small_batches, stored, stored_at, text_column

SKETCH_BITS = 23
SLICES = 64
#: an n-gram is frequent when its counter exceeds this many times the mean
FREQUENT = 4.0
#: frequent prefix n-grams a class holds on average
PER_CLASS = 6
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: distinct words a task remembers the hashes of
CACHE_WORDS = 150_000
#: cells of the count vector that bounds an overlap
CELLS = 256
#: longs of the parity bits that bound a symmetric difference
PARITY_LONGS = 8
#: n-grams and sets that a block of the link counts holds, and n-grams of a product
BLOCK_GRAMS, BLOCK_SETS, SLICE_GRAMS = 200_000, 512, 2048
#: rows of a batch that become Python objects at a time
SLICE_ROWS = 256
#: candidate texts up to which their hashes are broadcast to the text scan
MAX_BROADCAST = 500_000


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (two multiply-and-shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Word n-gram hashes of texts."""

    def __init__(self, n: int):
        self.n, self.seen = n, {}

    def word_hashes(self, text: bytes) -> np.ndarray:
        words = text.translate(UPPER).split()  # bytes split at exactly the ASCII white space
        seen = self.seen
        if len(seen) > CACHE_WORDS:
            seen.clear()
        for w in words:
            if w not in seen:
                seen[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.array([seen[w] for w in words], np.uint64)

    def grams(self, text: bytes) -> np.ndarray:
        """Hashes of all n-grams, repeats included."""
        h = self.word_hashes(text)
        if not len(h):
            return h
        n = min(self.n, len(h))
        m = len(h) - n + 1
        out = np.full(m, n, np.uint64)
        for k in range(n):
            out = mix64(out ^ h[k:k + m]) + np.uint64(k + 1)
        return out


def sliced(batches, rows: int = SLICE_ROWS):
    """Batches of few rows: only so many become Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
        give_back()


def as_bytes(column) -> list:
    return column.cast(pa.binary()).to_pylist()


# ---------------------------------------------------------------- the sketch
def sketch_counts(n, bits):
    size, width = 1 << bits, (1 << bits) // SLICES

    def run(batches):
        total, sh = np.zeros(size, np.int32), Shingler(n)
        for b in sliced(batches):
            slots = [sh.grams(t) >> np.uint64(64 - bits) for t in as_bytes(b.column(0))]
            if slots:
                slot, n_slot = np.unique(np.concatenate(slots), return_counts=True)
                total[slot.astype(np.int64)] += n_slot.astype(np.int32)
        for i in range(SLICES):
            part = total[i * width:(i + 1) * width]
            # one byte a counter, those above it by place and count
            high = np.flatnonzero(part > 255).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (np.where(part > 255, 0, part).astype(np.uint8), high, part[high]))],
                names=["slice", "counts", "high", "high_counts"])
    return run


def scale(counts):
    return np.minimum(255, np.round(6 * np.log2(1.0 + counts)))


def summed_slices(pdf):
    total = sum(np.frombuffer(c, np.uint8).astype(np.int64) for c in pdf["counts"])
    for places, counts in zip(pdf["high"], pdf["high_counts"]):
        total[np.frombuffer(places, np.int32)] += np.frombuffer(counts, np.int32)
    return pdf[["slice"]].iloc[:1].assign(counts=[scale(total).astype(np.uint8).tobytes()], grams=int(total.sum()))


def ranks(rows: DataFrame, n: int, bits: int) -> tuple[np.ndarray, int]:
    """Per counter a small integer that grows with the count (log scale, a
    sixth of a power of two a step), over all n-grams of all documents; and the
    rank above which an n-gram is frequent."""
    parts = rows.select("text").mapInArrow(sketch_counts(n, bits), "slice int, counts binary, high binary, high_counts binary")
    got = parts.groupBy("slice").applyInPandas(summed_slices, "slice int, counts binary, grams long").collect()
    if not got:
        return np.zeros(1 << bits, np.uint8), 0
    rank = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in sorted(got, key=lambda r: r["slice"])])
    mean = sum(r["grams"] for r in got) / (1 << bits)
    return rank, int(scale(FREQUENT * max(1.0, mean)))


# ------------------------------------------------------------- the signatures
def size_level(size: int, t: float) -> int:
    return int(math.log(size) / -math.log(t) + 1e-9)


def level_column(size: str, num: int, den: int) -> Column:
    """:func:`size_level` of a column."""
    return F.floor(F.log(F.col(size)) / -math.log(num / den) + 1e-9).cast("int")


def classes_at(level: int, t: float, per_class: int) -> int:
    """Number of frequent classes at a size level (from its largest prefix)."""
    largest = t ** -(level + 1)
    return max(1, int((1 - t) * largest / per_class))


def need(size: int, num: int, den: int) -> int:
    """Smallest overlap of a set of this size with any set it links to."""
    return -(-size * num // den)


def signatures(grams: np.ndarray, rank: np.ndarray, limit: int, num: int, den: int, per_class: int, bits: int):
    """Signatures of one set (sorted distinct n-grams) and the room
    of each: the largest overlap with any set that has no earlier signature in
    common. The first common rare n-gram at place i leaves ``size - i``; before
    the end of the first common pair, at place i, every class has at most one
    common n-gram, which leaves ``s + size - i``."""
    t, size = num / den, len(grams)
    r = rank[(grams >> np.uint64(64 - bits)).astype(np.int64)]
    order = np.lexsort((grams, r))
    grams, frequent = grams[order], r[order] > limit
    n_rare = int(size - frequent.sum())
    short = size - need(size, num, den) + 1
    if short <= n_rare:
        return grams[:short], size - np.arange(short)
    out, rooms, longest, few = [], [], short, False
    for level in (size_level(size, t), size_level(size, t) + 1):
        s = classes_at(level, t, per_class)
        prefix = min(size, short + s)
        longest = max(longest, prefix)
        few = few or need(size, num, den) <= s
        own = grams[n_rare:prefix]
        if len(own) < 2:
            continue
        cls = mix64(own + np.uint64(level)) % np.uint64(s)
        o = np.argsort(cls, kind="stable")  # by place within a class
        own, cls, place = own[o], cls[o], n_rare + o
        first = np.searchsorted(cls, cls, side="left")
        for gap in range(1, int((np.arange(len(own)) - first).max()) + 1):
            same = cls[gap:] == cls[:-gap]
            if not same.any():
                break
            a, b = own[:-gap][same], own[gap:][same]
            out.append(mix64(mix64(a + np.uint64(2 * level + 1)) ^ b))
            rooms.append(np.minimum(size, s + size - place[gap:][same]))
    if few:  # a link may share s n-grams or fewer, of which no two need be in one class
        out.append(grams[n_rare:short])
        rooms.append(size - np.arange(n_rare, short))
    rare = min(longest, n_rare)
    return np.concatenate([grams[:rare], *out]), np.concatenate([size - np.arange(rare), *rooms])


def count_vector(grams: np.ndarray) -> bytes:
    """N-grams per hash cell, at most 255: the smaller of two vectors, summed,
    bounds the overlap from above (255 stands for any number)."""
    return np.minimum(np.bincount((grams & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes()


def parities(grams: np.ndarray) -> np.ndarray:
    """One bit a hash cell, whether it holds an odd number of n-grams, as longs. Each
    n-gram that only one of two sets holds flips one cell, so the sets differ in at
    least as many n-grams as the bits in which they do."""
    odd = np.bincount((grams >> np.uint64(8) & np.uint64(64 * PARITY_LONGS - 1)).astype(np.int64), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def document_rows(n, num, den, per_class, bits, shared):
    """``(id, text hash, n_shingles, node, signatures, rooms, count vector, parity
    bits)`` of every row; within a slice of a batch the last four are given once per set."""
    least = 1 if 2 * num <= den else 2  # one n-gram can be half of another set

    def run(batches):
        rank, limit = shared.value
        sh = Shingler(n)
        for b in sliced(batches):
            size, node, sigs, rooms, vec, par, seen = [], [], [], [], [], [], set()
            for t in as_bytes(b.column(1)):
                g = np.unique(sh.grams(t))
                size.append(len(g))
                key = hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None
                node.append(key)
                if len(g) < least or key in seen:
                    sigs.append(None)
                    rooms.append(None)
                    vec.append(None)
                    par.append(None)
                else:
                    vec.append(count_vector(g))
                    par.append(parities(g))
                    seen.add(key)
                    sig, room = signatures(g, rank, limit, num, den, per_class, bits)
                    sigs.append(sig.view(np.int64))
                    rooms.append(room.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(size, pa.int64()), pa.array(node, pa.binary()), pa.array(sigs, pa.list_(pa.int64())),
                 pa.array(rooms, pa.list_(pa.int32())), pa.array(vec, pa.binary()), pa.array(par, pa.list_(pa.int64()))],
                names=["id", "th", "n", "node", "sigs", "rooms", "vec", "par"])
    return run


# ------------------------------------------------------------------ the checks
def set_rows(n):
    def run(batches):
        sh = Shingler(n)
        for b in sliced(batches):
            sets = [np.unique(sh.grams(t)) for t in as_bytes(b.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(g.tobytes(), digest_size=16).digest() for g in sets], pa.binary()),
                 pa.array([g.tobytes() for g in sets], pa.binary())], names=["node", "grams"])
    return run


def checked(num, den):
    def run(batches):
        for b in sliced(batches):
            a, bb = b.column(0).to_pylist(), b.column(1).to_pylist()
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            m = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()).filter(m), pa.array(bb, pa.binary()).filter(m)], names=["a", "b"])
    return run


def possible(num, den):
    """Pairs whose count vectors allow the overlap that a link needs."""
    def run(batches):
        for b in sliced(batches, 4 * SLICE_ROWS):
            na, nb = (b.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            vec = [np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, CELLS) for i in (4, 5)]
            low = np.minimum(*vec)
            most = low.sum(1, dtype=np.int64) + np.where((low == 255).any(1), np.minimum(na, nb), 0)
            ok = pa.array((num + den) * most >= num * (na + nb))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["a", "b"])
    return run


def links(pairs: DataFrame, where: DataFrame, rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The ``pairs`` (a, b) of nodes that link. ``where``: ``(node, n, vec,
    th)``: size and count vector of each node, and the hash of a text of it, by
    which the texts of the pairs that are left are found again."""
    a, b = (where.select(F.col("node").alias(x), F.col("n").alias("n" + x), F.col("vec").alias("v" + x)) for x in "ab")
    pairs = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "va", "vb")
    pairs = stored(pairs.mapInArrow(possible(num, den), "a binary, b binary"), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    keys = stored(wanted.join(where, "node").select("th"), "jaccard-keys")
    if keys.count() <= MAX_BROADCAST:  # else the scan is shuffled
        keys = F.broadcast(keys)
    texts = rows.select("text", "th").join(keys, "th", "left_semi").select("text")
    sets = texts.mapInArrow(set_rows(n), "node binary, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    sets = stored(sets, "jaccard-sets")
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "gb")
    return both.mapInArrow(checked(num, den), "a binary, b binary")


# ----------------------------------------------------------- the link counts
def pair_overlaps(x: list, y: list) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every one of ``y``:
    products of presence matrices, ``SLICE_GRAMS`` n-grams at a time."""
    out = np.zeros((len(x), len(y)), np.float32)
    grams, where = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    row = np.repeat(np.arange(len(x) + len(y)), [len(g) for g in (*x, *y)])
    several = np.bincount(where) > 1  # the others are in no intersection
    place = (np.cumsum(several) - 1)[where]
    use = several[where]
    row, place = row[use], place[use]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    cuts = np.searchsorted(place, np.arange(0, int(several.sum()) + SLICE_GRAMS, SLICE_GRAMS))
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        m = np.zeros((len(x) + len(y), int(place[j - 1]) - k * SLICE_GRAMS + 1), np.float32)
        m[row[i:j], place[i:j] - k * SLICE_GRAMS] = 1
        out += m[:len(x)] @ m[len(x):].T
    return out


def counted(num, den):
    """Link counts from rows sorted by group: in a group every set of side 0
    meets every one of side 1, or, where there is no side, all meet all."""
    def group_links(rows):
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        size, copies = np.array([len(g) for g in sets], np.float64), np.array([r[3] for r in rows], np.int64)
        side = np.array([-1 if r[1] is None else r[1] for r in rows])
        x = np.flatnonzero(side < 1)
        y = x if side[0] < 0 else np.flatnonzero(side == 1)
        if not len(x) or not len(y):
            return
        both = pair_overlaps([sets[i] for i in x], [sets[i] for i in y]).astype(np.float64)
        link = den * both >= num * (size[x][:, None] + size[y] - both)
        if y is x:
            np.fill_diagonal(link, False)
        for at, got in ((x, link @ copies[y]), *([] if y is x else [(y, copies[x] @ link)])):
            for i, c in zip(at, got):
                if c:
                    yield rows[i][4], int(c)

    def run(batches):
        rows = (r for b in sliced(batches) for r in zip(*(b.column(c).to_pylist() for c in ("grp", "side", "grams", "copies", "node"))))
        found = (f for _, g in groupby(rows, key=itemgetter(0)) for f in group_links(list(g)))
        while part := list(islice(found, 10_000)):
            node, links = zip(*part)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(links, pa.int64())], names=["node", "links"])
    return run


def link_counts(rows: DataFrame, where: DataFrame, comp: DataFrame, copies: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``(node, n_links)``: the rows of other nodes that a node links with.

    Linked nodes are in one component and at most one size level apart. So the
    nodes of a component and level are dealt into blocks of bounded size, and
    every two blocks of a level and of neighbouring levels make one group, in
    which all pairs are intersected. No pair becomes a row."""
    members = comp.join(where, "node").join(copies, "node").withColumn("level", level_column("n", num, den))
    members = stored(members.select("node", "root", "n", "level", "th", "copies"), "jaccard-members")
    keys = members.select("th")
    if members.count() <= MAX_BROADCAST:  # else the scan is shuffled
        keys = F.broadcast(keys)
    texts = rows.select("text", "th").join(keys, "th", "left_semi").select("text")
    sets = texts.mapInArrow(set_rows(n), "node binary, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    levels = members.groupBy("root", "level").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks"), F.count("*").alias("held"))
    at = lambda by, name: levels.select("root", (F.col("level") + by).alias("level"), F.col("blocks").alias(name))
    levels = levels.join(at(1, "below"), ["root", "level"], "left").join(at(-1, "above"), ["root", "level"], "left")
    dealt = members.select("node", "root", "level", "copies").join(stored(levels, "jaccard-levels"), ["root", "level"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def key(level, across, i, j, side):
        return F.struct(F.col("root"), level.alias("level"), F.lit(across).alias("across"), i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    def each(count, make, condition):
        """One key for each block that ``count`` numbers, if there is any."""
        to = F.when(condition, F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(to, make)

    own, level = F.col("own"), F.col("level")
    none = F.lit(None).cast("int")
    same = each("blocks", lambda j: key(level, False, F.least(own, j), F.greatest(own, j), F.when(own < j, 0).when(own > j, 1).otherwise(none)), F.col("held") > 1)
    up = each("above", lambda j: key(level, True, own, j, F.lit(0)), F.col("above").isNotNull())
    down = each("below", lambda i: key(level - 1, True, i, own, F.lit(1)), F.col("below").isNotNull())
    dealt = dealt.select("node", "copies", F.explode(F.concat(same, up, down)).alias("k"))
    # a group of two blocks i < j meets across them only; within a block is the group (i, i)
    groups = dealt.select("node", "copies", F.concat_ws(":", F.hex("k.root"), "k.level", "k.across", "k.i", "k.j").alias("grp"), F.col("k.side").alias("side"))
    met = groups.join(sets, "node").select("grp", "side", "grams", "copies", "node")
    met = met.repartition("grp").sortWithinPartitions("grp")
    return met.mapInArrow(counted(num, den), "node binary, links long").groupBy("node").agg(F.sum("links").alias("n_links"))


# ------------------------------------------------------------- the operator
def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    return rows.withColumn("th", F.xxhash64("text"))


def verified_links(rows: DataFrame, n: int, num: int, den: int, per_class: int, bits: int):
    """``(made, where, pairs)``: every row's id, size and node; size, count vector
    and text hash of the nodes; the verified links ``(a, b)`` of both rounds, which
    connect all that is connected."""
    spark = rows.sparkSession
    small_batches(spark)
    kind = rows.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(ranks(rows, n, bits))
    made = rows.select("id", "text", "th").mapInArrow(
        document_rows(n, num, den, per_class, bits, shared), f"id {kind}, th long, n long, node binary, sigs array<long>, rooms array<int>, vec binary, par array<long>")
    full, path = stored_at(made, "jaccard-full")
    made = stored(full.select("id", "n", "node"), "jaccard-rows")
    nodes = full.where("sigs is not null").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "sigs", "rooms", "vec", "par", "th")])
    nodes = stored(nodes, "jaccard-nodes")
    emptied(spark, path)  # signatures of all rows; from here on those of the nodes are enough
    where = nodes.select("node", "n", "vec", "th")
    postings = nodes.select("node", "n", F.explode(F.arrays_zip("sigs", "rooms")).alias("x")).select(
        "node", "n", F.col("x.sigs").alias("sig"), F.col("x.rooms").alias("room"))

    def fits(na, nb, ra, rb):
        """Whether sizes and rooms allow a link."""
        return ((F.col(na) * den >= F.col(nb) * num) & (F.col(nb) * den >= F.col(na) * num)
                & (F.least(ra, rb) * (num + den) >= (F.col(na) + F.col(nb)) * num))

    several = postings.groupBy("sig").agg(F.count("*").alias("members")).where("members > 1")
    shared_rows = postings.join(several, "sig").withColumn("level", level_column("n", num, den))
    shared_rows = stored(shared_rows, "jaccard-postings")
    hubs = (shared_rows.groupBy("sig", "level").agg(F.min(F.struct((-F.col("room")).alias("r"), "node", "n")).alias("h"))
            .select("sig", "level", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n"), (-F.col("h.r")).alias("hub_room")))

    # round 1: every member against the hub of its signature and size level
    pairs = shared_rows.join(hubs, ["sig", "level"]).where((F.col("node") != F.col("hub")) & fits("n", "hub_n", "room", "hub_room")).select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    pairs = stored(pairs, "jaccard-hubs")  # used again by round 2
    found = stored(links(pairs, where, rows, n, num, den), "jaccard-links")
    comp = stored(connected_components(found), "jaccard-comp")

    # round 2: members of one signature that are not connected yet
    labelled = (shared_rows.join(comp, "node", "left")
                .select("sig", "node", "n", "room", "level", F.coalesce("root", "node").alias("root")))
    mixed = labelled.groupBy("sig").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2").select("sig")
    bits_of = nodes.select("node", *[F.col("par")[i].alias(f"p{i}") for i in range(PARITY_LONGS)])
    open_rows = stored(labelled.join(mixed, "sig").join(bits_of, "node"), "jaccard-open")  # both sides of the join
    side = lambda x: [F.col(f"p{i}").alias(f"{x}{i}") for i in range(PARITY_LONGS)]
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"pa{i}").bitwiseXOR(F.col(f"pb{i}"))) for i in range(PARITY_LONGS)])
    near = apart * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)
    x = open_rows.select("sig", F.col("level").alias("at"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("room").alias("ma"), F.col("root").alias("ra"), *side("pa"))
    y = open_rows.select("sig", F.explode(F.array("level", F.col("level") - 1)).alias("at"), F.col("level").alias("lb"),
                         F.col("node").alias("b"), F.col("n").alias("nb"), F.col("room").alias("mb"), F.col("root").alias("rb"), *side("pb"))
    # each pair once: within a level by node, else from the lower level
    rest = (x.join(y, ["sig", "at"]).where(((F.col("lb") != F.col("at")) | (F.col("a") < F.col("b"))) & (F.col("ra") != F.col("rb"))
                                           & fits("na", "nb", "ma", "mb") & near)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rest = stored(rest.join(pairs, ["a", "b"], "left_anti"), "jaccard-rest")
    more = stored(links(rest, where, rows, n, num, den), "jaccard-links")
    return made, where, found.union(more)


def jaccard_components(docs: DataFrame, *, n: int = 3, num: int = 90, den: int = 100, id_col="doc_id",
                       text_col="text", per_class: int = PER_CLASS, bits: int = SKETCH_BITS, counts: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_copies, partner_id`` of every row of
    ``docs``: ``component_id`` is the smallest id reachable by links between
    documents of Jaccard similarity ``num / den`` or more over word ``n``-grams,
    ``n_copies`` the number of rows with the same set, ``partner_id`` the smallest id
    of one set that a verified link connects with the row's (NULL: it links with
    copies only). With ``counts`` also ``n_links``, the number of other rows that the
    row links with, copies included; that part intersects all pairs of a component."""
    rows = text_rows(docs, id_col, text_col)
    made, where, pairs = verified_links(rows, n, num, den, per_class, bits)
    pairs = stored(pairs, "jaccard-links")
    comp = stored(connected_components(pairs), "jaccard-comp")
    nodes = made.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = nodes.join(comp, "node", "left").withColumn("label", F.coalesce("root", "node"))
    classes = nodes.groupBy("label").agg(F.min("least").alias("component_id"))
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partner = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    partner = partner.join(nodes.select(F.col("node").alias("b"), F.col("least").alias("partner_id")), "b").select("node", "partner_id")
    known = nodes.join(classes, "label").join(partner, "node", "left").select("node", "copies", "component_id", "partner_id")
    out = made.select("id", "n", "node").join(known, "node", "left")
    cols = [F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("copies", F.lit(1)).alias("n_copies"), "partner_id"]
    if counts:
        degree = link_counts(rows, where, comp, nodes.select("node", "copies"), n, num, den)
        out = out.join(degree, "node", "left")
        cols.append((F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"))
    return out.select(*cols)


def similar_pairs(docs: DataFrame, *, n: int = 3, num: int = 90, den: int = 100, id_col="doc_id", text_col="text",
                  per_class: int = PER_CLASS, bits: int = SKETCH_BITS) -> tuple[DataFrame, DataFrame]:
    """``(pairs, members)``: verified links ``(a, b)`` between representatives (each
    the digest of a set of n-grams) that connect all that is connected, and
    ``(doc_id, representative)`` of every row (NULL without words)."""
    made, _, pairs = verified_links(text_rows(docs, id_col, text_col), n, num, den, per_class, bits)
    return pairs, made.select(F.col("id").alias("doc_id"), F.col("node").alias("representative"))


def one_of_each(docs: DataFrame, *, n: int, num: int, den: int, id_col="doc_id", text_col="text",
                per_class: int = PER_CLASS, bits: int = SKETCH_BITS) -> DataFrame:
    """The rows of ``docs`` without words, and exactly one row of each component:
    the smallest id (NULL last), then the smallest SHA-256 of the text. Rows are
    told apart by id and SHA-256; of rows equal in both one stays."""
    key = F.unhex(F.sha2(text_column(text_col).cast("binary"), 256))
    rows = docs.select(F.struct(F.col(id_col).alias("id"), key.alias("key")).alias("id"), text_column(text_col).alias("text"))
    made, _, pairs = verified_links(rows.withColumn("th", F.xxhash64("text")), n, num, den, per_class, bits)
    comp = connected_components(pairs)
    own = made.where("node is not null").join(comp, "node", "left")
    first = F.min(F.struct(F.col("id.id").isNull().alias("no_id"), F.col("id.id").alias("id"), F.col("id.key").alias("key")))
    stay = own.groupBy(F.coalesce("root", "node").alias("label")).agg(first.alias("s")).select(F.col("s.id").alias("stay_id"), F.col("s.key").alias("stay_key"))
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), key.alias("key"),
                         text_column(text_col).rlike(WORD_RE).alias("words"))
    # a text belongs to one component, so at most one row to stay has its key; the
    # rows with that text and id are counted where the join has put them
    kept = packed.where("words").join(stay, F.col("key") == F.col("stay_key")).where(F.col("id").eqNullSafe(F.col("stay_id")))
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    kept = kept.withColumn("nth", nth).where("nth = 1")
    return kept.select("row.*").unionByName(packed.where("not words").select("row.*"))


ship_by_value(__name__)
