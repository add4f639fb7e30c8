"""Exact deduplication with Patricia tries (operator 3).

Two texts are equal when they are identical after deleting every ASCII white
space character. Rows are dealt out by length and content hash of that
normalised byte string; each partition inserts the full byte strings into a
compressed radix trie whose terminal nodes hold the owner (most code points in
the original text, then smallest id) and the number of rows.

* Map side: every task first runs its rows through a trie of its own, so a
  text that makes up a third of the table leaves each task once, not once per
  copy. When the trie holds more than ``budget`` bytes its terminals are
  passed on and it starts anew; the reduce side merges partial owners.
* Reduce side: rows arrive sorted by (length, hash). Over the budget, every
  subtree left of the current key is finished, so it is spilled: its owners
  are emitted and the nodes dropped. Memory stays at the budget plus one text.
* Each row then finds its owner by an ordinary join on the SHA-256 of the
  normalised text (narrow rows; AQE splits a hot value).

Edge cases: a NULL text counts as empty, so NULL, empty and all-white texts are
one group. NULL ids come after all others as owners. Of fully repeated rows
(same id, same text) exactly one is kept. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, batch_texts, ship_by_value, small_batches, text_column

#: bytes a trie may hold before it spills
TRIE_BUDGET = 32 << 20
#: rows of a batch that are Python objects at a time
SLICE = 256


class Node:
    __slots__ = ("label", "kids", "owner")

    def __init__(self, label, owner=None):
        self.label, self.kids, self.owner = label, {}, owner


def better(a, b):
    """The owner of two ``(code points, id, rows)``; the rows add up."""
    first = lambda o: (-o[0], o[1] is None, o[1] if o[1] is not None else 0)
    x = a if first(a) <= first(b) else b
    return (x[0], x[1], a[2] + b[2])


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Patricia:
    """Compressed radix trie over byte strings with owners at terminals."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def insert(self, key: bytes, owner) -> None:
        node, pos = self.root, 0
        while pos < len(key):
            kid = node.kids.get(key[pos])
            if kid is None:
                kid = node.kids[key[pos]] = Node(key[pos:], owner)
                self.held += len(kid.label) + 300
                return
            if key.startswith(kid.label, pos):
                node, pos = kid, pos + len(kid.label)
                continue
            k = common_length(kid.label, key[pos:pos + len(kid.label)])
            mid = Node(kid.label[:k])
            kid.label = kid.label[k:]
            mid.kids[kid.label[0]] = kid
            node.kids[key[pos]] = mid
            self.held += 300
            node, pos = mid, pos + k
        node.owner = owner if node.owner is None else better(node.owner, owner)

    @staticmethod
    def terminals(node: Node, prefix: bytes):
        """``(key, owner)`` of every terminal at or below ``node``."""
        stack = [(node, prefix)]
        while stack:
            n, p = stack.pop()
            if n.owner is not None:
                yield p, n.owner
            stack += [(k, p + k.label) for k in n.kids.values()]

    def spill_before(self, key: bytes):
        """Emit and cut off every subtree that is not on the path of ``key``:
        with sorted input no later key can reach them."""
        node, pos = self.root, 0
        while pos < len(key):
            on_path = node.kids.get(key[pos])
            for b, kid in list(node.kids.items()):
                if kid is not on_path:
                    yield from self.terminals(kid, key[:pos] + kid.label)
                    del node.kids[b]
            if node.owner is not None:
                yield key[:pos], node.owner
                node.owner = None
            if on_path is None or not key.startswith(on_path.label, pos):
                break
            node, pos = on_path, pos + len(on_path.label)
        self.held = len(key) + 300

    def drain(self):
        yield from self.terminals(self.root, b"")
        self.root, self.held = Node(b""), 0


def normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE)


def byte_texts(texts: pa.Array):
    """Texts as bytes, NULL as empty, with their code points; some at a time,
    so that a task holds a batch once."""
    for at in range(0, len(texts), SLICE):
        part = pc.fill_null(texts.slice(at, SLICE), "")
        yield from zip(part.cast(pa.binary()).to_pylist(), pc.utf8_length(part).to_pylist())


def digests(field):
    """``(id, code points, SHA-256 of the normalised text)`` of every row, and
    ``extra`` where the batch has it."""
    def run(batches):
        for b in batches:
            sha, cps = [], []
            for t, cp in byte_texts(batch_texts(b, field)):
                sha.append(hashlib.sha256(normalised(t)).digest())
                cps.append(cp)
            extra = [b.column("extra")] if "extra" in b.schema.names else []
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(cps, pa.int64()), pa.array(sha, pa.binary()), *extra],
                names=["id", "n_cp", "sha", *["extra"] * len(extra)])
    return run


def owner_batches(found, id_type, size=8 << 20):
    """Arrow batches of ``(len, hash, norm, n_cp, id, n)`` from trie terminals."""
    rows, held = [], 0

    def flush():
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), id_type, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["len", "hash", "norm", "n_cp", "id", "n"])

    for key, owner in found:
        norm = key[16:]
        rows.append((len(norm), int.from_bytes(key[8:16], "big", signed=True), norm, *owner))
        held += len(norm) + 64
        if held > size:
            yield flush()
            rows, held = [], 0
    if rows:
        yield flush()


def trie_key(norm: bytes, signed_hash: int | None = None) -> bytes:
    """Length, content hash, full bytes: big-endian, so keys sort like rows."""
    h = (hashlib.sha256(norm).digest()[:8] if signed_hash is None
         else signed_hash.to_bytes(8, "big", signed=True))
    return len(norm).to_bytes(8, "big") + h + norm


def local_owners(budget):
    def run(batches):
        trie, kind = Patricia(), None

        def found():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                for i, (t, cp) in zip(b.column(0).to_pylist(), byte_texts(b.column(1))):
                    trie.insert(trie_key(normalised(t)), (cp, i, 1))
                    if trie.held > budget:
                        yield from trie.drain()
            yield from trie.drain()

        first = next(gen := found(), None)
        if first is not None:
            yield from owner_batches((x for part in ([first], gen) for x in part), kind)
    return run


def merged_owners(budget):
    def run(batches):
        trie, id_type = Patricia(), None

        def found():
            nonlocal id_type
            for b in batches:
                id_type = b.schema.field(4).type
                c = [x.to_pylist() for x in b.columns]
                for h, norm, cp, i, n in zip(*c[1:]):
                    key = trie_key(norm, h)
                    if trie.held > budget:
                        yield from trie.spill_before(key)
                    trie.insert(key, (cp, i, n))
            yield from trie.drain()

        def batch(rows):
            sha, cp, i, n = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(sha, pa.binary()), pa.array(cp, pa.int64()), pa.array(i, id_type), pa.array(n, pa.int64())],
                names=["sha", "keep_cp", "keep_id", "n"])

        rows = []
        for key, (cp, i, n) in found():
            rows.append((hashlib.sha256(key[16:]).digest(), cp, i, n))
            if len(rows) == 10_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)
    return run


def exact_owners(docs: DataFrame, *, id_col="doc_id", text_col="text",
                 budget: int = TRIE_BUDGET) -> DataFrame:
    """``(sha, keep_cp, keep_id, n)`` of every distinct normalised text."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    part = rows.mapInArrow(local_owners(budget), f"len long, hash long, norm binary, n_cp long, id {kind}, n long")
    dealt = part.repartition("len", "hash").sortWithinPartitions("len", "hash")
    return dealt.mapInArrow(merged_owners(budget), f"sha binary, keep_cp long, keep_id {kind}, n long")


def exact_dedup(docs: DataFrame, *, id_col="doc_id", text_col="text",
                budget: int = TRIE_BUDGET, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256`` and the columns named in ``carry``."""
    kind = docs.schema[id_col].dataType.simpleString()
    own = exact_owners(docs, id_col=id_col, text_col=text_col, budget=budget)
    field = carry.index(text_col) if text_col in carry else None
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), *([F.col(text_col).alias("text")] if field is None else []),
                       *([F.struct(*[F.col(c) for c in carry]).alias("extra")] if carry else []))
    fields = f"id {kind}, n_cp long, sha binary"
    if carry:
        fields += f", extra {rows.schema['extra'].dataType.simpleString()}"
    rows = rows.mapInArrow(digests(field), fields)
    joined = rows.join(own, "sha")
    # the owner's row; of fully repeated rows one, so rows are numbered only
    # among the rows that could be the owner; hex() makes this a shuffle of its
    # own on (text, id), so the join below it stays free to split a hot text
    mine = joined.withColumn("cand", (F.col("n_cp") == F.col("keep_cp")) & F.col("id").eqNullSafe(F.col("keep_id")))
    nth = F.row_number().over(Window.partitionBy(F.hex("sha"), "cand", "id", "n_cp").orderBy(F.lit(0)))
    return mine.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.col("cand") & (nth == 1)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
        *([F.col("extra")] if carry else []))


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_cp,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT *, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS rn,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM d WINDOW g AS (PARTITION BY norm ORDER BY n_cp DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

ship_by_value(__name__)
