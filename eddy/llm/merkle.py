"""Merkle manifest of a dataset with proofs by butterfly exchange (operator 11).

Every row is a leaf, a SHA-256 over its fields, each as ``-`` for NULL or else
UTF-8 byte count, colon, value. Per group (``lang``) leaves ascend by id; while
more than one node remains, every ``fanout`` consecutive ones (the last run may
be shorter, even a single one) become the SHA-256 of their hex digests. What
remains is the group's subroot; subroots, NULL group first, then by UTF-8
bytes, make the root in the same way. A leaf's proof is the SHA-256 of its
siblings' hex digests from its own level up to the root.

Butterfly exchange
    A group's leaves are cut into aligned blocks of ``fanout ** k`` leaves, and
    each block hashes its own subtree. Then, round by round, the ``fanout``
    neighbours of an aligned run of subtrees (blocks that differ in one digit of
    their number) swap subtree roots: every block fetches the roots of the other
    subtrees of its run and hashes the ancestor itself, redundantly. After
    ``log_fanout(blocks)`` rounds every block knows the group's root and has
    gathered the upper part of all its proofs on the way; no pass goes back down.
    In a last, incomplete run the blocks of the short subtree answer in turn.
    The subroots are leaves of one more tree, built by the same functions.

Scale: texts are read once and never shuffled, only ids and 32-byte digests are.
Places come from a range partition on (group, id) with offsets per range, so a
group with a third of all rows is spread over ranges and blocks like any other.
A task holds one block (at most ``BLOCK`` leaves). A round moves one digest a
block and is stored, so a lost executor costs a round at most. The driver reads
the largest number of blocks, which says how many rounds there are.

Edge cases: rows with equal ids are ordered by leaf digest (NULL ids first);
repeated rows are leaves of their own; a single leaf is its group's subroot, and
a single subroot is the root (a proof without siblings is the hash of nothing).
NULL ids are not tampered with. An empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CRC32_SQL, crc32_sql, ship_by_value, stored

#: leaves of a block at most (the largest power of the fanout up to it)
BLOCK = 4096
ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    """Digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def group_key(value: Column) -> Column:
    """A string that is never NULL and sorts NULL first, then by UTF-8 bytes."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value.cast("string")))


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (with a column ``g``) with ``pos``, the place in the group from
    0, and ``held``, the group's rows."""
    spark = leaves.sparkSession
    keys = ["g", *[F.col(c).asc_nulls_first() for c in order]]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = leaves.repartitionByRange(ranges, *keys, F.col("at")).sortWithinPartitions(*keys, F.col("at"))
    dealt = stored(dealt.drop("at").withColumn("m", F.monotonically_increasing_id()), "merkle-ordered")
    dealt = dealt.withColumn("part", F.shiftright("m", ROW_BITS))
    runs = dealt.groupBy("part", "g").agg(F.min("m").alias("low"), F.count("*").alias("n"))
    group = Window.partitionBy("g")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "g", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"), F.sum("n").over(group).alias("held"))
    return dealt.join(runs, ["part", "g"]).withColumn("pos", F.col("m") - F.col("low") + F.col("offset")).drop("part", "m", "low", "offset")


# ------------------------------------------------------------- inside a block
def parent_level(nodes: list, fanout: int) -> list:
    return [sha256(b"".join(nodes[i:i + fanout])).hexdigest().encode() for i in range(0, len(nodes), fanout)]


def subtree(nodes: list, fanout: int, depth: int | None) -> list:
    """Levels from the leaves (hex) up to one node; ``depth`` levels above the
    leaves if the block is one of several, else as many as are needed."""
    levels = [nodes]
    while len(levels[-1]) > 1 if depth is None else len(levels) <= depth:
        levels.append(parent_level(levels[-1], fanout))
    return levels


def block_root(fanout: int, size: int, depth: int):
    def run(key, table):
        t = table.sort_by("pos")
        nodes = [d.hex().encode() for d in t.column("d").to_pylist()]
        held = t.column("held")[0].as_py()
        top = subtree(nodes, fanout, None if held <= size else depth)[-1][0]
        return pa.table({"g": pa.array([key[0].as_py()], pa.string()), "b": pa.array([key[1].as_py()], pa.int64()),
                         "blocks": pa.array([-(-held // size)], pa.int64()), "node": pa.array([top.decode()], pa.string())})
    return run


# --------------------------------------------------------------- the exchange
def exchange(state: DataFrame, span: int, fanout: int) -> DataFrame:
    """One round: blocks whose numbers differ in the digit of weight ``span`` swap
    the roots of their subtrees of ``span`` blocks. ``above`` grows by the
    siblings' digests, ``node`` becomes the ancestor's."""
    b, span_l = F.col("b"), F.lit(span)
    subtrees = F.ceil(F.col("blocks") / span_l).cast("long")
    own = F.floor(b / span_l).cast("long")
    first = (own - own % fanout).cast("long")
    last = F.least(first + fanout, subtrees) - 1
    asked = state.select("g", "b", "blocks", "above", "node", F.explode(F.sequence(first, last)).alias("tree"))
    # a subtree's blocks answer in turn; only the last one can have fewer than span
    members = F.least(span_l, F.col("blocks") - F.col("tree") * span)
    asked = asked.withColumn("peer", F.when(F.col("tree") == own, b).otherwise(F.col("tree") * span + (b % span_l) % members).cast("long"))
    roots = state.select("g", F.col("b").alias("peer"), F.col("node").alias("root"))
    met = asked.join(roots, ["g", "peer"]).groupBy("g", "b").agg(
        F.first("blocks").alias("blocks"), F.first("above").alias("above"), F.first("node").alias("old"),
        F.sort_array(F.collect_list(F.struct("tree", "root"))).alias("run"))  # a run has fanout roots at most
    others = F.filter("run", lambda x: x["tree"] != F.floor(F.col("b") / span_l))
    join = lambda xs: F.array_join(F.transform(xs, lambda x: x["root"]), "")
    active = F.ceil(F.col("blocks") / span_l) > 1
    return met.select("g", "b", "blocks",
                      F.when(active, F.concat("above", F.array(join(others)))).otherwise(F.col("above")).alias("above"),
                      F.when(active, F.sha2(join(F.col("run")).cast("binary"), 256)).otherwise(F.col("old")).alias("node"))


def block_paths(leaves: DataFrame, fanout: int, size: int, depth: int) -> DataFrame:
    """``g, b, node`` (the group's root) and ``above`` (siblings' digests, level
    by level, above the block) of every block of the placed ``leaves``."""
    keyed = leaves.select("g", F.floor(F.col("pos") / size).cast("long").alias("b"), "pos", "held", "d")
    state = keyed.groupBy("g", "b").applyInArrow(block_root(fanout, size, depth), "g string, b long, blocks long, node string")
    state = stored(state.withColumn("above", F.array().cast("array<string>")), "merkle-blocks")
    blocks, span = state.agg(F.max("blocks")).first()[0] or 0, 1
    while span < blocks:
        state = stored(exchange(state, span, fanout), "merkle-blocks")
        span *= fanout
    return state


# ------------------------------------------------------------------ the proofs
def fold(node: bytes, at: int, siblings: list, fanout: int) -> bytes:
    """Hashes ``node``, place ``at`` of its level, up to the root."""
    for s in siblings:
        cut = 64 * (at % fanout)
        node = sha256(s[:cut] + node + s[cut:]).hexdigest().encode()
        at //= fanout
    return node


def proofs(fanout: int, size: int, depth: int):
    """Per block: its leaves' proofs, and the root folded from each."""
    def run(key, leaves, paths):
        t = leaves.sort_by("pos")
        nodes = [d.hex().encode() for d in t.column("d").to_pylist()]
        pos, held = t.column("pos").to_pylist(), t.column("held")[0].as_py()
        levels = subtree(nodes, fanout, None if held <= size else depth)
        path = {c: paths.column(c)[0].as_py() for c in ("above", "subroot", "top_above", "root", "group_at")}
        above, top = ([s.encode() for s in path[c]] for c in ("above", "top_above"))
        rest = b"".join(above + top)
        proof, folded = [], []
        for i, (node, changed) in enumerate(zip(nodes, t.column("changed").to_pylist())):
            own, j = [], i
            for level in levels[:-1]:
                a = j - j % fanout
                own.append(b"".join(level[a:j]) + b"".join(level[j + 1:a + fanout]))
                j //= fanout
            proof.append(sha256(b"".join(own) + rest).hexdigest())
            sub = fold(node if changed is None else changed.hex().encode(), pos[i], own + above, fanout)
            folded.append(fold(sub, path["group_at"], top, fanout).decode())
        n, whole = len(nodes), lambda x: pa.array([x] * len(nodes), pa.string())
        return pa.table([t.column("doc_id"), pa.array([x.decode() for x in nodes], pa.string()), whole(path["subroot"]), whole(path["root"]),
                         pa.array(proof, pa.string()), pa.array(folded, pa.string()), pa.array([folded[i] == path["root"] for i in range(n)], pa.bool_())],
                        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def manifest(docs: DataFrame, *, columns=("doc_id", "source", "lang", "n_chars", "text"), id_col="doc_id", group_col="lang",
             tampered: Column | None = None, changes: dict[str, Column] | None = None, fanout: int = 2, block: int = BLOCK) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row. Rows where ``tampered`` holds are checked with ``changes`` (column
    to new value) applied: ``folded_root`` is recomputed from their changed leaf
    and the original siblings, and ``verified`` says whether it is the root."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    depth = 0
    while fanout ** (depth + 1) <= max(block, fanout):
        depth += 1
    size = fanout ** depth
    kind = docs.schema[id_col].dataType.simpleString()
    fake = [(changes or {}).get(c, F.col(c)) for c in columns]
    changed = F.when(tampered, leaf_digest(fake)) if tampered is not None else F.lit(None).cast("binary")
    leaves = docs.select(F.col(id_col).alias("doc_id"), group_key(F.col(group_col)).alias("g"), leaf_digest([F.col(c) for c in columns]).alias("d"),
                         changed.alias("changed"), F.monotonically_increasing_id().alias("at"))
    leaves = stored(placed(stored(leaves, "merkle-leaves"), ["doc_id", "d"]), "merkle-places")
    state = block_paths(leaves, fanout, size, depth)

    # the subroots are the leaves of one more tree
    subroots = state.where("b = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.unhex("node").alias("d"), F.lit(0).alias("at"))
    subroots = stored(placed(subroots, ["name"]), "merkle-subroots")
    tops = block_paths(subroots, fanout, size, depth).select("g", "b", F.col("above").alias("upper"), F.col("node").alias("root"))
    keyed = subroots.withColumn("b", F.floor(F.col("pos") / size).cast("long"))
    tops = keyed.groupBy("g", "b").cogroup(tops.groupBy("g", "b")).applyInArrow(top_paths(fanout, size, depth), "g string, group_at long, subroot string, top_above array<string>, root string")
    paths = state.select("g", "b", "above").join(tops, "g")
    blocks = leaves.withColumn("b", F.floor(F.col("pos") / size).cast("long"))
    return blocks.groupBy("g", "b").cogroup(paths.groupBy("g", "b")).applyInArrow(
        proofs(fanout, size, depth), f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def top_paths(fanout: int, size: int, depth: int):
    """Per block of subroots: each one's place, siblings up to the root, and the root."""
    def run(key, leaves, paths):
        t = leaves.sort_by("pos")
        nodes = [d.hex().encode() for d in t.column("d").to_pylist()]
        levels = subtree(nodes, fanout, None if t.column("held")[0].as_py() <= size else depth)
        upper, root, out = paths.column("upper")[0].as_py(), paths.column("root")[0].as_py(), []
        for i in range(len(nodes)):
            own, j = [], i
            for level in levels[:-1]:
                a = j - j % fanout
                own.append(b"".join(level[a:j] + level[j + 1:a + fanout]).decode())
                j //= fanout
            out.append(own + upper)
        return pa.table([t.column("name"), t.column("pos"), pa.array([x.decode() for x in nodes], pa.string()), pa.array(out, pa.list_(pa.string())),
                         pa.array([root] * len(nodes), pa.string())], names=["g", "group_at", "subroot", "top_above", "root"])
    return run


def contract_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, with 1 added to ``n_chars`` where 7 divides
    the CRC of the id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(docs, tampered=F.coalesce(hit, F.lit(False)), changes={"n_chars": F.col("n_chars") + 1})


ORACLE = f"""
WITH RECURSIVE {CRC32_SQL},
f AS (SELECT doc_id, lang, n_chars, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g,
       CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
       || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
       || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
       CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body FROM documents),
x AS (SELECT *, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || body) AS leaf,
       sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || body) AS fake,
       {crc32_sql('doc_id::VARCHAR')} AS c FROM f, crc),
l AS (SELECT *, coalesce(c % 7 = 0, false) AS hit,
       row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM x),
t AS (SELECT g, 0 AS lvl, pos AS i, leaf AS d, n FROM l
      UNION ALL SELECT g, lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY g, lvl, i // 2, n),
s AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS gpos, count(*) OVER () AS gn FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, gpos AS i, subroot AS d, gn AS n FROM s
      UNION ALL SELECT lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, i // 2, n),
w AS (SELECT l.*, row_number() OVER () AS rn, s.subroot, s.gpos, (SELECT d FROM u WHERE n = 1) AS root FROM l JOIN s USING (g)),
e AS (SELECT w.rn, t.lvl, t.i % 2 AS side, t.d FROM w JOIN t ON t.g = w.g AND t.n > 1 AND t.i = xor(w.pos >> t.lvl, 1)),
p AS (SELECT w.rn, 100 + u.lvl AS lvl, u.i % 2 AS side, u.d FROM w JOIN u ON u.n > 1 AND u.i = xor(w.gpos >> u.lvl, 1)),
steps AS (SELECT w.rn, h.lvl, coalesce(q.side, 0) AS side, coalesce(q.d, '') AS d FROM w
          JOIN (SELECT DISTINCT g, lvl FROM t WHERE n > 1 UNION ALL SELECT DISTINCT s.g, 100 + lvl FROM u, s WHERE u.n > 1) h ON h.g = w.g
          LEFT JOIN (SELECT * FROM e UNION ALL SELECT * FROM p) q ON q.rn = w.rn AND q.lvl = h.lvl),
paths AS (SELECT rn, list(struct_pack(side := side, d := d) ORDER BY lvl) AS path, string_agg(d, '' ORDER BY lvl) AS every FROM steps GROUP BY rn),
z AS (SELECT w.*, coalesce(path, []) AS path, sha256(coalesce(every, '')) AS proof_sha256 FROM w LEFT JOIN paths USING (rn)),
k AS (SELECT rn, 1 AS nth, path, CASE WHEN hit THEN fake ELSE leaf END AS d FROM z
      UNION ALL SELECT rn, nth + 1, path, sha256(CASE WHEN path[nth].side = 0 THEN path[nth].d || d ELSE d || path[nth].d END) FROM k WHERE nth <= len(path)),
r AS (SELECT rn, d AS folded_root FROM k WHERE nth > len(path))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z JOIN r USING (rn)
"""

ship_by_value(__name__)
