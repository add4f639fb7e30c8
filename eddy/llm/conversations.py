"""Conversation structure repair by the auction shortest-path algorithm (operator 12).

A conversation is the sequence of its turns. Rows have faults: blank (no
character but ASCII white space), duplicate (role and text seen earlier),
truncated (the last character but white space is none of ``.!?``). Edits make the
roles' initials a word of ``(s?(ua)+)?``: Keep costs 0, Rerole (to the role that
fits, user or assistant) 3, Delete 4, Insert (a turn without text, of the role
that fits) 3; a blank or duplicate row must be deleted, a truncated one that stays
adds 3. Sought are the cheapest edits, of ties those whose initials are
ASCII-least.

Auction
    The edits of a run of rows form a lattice: nodes are (rows consumed, state of
    the role automaton), arcs are edits with integer costs. Every node has a price,
    at first 0, and one path is kept, at first the source alone. With ``best`` the
    least cost plus price over the arcs of the path's last node, the node's price
    is raised to ``best`` and the path contracted if the price is below it;
    otherwise the path is extended by that arc. When it reaches the target, the
    prices are an optimal dual solution: every arc of every shortest path is tight
    (its cost is the difference of its ends' prices). The least of these paths is
    traced through the tight arcs in the order of the letters, leaving nodes from
    which the target is not reached by tight arcs. Further sources go on with the
    same prices.

Scale: rows are range-partitioned by conversation and turn and numbered, so a
conversation with a third of all rows is spread over many ranges. Lattices are cut
into segments of at most ``SEGMENT`` consecutive rows of a conversation; those of a
conversation that has several get the least cost from each entry to each exit state
(an auction for each), one small row a segment. A backward pass over these rows
gives the costs of ending from each exit, then every segment traces its edits
for each entry state by itself, and a forward pass picks the entry states. Both
passes hold one row at a time. Texts travel when rows are put into order, when they
meet their edits (by row), and when a conversation's repaired text is hashed.
SHA-256 is sequential, so this
last step streams a conversation through one task (one row at a time), however
long it is; all other steps split it.

Edge cases: NULL text and role count as one space; NULL turns come first; rows of
one turn are ordered by role and SHA-256 of the text; NULL conversation ids are one
conversation. A conversation without rows has an empty audit and the hash of
nothing. An empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CRC32_SQL, crc32_sql, ship_by_value, stored

#: rows of a lattice at most; a power of two
SEGMENT_BITS = 6
SEGMENT = 1 << SEGMENT_BITS
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: ASCII white space
SPACES = " \t\n\x0b\x0c\r"
#: automaton: 0 start, 1 after s, 2 after u, 3 after a; the state after the role that fits
FITS = (2, 2, 3, 2)
ENDS = (0, None, None, 0)
#: state after keeping a role of class s, u, a or other
KEEPS = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
MUST_GO, CUT_OFF = 1, 2  # faults in a row's code: class + 4 * fault
SLICE = 256


# ------------------------------------------------------------------ the lattice
def lattice(codes: list, ends) -> list:
    """Arcs ``(letter, node, cost)`` of every node in the order of the letters.
    Node ``4 * i + q``: i rows consumed, state q; the last node is the target,
    reached from exit state q at cost ``ends[q]`` (None: not at all)."""
    n = len(codes)
    target, arcs = 4 * n + 4, []
    for i, code in enumerate(codes):
        keeps, fault = KEEPS[code & 3], code >> 2
        extra = TRUNCATED if fault == CUT_OFF else 0
        for q in range(4):
            out = [("D", 4 * i + 4 + q, DELETE), ("I", 4 * i + FITS[q], INSERT)]
            if fault != MUST_GO:
                if q in keeps:
                    out.append(("K", 4 * i + 4 + keeps[q], extra))
                out.append(("R", 4 * i + 4 + FITS[q], REROLE + extra))
            arcs.append(out)
    for q in range(4):
        end = [] if ends[q] is None else [("", target, ends[q])]
        arcs.append([*end, ("I", 4 * n + FITS[q], INSERT)])
    arcs.append([])
    return arcs


def auction(arcs: list, price: list, source: int) -> bool:
    """Raises ``price`` until it holds a shortest path from ``source`` to the last
    node; False if there is none."""
    target = len(arcs) - 1
    seen, todo = {source}, [source]
    while todo:
        for _, v, _c in arcs[todo.pop()]:
            if v not in seen:
                seen.add(v)
                todo.append(v)
    if target not in seen:
        return False
    path = [source]
    while path[-1] != target:
        u = path[-1]
        best, to = min((c + price[v], k) for k, (_, v, c) in enumerate(arcs[u]))
        if price[u] < best:
            price[u] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(arcs[u][to][1])
    return True


def trace(arcs: list, price: list, source: int) -> tuple[str, int]:
    """Letters of the least shortest path, and the node before the target."""
    target, dead = len(arcs) - 1, set()
    path, letters = [source], []
    while path[-1] != target:
        u = path[-1]
        for letter, v, c in arcs[u]:
            if price[u] == c + price[v] and v not in dead:
                path.append(v)
                letters.append(letter)
                break
        else:
            dead.add(path.pop())
            letters.pop()
    return "".join(letters), path[-2]


def exit_costs(codes: list) -> list:
    """Least cost from entry state q to exit state r at place ``4 * q + r``."""
    out = [None] * 16
    for r in range(4):
        arcs = lattice(codes, [0 if r == x else None for x in range(4)])
        price = [0] * len(arcs)
        for q in range(4):
            if auction(arcs, price, q):
                out[4 * q + r] = price[q]
    return out


def best_edits(codes: list, ends, entries) -> tuple[list, list, list]:
    """Per entry state: least cost, letters and exit state (None if not asked for
    or not possible)."""
    arcs = lattice(codes, ends)
    price, cost, letters, exits = [0] * len(arcs), [None] * 4, [None] * 4, [None] * 4
    for q in entries:
        if auction(arcs, price, q):
            cost[q] = price[q]
            letters[q], last = trace(arcs, price, q)
            exits[q] = last & 3
    return cost, letters, exits


ROLE_OF = {2: "user", 3: "assistant"}


def row_edits(letters: str, codes: list, entry: int) -> list:
    """``[roles inserted before, letter, new role, roles inserted after]`` of each
    row; what is inserted after the last row goes with it. The new role is that
    of a rerole, else None."""
    out, before, q = [], [], entry
    for x in letters:
        if x == "I":
            q = FITS[q]
            before.append(ROLE_OF[q])
            continue
        q = FITS[q] if x == "R" else KEEPS[codes[len(out)] & 3][q] if x == "K" else q
        out.append([before, x, ROLE_OF[q] if x == "R" else None, []])
        before = []
    out[-1][3] = before
    return out


# --------------------------------------------------------------- rows and faults
def conversation_key(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` (``c, turn, role, text``) with ``m``, a number that grows in a
    conversation's order; rows of one conversation are next to each other."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = ["c", F.col("turn").asc_nulls_first(), "role", "h", "at"]
    dealt = (rows.withColumn("h", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).withColumn("at", F.monotonically_increasing_id())
             .repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("at").withColumn("m", F.monotonically_increasing_id()))
    return stored(dealt, "repair-rows")


def faults(rows: DataFrame) -> DataFrame:
    """``c, m, turn, code, blank, duplicate, truncated`` of every ordered row."""
    key = F.unhex(F.sha2(F.concat("role", F.lit(":"), F.hex("h")).cast("binary"), 256))
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    small = rows.select("c", "m", "turn", key.alias("k"), (last == "").alias("blank"), last.isin(".", "!", "?").alias("ended"),
                        F.left("role", F.lit(1)).alias("initial"))
    first = small.groupBy("c", "k").agg(F.min("m").alias("first"))
    out = small.join(first, ["c", "k"])
    duplicate = ~F.col("blank") & (F.col("m") > F.col("first"))
    truncated = ~F.col("blank") & ~duplicate & ~F.col("ended")
    fault = F.when(F.col("blank") | duplicate, MUST_GO).when(truncated, CUT_OFF).otherwise(0)
    cls = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return stored(out.select("c", "m", "turn", (cls + 4 * fault).cast("int").alias("code"), "blank", duplicate.alias("duplicate"), truncated.alias("truncated")), "repair-faults")


# ------------------------------------------------------------ passes over segments
def rows_of(batches):
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE).to_pylist()


def batch_of(rows: list, fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields], names=[n for n, _ in fields])


LONGS, INTS, STRINGS = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())
SEG = [("c", pa.string()), ("seg", pa.int64()), ("m", pa.int64()), ("codes", INTS), ("several", pa.bool_())]
BACK = [*SEG, ("ends", LONGS), ("illegal", pa.int64())]
TRACED = [("c", pa.string()), ("seg", pa.int64()), ("m", pa.int64()), ("codes", INTS), ("illegal", pa.int64()), ("costs", LONGS), ("letters", STRINGS), ("exits", INTS)]
CHOSEN = [("c", pa.string()), ("seg", pa.int64()), ("m", pa.int64()), ("codes", INTS), ("illegal", pa.int64()), ("cost", pa.int64()), ("letters", pa.string()), ("entry", pa.int32())]
EDITS = [("c", pa.string()), ("m", pa.int64()), ("before", STRINGS), ("letter", pa.string()), ("new_role", pa.string()), ("after", STRINGS)]
DDL = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", LONGS: "array<long>", INTS: "array<int>", STRINGS: "array<string>"}


def ddl(fields) -> str:
    return ", ".join(f"{n} {DDL[t]}" for n, t in fields)


def with_exit_costs(batches):
    for rows in rows_of(batches):
        for r in rows:
            r["matrix"] = exit_costs(r["codes"]) if r["several"] else None
        yield batch_of(rows, [*SEG, ("matrix", LONGS)])


LEGAL = {(0, 1), (1, 2), (2, 1)}


def backward(batches):
    """Segments from the last to the first: the costs of ending from each exit
    state, and the illegal neighbours up to the next segment's first row."""
    c, ends, following = None, None, None
    for rows in rows_of(batches):
        for r in rows:
            if r["c"] != c:
                c, ends, following = r["c"], list(ENDS), None
            roles = [x & 3 for x in r["codes"]] + ([] if following is None else [following])
            r["illegal"] = sum(p not in LEGAL for p in zip(roles, roles[1:]))
            r["ends"], following = ends, roles[0]
            if r["several"]:
                d = r["matrix"]
                ends = [min((d[4 * q + x] + r["ends"][x] for x in range(4) if d[4 * q + x] is not None and r["ends"][x] is not None), default=None) for q in range(4)]
        yield batch_of(rows, BACK)


def traced(batches):
    for rows in rows_of(batches):
        for r in rows:
            r["costs"], r["letters"], r["exits"] = best_edits(r["codes"], r["ends"], range(4) if r["several"] else (0,))
        yield batch_of(rows, TRACED)


def forward(batches):
    """Segments from the first to the last: the letters of the entry state that
    the segment before ends in. ``cost`` is the conversation's, on its first segment."""
    c, state = None, 0
    for rows in rows_of(batches):
        for r in rows:
            first = r["c"] != c
            if first:
                c, state = r["c"], 0
            r["cost"] = r["costs"][state] if first else None
            r["entry"], r["letters"], state = state, r["letters"][state], r["exits"][state]
        yield batch_of(rows, CHOSEN)


def edits_of_rows(batches):
    for rows in rows_of(batches):
        out = [dict(zip(("c", "m", "before", "letter", "new_role", "after"), (r["c"], r["m"] + i, *e)))
               for r in rows for i, e in enumerate(row_edits(r["letters"], r["codes"], r["entry"]))]
        yield batch_of(out, EDITS)


def segments(flags: DataFrame) -> DataFrame:
    segs = flags.groupBy("c", F.shiftright("m", SEGMENT_BITS).alias("seg")).agg(F.sort_array(F.collect_list(F.struct("m", "code"))).alias("x"))
    segs = segs.select("c", "seg", F.col("x")[0]["m"].alias("m"), F.transform("x", lambda x: x["code"]).alias("codes"))
    count = segs.groupBy("c").agg((F.count("*") > 1).alias("several"))
    return segs.join(count, "c")


def chosen_edits(flags: DataFrame) -> DataFrame:
    """``c, seg, m, codes, illegal, cost, letters, entry`` of every segment: its
    first row's number, its rows' codes, illegal neighbours, the conversation's
    cost (on its first segment), the segment's edits and entry state."""
    parts = int(flags.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))  # given, so that small rows with much work stay spread
    segs = segments(flags).repartition(parts, "c", "seg").mapInArrow(with_exit_costs, ddl([*SEG, ("matrix", LONGS)]))
    segs = segs.repartition("c").sortWithinPartitions("c", F.col("seg").desc()).mapInArrow(backward, ddl(BACK))
    edits = segs.repartition(parts, "c", "seg").mapInArrow(traced, ddl(TRACED))
    edits = edits.repartition("c").sortWithinPartitions("c", "seg").mapInArrow(forward, ddl(CHOSEN))
    return stored(edits, "repair-edits")


# ------------------------------------------------------------------- the operator
def repair(rows: DataFrame, *, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> tuple[DataFrame, DataFrame]:
    """``(conversations, repaired)``. Conversations: ``conv_id``, the counts
    ``gaps, blank, duplicate, truncated, illegal``, ``cost`` and ``audit``, one row
    for each conversation that has rows. Repaired: ``conv_id, m, nth, role, text``,
    a conversation's turns in the order of (m, nth), inserted ones included;
    ``c`` is the conversation's key (never NULL) in both."""
    space = F.lit(" ")
    given = rows.select(F.col(conv_col).alias("conv_id"), conversation_key(F.col(conv_col)).alias("c"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"))
    given = ordered(given)
    flags = faults(given)
    edits = chosen_edits(flags)
    turns = flags.groupBy("c", "turn").agg(*[F.sum(F.col(x).cast("long")).alias(x) for x in ("blank", "duplicate", "truncated")])
    counts = turns.groupBy("c").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
                                    *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")])
    found = edits.groupBy("c").agg(F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"),
                                   F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "letters"))), lambda x: x["letters"]), "").alias("audit"))
    names = given.groupBy("c").agg(F.first("conv_id").alias("conv_id"))
    conversations = names.join(counts, "c").join(found, "c").select("c", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    own = given.select("c", "conv_id", "m", "role", "text").join(edits.mapInArrow(edits_of_rows, ddl(EDITS)), ["c", "m"])
    turn = lambda nth, role, text: F.struct(nth.cast("int").alias("nth"), role.alias("role"), text.alias("text"))
    inserted = lambda col, sign: F.transform(col, lambda role, i: turn(i * sign + sign, role, F.lit("")))
    stays = F.when(F.col("letter") == "D", F.array()).otherwise(F.array(turn(F.lit(0), F.coalesce("new_role", "role"), F.col("text"))))
    turns = own.select("c", "conv_id", "m", F.explode(F.concat(inserted(F.reverse("before"), -1), stays, inserted(F.col("after"), 1))).alias("t"))
    return conversations, turns.select("c", "conv_id", "m", "t.nth", "t.role", "t.text")


def hashed(batches):
    """SHA-256 of the conversations' turns (``role:text``, newline-joined); the
    turns come in order, next to each other."""
    c, state, out = None, None, []
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            for key, role, text in zip(*(part.column(x).to_pylist() for x in ("c", "role", "text"))):
                if key != c:
                    if c is not None:
                        out.append((c, state.hexdigest()))
                    c, state = key, sha256()
                else:
                    state.update(b"\n")
                state.update(role.encode())
                state.update(b":")
                state.update(text.encode())
            if len(out) >= 4096:
                yield digests(out)
                out = []
    if c is not None:
        out.append((c, state.hexdigest()))
    if out:
        yield digests(out)


def digests(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], names=["c", "repaired_sha256"])


# ------------------------------------------------------------------- the contract
def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the contract's damage."""
    text_of = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(twice).alias("copy")).drop("copy")


def audit_conversations(conversations: DataFrame) -> DataFrame:
    """The contract's row of every conversation id of ``conversations``."""
    found, repaired = repair(damaged(conversations))
    hashes = repaired.repartition("c").sortWithinPartitions("c", "m", "nth").mapInArrow(hashed, "c string, repaired_sha256 string")
    every = conversations.select("conv_id").distinct().withColumn("c", conversation_key(F.col("conv_id")))
    out = every.join(found.drop("conv_id"), "c", "left").join(hashes, "c", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))


ORACLE = r"""
WITH RECURSIVE {crc_table},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
k AS (SELECT *, {crc} % 20 AS kind FROM raw, crc),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM k, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) u(copy) WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
q AS (SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
             lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
f AS (SELECT *, NOT blank AND NOT dup AND right(body, 1) NOT IN ('.', '!', '?') AS cut FROM q),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(dup::INT) AS duplicate,
             sum(cut::INT) AS truncated, sum((before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au'))::INT) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
fits AS (SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) v(s, t, r)),
keeps AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) v(s, x, t)),
ins AS (SELECT s, s AS t, 0 AS cost, '' AS letters, '' AS body FROM fits
        UNION ALL SELECT s, t, 3, 'I', chr(10) || r || ':' FROM fits
        UNION ALL SELECT a.s, b.t, 6, 'II', chr(10) || a.r || ':' || chr(10) || b.r || ':' FROM fits a JOIN fits b ON b.s = a.t),
moves AS (SELECT conv_id, i, s, s AS t, 4 AS cost, 'D' AS letter, '' AS part FROM f, fits
          UNION ALL SELECT conv_id, i, s, t, 3 + 3 * cut::INT, 'R', chr(10) || r || ':' || text FROM f, fits WHERE NOT blank AND NOT dup
          UNION ALL SELECT conv_id, i, s, t, 3 * cut::INT, 'K', chr(10) || role || ':' || text FROM f JOIN keeps ON keeps.x = f.role[1] WHERE NOT blank AND NOT dup),
w AS (SELECT c.conv_id, 0::BIGINT AS i, ins.t AS s, min({{'cost': ins.cost, 'letters': ins.letters, 'body': ins.body}}) AS best FROM c, ins WHERE ins.s = 0 GROUP BY c.conv_id, ins.t
      UNION ALL
      SELECT w.conv_id, w.i + 1, ins.t, min({{'cost': w.best.cost + m.cost + ins.cost, 'letters': w.best.letters || m.letter || ins.letters, 'body': w.best.body || m.part || ins.body}})
      FROM w JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1 AND m.s = w.s JOIN ins ON ins.s = m.t
      GROUP BY w.conv_id, w.i, ins.t),
z AS (SELECT w.conv_id, min(w.best) AS best FROM w JOIN c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i WHERE w.s IN (0, 3) GROUP BY w.conv_id),
r AS (SELECT DISTINCT conv_id FROM conversations)
SELECT r.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.letters, '') AS audit, sha256(coalesce(substr(best.body, 2), '')) AS repaired_sha256
FROM r LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM r.conv_id
""".format(crc_table=CRC32_SQL, crc=crc32_sql("key"))

ship_by_value(__name__)
