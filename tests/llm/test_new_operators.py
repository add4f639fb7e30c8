"""Merkle manifest, conversation repair and toxicity against plain-Python
versions and their SQL, on hand-made rows and on the smallest tables."""

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [HERE, ROOT, os.path.join(ROOT, "tools")]

from pyspark.sql import functions as F  # noqa: E402

from eddy.llm import conversations, merkle, topk, toxicity  # noqa: E402
from oracle_check import compare, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ the manifest
def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """Root and every leaf's siblings, level by level, with its place among them."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    level = list(nodes)
    while len(level) > 1:
        for p, i in zip(paths, at):
            a = i - i % fanout
            p.append((i - a, level[a:i] + level[i + 1:a + fanout]))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], paths


def plain_manifest(rows, fanout=2):
    leaf = lambda r, n: h(*map(field, (r[0], r[1], r[2], n, r[4])))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[3]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names}
    root, tops = tree([subs[g][0] for g in names], fanout)
    out = []
    for g, top in zip(names, tops):
        for (_, _, own, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), subs[g][1]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, r[3] + 1) if hit and r[3] is not None else own
            for place, others in path + top:
                node = h(*others[:place], node, *others[place:])
            out.append((r[0], own, subs[g][0], root, h(*[s for _, others in path + top for s in others]), node, node == root))
    return out


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, g string, pos long, node string, b long, held long, d string, root string"


def manifest_rows(n, seed=5):
    r = random.Random(seed)
    rows = [(i, f"s{i % 3}", r.choice(["en", "en", "en", "fr", "dé", None, ""]), i * 7 if i % 5 else None, "é" * (i % 9) or None) for i in range(n)]
    rows += [(3, "s0", "en", 1, "tie"), (3, "s0", "en", 1, "tie"), (3, "s1", "en", 2, "other"), (None, None, None, None, None), (None, "x", "en", 5, "")]
    return rows + [(9_999, "s", "alone", 1, "x" * 200_000)]


def manifest_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x", 2, 3, "x", "x") for r in rows], MANIFEST)


@pytest.mark.parametrize("n,fanout,block", [(0, 2, 4096), (90, 2, 4096), (150, 2, 4), (83, 2, 1), (120, 3, 9), (70, 5, 5)])
def test_manifest(spark, n, fanout, block):
    rows = manifest_rows(n)
    df = manifest_frame(spark, rows)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    got = merkle.manifest(df, tampered=hit, changes={"n_chars": F.col("n_chars") + 1}, fanout=fanout, block=block).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(map(tuple, got), key=key) == sorted(plain_manifest(rows, fanout), key=key)


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.contract_manifest(manifest_frame(spark, [])).collect() == []
    one = merkle.contract_manifest(manifest_frame(spark, [(1, None, None, None, None)])).collect()
    assert [tuple(r) for r in one] == plain_manifest([(1, None, None, None, None)])
    assert one[0].root == one[0].leaf and one[0].proof_sha256 == h()


def test_manifest_sql(spark):
    assert compare(spark, SF, ["op11_merkle_manifest"])["op11_merkle_manifest"][0] == "match"


# --------------------------------------------------------------- the conversations
def plain_edits(codes):
    """Least cost and letters by dynamic programming over (rows, state)."""
    best = {0: (0, "")}

    def inserts(b):
        for _ in range(3):
            for q, (c, s) in list(b.items()):
                to = conversations.FITS[q]
                b[to] = min(b.get(to, (9e9, "")), (c + 3, s + "I"))
        return b

    best = inserts(best)
    for code in codes:
        new, extra = {}, 3 if code >> 2 == conversations.CUT_OFF else 0
        for q, (c, s) in best.items():
            moves = [(q, 4, "D")]
            if code >> 2 != conversations.MUST_GO:
                moves.append((conversations.FITS[q], 3 + extra, "R"))
                if q in conversations.KEEPS[code & 3]:
                    moves.append((conversations.KEEPS[code & 3][q], extra, "K"))
            for to, cost, x in moves:
                new[to] = min(new.get(to, (9e9, "")), (c + cost, s + x))
        best = inserts(new)
    return min(best[q] for q in (0, 3) if q in best)


def test_auction_is_the_least_shortest_path():
    r = random.Random(3)
    for _ in range(400):
        codes = [r.randrange(4) + 4 * r.choice([0, 0, 0, 1, 2]) for _ in range(r.randrange(1, 14))]
        cost, letters, _ = conversations.best_edits(codes, conversations.ENDS, (0,))
        assert (cost[0], letters[0]) == plain_edits(codes)


def test_auction_without_a_path():
    arcs = conversations.lattice([1], [0, None, None, None])
    assert not conversations.auction(arcs, [0] * len(arcs), 3)
    assert conversations.exit_costs([1])[12] is None


CONVERSATIONS = "conv_id long, turn long, role string, text string, c string, m long, seg long, letters string, cost long, h string"


def conversation_rows():
    r = random.Random(8)
    rows = []
    for c in range(60):
        for t in range(r.randrange(1, 12)):
            text = r.choice(["Hello there.", "And then", "What?", "  \t", "", None, "Fine!", f"Number {r.randrange(40)}."])
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "agent"]), text))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None)]
    rows += [(500, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(300)]  # hot
    rows += [(501, 4, "user", "Same.")] * 40 + [(502, 7, "user", "x" * 100_000 + "."), (503, 2, "assistant", "é\nü.")]
    return rows


def conversation_frame(spark, rows):
    return spark.createDataFrame([(*x, "x", 1, 2, "x", 3, "x") for x in rows], CONVERSATIONS)


@pytest.mark.parametrize("bits", [0, 2, 6])
def test_repair_equals_its_sql(spark, monkeypatch, bits):
    """Lattices cut into segments of 1, 4 and 64 rows give the same edits."""
    import duckdb
    monkeypatch.setattr(conversations, "SEGMENT_BITS", bits)
    rows = [x for x in conversation_rows() if x[0] != 500 or x[1] < 120]
    df = conversation_frame(spark, rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(conversations.ORACLE)
    names = [c[0] for c in want.description]
    got = conversations.audit_conversations(df)
    assert digest(got.columns, [tuple(x) for x in got.collect()])[:3] == digest(names, want.fetchall())[:3]


def test_repaired_turns(spark):
    """The operator's own output: conversations that are legal after repair."""
    import re
    found, repaired = conversations.repair(conversation_frame(spark, conversation_rows()))
    by = {}
    for x in repaired.orderBy("c", "m", "nth").collect():
        by.setdefault(x.c, []).append(x)
    for x in found.collect():
        turns = by.get(x.c, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[:1] for t in turns))
        assert len(turns) == sum(ch in "KRI" for ch in x.audit)
        assert x.cost >= 4 * x.audit.count("D") + 3 * (x.audit.count("I") + x.audit.count("R"))
    hot = next(x for x in found.collect() if x.conv_id == 500)
    assert hot.audit == "K" * 300 and hot.cost == 0


def test_repair_of_nothing(spark):
    assert conversations.audit_conversations(conversation_frame(spark, [])).collect() == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = conversations.audit_conversations(conversation_frame(spark, [(1, dropped, "user", "Hi.")])).collect()
    assert [tuple(x) for x in got] == [(1, 0, 0, 0, 0, 0, 0, "", h())]


def test_repair_sql(spark):
    assert compare(spark, SF, ["op12_conversation_repair"])["op12_conversation_repair"][0] == "match"


# --------------------------------------------------------------------------- top k
def plain_top(rows, k, scale=64):
    ids = np.array([r[0] for r in rows])
    v = np.floor(scale * np.array([r[1] for r in rows])).astype(np.int64)
    out = []
    for q in sorted({i for i in ids if i % 20 == 0}):
        got = []
        for x in v[ids == q]:
            s = v @ x
            got += [(-int(s[j]), int(ids[j])) for j in np.flatnonzero(ids != q)]
        got.sort()
        out += [(int(q), n + 1, i, -s) for n, (s, i) in enumerate(got[:k])]
    return out


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_top_k_over_many_blocks_and_repeated_ids(spark, spread):
    """More blocks than a plan could hold as conditions; lengths alike or not."""
    r = np.random.default_rng(3)
    n = 12_000
    v = r.normal(size=(n, 6)) * np.exp(spread * r.normal(size=(n, 1)))
    ids = [i if i >= 400 else 20 * (i // 40) for i in range(n)]  # ten ids come forty times
    ids = [i if i < 400 or i % 400 == 0 else i // 20 * 20 + 1 + i % 19 for i in ids]
    rows = [(int(i), [float(c) for c in x]) for i, x in zip(ids, v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_inner_products(df, F.col("vec_id") % 20 == 0, k=5, bucket_rows=10, query_rows=16)
    assert sorted(map(tuple, got.collect())) == sorted(plain_top(rows, 5))


# ------------------------------------------------------------------------ toxicity
def plain_kernel(a, b):
    """Product of the gap-weighted three-letter subsequences, one by one."""
    def vector(piece):
        c, out, square = toxicity.coded([piece])[0], {}, 0.0
        for i in range(len(c)):
            for j in range(i + 1, len(c)):
                for k in range(j + 1, min(len(c), i + toxicity.SPAN)):
                    if toxicity.NONE not in (c[i], c[j], c[k]):
                        w = toxicity.DECAY ** (k - i + 1)
                        out[c[i], c[j], c[k]] = out.get((c[i], c[j], c[k]), 0) + w
                        square += w * w
        return out, square
    (x, m), (y, n) = vector(a), vector(b)
    return sum(v * y.get(u, 0) for u, v in x.items()) / (m * n) ** 0.5 if m * n else 0.0


def test_features_are_the_kernel():
    words = ["idiot", "i-d-i-o-t", "id iot", "xidiotx", "", "a", "été", "banana banana", "..", "q" * 24]
    dense = np.array([toxicity.features(w) for w in words]).T
    got = toxicity.linear(words, dense)
    for i, a in enumerate(words):
        assert np.allclose(toxicity.linear([a], dense), got[i], atol=1e-5)
        for j, b in enumerate(words):
            assert abs(got[i, j] - plain_kernel(a, b)) < 1e-4 * max(1, plain_kernel(a, b))
    assert plain_kernel("idiot", "i-d-i-o-t") > 0.7 > 0.3 > plain_kernel("idiot", "the")


def test_pieces():
    got = toxicity.pieces_of("You i d i o t! An id iot. " + "z" * 60, frozenset())
    assert {"i d i o t!", "id iot.", "you", "z" * 24} <= got and all(len(p) <= toxicity.PIECE for p in got)
    assert toxicity.pieces_of(None, frozenset()) == toxicity.pieces_of(" \t", frozenset()) == set()


INSULTS = ["blorgface", "snarfle", "wexnut"]


def toxic_rows(n=900, seed=4):
    r = random.Random(seed)
    say = lambda k: " ".join(r.choice("aeiourtlsmn") + r.choice("aeiou") + r.choice(["l", "ma", "ton", "ri", "ben"]) + r.choice(["", "s", "da"]) for _ in range(k))
    out = []
    for i in range(n):
        words = say(r.randrange(5, 60)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(r.randrange(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(INSULTS))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_toxicity(spark):
    rows = toxic_rows()
    clean = rows[1][1]
    extra = [(5000, None), (5001, ""), (5002, " \n"), (5003, "12 34"), (None, "snarfle"), (5004, f"{clean} s-n-a-r-f-l-e"), (5005, f"{clean} w e x n u t"),
             (5006, f"{clean} blorg-face"), (5007, clean), (5007, clean), (5008, (clean + ". ") * 3000), (5009, (clean + ". ") * 3000 + "blorgface")]
    docs = spark.createDataFrame([(i, t, "x", "x", 1) for i, t, _ in rows] + [(*e, "x", "x", 1) for e in extra], "doc_id long, text string, toxic string, h string, id long")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(0, 0, 0), (1, None, 0), (None, 1, 1)], "doc_id long, toxic int, h int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    held = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows) and len(held) > 100
    assert sum(p == y for p, y in held) / len(held) >= 0.97
    assert [by[i].predicted for i in (5000, 5001, 5002, 5003, 5007, 5008)] == [0] * 6
    assert [by[i].predicted for i in (5004, 5005, 5006, 5009)] == [1] * 4
    again = toxicity.toxicity(docs.repartition(3), labels).collect()
    assert sorted((r.doc_id or 0, r.score) for r in again) == sorted((r.doc_id or 0, r.score) for r in got)


def test_toxicity_needs_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert sorted(tuple(r) for r in toxicity.toxicity(docs, labels).select("doc_id", "score", "predicted").collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
    assert toxicity.toxicity(docs.where("false"), labels).collect() == []


def test_toxicity_on_the_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    y, s = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    auc = (s[y == 1][:, None] > s[y == 0]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0]).mean()
    # some labels lie on texts without any insult
    assert auc > 0.9
    assert (np.array([r.predicted for r in got]) == y).mean() > 0.93
