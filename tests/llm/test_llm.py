"""The training-data operators against plain-Python versions and their SQL, on
hand-made rows with NULLs, ties, repeated rows, long texts and clashing column
names, and on the smallest tables."""

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [HERE, ROOT, os.path.join(ROOT, "tools")]

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
import __spark_entry__ as E  # noqa: E402
from eddy.llm import (exact_dedup, langid, lm_score, mixing, ngram_jaccard, packing,  # noqa: E402
                      secrets, suffix_dedup, topk, url_filter)
from oracle_check import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, id string, n long, sha string, node string, size string, h string, rules string, key string"


def frame(spark, rows):
    """``(doc_id, text, lang, source)`` with columns whose names clash."""
    return spark.createDataFrame([(*r, *["x", 1, "x", "x", "x", "x", "x", "x"]) for r in rows], SCHEMA)


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(r.choice("abcdefghij") + str(r.randrange(vocabulary)) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, NULLs, empty and long texts, ties."""
    passage, base = prose(1, 120), prose(2, 200)
    out = [(i, prose(100 + i, 30 + 7 * (i % 9)), "en", f"s{i % 3}") for i in range(40)]
    out += [(100 + i, base if i % 2 else base.replace(" ", "  \n"), "fr", "s0") for i in range(12)]
    for i in range(14):  # near copies of one base, some on a chain
        w = base.split()
        for k in range(i % 5):
            w[(13 * i + 31 * k) % len(w)] = f"edit{i}x{k}"
        out.append((200 + i, " ".join(w), "fr", "s1"))
    out += [(300 + i, prose(500 + i, 20) + " " + passage + " " + prose(600 + i, 20), None, None) for i in range(8)]
    out += [(400, None, None, None), (401, "", "en", ""), (402, " \t\n", "de", "s0"), (None, base, None, "s1"), (None, None, None, None)]
    out += [(403, "one", "en", "s1"), (404, "one two", "en", "s1"), (404, "one two", "en", "s1"), (405, "ONE Two", "en", "s1")]
    out += [(500, prose(9, 12000, 90), "en", "s2"), (501, "aaaa" * 600, "en", "s2")]
    return out


def test_exact_dedup(spark, rows):
    got = exact_dedup.exact_dedup(frame(spark, rows), budget=3000).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t, *_ in rows:
        norm = "".join(c for c in (t or "") if c not in " \t\n\r\x0b\x0c")
        groups.setdefault(hashlib.sha256(norm.encode()).hexdigest(), []).append((-len(t or ""), i is None, i or 0))
    for r in got:
        g = groups[r.text_sha256]
        best = min(g)
        assert (r.group_size, r.keep_id) == (len(g), None if best[1] else best[2])
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups)


def test_trie_spills_and_splits():
    trie = exact_dedup.Patricia()
    words = sorted({hashlib.md5(str(i % 700).encode()).hexdigest()[: 3 + i % 20].encode() for i in range(2000)})
    for w in words:
        trie.insert(w, (1, 7, 1))
        trie.insert(w, (2, 9, 1))
    assert dict(trie.drain()) == {w: (2, 9, 2) for w in words}
    seen = {}
    for w in words:
        for k, o in trie.spill_before(w):
            assert k not in seen
            seen[k] = o
        trie.insert(w, (1, None, 1))
    seen |= dict(trie.drain())
    assert seen == {w: (1, None, 1) for w in words}


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100), (2, 60, 100)])
@pytest.mark.parametrize("bits,per_class", [(14, 6), (6, 2)])
def test_jaccard_components(spark, rows, n, num, den, bits, per_class):
    got = ngram_jaccard.jaccard_components(frame(spark, rows), n=n, num=num, den=den, bits=bits, per_class=per_class)
    want = brute.jaccard_components([r[:2] for r in rows], n, num, den)
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([tuple(r)[:3] for r in got.collect()], key=order) == sorted(want, key=order)


def test_jaccard_partners_and_pairs(spark, rows):
    """Copies are counted, partners are linked, pairs of representatives connect
    what is connected."""
    n, num, den = 2, 60, 100
    sets = [brute.shingles(t, n) for _, t, *_ in rows]
    got = ngram_jaccard.jaccard_components(frame(spark, rows), n=n, num=num, den=den, bits=14).collect()
    of_id = {}
    for (i, *_), x in zip(rows, sets):
        of_id.setdefault(i, []).append(x)
    assert sorted((r.doc_id or -1, r.n_copies) for r in got) == sorted((i or -1, sets.count(x) if x else 1) for (i, *_), x in zip(rows, sets))
    for r in got:
        if r.partner_id is not None:
            assert any(x != y and den * len(x & y) >= num * len(x | y) for x in of_id[r.doc_id] for y in of_id[r.partner_id])
    pairs, members = ngram_jaccard.similar_pairs(frame(spark, rows), n=n, num=num, den=den, bits=14)
    names = {r.representative: r.doc_id for r in members.collect() if r.representative}
    linked = {frozenset((names[r.a], names[r.b])) for r in pairs.collect()}
    assert linked and all(len(p) == 2 for p in linked)


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (2, 60, 100)])
def test_jaccard_link_counts(spark, rows, monkeypatch, n, num, den):
    """Every row's links, copies included, in one block and in many."""
    base = prose(77, 90).split()
    near = []
    for i in range(30):  # one large group; not all of its members link
        w = list(base)
        for k in range(i % 6):
            w[(17 * i + 23 * k) % len(w)] = f"near{i}x{k}"
        near.append((800 + i, " ".join(w[:len(w) - i % 7]), "en", "s0"))
    docs = rows + near + near[:3]
    sets = [brute.shingles(t, n) for _, t, *_ in docs]
    links = lambda x, y: bool(x and y) and den * len(x & y) >= num * len(x | y)
    want = [(r[0], len(x), sum(links(x, y) for y in sets) - bool(x)) for r, x in zip(docs, sets)]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    for blocks in ((400_000, 1024, 4096), (700, 3, 64)):
        for name, value in zip(("BLOCK_GRAMS", "BLOCK_SETS", "SLICE_GRAMS"), blocks):
            monkeypatch.setattr(ngram_jaccard, name, value)
        got = ngram_jaccard.jaccard_components(frame(spark, docs), n=n, num=num, den=den, bits=14, counts=True).collect()
        assert sorted([(r.doc_id, r.n_shingles, r.n_links) for r in got], key=order) == sorted(want, key=order)


def test_jaccard_sketch_counts():
    """Counters above one byte travel beside the others; tasks add up."""
    import pyarrow as pa
    texts = ["a b c " * 200, "a b c", "d e f g", ""]
    parts = []
    for chunk in (texts, texts[:2], []):
        for out in ngram_jaccard.sketch_counts(3, 10)([pa.RecordBatch.from_arrays([pa.array(chunk, pa.string())], names=["text"])]):
            parts.append(out.to_pandas())
    got = pd.concat(parts).groupby("slice", sort=True)[["slice", "counts", "high", "high_counts"]].apply(ngram_jaccard.summed_slices)
    rank = np.concatenate([np.frombuffer(c, np.uint8) for c in got["counts"]])
    sh, want = ngram_jaccard.Shingler(3), np.zeros(1 << 10, np.int64)
    for t in texts + texts[:2]:
        np.add.at(want, (sh.grams(t.encode()) >> np.uint64(54)).astype(np.int64), 1)
    assert want.max() > 255 and got["grams"].sum() == want.sum()
    assert (rank == ngram_jaccard.scale(want).astype(np.uint8)).all()


def test_jaccard_signatures_find_every_link():
    """Sets at and just above the threshold share a signature with enough room."""
    rng = np.random.default_rng(3)
    rank = rng.integers(0, 4, 1 << 8).astype(np.uint8)
    for size in (9, 10, 20, 57, 148, 600):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
            drop = int(len(a) * 0.1)
            b = np.sort(np.delete(a, rng.choice(len(a), drop, replace=False)))
            if 100 * len(b) < 90 * len(a):
                continue
            for limit in (-1, 1, 9):
                x, y = (dict(zip(*(v.tolist() for v in ngram_jaccard.signatures(g, rank, limit, 90, 100, 6, 8)))) for g in (a, b))
                need = 90 * (len(a) + len(b)) / 190
                assert any(min(x[s], y[s]) >= need for s in x.keys() & y.keys())


def test_language_id(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.9
    odd = langid.predict_language(frame(spark, rows + [(600, "12 34 !?", "en", "s")])).collect()
    by = {r.doc_id: r for r in odd}
    assert len(odd) == len(rows) + 1
    assert by[400].lang_pred == by[401].lang_pred == by[402].lang_pred == by[600].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in odd)
    none = langid.predict_language(frame(spark, [(*r[:2], None, r[3]) for r in rows]))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_language_stage_rejects_noise(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    held = [i for i in range(max(ids) + 1, max(ids) + 400) if zlib.crc32(str(i).encode()) % 5 == 0]  # not learned from
    r = random.Random(7)
    noise = lambda n, letters: " ".join("".join(r.choice(letters) for _ in range(7)) for _ in range(n))
    bad = [noise(3, "bcdfghjklmnpqrstvwxz"), noise(200, "abcdefghijklmnopqrstuvwxyz0123456789"), noise(30, "абвгдежзиклмноп"), "q"]
    texts = [x.text for x in docs.where("lang is not null and length(text) > 200").limit(20).collect()]
    good = [" ".join(t.split()[5:5 + n]) for t in texts for n in (4, 8)]
    extra = list(zip(held, bad + good))
    more = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    kept = {x.doc_id for x in corpus_pipeline.language_id(spark, more, SF).collect()}
    assert len(extra) == len(bad) + len(good)
    assert kept.isdisjoint(i for i, _ in extra[:len(bad)])
    assert kept >= {i for i, _ in extra[len(bad):]}
    clean = [x.doc_id for x in docs.where("text rlike '[a-z]{3}'").collect()]
    assert len(kept & set(clean)) >= 0.98 * len(clean)


def test_presence_is_the_ngram_set():
    table, out = langid.class_table(), np.zeros(langid.SPACE, bool)
    old, langid.CHUNK = langid.CHUNK, 7
    try:
        text = "Été à la mer, 42 fois! " * 3
        assert langid.presence(text, table, out)
        parts = out.copy()
        langid.CHUNK = 1 << 20
        langid.presence(text, table, out)
    finally:
        langid.CHUNK = old
    assert (parts == out).all() and out.sum() > 20
    assert not langid.presence("12 ?", table, out)


def test_topk_against_products(spark):
    rng = np.random.default_rng(5)
    v = [(i, (rng.normal(size=12) * (1 + i % 4) / 4).tolist()) for i in range(300)]
    v += [(300 + i, v[7][1]) for i in range(30)]  # ties
    v += [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf")]), (404, []), (405, [3.0]), (None, [9.0] * 12), (420, [0.0] * 12)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F
    for rows, start in ((64, 0.0), (64, 0.9), (4096, 0.6)):
        got = topk.top_inner_products(df, F.col("vec_id") % 20 == 0, bucket_rows=rows, query_rows=7, coord_from=start).collect()
        ok = [(i, [int(np.floor(64 * x)) for x in e]) for i, e in v if e is not None and all(x is not None and np.isfinite(x) for x in e)]
        want = set()
        for q, a in ok:
            if q is None or q % 20:
                continue
            s = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0) for c, b in ok if c != q)[:20]
            want |= {(q, k + 1, None if c[1] else c[2], -c[0]) for k, c in enumerate(s)}
        assert {tuple(r) for r in got} == want


SECRETS = [
    (1, 'Password = "hunter2hunter" token=token:abcdefghij', None, None), (2, "api_key:short é AKIAABCDEFGHIJKL", None, None),
    (3, "x" + "0123456789abcdef" * 2 + " PASSWD='a.b/c+d=e' secret=" + "f" * 40, None, None), (4, None, None, None), (5, "", None, None),
    (6, "tokEN==abcdefgh AKIA1234 passwordpasswd : xxxxxxxxx", None, None), (6, "tokEN==abcdefgh AKIA1234 passwordpasswd : xxxxxxxxx", None, None),
    (None, "secret: 12345678 " * 40, None, None), (7, "a b " * 5000 + "apikey=zzzzzzzzzzzz", None, None), (8, "é\U0001f600" * 9 + "deadbeef" * 4, None, None)]


def test_secrets(spark):
    got = secrets.scan_secrets(frame(spark, SECRETS)).collect()
    want = sorted(((i, *brute.secrets(t)) for i, t, *_ in SECRETS), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert [len(r.query()) for r in secrets.BASE] == [6, 1, 0]


@pytest.mark.parametrize("length", [200, 400])
def test_suffix_dedup(spark, rows, length):
    got = suffix_dedup.remove_repeats(frame(spark, rows), length=length).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute.suffix_dedup([r[1] for r in rows], length))]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_suffix_sections_agree():
    """Blocks of a text are found alike when it is cut into sections."""
    data = np.frombuffer(prose(4, 3000).encode(), np.uint8)
    h = suffix_dedup.Hasher()
    runs = []
    for size in (1 << 22, 1500):
        old, suffix_dedup.SECTION = suffix_dedup.SECTION, size
        try:
            prints = {}
            for at, part in suffix_dedup.sections(data, 400):
                a, p0, p1, core, _ = suffix_dedup.section_blocks(h, part, 400)
                for i in range(len(a)):
                    prints.update({at + p: (at + a[i], core[i]) for p in range(p0[i], p1[i] + 1)})
        finally:
            suffix_dedup.SECTION = old
        runs.append(prints)
    assert runs[0] == runs[1] and len(runs[0]) == len(data) - 399


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/1?x", "https://a.example.com/en/", "https://example.com", "ftp://b.net/es/x#y", "http://xexample.com/en/2",
            "http://b.net/de/1", "no url", None, "http://x.org/", "http://new.com:80/a", "http://b.net/de/1"]
    got = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    by = {r.page_id: tuple(r)[1:5] for r in got}
    assert len(got) == len(urls)
    assert by[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert by[1] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert by[2][:3] == ("example.com", "", None)
    assert by[3] == ("b.net", "/es/x", "net/es/", "block")
    assert by[4] == ("xexample.com", "/en/2", "com/", "allow")
    assert by[6][:3] == by[7][:3] == ("", "", None) and by[8][3] == "allow"
    assert by[9][:2] == ("new.com:80", "/a")


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix_sizes(docs, per_range=7).collect()
    again = mixing.mix_sizes(docs.repartition(3), per_range=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert sum(r.taken for r in got) <= 1.5 * sum(r["size"] for r in got)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.taken // r["size"] for r in got if r["size"])


def test_packing_round_trip(spark, rows):
    from tokenizers import Tokenizer
    path = packing.contract_tokenizer()
    tok = Tokenizer.from_file(path)
    special = [(700, "L'été, c'est NAÏVE's <|endoftext|> éa ΣΑΣ don't 3rd x_y…!!   z\x1cq", None, None)]
    docs = rows + special
    got = packing.best_fit_pack(frame(spark, docs), path, capacity=256, group_rows=40).collect()
    tok.encode_special_tokens = True
    want = []
    for i, t, *_ in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            own = np.asarray(ids[k:k + 256], "<u4")
            want.append((i, k // 256, k, len(own), zlib.crc32(own.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 256


def test_bin_completion_beats_best_fit():
    counts = np.zeros(101, int)
    for x in (44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 50, 50, 49, 49, 36, 36, 34, 33, 33, 30):
        counts[x] += 1
    first = packing.best_fit(counts, 100)
    best = packing.complete_bins(counts, 100, 20_000)
    total = int((np.arange(101) * counts).sum())
    assert -(-total // 100) <= len(best) <= len(first)
    assert sorted(x for b in best for x in b) == sorted(np.repeat(np.arange(101), counts).tolist())
    assert all(sum(b) <= 100 for b in best)


def test_mix_documents_equals_its_sizes(spark, rows):
    """NULL sources and ids, repeated rows, equal id and text in two sources: the
    mix holds the words that ``mix_sizes`` says, source by source."""
    same = [(700, prose(5, 80), "en", "s0"), (700, prose(5, 80), "en", "s1"), (700, prose(5, 80), "fr", "s1")] * 2 + [(None, prose(6, 50), None, None)] * 3
    for docs in (rows + same, same, [(1, "", "en", "a"), (2, None, "en", None), (3, " ", "en", "a")]):
        d = frame(spark, docs)
        want = {r.source: r.words for r in mixing.fair_queue(d).groupBy("source").agg(F.sum(F.col("size") * F.col("passes")).alias("words")).collect()}
        got = {}
        for r in mixing.mix_documents(d).collect():
            got[r.source] = got.get(r.source, 0) + len(brute.WORD.findall(r.text or ""))
        assert got == {k: v for k, v in want.items() if v}


def test_backoff_edges(spark, rows):
    got = lm_score.stupid_backoff(frame(spark, rows), chunk_bytes=3000, range_grams=500).collect()
    one = lm_score.stupid_backoff(frame(spark, rows)).collect()
    order = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words, r.score or 0)
    for a, b in zip(sorted(got, key=order), sorted(one, key=order)):
        assert a.doc_id == b.doc_id and a.n_words == b.n_words and (a.score or 0) == pytest.approx(b.score or 0)
    assert {r.doc_id for r in got if r.score is None} == {400, 401, 402, None}
    alone = lm_score.stupid_backoff(frame(spark, [(1, "a b c", None, None)])).collect()[0]
    assert alone.score == pytest.approx(np.log(0.16))


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op4_exact_topk", "op8_stupid_backoff", "op9_fair_mix"])
def test_query_matches_sql(spark, name):
    assert compare(spark, SF, [name])[name][0] == "match"


def test_empty_tables(spark):
    d = frame(spark, [])
    path = packing.contract_tokenizer()
    for out in (exact_dedup.exact_dedup(d), ngram_jaccard.jaccard_components(d, bits=8), langid.predict_language(d), secrets.scan_secrets(d),
                suffix_dedup.remove_repeats(d), mixing.mix_sizes(d), mixing.mix_documents(d), packing.best_fit_pack(d, path),
                lm_score.stupid_backoff(d), url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"))):
        assert out.count() == 0


def test_pipeline_stages(spark, rows, tmp_path):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    cols = d.columns
    kept = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF).cache()
        assert out.columns == cols
        if name == "exact_dedup":
            norm = lambda t: "".join((t or "").split())
            assert sorted(norm(r.text) for r in out.collect()) == sorted({norm(r.text) for r in kept.collect()})
        if name == "ngram_jaccard":
            want = {c if c is not None else i for i, _, c in brute.jaccard_components([(r.doc_id, r.text) for r in kept.collect()], 5, 80, 100)}
            assert sorted(r.doc_id for r in out.collect()) == sorted(want)
        kept = out
    assert corpus_pipeline.run(spark, SF).count() >= kept.count()


def test_jaccard_stage_repeated_and_null_ids(spark):
    base, other = prose(41, 60), prose(42, 60)
    near = lambda k: base + f" tail{k}"
    docs = [(1, base, "en", "a"), (2, near(2), "en", "b"), (2, other, "fr", "c"), (2, prose(43, 40), "fr", "d"),
            (None, prose(44, 50), "en", "e"), (None, prose(44, 50) + " more", "en", "f"), (None, prose(44, 50), "en", "e"),
            (None, near(3), "en", "g"), (3, prose(45, 30), "en", "h"), (3, prose(45, 30), "en", "h"), (None, None, "en", "i"), (4, " ", "en", "j"), (4, " ", "en", "j")]
    got = corpus_pipeline.jaccard(spark, frame(spark, docs), SF)
    assert got.columns == frame(spark, []).columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    null = [t for i, t in got if i is None and t is not None]
    assert len(null) == 1 and null[0] in (docs[4][1], docs[5][1])
    rest = [x for x in got if x[0] is not None or x[1] is None]
    want = [(1, base), (2, other), (2, prose(43, 40)), (3, prose(45, 30)), (None, None), (4, " "), (4, " ")]
    assert sorted(rest, key=str) == sorted(want, key=str)


def test_registered():
    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {x.split("_")[0] + "_" for x in names if x.startswith("op")}
    assert "pipeline" in names
