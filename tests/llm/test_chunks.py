"""Chunks of op8 and the word table of op10, which work on Arrow arrays."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eddy.llm import lm_score, packing

TEXTS = ["a b a b c", "", " \x0b", "\tB a\x0bÉ é\n\nb\r", "x\x1cy \x85 z", "a  b", "one"]


def test_chunk_counts_are_those_of_plain_python():
    doc, one, at, two, (words, pairs) = lm_score.chunk_grams(pa.chunked_array([TEXTS]))
    split = [t.encode().lower().split() for t in TEXTS]
    assert np.bincount(doc, minlength=len(TEXTS)).tolist() == [len(w) for w in split]
    flat = [w for ws in split for w in ws]
    assert len(words) == len(set(flat)) and Counter(Counter(one.tolist()).values()) == Counter(Counter(flat).values())
    both = [x for ws in split for x in zip(ws, ws[1:])]
    assert len(at) == len(two) == len(both) and Counter(Counter(two.tolist()).values()) == Counter(Counter(both).values())
    assert len(pairs) == len(set(both))
    own = [Counter(ws)[w] for ws in split for w in ws]
    assert lm_score.own_counts(doc, one).tolist() == own


def test_ids_beside_a_null_id_stay_whole(spark):
    rows = [(None, "a b"), ((1 << 53) + 1, "a b c"), ((1 << 60) + 7, None)]
    got = lm_score.stupid_backoff(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=1 << 20).collect()
    assert {(r.doc_id, r.n_words) for r in got} == {(None, 2), ((1 << 53) + 1, 3), ((1 << 60) + 7, 0)}


@pytest.mark.parametrize("held", [500_000, 40])
def test_word_table_gives_the_tokenizers_ids(held, monkeypatch):
    """Also when the table is full at every call: words met lately stay known."""
    monkeypatch.setattr(packing, "CACHE_WORDS", held)
    r = random.Random(3)
    marks = [chr(c) for c in range(0xa1, 0x250) if chr(c) != "İ"] + list("abcXYZ.,'!_-01") + ["漢", "σ", "Ж", "'s"]
    texts = ["", " ", "\t a\n\nb\r"] + [" ".join("".join(r.choice(marks) for _ in range(r.randrange(6))) for _ in range(30)) for _ in range(200)]
    enc = packing.WordEncoder(packing.contract_tokenizer())
    want = [np.asarray(e.ids, "<u4").tobytes() for e in enc.tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x for i in range(0, len(texts), 20) for x in enc.encode(texts[i:i + 20])] == want
    if held < 100:
        enc.encode(["gamma " + " ".join(f"w{i}" for i in range(60))])
        new = []
        monkeypatch.setattr(enc, "learn", new.extend)  # a word of the table before is not learned again
        assert enc.encode(["gamma"]) and new == []


def test_slices_hold_every_text():
    texts = pa.array(["a" * 7, "", "é" * 4, "b"])
    assert [(at, part.to_pylist()) for at, part in packing.slices(texts, 8)] == [(0, ["a" * 7, "", "é" * 4]), (3, ["b"])]
