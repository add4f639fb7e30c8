"""Findings of the third round on the training-data operators."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from eddy.llm import ngram_jaccard, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_low_thresholds_lose_no_link(spark, monkeypatch):
    """Sets of one to four n-grams, most of them frequent: links that share one."""
    monkeypatch.setattr(ngram_jaccard, "FREQUENT", 0.01)
    r = random.Random(3)
    docs = [(i, " ".join(r.choice("abcdefghij") + r.choice("xyz") for _ in range(r.randint(1, 4))), "en", "s") for i in range(60)]
    for num in (34, 50):
        got = ngram_jaccard.jaccard_components(frame(spark, docs), n=1, num=num, den=100, bits=8)
        want = {i: c for i, _, c in brute.jaccard_components([x[:2] for x in docs], 1, num, 100)}
        assert {x.doc_id: x.component_id for x in got.collect()} == want


def test_op1_counts_links(spark, tmp_path):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base), " ".join([*base, "end"]), "something else here now", None]
    frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.n_links for x in queries.QUERIES["op1_ngram_jaccard"](spark, str(tmp_path)).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 0, 4: 0}


def test_predicted_language_decides_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.where("lang is not null and length(text) > 200").orderBy("doc_id").limit(30)
    given = {x.doc_id: x.lang for x in some.collect()}
    unlabelled = docs.unionByName(some.selectExpr("doc_id + 1000000 as doc_id", "text"), allowMissingColumns=True)
    kept = corpus_pipeline.language_id(spark, unlabelled, SF).where("doc_id >= 1000000").collect()
    assert len(kept) == 30 and sum(x.lang == given[x.doc_id - 1000000] for x in kept) >= 27
    # one source: three parts of one language to one of the other
    rows = [(i, " ".join(f"t{i}w{k}" for k in range(20)), "en" if i % 2 else "fr", "s") for i in range(40)]
    taken = corpus_pipeline.mix_sources(spark, frame(spark, rows), SF).groupBy("lang").count().collect()
    assert {x.lang: x["count"] for x in taken} == {"en": 40, "fr": 20}
