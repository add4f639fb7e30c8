"""Findings of the third round on the memory and disk of text operators."""

import random

import pyarrow as pa
import pyarrow.parquet as pq

from eddy.llm import common, ngram_jaccard, suffix_dedup


def test_suffixes_leave_in_bounded_batches():
    """op6: the suffixes of a batch of texts leave Python in parts, none lost."""
    r = random.Random(3)
    texts = [bytes(r.choices(range(97, 123), k=6000)) for _ in range(120)]
    blocks = [[{"core": 1, "dig": i, "p0": 0, "p1": len(t) - 400}] for i, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([bytes([i]) for i in range(120)], pa.binary()), pa.array([t.decode() for t in texts]), pa.array(blocks)],
        names=["sha", "text", "blocks"])
    got = list(suffix_dedup.block_suffixes(400)([batch]))
    sizes = [sum(len(x) // 8 for x in b.column(4).to_pylist()) for b in got]
    assert max(sizes) <= suffix_dedup.HELD_SUFFIXES + 5601 and sum(sizes) == 120 * 5601


def test_spent_signatures_are_freed(spark, monkeypatch):
    """op1, pipeline: signatures of all rows don't stay on disk beside those of the
    distinct sets."""
    paths = []
    path_of = common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda s, name: paths.append(path_of(s, name)) or paths[-1])
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    text = [" ".join(r.choices(words, k=80)) for _ in range(20)]
    docs = spark.createDataFrame([(i, text[i % 20]) for i in range(60)], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in ngram_jaccard.jaccard_components(docs).collect()}
    assert got == {i: i % 20 for i in range(60)}
    held = [sum(x is not None for x in t["sigs"].to_pylist()) for t in map(pq.read_table, paths) if "sigs" in t.column_names]
    assert held == [20]
