"""Stupid-backoff LM scores, computed relationally (operator 8).

The counts of all 1- and 2-grams of all documents, and the score of every
document under the model that the other documents make (its own counts are
taken off, else every n-gram would be known):

    S(w | v) = c(v w) / c(v)             if c(v w) > 0
             = alpha * c(w) / N          else, if c(w) > 0
             = alpha * alpha / (N + 1)   else (a word of this document only)

with the own counts of the document subtracted from c and N. The first word is
scored as a 1-gram. The score is the mean of ln S over the words.

Tables: documents are dealt into chunks by a hash of id and text. A chunk
explodes its texts into its distinct n-grams with counts, cut into blocks by the
hash of the n-gram. The count table is partitioned by that hash: one group holds
the blocks of all chunks for one hash range, adds up the counts of equal n-grams
and answers every block with its totals, in the block's own order. Chunks then
meet the answers and sum per document. Blocks are arrays of hashes and counts
(12 bytes an n-gram before compression), not one row per n-gram; a frequent
n-gram comes once per chunk, however often it occurs, so none is hot.

Scale: text is shuffled once (by chunk) and used twice; n-grams once to their
hash range and their totals once back. Chunks are about ``chunk_bytes`` of text
(a longer text is a chunk of its own size; one a core at least), ranges about ``range_grams`` n-grams;
both numbers of groups follow the input. The driver reads two sums.

Words are maximal runs without ASCII white space, lower-cased A-Z, by 64-bit
hashes. Edge cases: NULL and empty texts have 0 words and a NULL score; with no
other words in the table every word is unknown; NULL ids and repeated rows are
scored row by row (a copy counts as another document). An empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, ship_by_value, text_column

ALPHA = 0.4
CHUNK_BYTES = 8 << 20
#: n-gram occurrences that one range of the count table answers
RANGE_GRAMS = 3_000_000
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def chunk_grams(texts: pa.ChunkedArray):
    """The n-grams of a chunk of texts: ``(document, 1-gram, where a 2-gram ends,
    2-gram, hashes)``. The first two are by word, in text order; the third holds
    the places of the words that have one before them, the fourth is by these.
    n-grams are numbers into the hashes, which are a pair: of the distinct
    1-grams and of the distinct 2-grams."""
    if texts.num_chunks != 1:
        texts = texts.cast(pa.large_string()).combine_chunks()
    else:
        texts = texts.chunk(0)
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = split.flatten()
    real = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty word
    if not real.all():
        words, doc = words.filter(pa.array(real)), doc[real]
    coded = words.dictionary_encode()
    one = coded.indices.to_numpy()
    distinct = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    h = np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in distinct), "<u8").astype(np.uint64)
    at = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    two, pairs = numbered(mixed(mixed(h + np.uint64(1))[one[at - 1]] ^ h[one[at]]))
    return doc, one, at, two, (mixed(h), pairs)


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every value as a number into the distinct values, and these."""
    coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_numpy()


def exploded(ranges):
    """Blocks of a chunk: ``(range, chunk, hashes, counts)``."""
    def run(rows):
        _, one, _, two, hashes = chunk_grams(rows["text"])
        n = np.concatenate([np.bincount(x, minlength=len(h)) for x, h in zip((one, two), hashes)])
        grams, where = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(where, weights=n, minlength=len(grams)).astype(np.uint32)
        # ranges are equal slices of the hash space, so a block is a slice too
        at = np.searchsorted(grams, bounds(ranges))
        blocks = [(r, x, y) for r, (x, y) in enumerate(zip(at, at[1:])) if y > x]
        return pa.table({"rng": pa.array([r for r, _, _ in blocks], pa.int32()),
                         "chunk": pa.array([rows["chunk"][0].as_py()] * len(blocks), pa.int32()),
                         "grams": pa.array([grams[x:y].tobytes() for _, x, y in blocks], pa.binary()),
                         "counts": pa.array([counts[x:y].tobytes() for _, x, y in blocks], pa.binary())})
    return run


def bounds(ranges: int) -> np.ndarray:
    """The first hash of every range, and the end of the last."""
    cuts = [(r << 64) // ranges for r in range(ranges)]
    return np.array([*cuts, (1 << 64) - 1], np.uint64)


def totals(pdf):
    """The count table of one hash range, as answers to its blocks."""
    grams = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
    counts = [np.frombuffer(c, np.uint32) for c in pdf["counts"]]
    known, where = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)
    cuts = np.cumsum([0, *map(len, grams)])
    answers = [total[where[x:y]].tobytes() for x, y in zip(cuts, cuts[1:])]
    return pd.DataFrame({"chunk": pdf["chunk"], "rng": pdf["rng"], "totals": answers})


def own_counts(doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often the word's n-gram occurs in the word's own document."""
    n = np.bincount(gram)
    own = np.ones(len(gram), np.int64)
    many = np.flatnonzero(n[gram] > 1)  # others occur once in the whole chunk
    if len(many):
        where, _ = numbered(doc[many] * np.int64(len(n)) + gram[many])
        own[many] = np.bincount(where)[where]
    return own


def scored(alpha, n_words):
    def run(rows, answers):
        doc, one, at, two, hashes = chunk_grams(rows["text"])
        lengths = np.bincount(doc, minlength=len(rows))
        parts = answers.sort_by("rng")["totals"].to_pylist()
        total = np.concatenate([np.frombuffer(t, np.int64) for t in parts]) if parts else np.zeros(0, np.int64)
        _, where = np.unique(np.concatenate(hashes), return_inverse=True)
        known = len(hashes[0])
        c1 = total[where[:known]][one] - own_counts(doc, one)
        c2 = np.zeros(len(one), np.int64)
        c2[at] = total[where[known:]][two] - own_counts(doc[at], two)
        first = np.ones(len(one), bool)
        first[at] = False
        rest = n_words - lengths[doc]  # words of the other documents
        back = np.concatenate([[0], c1[:-1]]) if len(c1) else c1  # count of the word before
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where(c2 > 0, c2 / np.maximum(back, 1),
                         np.where(c1 > 0, np.where(first, 1.0, alpha) * c1 / np.maximum(rest, 1), alpha * alpha / (rest + 1.0)))
            sums = np.bincount(doc, weights=np.log(s), minlength=len(rows))
            mean = np.where(lengths > 0, sums / np.maximum(lengths, 1), np.nan)
        return pa.table({"doc_id": rows["id"], "n_words": pa.array(lengths, pa.int64()), "score": pa.array(mean, pa.float64())})
    return run


def stupid_backoff(docs: DataFrame, *, alpha: float = ALPHA, id_col="doc_id", text_col="text",
                   chunk_bytes: int = CHUNK_BYTES, range_grams: int = RANGE_GRAMS) -> DataFrame:
    """``doc_id, n_words, score`` of every row: the mean of ln S over its words,
    NULL without words."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")), F.sum(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")))).first()
    n_bytes, n_words = (int(x or 0) for x in size)
    # at least one chunk a core, so that a small table keeps all cores busy
    chunks = max(parts_for(spark, n_bytes, chunk_bytes), spark.sparkContext.defaultParallelism)
    ranges = parts_for(spark, 2 * n_words, range_grams)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(chunks)).cast("int"))
    # one shuffle of the text, for counting and scoring alike
    dealt = dealt.repartition(chunks, "chunk").sortWithinPartitions("chunk", F.xxhash64(F.col("id").cast("string"), "text"))
    blocks = dealt.groupBy("chunk").applyInArrow(exploded(ranges), "rng int, chunk int, grams binary, counts binary")
    answers = blocks.groupBy("rng").applyInPandas(totals, "chunk int, rng int, totals binary")
    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        scored(alpha, n_words), f"doc_id {kind}, n_words long, score double")
    return out.select("doc_id", "n_words", F.when(F.col("n_words") > 0, F.col("score")).alias("score"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v FROM d, unnest(range(1, len(ws) + 1)) t(i)),
n AS (SELECT count(*) AS n FROM w),
c1 AS (SELECT w, count(*) AS c FROM w GROUP BY w), o1 AS (SELECT r, w, count(*) AS c FROM w GROUP BY r, w),
c2 AS (SELECT v, w, count(*) AS c FROM w WHERE v IS NOT NULL GROUP BY v, w),
o2 AS (SELECT r, v, w, count(*) AS c FROM w WHERE v IS NOT NULL GROUP BY r, v, w),
s AS (SELECT w.r, w.v, c1.c - o1.c AS cw, coalesce(b1.c - p1.c, 0) AS cv, coalesce(c2.c - o2.c, 0) AS cvw,
             n.n - len(d.ws) AS rest
      FROM w JOIN c1 ON w.w = c1.w JOIN o1 ON w.r = o1.r AND w.w = o1.w
      LEFT JOIN c1 b1 ON w.v = b1.w LEFT JOIN o1 p1 ON w.r = p1.r AND w.v = p1.w
      LEFT JOIN c2 ON w.v = c2.v AND w.w = c2.w LEFT JOIN o2 ON w.r = o2.r AND w.v = o2.v AND w.w = o2.w
      JOIN d ON w.r = d.r, n),
t AS (SELECT r, avg(ln(CASE WHEN cvw > 0 THEN cvw / cv WHEN cw > 0 THEN CASE WHEN v IS NULL THEN 1.0 ELSE 0.4 END * cw / rest
                       ELSE 0.4 * 0.4 / (rest + 1) END)) AS score FROM s GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, round(t.score, 6) AS score FROM d LEFT JOIN t ON d.r = t.r
"""

ship_by_value(__name__)
