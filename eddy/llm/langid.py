"""Language ID with string kernels (operator 2).

A text is mapped to a string of letter classes (a-z each its own, other letters
hashed by lower-cased code point into 37 classes, runs of non-letters one gap).
Its blended spectrum is the set of 1-, 2- and 3-grams that occur in that
string; the kernel of two texts is the number of n-grams present in both,
divided by the root of the product of their set sizes. The n-gram codes are
exact (6 bits a class), nothing is hashed further.

Nystroem landmarks (some training texts of each language) turn the kernel into
features ``K(x, landmarks) K_mm^(-1/2)``, on which one-versus-rest kernel ridge
regression is solved in closed form on the driver. Scoring is a batched matrix
product: presence rows times landmark presences, scaled, times coefficients.

Learning uses text and non-NULL language of rows outside the held-out fold only,
and at most ``max_train`` of them: an equal number of each language, those with
the smallest hash of (id, text). Their presence sets (33 kB each, whatever the
length of the text) are all that the driver reads; the model it broadcasts is
bounded by ``max_landmarks`` times the code space. Prediction reads whole texts,
a million characters at a time, in one pass without a shuffle, so a hot
language or source makes no difference.

The scores of all languages sum to 1 for every text, so the best one says which
language but not whether it is any. ``known`` says that: the share of the text's
own 3-grams that occur in learning texts, divided by that share's median over the
learning rows (each held against the others), at most 1. It hardly depends on a
text's length; a text without a 3-gram (a single letter) has 0.

Edge cases: NULL text or a text without a letter is ``und`` with score 0; if
nothing can be learned, every row is. NULL ids count as the empty string in
the fold. Repeated rows count once in learning and are each predicted. Of tied
scores the smaller language wins. An empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_texts, ship_by_value, small_batches

#: rows that learning may use, over all languages
MAX_TRAIN = 768
#: landmarks over all languages
MAX_LANDMARKS = 64
RIDGE = 1e-2
#: every FOLDS-th id, by CRC, is held out
FOLDS = 5
CLASSES = 64
#: code space: 1-, 2- and 3-grams of classes
SPACE = CLASSES + CLASSES ** 2 + CLASSES ** 3
#: where the 3-grams begin in it
TRIGRAMS = CLASSES + CLASSES ** 2
BATCH = 128
#: languages up to which the sampling limits are broadcast instead of shuffled
MAX_BROADCAST = 10_000
CHUNK = 1 << 20


def class_table() -> np.ndarray:
    """Letter class of every code point; 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000 or not (ch := chr(cp)).isalpha():
            continue
        low = ord(ch.lower()[0])
        out[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % 37
    return out


def presence(text: str, table: np.ndarray, out: np.ndarray) -> bool:
    """Set ``out`` (``SPACE`` booleans) to the text's n-gram set; False if the
    text has no letter."""
    out[:] = False
    tail, any_letter = np.zeros(1, np.int32), False
    for at in range(0, len(text), CHUNK):
        c = table[np.frombuffer(text[at:at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int32)
        any_letter = any_letter or bool(c.any())
        c = np.concatenate([tail, c])
        c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # one gap for a run of them
        out[c] = True
        two = c[:-1] * CLASSES + c[1:]
        out[CLASSES + two] = True
        if len(c) > 2:
            out[CLASSES + CLASSES ** 2 + two[:-1] * CLASSES + c[2:]] = True
        tail = c[-2:]
    return any_letter


def held_out(id_col: str) -> Column:
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return crc % F.lit(FOLDS) == 0


def training_rows(docs: DataFrame, id_col, text_col, lang_col, max_train, table) -> list:
    """``(lang, h, packed presence)`` of the learning sample."""
    spark = docs.sparkSession
    rows = (docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                    F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h")))
    n_langs = rows.agg(F.countDistinct("lang")).first()[0]
    if not n_langs:
        return []
    each = max(1, max_train // n_langs)
    small = rows.select("lang", "h").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    limits = (small.withColumn("r", rank).where(F.col("r") <= each)
              .groupBy("lang").agg(F.max("h").alias("most")))
    if n_langs <= MAX_BROADCAST:  # one row of a label and a number per language
        limits = F.broadcast(limits)
    picked = rows.join(limits, "lang").where(F.col("h") <= F.col("most")).select("lang", "h", "text")
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        out = np.zeros(SPACE, bool)
        for b in batches:
            sets = [np.packbits(out).tobytes() if presence(t, shared.value, out) else None for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.binary())], names=["lang", "h", "bits"])

    packed = picked.mapInArrow(run, "lang string, h long, bits binary").where("bits is not null")
    once = packed.groupBy("lang", "h").agg(F.first("bits").alias("bits"))
    return sorted(once.collect(), key=lambda r: (r["lang"], r["h"]))


def fit(sample: list, max_landmarks: int, ridge: float):
    """``(languages, vocabulary, landmark presences, coefficients, bias)``."""
    langs = sorted({r["lang"] for r in sample})
    each = max(1, max_landmarks // len(langs))
    by = {g: [r for r in sample if r["lang"] == g] for g in langs}
    unpack = lambda r: np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=SPACE).astype(bool)
    marks = np.array([unpack(r) for g in langs for r in by[g][:each]])
    vocab = np.flatnonzero(marks.any(0))
    size_m = marks.sum(1)
    p = marks[:, vocab].astype(np.float32) / np.sqrt(size_m)[:, None].astype(np.float32)
    x = np.empty((len(sample), len(vocab)), np.float32)
    size_x = np.empty(len(sample))
    for i, r in enumerate(sample):
        own = unpack(r)
        x[i], size_x[i] = own[vocab], own.sum()
    k_mm = (p @ p.T).astype(np.float64)
    val, vec = np.linalg.eigh(k_mm)
    val = np.maximum(val, 1e-6)
    root = vec @ np.diag(val ** -0.5) @ vec.T
    phi = (x @ p.T).astype(np.float64) / np.sqrt(size_x)[:, None] @ root
    phi = np.hstack([phi, np.ones((len(phi), 1))])
    y = np.array([[float(r["lang"] == g) for g in langs] for r in sample])
    reg = ridge * np.eye(phi.shape[1])
    reg[-1, -1] = 1e-9
    w = np.linalg.solve(phi.T @ phi + reg, phi.T @ y)
    return langs, vocab, p, (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)


def learned_trigrams(sample: list) -> tuple[np.ndarray, float]:
    """The 3-grams of the learning texts (booleans), and the median over these
    texts of the share of their 3-grams that another one has."""
    seen = np.zeros(SPACE - TRIGRAMS, np.int32)
    own = [np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=SPACE)[TRIGRAMS:]) for r in sample]
    for x in own:
        seen[x] += 1
    shares = [float((seen[x] > 1).mean()) for x in own if len(x)]
    return seen > 0, float(np.median(shares)) if shares else 0.0


def known_share(grams: np.ndarray, learned: np.ndarray, usual: float) -> float:
    n = np.count_nonzero(grams[TRIGRAMS:])
    return min(1.0, np.count_nonzero(grams[TRIGRAMS:] & learned) / n / max(usual, 1e-9)) if n else 0.0


def labelled(batch, langs, scores, known):
    """``batch`` without its own text column, with language, score and known share."""
    keep = [n for n in batch.schema.names if n != "text"]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(n) for n in keep], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(known, pa.float64())],
        names=[*keep, "lang_pred", "score", "known"])


def score(model, field):
    def run(batches):
        table, (langs, vocab, p, coef, bias), (learned, usual) = model.value
        out, x = np.zeros(SPACE, bool), np.zeros((BATCH, len(vocab)), np.float32)
        for b in batches:
            texts = batch_texts(b, field)
            pred, best, known = [], [], []
            for at in range(0, len(texts), BATCH):
                part = texts.slice(at, BATCH).to_pylist()
                size = np.ones(len(part), np.float32)
                live = np.zeros(len(part), bool)
                for i, t in enumerate(part):
                    live[i] = t is not None and presence(t, table, out)
                    if live[i]:
                        x[i], size[i] = out[vocab], np.count_nonzero(out)
                    known.append(known_share(out, learned, usual) if live[i] else 0.0)
                f = (x[:len(part)] @ p.T) / np.sqrt(size)[:, None] @ coef + bias
                top = f.argmax(1)
                pred += [langs[k] if ok else "und" for k, ok in zip(top, live)]
                best += [float(min(max(f[i, k], 0.0), 1.0)) if live[i] else 0.0 for i, k in enumerate(top)]
            yield labelled(b, pred, best, known)
    return run


def undecided(batches):
    for b in batches:
        yield labelled(b, ["und"] * b.num_rows, *[[0.0] * b.num_rows] * 2)


def predict_language(docs: DataFrame, *, id_col="doc_id", text_col="text", lang_col="lang",
                     max_train: int = MAX_TRAIN, max_landmarks: int = MAX_LANDMARKS,
                     ridge: float = RIDGE, carry: tuple[str, ...] = (), known: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``, a
    struct ``extra`` of the columns named in ``carry`` and, if asked for, ``known``."""
    spark = docs.sparkSession
    small_batches(spark)
    table = class_table()
    sample = training_rows(docs, id_col, text_col, lang_col, max_train, table)
    field = carry.index(text_col) if text_col in carry else None
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       *([F.col(text_col).alias("text")] if field is None else []),
                       *([F.struct(*[F.col(c) for c in carry]).alias("extra")] if carry else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    schema += ", lang_pred string, score double, known double"
    if sample:
        model = spark.sparkContext.broadcast((table, fit(sample, max_landmarks, ridge), learned_trigrams(sample)))
    out = rows.mapInArrow(score(model, field) if sample else undecided, schema)
    return out if known else out.drop("known")


def keep_confident(docs: DataFrame, *, min_score: float, label: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` in one of the languages learned: those that are not
    ``und`` and whose ``known`` is at least ``min_score``. The column ``label``, if
    named, then holds the predicted language."""
    if not 0 <= min_score <= 1 or math.isnan(min_score):
        raise ValueError("min_score must lie in [0, 1]")
    p = predict_language(docs, carry=tuple(docs.columns), known=True, **options)
    kept = p.where((F.col("lang_pred") != "und") & (F.col("known") >= min_score))
    return kept.select(*[F.col("lang_pred").alias(c) if c == label else F.col(f"extra.`{c}`") for c in docs.columns])


ship_by_value(__name__)
